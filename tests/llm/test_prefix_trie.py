"""The prefix trie against plain loops over all prefixes."""
import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from transitlab.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth string, node int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, v in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = turns.get(c - int(np.fmod(c, 20)), [])[:h] + v[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].add(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) if kids[p] else 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        saved[p] = (len(members[p]) - 1) * words + sum(saved[k] for k in kids[p])
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items()))


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    got = pt.prefix_trie(df, **options)
    assert got.columns == COLUMNS
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in got.collect())


def random_rows(n, seed, words=("a b", "b", "", "c\tc c")):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(words)) for c in range(n) for t in range(rnd.randrange(0, 6))]


def test_arrays_equal_plain_sums():
    rnd = np.random.RandomState(4)
    for shape in ("random", "chain", "star", "forest"):
        n = 400
        up = np.array([0] + [{"random": rnd.randint(0, i), "chain": i - 1, "star": 0, "forest": i if rnd.rand() < 0.1 else rnd.randint(0, i)}[shape]
                             for i in range(1, n)])
        own = rnd.randint(1, 5, n)
        values = rnd.randint(0, 10, (2, n))
        weight, want = own.astype(np.int64), values.astype(np.int64)
        for i in range(n - 1, 0, -1):
            if up[i] != i:
                weight[up[i]] += weight[i]
                want[:, up[i]] += want[:, i]
        assert (pt.decompose(up, weight, values.astype(np.int64)) == want).all()


def test_equals_brute_force_in_one_task_and_in_rounds(spark):
    rows = random_rows(60, 1)
    want = brute(rows)
    assert found(spark, rows) == want
    assert found(spark, rows, task_nodes=40) == want


def test_a_deep_conversation_and_its_copies(spark):
    long = [(c, t, "user", f"turn {t}") for c in (0, 20, 40) for t in range(60)]
    rows = long + [(60, t, "user", f"turn {t}") for t in range(30)] + random_rows(10, 3)
    assert found(spark, rows, task_nodes=16) == brute(rows)


def test_nulls_repeats_and_turnless_conversations(spark):
    rows = [(None, 0, "user", "lost"), (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 5, "user", "x y"), (-3, 0, "user", "z"),
            (7, 0, "user", "only"), (8, 0, "user", "only"), (9, 0, "user", "only"), (9, 1, "", "only"), (10 ** 12, 0, "user", "only")]
    want = brute(rows)
    assert found(spark, rows) == want
    assert any(zlib.crc32(str(c).encode()) % 4 >= 1 and c in (7, 8, 9) for c in (7, 8, 9))      # some of them have no turn left


def test_repeated_turn_numbers_keep_their_rows(spark):
    rows = [(0, 1, "user", x) for x in "abcab"] + [(20, 1, "user", x) for x in "bacba"]
    got = found(spark, rows)
    # the order among equal turn numbers goes by a hash, the same in both conversations
    assert max(r[1] for r in got) >= 4 and sum(r[3] for r in got if r[1] == 0) == 2


def test_one_conversation_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(3, t, "user", f"w{t % 7} v") for t in range(200)] + [(c, 0, "user", "w0 v") for c in range(20, 40)]
        assert found(spark, rows) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_member_lists_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(pt, "PIECE", 16)
    rows = [(c, 0, "user", "same") for c in range(0, 4000, 20)]
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")]])
def test_empty_tables(spark, rows):
    assert found(spark, rows) == []


def test_a_lone_turn(spark):
    assert found(spark, [(4, 0, "user", "hi there")]) == brute([(4, 0, "user", "hi there")])
