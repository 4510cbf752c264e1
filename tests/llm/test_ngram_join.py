import random
import re
from collections import Counter

import numpy as np

from transitlab.llm import common
from transitlab.llm import ngram_join as nj

SCHEMA = "doc_id long, text string, size string"


def sets(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    """(class_id, n_links) of every row by comparing all pairs."""
    s = [sets(t) for _, t, *_ in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and s[i] and s[j] and 5 * len(s[i] & s[j]) >= 4 * len(s[i] | s[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(links[i])))
    return Counter(out)


def corpus():
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows, i = [], 0
    passage = [rnd.choice(words) for _ in range(60)]
    for g in range(25):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 5, 30, 120, 300]))]
        if g % 3 == 0:
            base = base + passage
        for _ in range(rnd.choice([1, 2, 6, 20])):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                w[rnd.randrange(len(w))] = rnd.choice(words)
            rows.append((i, " ".join(w) + rnd.choice(["", ".", "!\n"]), "x"))
            i += 1
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, "...", "x"), (1003, "Hi there", "x"), (1004, "hi, THERE!", "x"), (3, rows[3][1], "x"),
             (None, rows[0][1], "x"), (None, "lonely words without any partner at all", "x"), (1005, "w1 " * 60_000, "x")]
    return rows


def test_equals_brute_force_over_all_pairs(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in nj.similar_documents(df).collect())
    assert got == brute(rows)
    kept = nj.keep_one(df)
    assert kept.columns == df.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    again = brute([(i, t) for i, t in left])
    assert all(n == 0 for _, _, n in again.elements())           # no two of what stays are alike
    groups = {c for (_, c, _), k in brute(rows).items() if c is not None}
    assert {i for i, _ in left if i is not None} == groups
    assert len(left) == len(groups) + 1                          # and the partnerless row without an id


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert nj.similar_documents(df).count() == 0 and nj.keep_one(df).count() == 0


def test_blocks_cover_every_pair_once(spark):
    rows = [(7, i) for i in range(60)] + [(8, i) for i in range(3)]
    df = spark.createDataFrame(rows, "g long, x long").selectExpr("g", "x", "if(g = 7, 60L, 3L) AS m")
    members = {}
    for r in common.blocks(df, "g", "m", "x", 16).collect():
        members.setdefault((r["g"], r["block"]), []).append((r["x"], r["part"]))
    pairs = Counter()
    for (g, _), ms in members.items():
        several = len({p for _, p in ms}) > 1
        for a, p in ms:
            for b, q in ms:
                if a < b and (not several or p != q):
                    pairs[g, a, b] += 1
    assert all(v == 1 for v in pairs.values()) and len(pairs) == 60 * 59 // 2 + 3


def test_posterior_rule_by_simulation():
    rules = dict(nj.least_matches())
    rnd = np.random.RandomState(0)
    for k, least in rules.items():
        matches = rnd.binomial(k, 0.8, 200_000)
        assert (matches < least).mean() < 1e-4
    assert rules[nj.HASHES] > 0.55 * nj.HASHES


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (1, 0)]
    got = dict(common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(31)}, **{100 + i: 100 for i in range(40)}}
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
