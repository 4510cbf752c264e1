"""Hard negatives against scores of all pairs."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlab.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, is_anchor, low=30, high=90):
    """Sorted result tuples of plain loops over all pairs."""
    kept = [(i, v, lab) for i, v, lab in rows if i is not None and v is not None and lab is not None and None not in v and all(map(math.isfinite, v))]
    ints = [[max(-(1 << 24), min(1 << 24, math.floor(256 * float(np.float32(x))))) for x in v] for _, v, _ in kept]
    out = []
    for a, (ai, av, al) in enumerate(kept):
        if not is_anchor(ai):
            continue
        scored = sorted((-sum(x * y for x, y in zip(ints[a], ints[b])), bi, bl) for b, (bi, bv, bl) in enumerate(kept) if b != a and len(bv) == len(av))
        for s, p, _ in [x for x in scored if x[2] == al][:5]:
            fit = [(n, i) for n, i, lab in scored if lab != al and low * -s <= 100 * -n <= high * -s][:10]
            out += [(ai, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = hn.mine(df, F.col("vec_id") % 5 == 0, **options)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    return sorted(map(tuple, got.collect()))


def made(n, dim, labels, seed):
    rnd = random.Random(seed)
    return [(i, [rnd.gauss(0.2, 0.5) for _ in range(dim)], rnd.randrange(labels)) for i in range(n)]


def test_scores_are_exact_inner_products():
    rnd = np.random.RandomState(3)
    for dim, size in ((1, 5), (8, 300), (13, 1 << 24), (64, 200)):
        a, c = rnd.randint(-size, size, (7, dim)), rnd.randint(-size, size, (50, dim))
        c[0], c[1] = -size, size
        bits = hn.bit_planes(c)
        assert (hn.scores(hn.subset_sums(a), bits) == c @ a.T).all()
        assert (hn.scores(hn.narrow(hn.subset_sums(a), bits.shape[1]), bits) == c @ a.T).all()
    zero = np.zeros((3, 4), dtype=np.int64)
    assert hn.bit_planes(zero).shape == (3, 1, 1) and (hn.scores(hn.subset_sums(zero), hn.bit_planes(zero)) == 0).all()


def test_best_keeps_ties_by_id():
    rnd = random.Random(1)
    best, every = hn.Best(3, 4), [[], [], []]
    for _ in range(20):
        n = 50
        score = np.array([[rnd.randrange(4) for _ in range(3)] for _ in range(n)])
        allowed = np.array([[rnd.random() < 0.7 for _ in range(3)] for _ in range(n)])
        ids = np.array([rnd.randrange(1000) for _ in range(n)])
        uid = np.arange(n) + 1000 * len(every[0])
        best.offer(score, allowed, [ids, np.zeros(n, dtype=np.int64), uid], 0)
        for j in range(3):
            every[j] += [(-int(score[i, j]), int(ids[i]), 0, int(uid[i])) for i in range(n) if allowed[i, j]]
    for j in range(3):
        assert sorted(map(tuple, best.rows[1:5, best.rows[0] == j].T.tolist())) == sorted(every[j])[:4]


def test_equals_all_pairs_in_many_blocks(spark, monkeypatch):
    rows = made(160, 9, 3, 2)
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and mined(spark, rows) == want
    for name, value in (("LEAST_CHUNK", 16), ("CHUNK_BYTES", 64), ("GROUP_BYTES", 64), ("TABLE_BYTES", 1), ("SLICE", 7)):
        monkeypatch.setattr(hn, name, value)
    assert mined(spark, rows) == want


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = made(30, 4, 2, 5) + [(None, [1.0, 1.0, 1.0, 1.0], 0), (100, None, 0), (105, [1.0, None, 1.0, 1.0], 0), (110, [1.0, 1.0, inf, 1.0], 1),
                                (115, [nan, 1.0, 1.0, 1.0], 1), (120, [1.0, 1.0, 1.0, 1.0], None), (125, [1.0, 2.0], 0), (126, [1.0, 2.0], 0),
                                (127, [0.5, 1.0], 1), (130, [], 0), (131, [], 0), (132, [], 1), (135, [0.0] * 4, 0), (140, [3e38, -3e38, 1.0, 0.0], 1)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_repeated_rows_and_ties(spark):
    base = made(12, 3, 2, 8)
    rows = base * 4 + [(50, [0.5, 0.5, 0.5], 0)] * 8 + [(51, [0.25, 0.25, 0.25], 1)] * 12
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_one_label_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(hn, "LEAST_CHUNK", 32)
    rows = [(i, v, 0 if i % 10 else lab) for i, v, lab in made(300, 6, 4, 11)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


@pytest.mark.parametrize("rows", [[], [(1, [1.0], 0)], [(0, [1.0], 0)], [(0, [1.0], 0), (1, [1.0], 0)]])
def test_small_tables_give_nothing(spark, rows):
    assert mined(spark, rows) == []
