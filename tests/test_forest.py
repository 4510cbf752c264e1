"""Random forest from cells: its trees against plain loops over the same bootstrap, whichever way they are grown."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlab.operators import forest, model

FEATS = ["a", "b", "c"]


def _rows(spark, n, seed=3):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 6)), rnd.choice([0.0, 0.5, 9.0]), round(rnd.random(), 2)) for _ in range(n)]
    return spark.createDataFrame([(*r, r[0] * 2 - (r[1] == 9.0) * r[0] + rnd.randint(0, 3)) for r in rows] + [(1.0, 0.0, 0.5, 4.0)] * (n // 4),
                                 "a double, b double, c double, y double")


def _plain(rows, depth):
    """(feature, threshold, left, right) or mean, by trying every split of weighted rows (x, y, w)."""
    w, s, q = sum(r[2] for r in rows), sum(r[1] * r[2] for r in rows), sum(r[1] ** 2 * r[2] for r in rows)
    best = None
    for f in range(len(rows[0][0])) if depth else ():
        for cut in sorted({r[0][f] for r in rows})[:-1]:
            left = [r for r in rows if r[0][f] <= cut]
            lw, ls = sum(r[2] for r in left), sum(r[1] * r[2] for r in left)
            gain = ls ** 2 / lw + (s - ls) ** 2 / (w - lw) - s ** 2 / w
            if gain > 1e-12 * q and (best is None or gain > best[0] * (1 + 1e-9)):
                best = gain, f, cut
    if best is None:
        return s / w
    _, f, cut = best
    return f, cut, _plain([r for r in rows if r[0][f] <= cut], depth - 1), _plain([r for r in rows if r[0][f] > cut], depth - 1)


def _of(tree, x):
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree



@pytest.mark.parametrize("local", [forest.LOCAL_ENTRIES, 5])
def test_trees_equal_plain_loops_on_the_same_bootstrap(spark, local):
    df = _rows(spark, 120)
    edges = forest.all_edges(df, FEATS)
    entries = forest.drawn(forest.to_counts(df, FEATS, "y", edges), 3, 4, 42)
    drawn = [[((r["_b0"], r["_b1"], r["_b2"]), r["s"] / r["w"], r["w"]) for r in entries.filter(F.col("tree") == t).collect()] for t in range(4)]
    fitted = forest.fit_forest(df, FEATS, "y", 4, 6, 42, local_entries=local)
    plain = [_plain(d, 6) for d in drawn]
    for r in fitted.transform(df).collect():
        x = [int(np.searchsorted(edges[f], r[c], side="right")) for f, c in enumerate(FEATS)]
        assert r["prediction"] == pytest.approx(sum(_of(t, x) for t in plain) / 4, abs=1e-9)


def test_a_forest_does_not_depend_on_partitions_or_on_the_way_it_grows(spark):
    df = _rows(spark, 300)
    one = forest.fit_forest(df.coalesce(1), FEATS, "y", 5, 20, 7).stages[-1].toDebugString.split("\n", 1)[1]
    two = forest.fit_forest(df.repartition(7), FEATS, "y", 5, 20, 7, local_entries=9).stages[-1].toDebugString.split("\n", 1)[1]
    assert [x.split("(uid")[0] for x in one.splitlines() if "Predict" not in x] == [x.split("(uid")[0] for x in two.splitlines() if "Predict" not in x]


def test_draws_are_poisson():
    h = np.random.default_rng(5).integers(-(1 << 63), (1 << 63) - 1, 4000)
    u = forest.uniform(h, np.arange(20))
    assert 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.01 and abs(np.corrcoef(u[:, 0], u[:, 1])[0, 1]) < 0.06
    for mean in (1, 7, 500, 100_000):
        k = forest.poisson(u, mean)
        assert abs(k.mean() - mean) < 5 * (mean / k.size) ** 0.5 and abs(k.var() / mean - 1) < 0.05


def test_copies_far_over_one_group_and_few_rows(spark):
    many = spark.range(60_000).select((F.col("id") % 2).cast("double").alias("a"), F.lit(0.0).alias("b"), F.lit(1.0).alias("c"), (F.col("id") % 2 * 5.0).alias("y"))
    fitted = model.train_random_forest(many, FEATS, "y")
    assert fitted.stages[-1].getNumTrees == 100 and fitted.stages[-1].totalNumNodes == 300
    assert {(r["a"], r["prediction"]) for r in fitted.transform(many).select("a", "prediction").distinct().collect()} == {(0.0, 0.0), (1.0, 5.0)}
    single = model.train_random_forest(many.limit(1), FEATS, "y")
    assert single.stages[-1].getNumTrees == 100 and single.transform(many.limit(1)).first()["prediction"] == 0.0
    with pytest.raises(ValueError, match="no training rows"):
        model.train_random_forest(many.limit(0), FEATS, "y")


def test_rare_values_keep_a_bin_of_their_own(spark):
    df = spark.range(5000).select((F.col("id") == 77).cast("double").alias("a"), (F.col("id") % 20).cast("double").alias("b"),
                                  F.col("id").cast("double").alias("c"), F.when(F.col("id") == 77, 1000.0).otherwise(0.0).alias("y"))
    edges = forest.all_edges(df, FEATS)
    assert edges[0] == [1.0] and edges[1] == [float(i) for i in range(1, 20)] and 20 <= len(edges[2]) <= 32
    fitted = forest.fit_forest(df, ["a", "b"], "y", 10, 4, 1)
    got = {r["a"]: r["p"] for r in fitted.transform(df).groupBy("a").agg(F.max("prediction").alias("p")).collect()}
    assert got[0.0] == 0.0 and got[1.0] > 100
