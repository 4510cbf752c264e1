"""Exact quantiles over ranges against plain sorting, and the statistics that use them."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from transitlab.operators import delays, quantiles

SCHEMA = "k string, g int, x double"


def plain(rows, share):
    by = {}
    for k, g, x in rows:
        if x is not None:
            by.setdefault((k, g), []).append(x)
    return {key: float(np.quantile(v, share)) for key, v in by.items()}


def test_equals_sorting(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, "a", "b"]), rnd.choice([1, 2, None]), rnd.choice([None, float(rnd.randrange(6)), rnd.gauss(0, 1)])) for _ in range(600)]
    rows += [("one", 1, 5.0), ("two", 1, 1.0), ("two", 1, 4.0), ("none", 1, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = quantiles.group_quantiles(df, ["k", "g"], "x", [0.5, 0.9, 0.0, 1.0], ["q50", "q90", "q0", "q1"]).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for name, share in (("q50", 0.5), ("q90", 0.9), ("q0", 0.0), ("q1", 1.0)):
        want = plain(rows, share)
        assert {(r.k, r.g): r[name] for r in got}.keys() == want.keys()
        assert all(abs(r[name] - want[(r.k, r.g)]) < 1e-9 for r in got)


def test_without_keys_and_without_values(spark):
    df = spark.createDataFrame([("a", 1, float(i)) for i in range(10)], SCHEMA)
    assert quantiles.group_quantiles(df, [], "x", [0.5], ["m"]).first().m == 4.5
    assert quantiles.group_quantiles(df.limit(0), [], "x", [0.5], ["m"]).count() == 0
    assert quantiles.group_quantiles(df.withColumn("x", F.lit(None).cast("double")), ["k"], "x", [0.5], ["m"]).count() == 0


@pytest.mark.parametrize("empty", [False, True])
def test_statistics_are_the_same_both_ways(spark, empty):
    rnd = random.Random(6)
    rows = [(rnd.choice(["r1", "r2", "r3", None]), rnd.choice([None, rnd.gauss(2, 4), float(rnd.randrange(4))]), f"2024-01-01 {rnd.randrange(24):02d}:10:00")
            for _ in range(0 if empty else 300)] + ([] if empty else [("r9", None, "2024-01-01 03:00:00")])
    df = spark.createDataFrame(rows, "route_id string, delay_minutes double, t string").withColumn("feed_timestamp", F.to_timestamp("t"))
    for f in (delays.delay_statistics, delays.delay_by_route, delays.delay_by_hour):
        one, other = f(df), f(df, median="ranges")
        assert one.columns == other.columns
        a, b = (sorted(map(tuple, d.collect()), key=repr) for d in (one, other))
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert all((p == q) or abs(p - q) < 1e-9 for p, q in zip(x, y))
        # Spark's median is a percentile in the plan
        made, plain_way = (d._jdf.queryExecution().executedPlan().toString() for d in (other, one))
        assert "percentile(" not in made and "median(" not in made.replace("max(_median", "") and ("percentile(" in plain_way or "median(" in plain_way)
    with pytest.raises(ValueError):
        delays.delay_statistics(df, median="guess")
