"""Running sums and ranks over ranges against plain loops."""
import random

import pytest
from pyspark.sql import functions as F

from transitlab.operators import features, model, ranks


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_running_sum_over_many_ranges(spark, many_ranges):
    rnd = random.Random(1)
    rows = list({(rnd.choice([None, "a", "b", "cc"]), rnd.randrange(200), rnd.randrange(5)) for _ in range(300)})
    df = spark.createDataFrame(rows, "k string, i int, n long")
    got = {(r.k, r.i, r.n): r.upto for r in ranks.running_sum(df, ["k", "i", "n"], "n", "upto").collect()}
    total, want = 0, {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        total += r[2]
        want[r] = total
    assert got == want
    assert ranks.running_sum(df.limit(0), ["k"], "n", "upto").count() == 0


def test_ranges_are_not_gathered(spark, many_ranges):
    df = spark.range(5000).withColumn("n", F.lit(1).cast("long"))
    out = ranks.running_sum(df, ["id"], "n", "upto")
    assert out.filter(F.col("upto") != F.col("id") + 1).count() == 0
    assert out.select("id").rdd.getNumPartitions() > 1


def test_copies_come_in_chunks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 0), ("c", 1), ("d", 10)], "k string, n long")
    got = {r.k: r["count"] for r in ranks.repeated(df, "n", chunk=10).groupBy("k").count().collect()}
    assert got == {"a": 25, "c": 1, "d": 10}


def test_split_when_one_key_holds_every_row(spark, many_ranges):
    rows = [(7, i % 40, 1.0) for i in range(400)]
    df = spark.createDataFrame(rows, "key int, x int, y double")
    train, test = model.exact_hash_split(df, 0.2, key_cols=["key"])
    assert (train.count(), test.count()) == (320, 80)
    both = sorted(map(tuple, train.unionByName(test).collect()))
    assert both == sorted(rows)
    # rows of one hash go to the test part in the order of all columns
    assert sorted({r.x for r in test.collect()}) == list(range(8))


def test_codes_of_many_labels(spark, many_ranges):
    labels = [f"{i * 7919 % 10007}" for i in range(2000)] + [None, "Ä", "a b"]
    df = spark.createDataFrame([(x,) for x in labels], "route_id string")
    enc, encoder = features.encode_categorical_features(df)
    want = {x: i for i, x in enumerate(sorted({x or "None" for x in labels}))}
    assert {r.route_id or "None": r.route_id_encoded for r in enc.collect()} == want
    assert encoder.labels.count() == len(want)
    with pytest.raises(Exception, match="not fitted on"):
        features.encode_route(spark.createDataFrame([("zzz",)], "route_id string"), encoder).collect()
