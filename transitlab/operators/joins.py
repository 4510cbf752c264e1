"""Join helpers. Which side is broadcast is left to the planner and to AQE, which go by real bytes."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Hot keys are shipped to every executor: at most 1 / MIN_HOT_FRACTION of them.
MIN_HOT_FRACTION = 1e-4
HOT_BUCKETS = 1 << 16


def left_join_dimension(fact: DataFrame, dim: DataFrame, on) -> DataFrame:
    """Left join with a dimension, without a hint: the planner broadcasts a side whose scan is known to be below
    ``spark.sql.autoBroadcastJoinThreshold``, AQE one whose shuffle output proves to be; no job runs before the query."""
    return fact.join(dim, on=on, how="left")


def hot_keys(df: DataFrame, keys, fraction: float) -> DataFrame:
    """Keys holding at least ``fraction`` of the rows of ``df`` (at most ``1 / fraction`` of them), nulls excepted.

    Rows are first counted by ``HOT_BUCKETS`` hashes of their key: only a bucket that holds that many rows can hold such a key, so
    whole keys are counted (and shuffled) for the rows of these few buckets alone. ``fraction`` may not be below ``MIN_HOT_FRACTION``.
    """
    if fraction < MIN_HOT_FRACTION:
        raise ValueError(f"fraction must be at least {MIN_HOT_FRACTION}")
    least = df.select(F.count(F.lit(1))).scalar() * fraction
    known = df.select(*keys).na.drop().withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS)))
    full = known.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("_bucket")
    return known.join(F.broadcast(full), "_bucket", "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) \
        .filter(F.col("_n") >= least).select(*keys, F.lit(True).alias("_hot"))


def salted_left_join(left: DataFrame, right: DataFrame, keys, fraction: float = 0.01, salts: int = 32
                     ) -> DataFrame:
    """Left equi-join that splits hot keys of ``left`` over ``salts`` tasks.

    Rows of a key holding at least ``fraction`` of ``left`` get a salt from a hash of the whole row; the right rows
    of those keys are repeated once per salt value. Left rows with a null key match nothing, so they get a
    salt too and spread out instead of meeting in one task. Every other key keeps salt 0. Same result as
    ``left.join(right, keys, "left")``.
    """
    keys = list(keys)
    hot = F.broadcast(hot_keys(left, keys, fraction))       # at most 1 / fraction rows
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)).cast("int")
    unmatched = F.lit(False)
    for k in keys:
        unmatched = unmatched | F.col(k).isNull()
    l2 = left.join(hot, keys, "left") \
        .withColumn("_salt", F.when(F.col("_hot") | unmatched, salt).otherwise(F.lit(0))).drop("_hot")
    r2 = right.join(hot, keys, "left") \
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                       .otherwise(F.array(F.lit(0))))).drop("_hot")
    return l2.join(r2, keys + ["_salt"], "left").drop("_salt")
