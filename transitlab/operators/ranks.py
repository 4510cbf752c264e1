"""Running sums and ranks over a whole table without gathering it: range partitions, sums inside each, and offsets of the ranges before."""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

_RANGE, _LOCAL = "_range", "_local"


def running_sum(df: DataFrame, order_cols: Sequence[str], value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows before each row and itself, in the order of ``order_cols`` (null first).

    Rows are dealt into ranges of the order (one shuffle) and written, so that every later step sees the same ranges; a range
    sums its own rows, and one row a range carries the totals. ``order_cols`` should tell rows apart: equal rows stand in one range.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "ranks", uuid.uuid4().hex)
    dealt = df.repartitionByRange(*[F.col(c) for c in order_cols]).withColumn(_RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)
    inside = Window.partitionBy(_RANGE).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row a range: as many as there are partitions, whatever the table's size
    totals = rows.groupBy(_RANGE).agg(F.sum(value).alias("_total"))
    before = Window.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col(_RANGE).alias("_r"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return rows.withColumn(_LOCAL, F.sum(value).over(inside)).join(offsets, F.col(_RANGE) == F.col("_r")) \
        .withColumn(name, F.col(_LOCAL) + F.col("_offset")).drop(_RANGE, _LOCAL, "_r", "_offset")


def dense_ranks(df: DataFrame, col: str, name: str) -> DataFrame:
    """The distinct values of ``col`` with their 0-based rank (``name``, long)."""
    values = df.select(col).distinct().withColumn("_one", F.lit(1).cast("long"))
    return running_sum(values, [col], "_one", name).select(col, (F.col(name) - 1).alias(name))


def repeated(df: DataFrame, count: str, chunk: int = 10_000) -> DataFrame:
    """Every row ``count`` times (0: not at all), without ``count``; copies are made ``chunk`` at a time, never as one array."""
    chunks = F.ceil(F.col(count) / chunk).cast("int")
    parts = df.filter(F.col(count) > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    here = F.least(F.lit(chunk), F.col(count) - F.col("_chunk").cast("long") * chunk).cast("int")
    return parts.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), here))).drop("_chunk", "_copy", count)
