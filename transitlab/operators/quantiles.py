"""Exact quantiles of many groups at once, without a value map in any task.

Values are counted by (group, value), combined map-side; the counts are put in order over range partitions with a running sum, so a value's place
in its group is that sum less the sum where the group starts. A quantile is read off the one or two values whose places enclose it. Memory is that
of a sort, however many distinct values a group has; a group of any size is spread over ranges.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import running_sum


def group_quantiles(df: DataFrame, keys: Sequence[str], col: str, shares: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``keys`` and, for each share (0 to 1), the exact quantile with linear interpolation between neighbours, as ``percentile`` has it.

    Null values are left out, and groups without any value; NaN counts as the largest value. Without ``keys`` there is one row, or none
    if there is no value. Groups with null keys are groups.
    """
    keys = list(keys)
    value = F.col(col).cast("double")
    counts = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], value.alias("_v")).filter("_v IS NOT NULL") \
        .groupBy(*[f"_k{i}" for i in range(len(keys))], "_v").agg(F.count(F.lit(1)).alias("_n"))
    own = [f"_k{i}" for i in range(len(keys))]
    placed = running_sum(counts, [*own, "_v"], "_n", "_upto")
    # where a group starts and how many values it has
    start_and_size = [F.min(F.col("_upto") - F.col("_n")).alias("_start"), F.sum("_n").alias("_size")]
    if own:
        size = placed.groupBy(*own).agg(*start_and_size).withColumnsRenamed({k: f"_s{k}" for k in own})
        same = F.lit(True)
        for k in own:
            same = same & F.col(k).eqNullSafe(F.col(f"_s{k}"))
        rows = placed.join(size, same)
    else:
        rows = placed.join(F.broadcast(placed.agg(*start_and_size)))        # one row
    rows = rows.select(*own, "_v", (F.col("_upto") - F.col("_start")).alias("_last"),
                       (F.col("_upto") - F.col("_start") - F.col("_n")).alias("_first"), "_size")
    aggs = []
    for share, name in zip(shares, names):
        at = (F.col("_size") - 1) * F.lit(float(share))
        low, high = F.floor(at), F.ceil(at)

        def value_at(place):
            return F.max(F.when((F.col("_first") <= place) & (place < F.col("_last")), F.col("_v")))
        aggs += [value_at(low).alias(f"_low_{name}"), value_at(high).alias(f"_high_{name}"), F.max(at - low).alias(f"_part_{name}")]
    out = rows.groupBy(*own).agg(*aggs, F.count(F.lit(1)).alias("_rows")).filter("_rows > 0")
    return out.select(*[F.col(k).alias(keys[i]) for i, k in enumerate(own)], *[
        F.when(F.col(f"_part_{n}") == 0, F.col(f"_low_{n}"))
        .otherwise(F.col(f"_low_{n}") + (F.col(f"_high_{n}") - F.col(f"_low_{n}")) * F.col(f"_part_{n}")).alias(n) for n in names])
