"""Delay computation and delay aggregates."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefuncs import hour_of_day
from .quantiles import group_quantiles
from .schedule import merge_realtime_with_schedule, merge_realtime_with_timetable

# Fixed values: |delay| <= 5 minutes counts as on time; histograms have 50 equal-width bins.
ON_TIME_MINUTES = 5.0
HISTOGRAM_BINS = 50


def _ts(df: DataFrame, col: str) -> Column:
    if isinstance(df.schema[col].dataType, T.StringType):
        return F.to_timestamp(F.col(col))
    return F.col(col)


def calculate_delay_from_trip_updates(df: DataFrame) -> DataFrame:
    """A1: ``delay_minutes = arrival_delay / 60``, a missing delay counted as 0 (on time)."""
    out = df.withColumn("delay_minutes", F.coalesce(F.col("arrival_delay") / F.lit(60.0), F.lit(0.0)))
    if "feed_timestamp" in df.columns:
        out = out.withColumn("feed_timestamp", _ts(df, "feed_timestamp"))
    return out


def calculate_delays(updates: DataFrame, schedule: DataFrame) -> DataFrame:
    """A5: A1, then J6 against the schedule (pass the schedule before the calendar join)."""
    return merge_realtime_with_schedule(calculate_delay_from_trip_updates(updates), schedule)


def calculate_delays_from_timetable(updates: DataFrame, stop_times: DataFrame, trips: DataFrame,
                                    routes: DataFrame, stops: DataFrame) -> DataFrame:
    """A5 from the timetable tables (schedule reduced before the dimension joins)."""
    return merge_realtime_with_timetable(calculate_delay_from_trip_updates(updates), stop_times, trips, routes, stops)


MEDIANS = ("map", "ranges", "sketch")


def _median(col: str, median: str) -> Column:
    # "map": Spark's percentile keeps a value -> frequency map per group (partial aggregation included), so memory follows the number
    # of distinct delays, not rows: whole seconds, a few thousand. "ranges" is exact too, for values of any precision: its value
    # joins the aggregate afterwards (``_with_medians``). "sketch" is approximate.
    if median not in MEDIANS:
        raise ValueError(f"median must be one of {MEDIANS}")
    if median == "ranges":
        return F.lit(None).cast("double")
    return F.percentile_approx(col, 0.5, 10000) if median == "sketch" else F.median(col)


def _with_medians(out: DataFrame, rows: DataFrame, keys: list[str], col: str, name: str, median: str) -> DataFrame:
    """The aggregate with the medians of ``rows`` in ``name`` where they are made over ranges."""
    if median != "ranges":
        return out
    found = group_quantiles(rows, keys, col, [0.5], ["_median"])
    if keys:
        found = found.select(*[F.col(k).alias(f"_{k}") for k in keys], "_median")
        joined = out.join(found, [out[k] == found[f"_{k}"] for k in keys], "left")
        return joined.withColumn(name, F.col("_median")).select(*out.columns)
    return out.withColumn(name, found.select(F.max("_median")).scalar())


def _median_kind(median: str, approx: bool) -> str:
    return "sketch" if approx else median


def on_time_rate(col: str = "delay_minutes", threshold: float = ON_TIME_MINUTES) -> Column:
    """Share of **all** rows with |delay| <= threshold (a null delay is not on time)."""
    return F.count_if(F.abs(F.col(col)) <= threshold) / F.count(F.lit(1))


def delay_statistics(df: DataFrame, col: str = "delay_minutes", threshold: float = ON_TIME_MINUTES,
                     approx: bool = False, median: str = "map") -> DataFrame:
    """A2: one row of count, mean, median, max, min, on-time rate and sample std; zeros when empty. ``median``: see ``MEDIANS``."""
    median = _median_kind(median, approx)
    n = F.count(F.lit(1))
    agg = df.agg(n.alias("total_records"), F.avg(col).alias("avg"), _median(col, median).alias("median"),
                 F.max(col).alias("max"), F.min(col).alias("min"), on_time_rate(col, threshold).alias("rate"),
                 F.stddev_samp(col).alias("std"))
    agg = _with_medians(agg, df, [], col, "median", median)
    empty = F.col("total_records") == 0
    z = F.lit(0.0)
    return agg.select(
        "total_records",
        F.when(empty, z).otherwise(F.col("avg")).alias("avg_delay_minutes"),
        F.when(empty, z).otherwise(F.col("median").cast("double")).alias("median_delay_minutes"),
        F.when(empty, z).otherwise(F.col("max")).alias("max_delay_minutes"),
        F.when(empty, z).otherwise(F.col("min")).alias("min_delay_minutes"),
        F.when(empty, z).otherwise(F.col("rate")).alias("on_time_rate"),
        F.col("std").alias("std_delay_minutes"),
    )


def delay_by_route(df: DataFrame, col: str = "delay_minutes", threshold: float = ON_TIME_MINUTES,
                   approx: bool = False, median: str = "map") -> DataFrame:
    """A3: per route mean, median, sample std, non-null count, route names and on-time rate; mean desc.

    One ``groupBy`` replaces the two aggregations and self-join of the row-by-row version. Rows with a null
    route are dropped. The name columns take the smallest name of the route (deterministic "first").
    """
    median = _median_kind(median, approx)
    names = [F.min(c).alias(c) for c in ("route_short_name", "route_long_name") if c in df.columns]
    known = df.filter(F.col("route_id").isNotNull())
    out = known.groupBy("route_id").agg(
        F.avg(col).alias("avg_delay"), _median(col, median).cast("double").alias("median_delay"),
        F.stddev_samp(col).alias("std_delay"), F.count(col).alias("count"), *names,
        on_time_rate(col, threshold).alias("on_time_rate"))
    out = _with_medians(out, known, ["route_id"], col, "median_delay", median)
    return out.orderBy(F.desc("avg_delay"), F.asc("route_id"))


def delay_by_hour(df: DataFrame, col: str = "delay_minutes", ts_col: str = "feed_timestamp",
                  approx: bool = False, median: str = "map") -> DataFrame:
    """A4: per hour of ``ts_col``: mean, median and non-null count of the delay; hour ascending."""
    median = _median_kind(median, approx)
    known = df.withColumn("hour", hour_of_day(_ts(df, ts_col))).filter(F.col("hour").isNotNull())
    out = known.groupBy("hour").agg(F.avg(col).alias("avg_delay"), _median(col, median).cast("double").alias("median_delay"),
                                    F.count(col).alias("count"))
    out = _with_medians(out, known, ["hour"], col, "median_delay", median)
    return out.orderBy("hour")


def delay_histogram(df: DataFrame, col: str = "delay_minutes", bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Frequency per equal-width bin between the smallest and largest delay (null delays ignored).

    Bin ``b`` (1-based) covers ``[lo + (b-1) w, lo + b w)``; the largest value falls in the last bin.
    The bounds come from one scalar subquery, so the whole histogram is two passes with a
    ``bins``-sized aggregate.
    """
    vals = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    bounds = vals.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo = bounds.select("lo").scalar()
    hi = bounds.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    raw = F.floor((F.col("v") - lo) / (hi - lo) * F.lit(float(bins))) + 1
    b = F.when(hi == lo, F.lit(1)).otherwise(F.least(raw, F.lit(bins))).cast("int")
    counted = vals.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("frequency"))
    return counted.select(
        "bin",
        (lo + (F.col("bin") - 1) * width).alias("bin_start"),
        F.when(F.col("bin") == bins, hi).otherwise(lo + F.col("bin") * width).alias("bin_end"),
        "frequency",
    ).orderBy("bin")


def hourly_trend(df: DataFrame, col: str = "delay_minutes", ts_col: str = "feed_timestamp") -> DataFrame:
    """Mean delay per hour of day (an existing ``hour`` column is used as is)."""
    hour = F.col("hour") if "hour" in df.columns else hour_of_day(_ts(df, ts_col))
    return df.withColumn("hour", hour).filter(F.col("hour").isNotNull()).groupBy("hour") \
        .agg(F.avg(col).alias("avg_delay")).orderBy("hour")


def schedule_summary_from_timetable(stop_times: DataFrame, trips: DataFrame, routes: DataFrame,
                                    stops: DataFrame, calendar_dates: DataFrame | None = None,
                                    active_only: bool = False) -> DataFrame:
    """A18 of the master schedule (J5) without materialising its calendar fan-out.

    Each J1-J3 row stands for max(1, number of service dates of its service) master rows; distinct routes
    and stops are the same before and after the fan-out. So the summary costs one pass over the J1-J3
    rows plus a per-service count of the calendar, instead of a pass over rows x dates.
    """
    from .joins import left_join_dimension
    from .schedule import schedule_without_calendar
    rows = schedule_without_calendar(stop_times, trips, routes, stops).select("route_id", "stop_id", "service_id")
    weight = F.lit(1).cast("bigint")
    if calendar_dates is not None:
        cal = calendar_dates if not active_only else calendar_dates.filter(F.col("exception_type") != 2)
        per_service = cal.groupBy("service_id").agg(F.count(F.lit(1)).alias("_dates"))
        rows = left_join_dimension(rows, per_service, "service_id")
        weight = F.coalesce(F.col("_dates"), weight)
    return rows.agg(F.sum(weight).cast("bigint").alias("total_records"),
                  F.count_distinct("route_id").alias("unique_routes"),
                  F.count_distinct("stop_id").alias("unique_stops"))


def schedule_summary(schedule: DataFrame) -> DataFrame:
    """Schedule rows, distinct routes and distinct stops (nulls not counted)."""
    return schedule.agg(F.count(F.lit(1)).alias("total_records"),
                        F.count_distinct("route_id").alias("unique_routes"),
                        F.count_distinct("stop_id").alias("unique_stops"))
