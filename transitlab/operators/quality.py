"""Validation, de-duplication and row filters for vehicle positions and trip updates."""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Required attributes and de-duplication keys.
VEHICLE_REQUIRED = ("vehicle_id", "latitude", "longitude", "timestamp")
TRIP_UPDATE_REQUIRED = ("trip_id", "stop_id", "feed_timestamp")
VEHICLE_KEYS = ("vehicle_id", "timestamp")
TRIP_UPDATE_KEYS = ("trip_id", "stop_id", "feed_timestamp")
LAT_BOUND, LON_BOUND = 90.0, 180.0


def _present(df: DataFrame, cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        # An absent attribute fails the check, like a null one.
        cond = cond & (F.col(c).isNotNull() if c in df.columns else F.lit(False))
    return cond


def _within(df: DataFrame, col: str, bound: float) -> Column:
    # NaN is rejected explicitly (Spark orders NaN above every number; the check must not depend on that).
    if col not in df.columns:
        return F.lit(True)  # absence already fails the required-attribute check
    c = F.col(col)
    return c.isNull() | (~F.isnan(c) & c.between(-bound, bound))


def vehicle_is_valid(df: DataFrame) -> Column:
    """F1 as a boolean column: required present, coordinates in range (bounds allowed), speed null or >= 0."""
    cond = _present(df, VEHICLE_REQUIRED) & _within(df, "latitude", LAT_BOUND) \
        & _within(df, "longitude", LON_BOUND)
    if "speed" in df.columns:
        cond = cond & (F.col("speed").isNull() | ~(F.col("speed") < 0))
    return cond


def trip_update_is_valid(df: DataFrame) -> Column:
    """F2 as a boolean column: trip_id, stop_id and feed_timestamp present."""
    return _present(df, TRIP_UPDATE_REQUIRED)


def validate_vehicle_positions(df: DataFrame) -> DataFrame:
    return df.filter(vehicle_is_valid(df))


def validate_trip_updates(df: DataFrame) -> DataFrame:
    return df.filter(trip_update_is_valid(df))


def first_per_key(df: DataFrame, keys: Sequence[str], order_col: str | None) -> DataFrame:
    """Keep the first row per key in arrival order (smallest ``order_col``).

    Rows without an order value come last; equal order values are settled by the remaining columns, so the
    result does not depend on partitioning. Written as ``groupBy(keys).agg(min(struct(order, row)))``: the partial
    aggregate keeps one row per key and map task before the shuffle, so a key holding a third of all rows ships one
    row per task. Keys are compared as a tuple (nulls form one group). ``order_col=None`` orders by the
    remaining columns alone.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    order = [F.col(order_col).isNull().alias("_late"), F.col(order_col).alias("_order")] if order_col else []
    out = df.groupBy(*keys).agg(F.min(F.struct(*order, F.struct(*[F.col(c) for c in rest]).alias("_row"))).alias("_first"))
    return out.select(*[F.col(k) for k in keys], *[F.col(f"_first._row.{c}").alias(c) for c in rest]) \
        .select(*df.columns)


def deduplicate_vehicle_positions(df: DataFrame, order_col: str | None = "event_id") -> DataFrame:
    return first_per_key(df, VEHICLE_KEYS, order_col)


def deduplicate_trip_updates(df: DataFrame, order_col: str | None = "event_id") -> DataFrame:
    return first_per_key(df, TRIP_UPDATE_KEYS, order_col)


def clean_vehicles(df: DataFrame, order_col: str | None = "event_id") -> DataFrame:
    """validate, then de-duplicate the valid rows."""
    return deduplicate_vehicle_positions(validate_vehicle_positions(df), order_col)


def clean_trip_updates(df: DataFrame, order_col: str | None = "event_id") -> DataFrame:
    """validate, then de-duplicate the valid rows."""
    return deduplicate_trip_updates(validate_trip_updates(df), order_col)


def _stats(df: DataFrame, record_type: str, valid: Column, keys: Sequence[str]) -> DataFrame:
    # valid counts duplicates too; duplicates = valid rows - distinct keys among valid rows.
    n_valid = F.count_if(valid)
    distinct_valid = F.count_distinct(F.when(valid, F.struct(*[F.col(k) for k in keys])))
    return df.agg(
        F.count(F.lit(1)).alias("processed"),
        n_valid.alias("valid"),
        (F.count(F.lit(1)) - n_valid).alias("invalid"),
        (n_valid - distinct_valid).alias("duplicate"),
    ).select(F.lit(record_type).alias("record_type"), "processed", "valid", "invalid", "duplicate")


def quality_stats(vehicles: DataFrame | None = None, trip_updates: DataFrame | None = None) -> DataFrame:
    """processed / valid / invalid / duplicate counters, one row per record type."""
    parts = []
    if vehicles is not None:
        parts.append(_stats(vehicles, "vehicle_position", vehicle_is_valid(vehicles), VEHICLE_KEYS))
    if trip_updates is not None:
        parts.append(_stats(trip_updates, "trip_update", trip_update_is_valid(trip_updates), TRIP_UPDATE_KEYS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filter_routes(df: DataFrame, routes: Sequence[str] | None, route_col: str = "route_id") -> DataFrame:
    """F8: keep the selected routes; an empty selection keeps everything."""
    if not routes:
        return df
    return df.filter(F.col(route_col).isin(list(routes)))


def recent_rows(df: DataFrame, ts_col: str, window: str, as_of=None) -> DataFrame:
    """Rows with ``ts_col > as_of - window`` (strict). Null or unparseable times never pass.

    With ``as_of`` the cutoff is a literal, so Parquet row groups and date partitions are pruned by the scan. Without it,
    "now" is the newest ``ts_col``, found by a scalar subquery of the same query (no job of its own before it).
    """
    if as_of is None:
        newest = df.agg(F.max(ts_col).cast("timestamp")).scalar()
        return df.filter(F.col(ts_col) > newest - F.expr(f"INTERVAL {window}"))
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    return df.filter(F.col(ts_col) > F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {window}"))


# The time-range choices of the report page (hours; None = all), default 24.
TIME_RANGE_CHOICES = (1, 4, 12, 24, None)


def time_range_filter(df: DataFrame, hours: int | None = 24, ts_col: str = "feed_timestamp", as_of=None
                      ) -> DataFrame:
    """last ``hours`` hours before ``as_of``; ``None`` keeps all rows."""
    if hours is None:
        return df
    return recent_rows(df, ts_col, f"{int(hours)} HOURS", as_of)


def map_points(df: DataFrame, size: int = 50) -> DataFrame:
    """F10 + F11: positions fit to draw (both coordinates present, non-NaN and non-zero), numeric, sized."""
    keep = [c for c in ("vehicle_id",) if c in df.columns]
    return drawable_positions(df).select(*keep, F.col("latitude").try_cast("double").alias("latitude"),
                                         F.col("longitude").try_cast("double").alias("longitude"),
                                         F.lit(size).alias("size"))


def preview(df: DataFrame, order_cols: Sequence[str], n: int = 100) -> DataFrame:
    """the first ``n`` rows in a stated order, each carrying the total row count."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.orderBy(*order_cols).limit(n).withColumn("total_rows", total)


def drawable_positions(df: DataFrame) -> DataFrame:
    """F10 without the projection: rows whose coordinates can be drawn."""
    lat = F.col("latitude").try_cast("double")
    lon = F.col("longitude").try_cast("double")
    return df.filter(lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon) & (lat != 0) & (lon != 0))
