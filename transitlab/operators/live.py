"""Live views: newest state per vehicle and recent per-trip delays."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality import recent_rows

# Freshness windows of the live views.
VEHICLE_WINDOW = "10 MINUTES"
TRIP_WINDOW = "1 HOUR"
TRIP_GROUP = ("route_id", "trip_id", "vehicle_id")


def last_non_null(col: str, order_cols: Sequence[str]) -> Column:
    """Value of ``col`` on the latest row (by ``order_cols``) where ``col`` is not null.

    Rows whose ``col`` is null get a null ordering and are skipped by ``max_by``, so each column is taken
    from its own latest non-null row (a result row may mix source rows, as a per-column "last" does).
    """
    order = F.struct(*[F.col(c) for c in order_cols])
    return F.max_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def decimals_to_double(df: DataFrame) -> DataFrame:
    """L4: store numbers (DECIMAL) back to DOUBLE."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def live_vehicle_positions(df: DataFrame, as_of=None, window: str = VEHICLE_WINDOW,
                           order_cols: Sequence[str] = ("timestamp", "event_id")) -> DataFrame:
    """L1: positions newer than ``as_of - window``; per vehicle the last non-null value of every column.

    ``order_cols`` after the timestamp break ties in arrival order; they are not part of the result.
    One hash shuffle on vehicle_id; the per-column ``max_by`` aggregates combine map-side.
    """
    df = decimals_to_double(df)
    order_cols = [c for c in order_cols if c in df.columns]
    recent = recent_rows(df, "timestamp", window, as_of).filter(F.col("vehicle_id").isNotNull())
    hidden = set(order_cols) - {"timestamp"}
    value_cols = [c for c in df.columns if c != "vehicle_id" and c not in hidden]
    return recent.groupBy("vehicle_id").agg(*[last_non_null(c, order_cols).alias(c) for c in value_cols])


def delay_minutes_column(df: DataFrame) -> Column | None:
    """L3: existing ``delay_minutes``, else ``arrival_delay / 60``, else ``departure_delay / 60``.

    Chosen by column presence at plan time; a null delay stays null (unlike A1).
    """
    if "delay_minutes" in df.columns:
        return F.col("delay_minutes").cast("double")
    if "arrival_delay" in df.columns:
        return F.col("arrival_delay") / F.lit(60.0)
    if "departure_delay" in df.columns:
        return F.col("departure_delay") / F.lit(60.0)
    return None


def with_delay_minutes(df: DataFrame) -> DataFrame:
    d = delay_minutes_column(df)
    return df if d is None else df.withColumn("delay_minutes", d)


def live_trip_delays(df: DataFrame, as_of=None, window: str = TRIP_WINDOW) -> DataFrame:
    """L2: updates newer than ``as_of - window``; per (route, trip, vehicle) the mean delay and the
    earliest feed time. Rows with a null key are dropped."""
    df = with_delay_minutes(decimals_to_double(df))
    recent = recent_rows(df, "feed_timestamp", window, as_of)
    if not all(c in df.columns for c in TRIP_GROUP):
        return recent
    keyed = recent.filter(F.col("route_id").isNotNull() & F.col("trip_id").isNotNull()
                          & F.col("vehicle_id").isNotNull())
    aggs = [F.min("feed_timestamp").alias("feed_timestamp")]
    if "delay_minutes" in df.columns:
        aggs.insert(0, F.avg("delay_minutes").alias("delay_minutes"))
    return keyed.groupBy(*TRIP_GROUP).agg(*aggs)


def latest_delay_per_vehicle(df: DataFrame, order_cols: Sequence[str] = ("feed_timestamp",),
                             col: str = "delay_minutes") -> DataFrame:
    """Per vehicle the delay of its latest row that has one (null delays skipped)."""
    order_cols = [c for c in order_cols if c in df.columns]
    return df.filter(F.col("vehicle_id").isNotNull()).groupBy("vehicle_id") \
        .agg(last_non_null(col, order_cols).alias(col))


def vehicles_with_latest_delay(vehicles: DataFrame, trip_delays: DataFrame,
                               order_cols: Sequence[str] = ("feed_timestamp", "route_id", "trip_id")
                               ) -> DataFrame:
    """Live vehicles left-joined with their latest delay (both sides are keyed by vehicle_id)."""
    latest = latest_delay_per_vehicle(trip_delays, order_cols)
    base = vehicles.drop("delay_minutes") if "delay_minutes" in vehicles.columns else vehicles
    return base.join(latest, "vehicle_id", "left")


def load_dashboard_data(vehicle_positions: DataFrame, trip_updates: DataFrame, as_of=None,
                        vehicle_window: str = VEHICLE_WINDOW, trip_window: str = TRIP_WINDOW,
                        persist: bool = True) -> dict:
    """The two live views of one report run plus a source tag; persisted so every report reuses them.

    There is no silent fallback to sample data: empty input gives empty views.
    """
    vehicles = live_vehicle_positions(vehicle_positions, as_of, vehicle_window)
    trips = live_trip_delays(trip_updates, as_of, trip_window)
    if persist:
        vehicles, trips = vehicles.persist(), trips.persist()
    return {"vehicles": vehicles, "trip_updates": trips, "data_source": "live"}
