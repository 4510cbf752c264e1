"""Report aggregates over the live views."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefuncs import hour_of_day
from .delays import ON_TIME_MINUTES

# Report thresholds.
AVG_DELAY_TARGET = 3.0          # minutes; above it the average-delay card turns "inverse"
ON_TIME_TARGET = 80.0           # percent; at or above it the on-time card reads "Good"
STATUS_ON_TIME, STATUS_SLIGHT = 2.0, 5.0   # vehicle status buckets: <=2, (2,5], >5, unknown
RANKING_MIN_UPDATES = 5
RANKING_TOP_N = 15
HOURS = list(range(24))


def active_vehicles(vehicles: DataFrame):
    """A6 as a scalar column: distinct vehicle ids, a null id counting as one more value."""
    n = F.count_distinct("vehicle_id") + F.coalesce(F.max(F.col("vehicle_id").isNull().cast("int")), F.lit(0))
    return vehicles.select(n.cast("bigint")).scalar()


def kpis(vehicles: DataFrame, trip_delays: DataFrame, avg_target: float = AVG_DELAY_TARGET,
         on_time_minutes: float = ON_TIME_MINUTES, on_time_target: float = ON_TIME_TARGET) -> DataFrame:
    """Active vehicles, average delay with its status, on-time percentage with its label."""
    has_delay = "delay_minutes" in trip_delays.columns
    d = F.col("delay_minutes") if has_delay else F.lit(None).cast("double")
    n = F.count(F.lit(1))
    agg = trip_delays.agg(F.avg(d).alias("avg_delay"),
                          F.when(n > 0, F.count_if(F.abs(d) <= on_time_minutes) / n * 100.0).alias("on_time_rate"))
    avg, rate = F.col("avg_delay"), F.col("on_time_rate")
    return agg.select(
        active_vehicles(vehicles).alias("active_buses"),
        "avg_delay",
        F.when(avg.isNull(), "N/A").when(avg <= avg_target, "normal").otherwise("inverse").alias("avg_delay_status"),
        "on_time_rate",
        F.when(rate.isNull(), "N/A").when(rate >= on_time_target, "Good").otherwise("Below Target")
        .alias("on_time_label"),
    )


def _route_col(df: DataFrame) -> str:
    return "route_short_name" if "route_short_name" in df.columns else "route_id"


def _with_hour(df: DataFrame) -> DataFrame:
    return df if "hour" in df.columns else df.withColumn("hour", hour_of_day("feed_timestamp"))


def heatmap_long(df: DataFrame) -> DataFrame:
    """Mean delay per (route, hour); route is the short name when present, else the route id."""
    rc = _route_col(df)
    return _with_hour(df).filter(F.col(rc).isNotNull() & F.col("hour").isNotNull()) \
        .groupBy(rc, "hour").agg(F.avg("delay_minutes").alias("delay_minutes"))


def heatmap_pivot(df: DataFrame) -> DataFrame:
    """A10: routes as rows, hours 0-23 as columns ``h00``..``h23`` (null where a cell has no data).

    The hour list is fixed, so the pivot is one aggregation without a distinct-values pass.
    """
    rc = _route_col(df)
    cells = _with_hour(df).filter(F.col(rc).isNotNull())
    wide = cells.groupBy(rc).pivot("hour", HOURS).agg(F.avg("delay_minutes"))
    return wide.select(rc, *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def heatmap_peaks(df: DataFrame) -> DataFrame:
    """The hour and the route with the highest mean **of cell means**; ties go to the lowest key."""
    cells = heatmap_long(df)
    rc = _route_col(df)

    def peak(dim_col: str, label: str) -> DataFrame:
        g = cells.groupBy(dim_col).agg(F.avg("delay_minutes").alias("avg_delay"))
        return g.orderBy(F.desc_nulls_last("avg_delay"), F.asc(dim_col)).limit(1) \
            .select(F.lit(label).alias("dimension"), F.col(dim_col).cast("string").alias("key"), "avg_delay")

    return peak("hour", "hour").unionByName(peak(rc, "route"))


def status_summary(vehicles_with_delay: DataFrame) -> DataFrame:
    """Vehicle counts on time (<= 2 min, early included), slightly late, late and unknown."""
    d = F.col("delay_minutes")
    return vehicles_with_delay.agg(
        F.count_if(d <= STATUS_ON_TIME).alias("on_time"),
        F.count_if((d > STATUS_ON_TIME) & (d <= STATUS_SLIGHT)).alias("slight_delay"),
        F.count_if(d > STATUS_SLIGHT).alias("delayed"),
        F.count_if(d.isNull()).alias("unknown"))


def route_ranking(df: DataFrame, top_n: int = RANKING_TOP_N, min_updates: int = RANKING_MIN_UPDATES
                  ) -> DataFrame:
    """Per route mean delay, number of non-null delays and a name; routes with at least
    ``min_updates``; the ``top_n`` largest means (ties by route)."""
    rc = _route_col(df)
    if rc == "route_short_name":
        name_col = "route_long_name" if "route_long_name" in df.columns else "route_short_name"
    else:
        name_col = "route_id"
    g = df.filter(F.col(rc).isNotNull()).groupBy(rc).agg(
        F.avg("delay_minutes").alias("avg_delay"), F.count("delay_minutes").alias("num_updates"),
        F.min(name_col).alias("route_name"))
    return g.filter(F.col("num_updates") >= min_updates) \
        .orderBy(F.desc_nulls_last("avg_delay"), F.asc(rc)).limit(top_n)


def route_ranking_display(ranking: DataFrame) -> DataFrame:
    """The ranking as a display table (``x.xx min`` text, readable headers)."""
    rc = ranking.columns[0]
    # Round half-even on x*100 first: ``%.2f`` alone rounds the decimal text half-up (2.675 -> 2.68),
    # while the reference's text rounds the binary value (2.675 -> 2.67, 0.125 -> 0.12).
    two_dp = F.bround(F.col("avg_delay") * 100.0, 0) / 100.0
    return ranking.select(F.col(rc).alias("Route"),
                          F.format_string("%.2f min", two_dp).alias("Avg Delay"),
                          F.col("num_updates").alias("Sample Size"),
                          F.col("route_name").alias("Route Name"))


def report_page(page: dict, routes=None) -> dict:
    """One run of the report page: the selected routes in both live views, then every report on them.

    ``page`` is what ``live.load_dashboard_data`` returns. KPIs, map points, status summary, heatmap and hourly means come
    back as frames.
    """
    from . import live, quality
    vehicles = quality.filter_routes(page["vehicles"], routes)
    trips = quality.filter_routes(page["trip_updates"], routes)
    return {"kpis": kpis(vehicles, trips), "map_points": quality.map_points(vehicles),
            "status_summary": status_summary(live.vehicles_with_latest_delay(quality.drawable_positions(vehicles), trips)),
            "heatmap": heatmap_long(trips), "vehicles": vehicles, "trip_updates": trips}
