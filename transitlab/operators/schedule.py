"""Static timetable joins (J1-J6) and the service calendar."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefuncs import parse_service_date, weekday_monday0
from .joins import left_join_dimension, salted_left_join

# The columns each timetable table contributes to the master schedule.
TRIP_COLUMNS = ("trip_id", "route_id", "service_id", "trip_headsign")
ROUTE_COLUMNS = ("route_id", "route_short_name", "route_long_name", "route_type")
STOP_COLUMNS = ("stop_id", "stop_name", "stop_lat", "stop_lon")
CALENDAR_COLUMNS = ("service_id", "date", "day_of_week")
# Columns of the schedule carried onto real-time updates (J6), in tie-break order after the keys.
SCHEDULE_INFO = ("stop_sequence", "arrival_time", "route_id", "route_short_name", "route_long_name",
                 "stop_name", "stop_lat", "stop_lon")
SCHEDULE_SUFFIX = "_scheduled"


def _cols(df: DataFrame, names) -> list[str]:
    return [c for c in names if c in df.columns]


def calendar_with_weekday(calendar_dates: DataFrame) -> DataFrame:
    """Service date text -> DATE and day of week (Monday = 0)."""
    return calendar_dates.withColumn("date", parse_service_date("date")) \
        .withColumn("day_of_week", weekday_monday0("date"))


def schedule_without_calendar(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame
                              ) -> DataFrame:
    """stop_times left-joined with trips, routes and stops.

    Small dimensions are broadcast by the planner or by AQE; large ones take a shuffle join whose skewed
    partitions AQE splits.
    """
    s = left_join_dimension(stop_times, trips.select(*_cols(trips, TRIP_COLUMNS)), "trip_id")
    s = left_join_dimension(s, routes.select(*_cols(routes, ROUTE_COLUMNS)), "route_id")
    return left_join_dimension(s, stops.select(*_cols(stops, STOP_COLUMNS)), "stop_id")


def expand_service_dates(schedule: DataFrame, calendar_dates: DataFrame | None, active_only: bool = False
                         ) -> DataFrame:
    """One row per service date (left join on service_id, fans out); skipped when there is no calendar.

    An empty calendar counts as none: the schedule's columns stay as they are. ``exception_type`` is not looked
    at unless ``active_only`` (then removed dates, type 2, are dropped).
    """
    if calendar_dates is None or calendar_dates.isEmpty():      # one row at most is read to decide
        return schedule
    cal = calendar_with_weekday(calendar_dates)
    if active_only:
        cal = cal.filter(F.col("exception_type") != 2)
    return left_join_dimension(schedule, cal.select(*CALENDAR_COLUMNS), "service_id")


def build_master_schedule(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame,
                          calendar_dates: DataFrame | None = None, active_only: bool = False) -> DataFrame:
    """J5 = J1 -> J2 -> J3 -> J4."""
    s = schedule_without_calendar(stop_times, trips, routes, stops)
    return expand_service_dates(s, calendar_dates, active_only)


def first_schedule_row(schedule: DataFrame) -> DataFrame:
    """The schedule reduced to one row per (trip_id, stop_id): the smallest
    (stop_sequence, arrival_time, route_id, names, stop attributes) tuple, a deterministic "first".

    Partial aggregation keeps one row per key and task before the shuffle.
    """
    info = _cols(schedule, SCHEDULE_INFO)
    best = F.min(F.struct(*[F.col(c) for c in info])).alias("_s")
    return schedule.groupBy("trip_id", "stop_id").agg(best) \
        .select("trip_id", "stop_id", *[F.col(f"_s.{c}").alias(c) for c in info])


def merge_realtime_with_schedule(updates: DataFrame, schedule: DataFrame, include_schedule_info: bool = True,
                                 skew_fraction: float | None = 0.01) -> DataFrame:
    """Updates left-joined with the first schedule row of their (trip_id, stop_id).

    Schedule columns whose name the updates already use get the ``_scheduled`` suffix. The calendar is
    not needed here, so pass the schedule *before* J4 (same answer, no date fan-out).
    """
    if not include_schedule_info:
        return updates
    return _attach(updates, first_schedule_row(schedule), skew_fraction)


def trip_service_dates(trips: DataFrame, calendar_dates: DataFrame, active_only: bool = False) -> DataFrame:
    """J4 on its own: every trip with each date its service runs (trips without a calendar keep one row)."""
    return expand_service_dates(trips.select(*_cols(trips, TRIP_COLUMNS)), calendar_dates, active_only)


def first_timetable_rows(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, stops: DataFrame
                         ) -> DataFrame:
    """``first_schedule_row(schedule_without_calendar(...))`` without building the full schedule.

    Route attributes depend only on trip_id and stop attributes only on stop_id, so the smallest
    (stop_sequence, arrival_time, route..., stop...) tuple of a (trip_id, stop_id) group is the smallest
    (stop_sequence, arrival_time) of its stop times, plus the smallest route tuple of the trip, plus the
    smallest stop tuple of the stop -- also when a dimension repeats a key. Reducing first means the
    dimension lookups run on one row per key, after the shuffle, instead of on every stop time.
    """
    st = stop_times.groupBy("trip_id", "stop_id") \
        .agg(F.min(F.struct("stop_sequence", "arrival_time")).alias("_t"))
    rt = routes.select(*_cols(routes, ("route_id", "route_short_name", "route_long_name")))
    tr = left_join_dimension(trips.select("trip_id", "route_id"), rt, "route_id") \
        .groupBy("trip_id").agg(F.min(F.struct("route_id", "route_short_name", "route_long_name")).alias("_r"))
    sp = stops.groupBy("stop_id").agg(F.min(F.struct("stop_name", "stop_lat", "stop_lon")).alias("_s"))
    out = left_join_dimension(left_join_dimension(st, tr, "trip_id"), sp, "stop_id")
    return out.select("trip_id", "stop_id", "_t.stop_sequence", "_t.arrival_time", "_r.route_id",
                      "_r.route_short_name", "_r.route_long_name", "_s.stop_name", "_s.stop_lat", "_s.stop_lon")


SKEW_FRACTION = 0.01


def merge_realtime_with_timetable(updates: DataFrame, stop_times: DataFrame, trips: DataFrame,
                                  routes: DataFrame, stops: DataFrame, include_schedule_info: bool = True,
                                  skew_fraction: float | None = SKEW_FRACTION) -> DataFrame:
    """J6 straight from the timetable tables: same result as ``merge_realtime_with_schedule`` on the
    J1-J3 schedule, with the schedule reduced before any dimension join.

    (trip, stop) keys that hold ``skew_fraction`` of the updates or more are salted, and updates without a key
    spread out (``joins.salted_left_join``): the reduced schedule is no plain table, so AQE's skew split does
    not apply to this join. ``None`` switches the salting off.
    """
    if not include_schedule_info:
        return updates
    return _attach(updates, first_timetable_rows(stop_times, trips, routes, stops), skew_fraction)


def _attach(updates: DataFrame, sched: DataFrame, skew_fraction: float | None = None) -> DataFrame:
    renamed = [F.col(c).alias(c + SCHEDULE_SUFFIX) if c in updates.columns and c not in ("trip_id", "stop_id")
               else F.col(c) for c in sched.columns]
    right = sched.select(*renamed)
    keys = ["trip_id", "stop_id"]
    joined = salted_left_join(updates, right, keys, skew_fraction) if skew_fraction \
        else updates.join(right, keys, "left")
    return joined.select(*updates.columns, *[c for c in right.columns if c not in keys])
