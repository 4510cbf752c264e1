import math

from conftest import ts
from transitlab.operators import delays

TU = "trip_id string, route_id string, stop_id string, arrival_delay int, feed_timestamp timestamp"


def test_delay_minutes_and_missing_delay_is_zero(spark):
    df = spark.createDataFrame([("t", "r", "s", 120, ts("2024-01-01T10:00:00")), ("t", "r", "s2", None, ts("2024-01-01T10:00:00"))], TU)
    got = sorted(r.delay_minutes for r in delays.calculate_delay_from_trip_updates(df).collect())
    assert got == [0.0, 2.0]


def test_statistics_one_row_std_is_null_and_empty_is_zero(spark):
    one = spark.createDataFrame([(3.0,)], "delay_minutes double")
    r = delays.delay_statistics(one).first()
    assert r.std_delay_minutes is None and r.median_delay_minutes == 3.0
    empty = delays.delay_statistics(one.limit(0)).first()
    assert (empty.total_records, empty.avg_delay_minutes, empty.on_time_rate) == (0, 0.0, 0.0)


def test_on_time_rate_counts_null_rows_in_denominator(spark):
    # Mean skips nulls, the on-time denominator does not.
    df = spark.createDataFrame([("r", 1.0), ("r", None), ("r", 9.0), ("r", 5.0)], "route_id string, delay_minutes double")
    r = delays.delay_by_route(df).first()
    assert r.on_time_rate == 0.5 and r["count"] == 3 and r.avg_delay == 5.0 and r.median_delay == 5.0


def test_by_route_drops_null_route_and_sorts(spark):
    df = spark.createDataFrame([("a", 1.0, "A"), ("b", 4.0, "B"), (None, 100.0, "X"), ("b", 6.0, "B2")],
                               "route_id string, delay_minutes double, route_short_name string")
    rows = delays.delay_by_route(df).collect()
    assert [r.route_id for r in rows] == ["b", "a"]
    assert rows[0].route_short_name == "B" and rows[1].std_delay is None


def test_by_hour(spark):
    df = spark.createDataFrame([(1.0, ts("2024-01-01T08:10:00")), (3.0, ts("2024-01-01T08:50:00")),
                                (2.0, ts("2024-01-01T17:00:00"))], "delay_minutes double, feed_timestamp timestamp")
    rows = delays.delay_by_hour(df).collect()
    assert [(r.hour, r.avg_delay, r["count"]) for r in rows] == [(8, 2.0, 2), (17, 2.0, 1)]


def test_histogram_equal_width_bins(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (5.0,), (10.0,), (None,)], "delay_minutes double")
    rows = delays.delay_histogram(df, bins=5).collect()
    assert {r.bin: r.frequency for r in rows} == {1: 2, 3: 1, 5: 1}
    assert rows[0].bin_start == 0.0 and rows[-1].bin_end == 10.0
    same = delays.delay_histogram(spark.createDataFrame([(2.0,), (2.0,)], "delay_minutes double")).collect()
    assert [(r.bin, r.frequency) for r in same] == [(1, 2)]


def test_hourly_trend_and_schedule_summary(spark):
    df = spark.createDataFrame([("r1", "s1", 1.0, ts("2024-01-01T08:00:00")), ("r1", "s2", 3.0, ts("2024-01-01T08:30:00")),
                                (None, "s2", 5.0, ts("2024-01-01T09:00:00"))],
                               "route_id string, stop_id string, delay_minutes double, feed_timestamp timestamp")
    assert [(r.hour, r.avg_delay) for r in delays.hourly_trend(df).collect()] == [(8, 2.0), (9, 5.0)]
    s = delays.schedule_summary(df).first()
    assert (s.total_records, s.unique_routes, s.unique_stops) == (3, 1, 2)


def test_schedule_summary_without_fan_out_equals_summary_of_fan_out(spark):
    from transitlab.operators import schedule
    st = spark.createDataFrame([("t1", "s1", "08:00:00", "08:00:00", 1), ("t1", "s2", "09:00:00", "09:00:00", 2),
                                ("t2", "s1", "10:00:00", "10:00:00", 1), ("t3", "s3", "11:00:00", "11:00:00", 1)],
                               "trip_id string, stop_id string, arrival_time string, departure_time string, stop_sequence int")
    trips = spark.createDataFrame([("t1", "r1", "a", "x"), ("t2", "r2", "b", "x"), ("t3", None, "zz", "x")],
                                  "trip_id string, route_id string, service_id string, trip_headsign string")
    routes = spark.createDataFrame([("r1", "1", "One", 3), ("r1", "1b", "One b", 3)],
                                   "route_id string, route_short_name string, route_long_name string, route_type int")
    stops = spark.createDataFrame([("s1", "S", 1.0, 1.0)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    cal = spark.createDataFrame([("a", "20240101", 1), ("a", "20240102", 2), ("a", "20240103", 1), ("b", "20240101", 1)],
                                "service_id string, date string, exception_type int")
    for active in (False, True):
        full = delays.schedule_summary(schedule.build_master_schedule(st, trips, routes, stops, cal, active)).first()
        fast = delays.schedule_summary_from_timetable(st, trips, routes, stops, cal, active).first()
        assert full == fast
    assert full.total_records == 2 * 2 * 2 + 1 + 1   # t1 rows x 2 route rows x 2 active dates, t2, t3
