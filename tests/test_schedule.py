from conftest import ts
from transitlab.functions.timefuncs import clock_to_seconds
from transitlab.operators import delays, schedule


def _sample(spark):
    sched = spark.createDataFrame(
        [("trip1", "stop1", 1, "10:00:00", "route1", "1", "Route 1", "Stop 1", 53.5, -113.5),
         ("trip1", "stop2", 2, "10:05:00", "route1", "1", "Route 1", "Stop 2", 53.6, -113.6)],
        "trip_id string, stop_id string, stop_sequence int, arrival_time string, route_id string, "
        "route_short_name string, route_long_name string, stop_name string, stop_lat double, stop_lon double")
    ups = spark.createDataFrame(
        [("trip1", "route1", "stop1", 120, ts("2024-01-01T10:00:00")),
         ("trip1", "route1", "stop2", 300, ts("2024-01-01T10:05:00"))],
        "trip_id string, route_id string, stop_id string, arrival_delay int, feed_timestamp timestamp")
    return sched, ups


def test_reference_delay_sample(spark):
    sched, ups = _sample(spark)
    out = delays.calculate_delays(ups, sched).orderBy("stop_id").collect()
    assert [r.delay_minutes for r in out] == [2.0, 5.0]
    assert out[0].route_id_scheduled == "route1" and out[0].stop_name == "Stop 1"
    assert "stop_sequence" in out[0].asDict() and "arrival_time" in out[0].asDict()
    stats = delays.delay_statistics(delays.calculate_delay_from_trip_updates(ups)).first()
    assert stats.on_time_rate == 1.0 and stats.total_records == 2


def test_suffix_only_on_clashing_columns(spark):
    sched, ups = _sample(spark)
    out = schedule.merge_realtime_with_schedule(ups.withColumn("stop_sequence", ups.arrival_delay * 0), sched)
    cols = set(out.columns)
    assert {"stop_sequence", "stop_sequence_scheduled", "route_id", "route_id_scheduled", "arrival_time"} <= cols
    assert "arrival_time_scheduled" not in cols
    assert schedule.merge_realtime_with_schedule(ups, sched, include_schedule_info=False).columns == ups.columns


def test_first_schedule_row_is_deterministic(spark):
    # T4: two schedule rows for one (trip, stop); the smaller stop_sequence wins, no fan-out.
    sched = spark.createDataFrame([("t", "s", 5, "10:00:00"), ("t", "s", 2, "11:00:00")],
                                  "trip_id string, stop_id string, stop_sequence int, arrival_time string")
    ups = spark.createDataFrame([("t", "s", 60)], "trip_id string, stop_id string, arrival_delay int")
    out = schedule.merge_realtime_with_schedule(ups, sched).collect()
    assert len(out) == 1 and out[0].stop_sequence == 2 and out[0].arrival_time == "11:00:00"


def _timetable(spark):
    st = spark.createDataFrame([("t1", "s1", "08:00:00", "08:00:30", 1), ("t2", "s9", "25:10:00", "25:10:00", 1)],
                               "trip_id string, stop_id string, arrival_time string, departure_time string, stop_sequence int")
    trips = spark.createDataFrame([("t1", "r1", "svc", "north")], "trip_id string, route_id string, service_id string, trip_headsign string")
    routes = spark.createDataFrame([("r1", "1", "Route 1", 3)], "route_id string, route_short_name string, route_long_name string, route_type int")
    stops = spark.createDataFrame([("s1", "Stop 1", 53.5, -113.5)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    cal = spark.createDataFrame([("svc", "20240101", 1), ("svc", "20240106", 2)], "service_id string, date string, exception_type int")
    return st, trips, routes, stops, cal


def test_master_schedule_left_joins_and_fan_out(spark):
    st, trips, routes, stops, cal = _timetable(spark)
    ms = schedule.build_master_schedule(st, trips, routes, stops, cal)
    rows = ms.orderBy("trip_id", "date").collect()
    assert len(rows) == 3                                   # t1 twice (two dates, T3), t2 once unmatched
    t1 = [r for r in rows if r.trip_id == "t1"]
    assert [r.day_of_week for r in t1] == [0, 5]            # 2024-01-01 Monday, 2024-01-06 Saturday
    assert t1[0].route_short_name == "1" and t1[0].stop_name == "Stop 1"
    t2 = [r for r in rows if r.trip_id == "t2"][0]
    assert t2.route_id is None and t2.date is None
    active = schedule.build_master_schedule(st, trips, routes, stops, cal, active_only=True)
    assert active.filter("trip_id = 't1'").count() == 1


def test_calendar_skipped_when_empty(spark):
    st, trips, routes, stops, cal = _timetable(spark)
    ms = schedule.build_master_schedule(st, trips, routes, stops, cal.limit(0))
    assert ms.count() == 2 and "date" not in ms.columns


def test_clock_text_to_seconds(spark):
    # Hours past 24; malformed, missing and short text give 0; extra parts are ignored.
    df = spark.createDataFrame([("25:10:00",), ("08:00:00",), ("ab:00:00",), (None,), ("10:00",), ("1:2:3:4",), ("",)],
                               "t string")
    got = [r[0] for r in df.select(clock_to_seconds("t")).collect()]
    assert got == [90600, 28800, 0, 0, 0, 3723, 0]


def test_timetable_merge_equals_schedule_merge_with_repeated_keys(spark):
    # dimensions that repeat keys (not allowed by the format, but must not change the answer)
    st = spark.createDataFrame([("t1", "s1", "08:00:00", "08:00:00", 2), ("t1", "s1", "07:00:00", "07:00:00", 2),
                                ("t1", "s2", "09:00:00", "09:00:00", 3), ("t9", "s1", "10:00:00", "10:00:00", 1)],
                               "trip_id string, stop_id string, arrival_time string, departure_time string, stop_sequence int")
    trips = spark.createDataFrame([("t1", "r2", "x", "h"), ("t1", "r1", "x", "h")],
                                  "trip_id string, route_id string, service_id string, trip_headsign string")
    routes = spark.createDataFrame([("r1", "B", "Bee", 3), ("r1", "A", "Zed", 3), ("r2", "C", "Cee", 3)],
                                   "route_id string, route_short_name string, route_long_name string, route_type int")
    stops = spark.createDataFrame([("s1", "Main", 1.0, 2.0), ("s1", "Main", 0.5, 2.0)],
                                  "stop_id string, stop_name string, stop_lat double, stop_lon double")
    ups = spark.createDataFrame([("t1", "s1", 60), ("t1", "s2", 0), ("t9", "s1", 1), ("t7", "s7", 2)],
                                "trip_id string, stop_id string, arrival_delay int")
    a = schedule.merge_realtime_with_schedule(ups, schedule.schedule_without_calendar(st, trips, routes, stops))
    b = schedule.merge_realtime_with_timetable(ups, st, trips, routes, stops)
    assert a.columns == b.columns
    assert sorted(a.collect()) == sorted(b.collect())
    r = {x.stop_id + x.trip_id: x for x in b.collect()}["s1t1"]
    assert (r.arrival_time, r.route_id, r.route_short_name, r.stop_lat) == ("07:00:00", "r1", "A", 0.5)


def _reference_clock(text):
    # brute-force model of the original parsing: three int() parts, anything failing gives 0
    if text is None:
        return 0
    try:
        parts = text.split(":")
        return int(parts[0]) * 3600 + int(parts[1]) * 60 + int(parts[2])
    except (ValueError, IndexError):
        return 0


def test_clock_text_matches_brute_force_model(spark):
    from hypothesis import given, settings, strategies as st
    part = st.text(alphabet="0123456789 +-_.a", min_size=0, max_size=4)
    clock = st.one_of(st.none(), st.lists(part, min_size=1, max_size=4).map(":".join))

    @settings(max_examples=4, deadline=None)
    @given(st.lists(clock, min_size=50, max_size=120))
    def check(texts):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        got = {r.i: r.s for r in df.select("i", clock_to_seconds("t").alias("s")).collect()}
        assert got == {i: _reference_clock(t) for i, t in enumerate(texts)}

    check()
