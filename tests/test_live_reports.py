from conftest import ts
from transitlab.operators import live, reports

VP = "vehicle_id string, route_id string, latitude double, longitude double, speed double, timestamp timestamp, event_id long"


def test_live_vehicles_last_non_null_per_column(spark):
    # The newest row has a null speed, so speed comes from an older row.
    rows = [("v1", "r1", 53.1, -113.1, 5.0, ts("2024-01-01T10:00:00"), 1),
            ("v1", None, 53.2, -113.2, None, ts("2024-01-01T10:05:00"), 2),
            ("v2", "r2", 1.0, 1.0, 1.0, ts("2024-01-01T09:00:00"), 3),        # older than the cutoff
            (None, "r3", 1.0, 1.0, 1.0, ts("2024-01-01T10:06:00"), 4)]        # null vehicle dropped
    out = live.live_vehicle_positions(spark.createDataFrame(rows, VP), as_of="2024-01-01T10:06:00").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.vehicle_id, r.route_id, r.latitude, r.speed) == ("v1", "r1", 53.2, 5.0)
    assert r.timestamp == ts("2024-01-01T10:05:00") and "event_id" not in r.asDict()


def test_live_vehicles_ties_break_by_arrival(spark):
    t = ts("2024-01-01T10:00:00")
    rows = [("v1", "a", 1.0, 1.0, 1.0, t, 2), ("v1", "b", 2.0, 2.0, 2.0, t, 1)]
    r = live.live_vehicle_positions(spark.createDataFrame(rows, VP)).first()
    assert r.route_id == "a"


def test_delay_column_choice(spark):
    # L3 keeps a missing delay as null (A1 would make it 0).
    a = spark.createDataFrame([(120,), (None,)], "arrival_delay int")
    assert sorted([r.delay_minutes for r in live.with_delay_minutes(a).collect()], key=lambda x: (x is None, x)) == [2.0, None]
    d = spark.createDataFrame([(60,)], "departure_delay int")
    assert live.with_delay_minutes(d).first().delay_minutes == 1.0
    both = spark.createDataFrame([(1.5, 600)], "delay_minutes double, arrival_delay int")
    assert live.with_delay_minutes(both).first().delay_minutes == 1.5


def _updates(spark):
    rows = [("r1", "t1", "v1", 60, ts("2024-01-01T10:00:00")), ("r1", "t1", "v1", 180, ts("2024-01-01T10:30:00")),
            ("r1", "t2", "v1", None, ts("2024-01-01T10:40:00")), (None, "t3", "v2", 60, ts("2024-01-01T10:40:00")),
            ("r2", "t4", "v3", 600, ts("2024-01-01T08:00:00"))]
    return spark.createDataFrame(rows, "route_id string, trip_id string, vehicle_id string, arrival_delay int, feed_timestamp timestamp")


def test_live_trip_delays(spark):
    out = {r.trip_id: r for r in live.live_trip_delays(_updates(spark)).collect()}
    assert set(out) == {"t1", "t2"}                       # null route dropped; 08:00 is older than 1 h
    assert out["t1"].delay_minutes == 2.0 and out["t1"].feed_timestamp == ts("2024-01-01T10:00:00")
    assert out["t2"].delay_minutes is None


def test_latest_delay_skips_null_and_join(spark):
    trips = live.live_trip_delays(_updates(spark))
    latest = {r.vehicle_id: r.delay_minutes for r in live.latest_delay_per_vehicle(trips).collect()}
    assert latest == {"v1": 2.0}                          # t2 is newer but has no delay
    vehicles = spark.createDataFrame([("v1", 1.0, 1.0), ("v9", 1.0, 1.0)], "vehicle_id string, latitude double, longitude double")
    j = {r.vehicle_id: r.delay_minutes for r in live.vehicles_with_latest_delay(vehicles, trips).collect()}
    assert j == {"v1": 2.0, "v9": None}
    s = reports.status_summary(live.vehicles_with_latest_delay(vehicles, trips)).first()
    assert (s.on_time, s.slight_delay, s.delayed, s.unknown) == (1, 0, 0, 1)


def test_status_bucket_edges(spark):
    df = spark.createDataFrame([(-3.0,), (2.0,), (2.5,), (5.0,), (5.1,), (None,)], "delay_minutes double")
    s = reports.status_summary(df).first()
    assert (s.on_time, s.slight_delay, s.delayed, s.unknown) == (2, 2, 1, 1)


def test_kpis_null_vehicle_counts_once_and_labels(spark):
    vehicles = spark.createDataFrame([("v1",), ("v2",), (None,), (None,)], "vehicle_id string")
    trips = spark.createDataFrame([(1.0,), (2.0,), (9.0,), (None,)], "delay_minutes double")
    k = reports.kpis(vehicles, trips).first()
    assert k.active_buses == 3                             # T9
    assert k.avg_delay == 4.0 and k.avg_delay_status == "inverse"
    assert k.on_time_rate == 50.0 and k.on_time_label == "Below Target"
    empty = reports.kpis(vehicles.limit(0), trips.limit(0)).first()
    assert (empty.active_buses, empty.avg_delay_status, empty.on_time_label) == (0, "N/A", "N/A")


def _cells(spark):
    rows = [("a", 1.0, ts("2024-01-01T08:00:00")), ("a", 3.0, ts("2024-01-01T08:30:00")),
            ("a", 10.0, ts("2024-01-01T09:00:00")), ("b", 4.0, ts("2024-01-01T08:00:00")),
            ("b", 0.0, ts("2024-01-01T09:00:00"))]
    return spark.createDataFrame(rows, "route_id string, delay_minutes double, feed_timestamp timestamp")


def test_heatmap_long_pivot_and_peaks(spark):
    df = _cells(spark)
    cells = {(r.route_id, r.hour): r.delay_minutes for r in reports.heatmap_long(df).collect()}
    assert cells == {("a", 8): 2.0, ("a", 9): 10.0, ("b", 8): 4.0, ("b", 9): 0.0}
    wide = {r.route_id: r for r in reports.heatmap_pivot(df).collect()}
    assert wide["a"].h08 == 2.0 and wide["a"].h09 == 10.0 and wide["a"].h10 is None
    assert len(reports.heatmap_pivot(df).columns) == 25
    peaks = {r.dimension: (r.key, r.avg_delay) for r in reports.heatmap_peaks(df).collect()}
    # Hour 9 -> mean of cell means (10 + 0) / 2 = 5 > hour 8 (2 + 4) / 2 = 3; route a = 6 > b = 2
    assert peaks == {"hour": ("9", 5.0), "route": ("a", 6.0)}


def test_heatmap_peak_tie_goes_to_lowest_key(spark):
    rows = [("b", 2.0, ts("2024-01-01T09:00:00")), ("a", 2.0, ts("2024-01-01T08:00:00"))]
    df = spark.createDataFrame(rows, "route_id string, delay_minutes double, feed_timestamp timestamp")
    peaks = {r.dimension: r.key for r in reports.heatmap_peaks(df).collect()}
    assert peaks == {"hour": "8", "route": "a"}


def test_route_ranking_and_display(spark):
    rows = [("10", "Ten", float(d)) for d in (1, 2, 3, 4, 5)] + [("2", "Two", 9.0)] * 4 + \
           [("3", "Three", 0.125)] * 5 + [("4", "Four", 3.0)] * 5
    df = spark.createDataFrame(rows, "route_short_name string, route_long_name string, delay_minutes double")
    r = reports.route_ranking(df, top_n=2).collect()
    assert [(x.route_short_name, x.avg_delay, x.num_updates, x.route_name) for x in r] == \
        [("10", 3.0, 5, "Ten"), ("4", 3.0, 5, "Four")]          # route 2 has only 4 updates; tie -> key order
    full = reports.route_ranking(df).collect()
    shown = reports.route_ranking_display(reports.route_ranking(df)).collect()
    assert shown[-1]["Avg Delay"] == "0.12 min" and shown[-1]["Route"] == "3"   # half-even like the reference
    assert len(full) == 3


def test_dashboard_bundle_has_expected_columns(spark):
    vp = spark.createDataFrame([("v1", "r1", 53.1, -113.1, 5.0, ts("2024-01-01T10:00:00"), 1)], VP)
    data = live.load_dashboard_data(vp, _updates(spark), as_of="2024-01-01T10:05:00")
    assert data["data_source"] == "live"
    assert set(data["vehicles"].columns) == {"vehicle_id", "route_id", "latitude", "longitude", "speed", "timestamp"}
    assert data["trip_updates"].columns == ["route_id", "trip_id", "vehicle_id", "delay_minutes", "feed_timestamp"]
    assert data["vehicles"].count() == 1
    empty = live.load_dashboard_data(vp.limit(0), _updates(spark).limit(0))
    assert empty["vehicles"].count() == 0 and empty["trip_updates"].count() == 0   # no fallback to sample data
