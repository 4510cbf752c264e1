import math

from pyspark.sql import functions as F

from conftest import ts
from transitlab.operators import quality

VP = "vehicle_id string, latitude double, longitude double, speed double, timestamp timestamp, event_id long"
TU = "trip_id string, stop_id string, feed_timestamp timestamp, event_id long"


def test_vehicle_validation_reference_cases(spark):
    rows = [("1", 53.5461, -113.4937, None, ts("2024-01-01T10:00:00"), 1),   # valid
            ("2", 53.5, None, None, ts("2024-01-01T10:00:00"), 2),           # missing longitude
            ("3", 95.0, -113.4, None, ts("2024-01-01T10:00:00"), 3)]          # latitude out of range
    out = quality.validate_vehicle_positions(spark.createDataFrame(rows, VP))
    assert [r.vehicle_id for r in out.collect()] == ["1"]


def test_vehicle_bounds_nan_and_speed(spark):
    t = ts("2024-01-01T10:00:00")
    rows = [("a", 90.0, 180.0, 0.0, t, 1),          # exact bounds are allowed
            ("b", -90.0, -180.0, None, t, 2),
            ("c", float("nan"), 10.0, None, t, 3),  # T1: NaN rejected explicitly
            ("d", 10.0, 10.0, -0.5, t, 4),          # negative speed
            ("e", 10.0, 10.0, None, None, 5),       # missing timestamp
            (None, 10.0, 10.0, None, t, 6)]
    out = quality.validate_vehicle_positions(spark.createDataFrame(rows, VP))
    assert sorted(r.vehicle_id for r in out.collect()) == ["a", "b"]


def test_missing_column_fails_validation(spark):
    df = spark.createDataFrame([("1", 1.0, ts("2024-01-01T00:00:00"))], "vehicle_id string, latitude double, timestamp timestamp")
    assert quality.validate_vehicle_positions(df).count() == 0


def test_trip_update_validation(spark):
    t = ts("2024-01-01T10:00:00")
    df = spark.createDataFrame([("t1", "s1", t, 1), ("t1", None, t, 2)], TU)
    assert quality.validate_trip_updates(df).count() == 1


def test_dedup_keeps_first_arrival(spark):
    t = ts("2024-01-01T10:00:00")
    rows = [("1", 53.5, -113.4, 1.0, t, 2), ("1", 53.6, -113.4, 2.0, t, 1), ("2", 53.5, -113.4, None, t, 3)]
    out = quality.deduplicate_vehicle_positions(spark.createDataFrame(rows, VP)).orderBy("vehicle_id").collect()
    assert len(out) == 2
    assert out[0].event_id == 1 and out[0].latitude == 53.6


def test_dedup_keys_are_tuples_not_joined_text(spark):
    # ('1_2', '3') and ('1', '2_3') would collide as "1_2_3"; they are different keys here.
    df = spark.createDataFrame([("1_2", "3", ts("2024-01-01T00:00:00"), 1), ("1", "2_3", ts("2024-01-01T00:00:00"), 2)], TU)
    assert quality.deduplicate_trip_updates(df).count() == 2


def test_clean_and_stats_reference_sample(spark):
    t0, t1 = ts("2024-01-01T10:00:00"), ts("2024-01-01T10:01:00")
    rows = [("1", 53.5461, -113.4937, None, t0, 1), ("1", 53.5461, -113.4937, None, t0, 2),
            ("2", None, -113.4937, None, t0, 3), ("3", 53.55, -113.5, None, t1, 4)]
    vp = spark.createDataFrame(rows, VP)
    assert quality.clean_vehicles(vp).count() == 2
    tu = spark.createDataFrame([("a", "s", t0, 1), ("a", "s", t0, 2), ("b", None, t0, 3)], TU)
    stats = {r.record_type: r.asDict() for r in quality.quality_stats(vp, tu).collect()}
    v = stats["vehicle_position"]
    assert (v["processed"], v["valid"], v["invalid"], v["duplicate"]) == (4, 3, 1, 1)
    t = stats["trip_update"]
    assert (t["processed"], t["valid"], t["invalid"], t["duplicate"]) == (3, 2, 1, 1)


def test_stats_on_empty_input(spark):
    vp = spark.createDataFrame([], VP)
    r = quality.quality_stats(vp).first()
    assert (r.processed, r.valid, r.invalid, r.duplicate) == (0, 0, 0, 0)


def test_route_filter_and_empty_selection(spark):
    df = spark.createDataFrame([("1",), ("2",), (None,)], "route_id string")
    assert quality.filter_routes(df, ["1"]).count() == 1
    assert quality.filter_routes(df, []).count() == 3


def test_time_range_filter_is_strict(spark):
    df = spark.createDataFrame([(ts("2024-01-02T00:00:00"),), (ts("2024-01-01T00:00:00"),),
                                (ts("2024-01-01T00:00:01"),), (None,)], "feed_timestamp timestamp")
    assert quality.time_range_filter(df, 24).count() == 2          # exactly 24 h old is out
    assert quality.time_range_filter(df, None).count() == 4
    # only a lower cutoff, as in the reference: rows after as_of also pass
    assert quality.time_range_filter(df, 1, as_of="2024-01-01T00:30:00").count() == 3


def test_map_points(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 0.0, 2.0), ("c", None, 2.0), ("d", float("nan"), 1.0)],
                               "vehicle_id string, latitude double, longitude double")
    out = quality.map_points(df).collect()
    assert [(r.vehicle_id, r.size) for r in out] == [("a", 50)]


def test_preview_counts_all_rows(spark):
    df = spark.range(250).withColumnRenamed("id", "k")
    out = quality.preview(df, ["k"], 100).collect()
    assert len(out) == 100 and out[0].total_rows == 250 and out[-1].k == 99
