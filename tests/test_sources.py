import os

import pytest
from pyspark.sql import functions as F

from conftest import ts
from transitlab.schemas import FEED_MESSAGE
from transitlab.sources import archive, feeds, gtfs_static, keyed_store, training_csv


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_timetable_scan_by_header_name_ids_stay_text(spark, tmp_dir):
    # columns in another order plus an extra one; numeric-looking ids stay text ('007' keeps its zeros)
    _write(f"{tmp_dir}/routes.txt", "route_type,route_long_name,route_id,route_short_name,agency\n3,Long,007,7,x\n")
    _write(f"{tmp_dir}/trips.txt", "trip_id,route_id,service_id\n1,007,wk\n")
    _write(f"{tmp_dir}/stops.txt", "stop_id,stop_name,stop_lat,stop_lon\n10,Main,53.5,-113.5\n")
    _write(f"{tmp_dir}/stop_times.txt", "trip_id,arrival_time,departure_time,stop_id,stop_sequence\n1,25:10:00,25:11:00,10,1\n")
    t = gtfs_static.load_timetable(spark, tmp_dir)
    r = t["routes"].first()
    assert (r.route_id, r.route_short_name, r.route_long_name, r.route_type) == ("007", "7", "Long", 3)
    assert t["trips"].first().trip_headsign is None
    assert t["stops"].first().stop_lat == 53.5
    assert t["stop_times"].first().arrival_time == "25:10:00"
    cal = t["calendar_dates"]                      # optional file missing -> typed empty table
    assert cal.count() == 0 and cal.columns == ["service_id", "date", "exception_type"]


def test_required_timetable_file_missing(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        gtfs_static.load_routes(spark, tmp_dir)


def test_timetable_write_read_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a, with comma", 53.5, -113.5)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    gtfs_static.write_timetable_table(df, tmp_dir, "stops")
    assert gtfs_static.load_stops(spark, tmp_dir).collect() == df.collect()


def _feed(spark):
    msg = {
        "header": {"timestamp": 1704103200},
        "entity": [
            {"id": "1", "vehicle": {"vehicle": {"id": "v1"}, "trip": {"trip_id": "t1", "route_id": "r1"},
                                    "position": {"latitude": 53.5, "longitude": -113.5, "speed": 4.0},
                                    "timestamp": 1704103190}},
            {"id": "2", "trip_update": {"trip": {"trip_id": "t1", "route_id": "r1"}, "vehicle": {"id": "v1"},
                                        "stop_time_update": [{"stop_id": "s1", "stop_sequence": 1, "arrival": {"delay": 120}},
                                                             {"stop_id": "s2", "stop_sequence": 2,
                                                              "departure": {"delay": 60, "time": 1704103300}}]}},
            {"id": "3", "trip_update": {"trip": {"trip_id": "t2"}, "stop_time_update": []}},
            {"id": "4"},
        ]}
    import json
    return spark.read.schema(FEED_MESSAGE).json(spark.sparkContext.parallelize([json.dumps(msg)]))


def test_flatten_vehicle_positions(spark):
    rows = feeds.parse_vehicle_positions(_feed(spark)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.vehicle_id, r.route_id, r.latitude, r.bearing) == ("v1", "r1", 53.5, None)
    assert r.timestamp == ts("2024-01-01T09:59:50") and r.feed_timestamp == ts("2024-01-01T10:00:00")


def test_flatten_trip_updates(spark):
    rows = feeds.parse_trip_updates(_feed(spark)).orderBy("stop_id").collect()
    assert [(r.trip_id, r.stop_id, r.arrival_delay, r.departure_delay) for r in rows] == \
        [("t1", "s1", 120, None), ("t1", "s2", None, 60)]
    assert rows[1].departure_time == ts("2024-01-01T10:01:40") and rows[0].vehicle_id == "v1"


def test_missing_feed_time_uses_ingest_time(spark):
    import json
    df = spark.read.schema(FEED_MESSAGE).json(spark.sparkContext.parallelize(
        [json.dumps({"header": {}, "entity": [{"id": "1", "vehicle": {"vehicle": {"id": "v"}}}]})]))
    r = feeds.parse_vehicle_positions(df, ingest_ts=F.lit(ts("2024-02-02T00:00:00"))).first()
    assert r.feed_timestamp == ts("2024-02-02T00:00:00") and r.timestamp == ts("2024-02-02T00:00:00")


def test_archive_write_read_list(spark, tmp_dir):
    df = spark.createDataFrame([("v1", ts("2024-01-01T10:00:00")), ("v2", ts("2024-01-02T11:30:05"))],
                               "vehicle_id string, feed_timestamp timestamp")
    root = f"{tmp_dir}/archive"
    assert archive.write_archive(df.limit(0), root, "vehicles") is False      # empty batch writes nothing
    assert not os.path.exists(root)
    assert archive.write_archive(df, root, "vehicles", batch_id=7)
    assert archive.write_archive(df, root, "vehicles", batch_id=7)           # replay replaces, no duplicates
    schema = df.schema
    day = archive.read_archive(spark, root, schema, "vehicles", "20240102").collect()
    assert [r.vehicle_id for r in day] == ["v2"] and day[0].archive_key == "transit/vehicles/20240102/20240102_113005.json"
    assert archive.read_archive(spark, root, schema).count() == 2
    files = [r.file_path for r in archive.list_archive_files(spark, root, "vehicles", "20240101").collect()]
    assert files and all("date=20240101" in f for f in files)


def test_keyed_store_upsert_later_put_wins(spark, tmp_dir):
    path = f"{tmp_dir}/store"
    vp = "vehicle_id string, route_id string, latitude double, timestamp timestamp, event_id long"
    b1 = spark.createDataFrame([("v1", "r1", 1.0, ts("2024-01-01T10:00:00"), 1), ("v2", None, 2.0, ts("2024-01-01T10:00:00"), 2)], vp)
    keyed_store.upsert_items(spark, keyed_store.vehicle_items(b1), path, ["event_id"], 0)
    b2 = spark.createDataFrame([("v1", "r1", 9.0, ts("2024-01-01T10:00:00"), 0), ("v3", "r1", 3.0, ts("2024-01-01T10:05:00"), 3)], vp)
    keyed_store.upsert_items(spark, keyed_store.vehicle_items(b2), path, ["event_id"], 1)
    keyed_store.upsert_items(spark, keyed_store.vehicle_items(b2), path, ["event_id"], 1)      # a replay
    assert keyed_store.read_puts(spark, path).count() == 4
    store = keyed_store.read_store(spark, path)
    got = {(r.pk, r.sk): r.latitude for r in store.collect()}
    assert got == {("VEHICLE#r1", "2024-01-01T10:00:00#v1"): 9.0,          # the later put wins
                   ("VEHICLE#None", "2024-01-01T10:00:00#v2"): 2.0,        # T15
                   ("VEHICLE#r1", "2024-01-01T10:05:00#v3"): 3.0}
    recent = keyed_store.query_recent_vehicles(store, "r1", limit=1).collect()
    assert [r.vehicle_id for r in recent] == ["v3"]
    assert keyed_store.query_recent_vehicles(store, None, limit=10).count() == 3


def test_store_reads_only_touched_days_and_compacts(spark, tmp_dir):
    import contextlib
    import io
    path = f"{tmp_dir}/days"
    vp = "vehicle_id string, route_id string, latitude double, timestamp timestamp, event_id long"
    rows = [("v", "r", float(d), ts(f"2024-01-{d:02d}T10:00:00"), d) for d in range(1, 6)]
    items = keyed_store.vehicle_items(spark.createDataFrame(rows, vp))
    assert keyed_store.read_store(spark, path) is None and keyed_store.compact(spark, path, f"{path}-new") is None
    keyed_store.upsert_items(spark, items, path, ["event_id"], 0)
    keyed_store.upsert_items(spark, items.filter("event_id = 2").withColumn("latitude", F.lit(9.0)), path, ["event_id"], 3)
    day = keyed_store.read_store(spark, path, ["2024-01-02"], items.schema)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day.explain()
    assert "PartitionFilters: [event_date" in buf.getvalue().replace("isnotnull(event_date#", "event_date#") or "event_date" in \
        buf.getvalue().split("PartitionFilters:")[1].split("]")[0]
    assert [(r.latitude, r.event_date) for r in day.collect()] == [(9.0, "2024-01-02")]
    compacted = keyed_store.compact(spark, path, f"{path}-new")
    assert sorted(r.latitude for r in compacted.collect()) == [1.0, 3.0, 4.0, 5.0, 9.0]
    assert keyed_store.read_puts(spark, f"{path}-new").count() == 5
    keyed_store.upsert_items(spark, items.filter("event_id = 1").withColumn("latitude", F.lit(7.0)), f"{path}-new", ["event_id"], 4)
    assert sorted(r.latitude for r in keyed_store.read_store(spark, f"{path}-new").collect()) == [3.0, 4.0, 5.0, 7.0, 9.0]


def test_failed_put_leaves_the_store_whole(spark, tmp_dir):
    import pytest
    path = f"{tmp_dir}/failing"
    vp = "vehicle_id string, route_id string, latitude double, timestamp timestamp, event_id long"
    good = keyed_store.vehicle_items(spark.createDataFrame([("v", "r", 1.0, ts("2024-01-01T10:00:00"), 1)], vp))
    keyed_store.upsert_items(spark, good, path, ["event_id"], 0)
    bad = good.withColumn("latitude", F.when(F.col("event_id") > 0, F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(Exception):
        keyed_store.upsert_items(spark, bad, path, ["event_id"], 1)
    assert [r.latitude for r in keyed_store.read_store(spark, path).collect()] == [1.0]


def test_writers_leave_the_callers_cache_alone(spark, tmp_dir):
    vp = "vehicle_id string, route_id string, timestamp timestamp, feed_timestamp timestamp, event_id long"
    df = spark.createDataFrame([("v", "r", ts("2024-01-01T10:00:00"), ts("2024-01-01T10:00:00"), 1)], vp).cache()
    df.count()
    archive.write_archive(df, f"{tmp_dir}/a", "vehicles", batch_id=1)
    assert df.storageLevel.useMemory
    items = keyed_store.vehicle_items(df).cache()
    keyed_store.upsert_items(spark, items, f"{tmp_dir}/s", ["event_id"], 1)
    assert items.storageLevel.useMemory and df.storageLevel.useMemory
    items.unpersist()
    df.unpersist()


def test_trip_update_keys_and_export(spark, tmp_dir):
    tu = spark.createDataFrame([("t1", "r1", "s1", ts("2024-01-01T10:00:00.250000"), 1)],
                               "trip_id string, route_id string, stop_id string, feed_timestamp timestamp, event_id long")
    items = keyed_store.trip_update_items(tu)
    r = items.first()
    assert (r.pk, r.sk, r.event_date) == ("TRIP#r1", "2024-01-01T10:00:00.250000#t1#s1", "2024-01-01")
    out = keyed_store.export_record_type(items, "trip_update", f"{tmp_dir}/export")
    assert out.count() == 1 and spark.read.option("header", True).csv(f"{tmp_dir}/export").count() == 1


def test_training_table_scan(spark, tmp_dir):
    _write(f"{tmp_dir}/train.csv", "trip_id,hour_of_day,route_id_encoded,delay_minutes\nt,8,2,1.5\nu,x,1,\n")
    df = training_csv.read_training_table(spark, f"{tmp_dir}/train.csv")
    assert dict(df.dtypes) == {"trip_id": "string", "hour_of_day": "int", "route_id_encoded": "int", "delay_minutes": "double"}
    assert [r.hour_of_day for r in df.collect()] == [8, None]


def test_archive_as_a_stream(spark, tmp_dir):
    df = spark.createDataFrame([("v1", ts("2024-01-01T10:00:00")), ("v2", ts("2024-01-02T11:30:05"))],
                               "vehicle_id string, feed_timestamp timestamp")
    root = f"{tmp_dir}/archive_s"
    archive.write_archive(df, root, "vehicles", batch_id=1)
    s = archive.read_archive_stream(spark, root, df.schema, "vehicles")
    q = s.writeStream.format("memory").queryName("archive_stream_test") \
        .option("checkpointLocation", f"{tmp_dir}/ck_arch").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.vehicle_id, r.date) for r in spark.sql("SELECT * FROM archive_stream_test").collect())
    assert got == [("v1", "20240101"), ("v2", "20240102")]


def test_master_schedule_from_text_tables(spark, tmp_dir):
    _write(f"{tmp_dir}/routes.txt", "route_id,route_short_name,route_long_name,route_type\nr1,1,One,3\n")
    _write(f"{tmp_dir}/trips.txt", "route_id,service_id,trip_id,trip_headsign\nr1,wk,t1,North\n")
    _write(f"{tmp_dir}/stops.txt", "stop_id,stop_name,stop_lat,stop_lon\ns1,Main,53.5,-113.5\n")
    _write(f"{tmp_dir}/stop_times.txt", "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,08:00:00,08:00:00,s1,1\n")
    _write(f"{tmp_dir}/calendar_dates.txt", "service_id,date,exception_type\nwk,20240101,1\nwk,20240102,1\n")
    ms = gtfs_static.load_master_schedule(spark, tmp_dir).orderBy("date").collect()
    assert [(r.trip_id, r.route_short_name, r.stop_name, r.day_of_week) for r in ms] == \
        [("t1", "1", "Main", 0), ("t1", "1", "Main", 1)]


def test_read_snapshots_in_the_original_layout(spark, tmp_dir):
    import json
    recs = [{"vehicle_id": "1", "latitude": 53.5461, "longitude": -113.4937, "timestamp": "2024-01-01T10:00:00"},
            {"vehicle_id": "2", "latitude": 53.55, "longitude": -113.5, "timestamp": "2024-01-01T10:00:30"}]
    _write(f"{tmp_dir}/transit/vehicles/20240101/20240101_100000.json", json.dumps(recs, indent=2))
    _write(f"{tmp_dir}/transit/vehicles/20240102/20240102_000000.json", json.dumps(recs[:1], indent=2))
    schema = "vehicle_id string, latitude double, longitude double, timestamp timestamp"
    from pyspark.sql.types import _parse_datatype_string
    day = archive.read_snapshot_files(spark, tmp_dir, _parse_datatype_string(schema), "vehicles", "20240101")
    rows = sorted(day.collect())
    assert [(r.vehicle_id, r.timestamp, r.date, r.archive_key) for r in rows] == [
        ("1", ts("2024-01-01T10:00:00"), "20240101", "transit/vehicles/20240101/20240101_100000.json"),
        ("2", ts("2024-01-01T10:00:30"), "20240101", "transit/vehicles/20240101/20240101_100000.json")]
    assert archive.read_snapshot_files(spark, tmp_dir, _parse_datatype_string(schema), "vehicles").count() == 3


def test_archive_day_filter_prunes_partitions(spark, tmp_dir):
    import contextlib
    import io
    df = spark.createDataFrame([("v1", ts("2024-01-01T10:00:00")), ("v2", ts("2024-01-02T11:30:05"))],
                               "vehicle_id string, feed_timestamp timestamp")
    root = f"{tmp_dir}/archive_p"
    archive.write_archive(df, root, "vehicles", batch_id=3)
    day = archive.read_archive(spark, root, df.schema, "vehicles", "20240102")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # explain cuts scan metadata at 100 chars
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            day.explain()
        plan = buf.getvalue()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    assert "PartitionFilters: [" in plan and "(date#" in plan and "= 20240102)" in plan
    assert [r.vehicle_id for r in day.collect()] == ["v2"]


def test_changed_inputs_are_staged_again(spark, tmp_dir):
    from transitlab.plans import staging
    built = []

    def once():
        return staging.once(spark, tmp_dir, "probe", ("events",), lambda: built.append(1) or f"run {len(built)}")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    assert once() == once() == "run 1"
    spark.range(5).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    assert once() == "run 2"
    spark.range(4).coalesce(1).write.mode("overwrite").parquet(f"{tmp_dir}/events.parquet")
    assert once() == once() == "run 3"


def test_feed_messages_are_made_with_one_shuffle(spark, tmp_dir):
    from pyspark.sql import functions as F

    from transitlab.plans import staging
    spark.sql("""SELECT id AS event_id, TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, CAST(id AS INT) * 7) AS ts, id % 5 AS user_id, 'view' AS event_type,
                 id * 0.5D AS value, concat('{"k": ', id % 9, '}') AS props FROM range(600)""").write.parquet(f"{tmp_dir}/events.parquet")
    msgs = staging._feed_messages(spark, tmp_dir)
    plan = msgs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 0
    # vehicle, update and (every 60th) empty update of each event, at most 256 events a message
    assert msgs.select(F.sum(F.size("entity")), F.max(F.size("entity"))).first()[0] == 600 + 600 + 10
    assert msgs.select(F.explode("entity").alias("e")).select("e.id").distinct().count() == 1210
