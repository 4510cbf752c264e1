"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame`` over the supplied test tables.

Each query reads whole tables through the views in ``views.py`` and applies library operators. Doubles
are rounded to 6 decimals at the very end so results compare across engines. Live views use a 24 h
freshness window ending at the newest row (the feeds are hourly, so 10 min / 1 h keep only one hour).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import archive_key
from ..functions.timefuncs import clock_to_seconds
from ..operators import delays, features, live, model, quality, reports, schedule
from ..sources import archive, feeds, gtfs_static, keyed_store, training_csv
from . import staging, views

LIVE_WINDOW = "24 HOURS"
SELECTED_ROUTES = ("click", "view")
RANKING_TOP_N = 10          # the report page asks for the top 10
WEATHER_TEMP = -5.0
RECENT_ROUTE, RECENT_LIMIT = "click", 100


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])


def _v(spark, sf, name):
    return views.view(spark, sf, name)


def _schedule3(spark, sf):
    return schedule.schedule_without_calendar(_v(spark, sf, "stop_times"), _v(spark, sf, "trips"),
                                              _v(spark, sf, "routes"), _v(spark, sf, "stops"))


def _master(spark, sf):
    return schedule.expand_service_dates(_schedule3(spark, sf), _v(spark, sf, "calendar_dates"))


def _timetable(spark, sf):
    return [_v(spark, sf, n) for n in ("stop_times", "trips", "routes", "stops")]


def _sched_delays(spark, sf):
    """A5 on the lineitem-derived updates."""
    return delays.calculate_delays_from_timetable(_v(spark, sf, "schedule_updates"), *_timetable(spark, sf))


def _live_vehicles(spark, sf):
    return live.live_vehicle_positions(_v(spark, sf, "vehicle_positions"), window=LIVE_WINDOW)


def _live_trips(spark, sf):
    return live.live_trip_delays(_v(spark, sf, "trip_updates"), window=LIVE_WINDOW)


def _scan(name):
    loaders = {"routes": gtfs_static.load_routes, "trips": gtfs_static.load_trips, "stops": gtfs_static.load_stops,
               "stop_times": gtfs_static.load_stop_times, "calendar_dates": gtfs_static.load_calendar_dates}

    def q(spark, sf):
        root = staging.stage_timetable_table(spark, sf, name)
        return loaders[name](spark, root)
    return q


def _feed(spark, sf):
    return feeds.read_feed_messages(spark, staging.stage_feed_messages(spark, sf))


def q_flatten_vehicles(spark, sf):
    return feeds.parse_vehicle_positions(_feed(spark, sf))


def q_flatten_trip_updates(spark, sf):
    return feeds.parse_trip_updates(_feed(spark, sf))


def q_archive_day(spark, sf):
    """S10 -> S11/S12: cleaned positions archived by snapshot day; the newest day read back (pruned)."""
    raw = _v(spark, sf, "vehicle_positions")
    vp = quality.clean_vehicles(raw)
    root = staging.stage_vehicle_archive(spark, sf, vp)
    schema = T.StructType([T.StructField(c, vp.schema[c].dataType) for c in vp.columns])
    # de-duplication keeps a row of every key, so the newest valid snapshot is the newest archived one
    latest_day = quality.validate_vehicle_positions(raw) \
        .agg(F.date_format(F.max("feed_timestamp"), "yyyyMMdd")).first()[0]
    return archive.read_archive(spark, root, schema, "vehicles", latest_day) \
        .select(*vp.columns, "archive_key", "date")


def q_quality_stats(spark, sf):
    return quality.quality_stats(_v(spark, sf, "vehicle_positions"), _v(spark, sf, "trip_updates"))


def q_time_range_filter(spark, sf):
    return quality.time_range_filter(_v(spark, sf, "trip_updates"), 24, "feed_timestamp")


def q_map_points(spark, sf):
    return quality.map_points(_live_vehicles(spark, sf))


def q_raw_preview(spark, sf):
    return quality.preview(_live_trips(spark, sf), ["route_id", "trip_id", "vehicle_id"], 100)


def q_updates_with_schedule(spark, sf):
    return schedule.merge_realtime_with_timetable(_v(spark, sf, "schedule_updates"), *_timetable(spark, sf))


def q_latest_delay(spark, sf):
    tu = live.with_delay_minutes(_v(spark, sf, "trip_updates"))
    return live.latest_delay_per_vehicle(tu, ("feed_timestamp", "event_id"))


def q_vehicles_with_delay(spark, sf):
    return live.vehicles_with_latest_delay(_live_vehicles(spark, sf), _live_trips(spark, sf))


def q_status_summary(spark, sf):
    drawable = quality.drawable_positions(_live_vehicles(spark, sf))
    return reports.status_summary(live.vehicles_with_latest_delay(drawable, _live_trips(spark, sf)))


def q_kpis(spark, sf):
    return reports.kpis(_live_vehicles(spark, sf), _live_trips(spark, sf))


def _tu_delays(spark, sf):
    return delays.calculate_delay_from_trip_updates(_v(spark, sf, "trip_updates"))


def q_route_ranking(spark, sf):
    return reports.route_ranking(_sched_delays(spark, sf), top_n=RANKING_TOP_N)


def q_arrival_seconds(spark, sf):
    st = _v(spark, sf, "stop_times")
    return st.select("trip_id", "stop_id", "stop_sequence", "arrival_time",
                     clock_to_seconds("arrival_time").alias("arrival_seconds"))


def q_calendar_weekday(spark, sf):
    return schedule.calendar_with_weekday(_v(spark, sf, "calendar_dates"))


def q_temporal_features(spark, sf):
    f = features.extract_temporal_features(_tu_delays(spark, sf))
    return f.select("event_id", "trip_id", "feed_timestamp", "hour_of_day", "day_of_week", "is_weekend",
                    "is_rush_hour", "time_of_day")


def q_archive_keys(spark, sf):
    snaps = _v(spark, sf, "vehicle_positions").select("feed_timestamp").distinct()
    return snaps.select("feed_timestamp", archive_key("vehicles", "feed_timestamp").alias("archive_key"))


def q_keyed_vehicles(spark, sf):
    return keyed_store.latest_items(keyed_store.vehicle_items(_v(spark, sf, "vehicle_positions")), ["event_id"])


def q_keyed_trip_updates(spark, sf):
    return keyed_store.latest_items(keyed_store.trip_update_items(_v(spark, sf, "trip_updates")), ["event_id"])


def q_recent_by_route(spark, sf):
    return keyed_store.query_recent_vehicles(q_keyed_vehicles(spark, sf), RECENT_ROUTE, RECENT_LIMIT)


def q_export_trip_updates(spark, sf):
    items = keyed_store.latest_items(keyed_store.trip_update_items(_v(spark, sf, "trip_updates")), ["event_id"])
    return keyed_store.export_record_type(items, "trip_update") \
        .select("pk", "sk", "trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "arrival_delay",
                "departure_delay", "feed_timestamp")


def q_export_written(spark, sf):
    """S16 with its file: the trip updates exported as CSV with a header and read back with declared types."""
    import uuid
    path = staging.staging_path(spark, sf, "export", uuid.uuid4().hex)
    items = keyed_store.latest_items(keyed_store.trip_update_items(_v(spark, sf, "trip_updates")), ["event_id"])
    schema = keyed_store.export_record_type(items, "trip_update", path).schema
    return spark.read.schema(schema).option("header", True).csv(path) \
        .select("pk", "sk", "trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "arrival_delay", "departure_delay", "feed_timestamp")


def q_route_encoding(spark, sf):
    d = delays.calculate_delay_from_trip_updates(_v(spark, sf, "schedule_updates"))
    enc, _ = features.encode_categorical_features(d)
    return enc.select("trip_id", "stop_id", "route_id", "route_id_encoded")


def q_weather_feature(spark, sf):
    return features.add_weather_feature(_tu_delays(spark, sf), WEATHER_TEMP) \
        .select("event_id", "feed_timestamp", "weather_temp")


def q_feature_set(spark, sf):
    fs, _ = features.create_feature_set(_tu_delays(spark, sf))
    return fs


def q_training_rows(spark, sf):
    fs, _ = features.create_feature_set(live.with_delay_minutes(_v(spark, sf, "trip_updates")))
    return model.clean_training_rows(fs, features.feature_columns(fs))


def q_regression_metrics(spark, sf):
    tu = _v(spark, sf, "trip_updates")
    pred = tu.select((F.col("arrival_delay") / F.lit(60.0)).alias("delay_minutes"),
                     (F.col("departure_delay") / F.lit(60.0)).alias("prediction")) \
        .na.drop()
    return model.regression_metrics(pred)


def _model_rows(spark, sf):
    fs, _ = features.create_feature_set(live.with_delay_minutes(_v(spark, sf, "trip_updates")))
    return fs, features.feature_columns(fs)


def _fitted_forest(spark, sf):
    """M1 -> M2 -> M6 once per application and input folder: the saved model is loaded by both model queries."""
    fs, feats = _model_rows(spark, sf)
    train, test = model.prepare_data(fs, feats)

    def build():
        fitted = model.train_random_forest(train, feats)
        return model.save_model(spark, fitted, staging.staging_path(spark, sf, "models"), "random_forest", feats, name="forest")
    path = staging.once(spark, sf, "models/forest", ("events",), build)
    return model.load_model(spark, path)[0], test


def q_delay_model_scores(spark, sf):
    """M1 -> M2 -> M7: random forest with the reference settings, scored on the held-out rows."""
    rf, test = _fitted_forest(spark, sf)
    return model.predict(rf, test).select("trip_id", "route_id", "stop_id", "feed_timestamp", "delay_minutes",
                                          "prediction")


def q_delay_model_metrics(spark, sf):
    """M4 on the held-out predictions."""
    return model.regression_metrics(q_delay_model_scores(spark, sf))


def q_split_counts(spark, sf):
    """M1: sizes of the exact 80/20 split and the rows both parts share."""
    fs, feats = _model_rows(spark, sf)
    rows = live.with_delay_minutes(_v(spark, sf, "trip_updates")).select("event_id", "delay_minutes")
    train, test = model.prepare_data(rows, ["event_id"])
    n_train, n_test = (d.select(F.count(F.lit(1))).scalar() for d in (train, test))
    shared = train.join(test, "event_id", "left_semi").select(F.count(F.lit(1))).scalar()
    return rows.na.drop().agg(F.count(F.lit(1)).alias("n")) \
        .select("n", n_train.alias("train"), n_test.alias("test"), shared.alias("overlap"))


def _model_round_trip(model_type, **params):
    def q(spark, sf):
        """Fit (M2/M3), save and load (M6, M8), score with both (M7), importances (M5): what does not depend on the trees."""
        fs, feats = _model_rows(spark, sf)
        train, test = model.prepare_data(fs, feats)
        fit = {"random_forest": model.train_random_forest, "boosted_trees": model.train_boosted_trees}[model_type]
        fitted = fit(train, feats, **params)
        path = model.save_model(spark, fitted, staging.staging_path(spark, sf, "models"), model_type, feats, name=f"trip-{model_type}")
        loaded, meta = model.load_model(spark, path)
        info = model.model_info(meta)
        both = model.predict(fitted, test).select(F.col("prediction").alias("a"), *feats) \
            .select("a", *feats).transform(lambda d: model.predict(loaded, d)) \
            .agg(F.count(F.lit(1)).alias("scored"), F.count_if(F.col("a") == F.col("prediction")).alias("equal"))
        imp = model.feature_importance(spark, loaded, feats).agg(
            F.array_join(F.array_sort(F.collect_list("feature")), ",").alias("features"), F.sum("importance").alias("importance_sum"))
        return both.join(F.broadcast(imp), F.lit(True)).join(
            F.broadcast(info.select("model_type", F.array_join("feature_names", ",").alias("feature_names"))), F.lit(True))
    return q


def _training_file(spark, sf):
    """The training export: delays with their schedule (J6) -> feature set (E5) -> CSV."""
    path = staging.staging_path(spark, sf, "training", "features.csv")

    def build():
        fs, _ = features.create_feature_set(_sched_delays(spark, sf))
        fs.write.mode("overwrite").option("header", True).csv(path)
        return path
    return staging.once(spark, sf, "training", ("lineitem", "orders", "part", "nation", "region"), build)


def q_training_table(spark, sf):
    """E5 after J6, written as a table of text and read back with declared types."""
    return training_csv.read_training_table(spark, _training_file(spark, sf))


def q_train_from_table(spark, sf):
    """M9: from the written table to the saved model; its type, rows and inputs."""
    run = model.train_delay_model(spark, _training_file(spark, sf), model_type="random_forest",
                                  model_dir=staging.staging_path(spark, sf, "models", "from-table"), n_estimators=4, max_depth=4)
    meta = model.model_info(model.load_model(spark, run["path"])[1])
    return meta.select("model_type", F.array_join("feature_names", ",").alias("feature_names"),
                       F.lit(run["metrics"]["test_samples"]).cast("long").alias("test_samples"))


def q_route_encoding_reuse(spark, sf):
    """Codes fitted on the updates, reused (not fitted again) on the updates joined with the schedule."""
    _, encoder = features.encode_categorical_features(_v(spark, sf, "schedule_updates"))
    enc, _ = features.encode_categorical_features(_sched_delays(spark, sf), fit=False, model=encoder)
    return enc.select("event_id", "route_id", "route_id_encoded")


def q_weather_hourly(spark, sf):
    """E4 with an hourly table that misses some hours and has null readings: both take the mean reading."""
    tu = _v(spark, sf, "trip_updates")
    hourly = tu.groupBy(F.col("feed_timestamp").alias("hour")).agg(F.avg("arrival_delay").alias("temperature")) \
        .filter(F.hour("hour") % 5 != 0).withColumn("temperature", F.when(F.hour("hour") % 7 != 0, F.col("temperature")))
    return features.add_weather_feature(tu, hourly).select("event_id", "feed_timestamp", "weather_temp")


def q_archive_files(spark, sf):
    """Whether the newest archived day has files, found by listing its folder."""
    vp = quality.clean_vehicles(_v(spark, sf, "vehicle_positions"))
    root = staging.stage_vehicle_archive(spark, sf, vp)
    day = quality.validate_vehicle_positions(_v(spark, sf, "vehicle_positions")) \
        .agg(F.date_format(F.max("feed_timestamp"), "yyyyMMdd")).first()[0]
    files = archive.list_archive_files(spark, root, "vehicles", day)
    return files.agg((F.count(F.lit(1)) > 0).alias("has_files"), F.min(F.col("length") > 0).alias("not_empty")) \
        .select(F.lit("vehicles").alias("data_type"), F.lit(day).alias("date"), "has_files", "not_empty")


def q_filtered_kpis(spark, sf):
    """L5 and the route selection of the report page: the selected routes in both live views, then the KPIs."""
    page = live.load_dashboard_data(_v(spark, sf, "vehicle_positions"), _v(spark, sf, "trip_updates"),
                                    vehicle_window=LIVE_WINDOW, trip_window=LIVE_WINDOW, persist=False)
    return reports.report_page(page, SELECTED_ROUTES)["kpis"]


def q_timetable_summary(spark, sf):
    """Rows of every table of the loaded timetable folder."""
    for name in ("routes", "trips", "stops", "stop_times", "calendar_dates"):
        root = staging.stage_timetable_table(spark, sf, name)
    out = None
    for name, df in gtfs_static.load_timetable(spark, root).items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_recent_any_route(spark, sf):
    """S15 without a route."""
    return keyed_store.query_recent_vehicles(q_keyed_vehicles(spark, sf), None, RECENT_LIMIT)


def q_store_upsert(spark, sf):
    """Two puts, the second replacing a third of the items and repeated as a replay would; read back from files."""
    import uuid
    path = staging.staging_path(spark, sf, "store", uuid.uuid4().hex)
    items = keyed_store.vehicle_items(_v(spark, sf, "vehicle_positions"))
    later = items.filter(F.col("event_id") % 3 == 0).withColumn("speed", F.coalesce("speed", F.lit(0.0)) + 100)
    for batch_id, put in ((0, items), (1, later), (1, later)):
        keyed_store.upsert_items(spark, put, path, ["event_id"], batch_id)
    return keyed_store.read_store(spark, path).select(*items.columns)


def q_archive_index(spark, sf):
    """S10-S12 by the index: positions archived in four batches, small snapshots merged into day files; rows of each day by the index and as read."""
    import uuid
    from ..sources import archive_index
    root = staging.staging_path(spark, sf, "archive-index", uuid.uuid4().hex)
    vp = _v(spark, sf, "vehicle_positions")
    for batch_id in range(4):
        archive.write_archive(vp.filter(F.col("event_id") % 4 == batch_id), root, "vehicles", "feed_timestamp", batch_id=batch_id)
        archive_index.index_batch(spark, root, "vehicles", batch_id)
    archive_index.merge_days(spark, root, "vehicles", vp.schema, least=4)
    archive_index.vacuum(spark, root, "vehicles", keep=1)
    listed = archive_index.list_files(spark, root, "vehicles").groupBy("date").agg(F.sum("rows").alias("rows"))
    read = archive_index.read_archive(spark, root, vp.schema, "vehicles").groupBy("date").agg(
        F.count(F.lit(1)).alias("read_rows"), F.sum("event_id").alias("event_ids"), F.count_distinct("archive_key").alias("snapshots"))
    return listed.join(read, "date", "full_outer").select(F.lit("vehicles").alias("data_type"), "date", "rows", "read_rows", "event_ids", "snapshots")


def _levelled_store(spark, sf):
    """S13/S14 in levels: five puts, merged on the way, one repeated as a replay would; the folder of the store."""
    import uuid
    from ..sources.store_levels import Levels
    root = staging.staging_path(spark, sf, "levels", uuid.uuid4().hex)
    items = keyed_store.vehicle_items(_v(spark, sf, "vehicle_positions"))
    store = Levels(spark, root, fanout=2)
    for batch_id in (0, 1, 2, 2, 3, 4):
        store.put(keyed_store.latest_items(items.filter(F.col("event_id") % 5 == batch_id), ["event_id"]), batch_id)
    store.vacuum(keep=1)
    return root


def q_store_levels(spark, sf):
    """The current items of the store in levels, read from the files of its last version."""
    from ..sources.store_levels import read_items
    return read_items(spark, _levelled_store(spark, sf))


def q_recent_by_route_files(spark, sf):
    """S15 on store files: newest items of one route by key range."""
    from ..sources.store_levels import recent_items
    return recent_items(spark, _levelled_store(spark, sf), f"VEHICLE#{RECENT_ROUTE}", RECENT_LIMIT)


VEHICLE_STORED = ["vehicle_id", "trip_id", "route_id", "latitude", "longitude", "bearing", "speed", "timestamp",
                  "current_stop_sequence", "current_status", "congestion_level", "feed_timestamp", "event_date"]
UPDATE_STORED = ["trip_id", "route_id", "vehicle_id", "stop_id", "stop_sequence", "arrival_delay", "arrival_time",
                 "departure_delay", "departure_time", "schedule_relationship", "feed_timestamp", "event_date"]


def _ingested(spark, sf, kinds, **options):
    """R1 + R2: the landed feed drained by the streaming ingest job; returns the folder it wrote."""
    import uuid
    from ..streaming import ingest
    feed = staging.stage_feed_messages(spark, sf)
    run = staging.staging_path(spark, sf, "ingest", uuid.uuid4().hex)
    stream = ingest.start_ingest(spark, feed, run, kinds, checkpoint=f"{run}/_checkpoint", **options)
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()
    return run


def _ingest_stream(kind, cols, **options):
    return lambda spark, sf: keyed_store.read_store(spark, f"{_ingested(spark, sf, kind, **options)}/store/{kind}").select(*cols)


def q_ingest_summary(spark, sf):
    """F7 on the stream: the counters of a run over both kinds, in several micro-batches."""
    from ..streaming import ingest
    return ingest.run_summary(spark, _ingested(spark, sf, tuple(ingest.KINDS), max_files_per_trigger=3)).drop("batches")


def q_ingest_memory(spark, sf):
    """R1 over runs: the feed, the feed again (all repeats), and once more after a reset of the key memory; counters of each run."""
    import uuid
    from ..streaming import ingest
    feed = staging.stage_feed_messages(spark, sf)
    root = staging.staging_path(spark, sf, "ingest-memory", uuid.uuid4().hex)
    for run in range(3):
        spark.read.text(feed).write.text(f"{root}/landed/run={run}")
        if run == 2:
            ingest.reset_memory(spark, f"{root}/out")
        stream = ingest.start_ingest(spark, f"{root}/landed/*", f"{root}/out", checkpoint=f"{root}/checkpoint", dedup="memory")
        stream.awaitTermination()
        if stream.exception() is not None:
            raise stream.exception()
    out = None
    for kind in ingest.KINDS:
        one = spark.read.parquet(f"{root}/out/counts/{kind}").select(
            F.col("batch_id").cast("int").alias("run"), F.lit(kind).alias("kind"), "processed", "valid", "invalid", "duplicate", "stored")
        out = one if out is None else out.unionByName(one)
    return out


STREAM_RUNS = 4             # scheduled runs in which the landed rows of the live streams are drained
LATE_EVERY = 50             # every so many rows land one run late


def _drained(spark, sf, name, landed, make, mode):
    """Rows with a ``run`` number landed run by run, each drained by the stream before the next lands; the batches it wrote."""
    import uuid
    from ..streaming import live_stream
    root = staging.staging_path(spark, sf, "streams", f"{name}-{uuid.uuid4().hex}")
    own = live_stream.stateful_session(spark)
    schema = T.StructType([f for f in landed.schema.fields if f.name != "run"])
    stream = own.readStream.schema(schema).parquet(f"{root}/landed/*")

    def keep(df, batch_id):
        df.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").parquet(f"{root}/out/part={batch_id}")
    for run in range(STREAM_RUNS + 1):
        landed.filter(F.col("run") == run).drop("run").write.parquet(f"{root}/landed/run={run}")
        query = make(stream).writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{root}/checkpoint") \
            .trigger(availableNow=True).start()
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return spark.read.parquet(f"{root}/out/*")


def _by_run(df, time_col):
    """Equal spans of time, one a run; every ``LATE_EVERY``-th row lands with the next one."""
    least, most = (df.select(f(F.unix_seconds(time_col))).scalar() for f in (F.min, F.max))
    run = F.floor((F.unix_seconds(time_col) - least) * STREAM_RUNS / (most - least + 1))
    return df.withColumn("run", (F.coalesce(run, F.lit(0)) + (F.col("event_id") % LATE_EVERY == 0).cast("int")).cast("int"))


def q_recent_delays_stream(spark, sf):
    """L2 as a stream over runs with late rows: every window that closed, and the rows that were too late by key."""
    from ..streaming import live_stream
    tu = _v(spark, sf, "trip_updates")
    spread = F.make_dt_interval(mins=(F.col("event_id") * 7 % 60).cast("int"), secs=(F.col("event_id") % 60).cast("decimal(18,6)"))
    landed = _by_run(tu.withColumn("feed_timestamp", F.col("feed_timestamp") + spread), "feed_timestamp")
    out = _drained(spark, sf, "recent-delays", landed, live_stream.recent_trip_delays_stream, "append")
    keys = ["route_id", "trip_id", "vehicle_id"]
    windows = out.filter("window IS NOT NULL").select(F.col("window.start").alias("window_start"), *keys, "delay_minutes", "feed_timestamp",
                                                      F.lit(0).cast("long").alias("late_rows"))
    late = out.filter("window IS NULL").groupBy(*keys).agg(F.sum("late_rows").alias("late_rows")) \
        .withColumns({"window_start": F.lit(None).cast("timestamp"), "delay_minutes": F.lit(None).cast("double"), "feed_timestamp": F.lit(None).cast("timestamp")})
    return windows.unionByName(late)


def q_fresh_vehicles_stream(spark, sf):
    """L1 as a stream whose idle vehicles leave after 10 minutes: the view after the last run."""
    from ..streaming import live_stream
    landed = _by_run(_v(spark, sf, "vehicle_positions"), "timestamp")
    out = _drained(spark, sf, "fresh-vehicles", landed, live_stream.fresh_vehicles_stream, "update")
    return live_stream.apply_updates(out)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "scan_routes": _scan("routes"),
    "scan_trips": _scan("trips"),
    "scan_stops": _scan("stops"),
    "scan_stop_times": _scan("stop_times"),
    "scan_calendar_dates": _scan("calendar_dates"),
    "flatten_vehicles": q_flatten_vehicles,
    "flatten_trip_updates": q_flatten_trip_updates,
    "archive_day": q_archive_day,
    "keyed_vehicles": q_keyed_vehicles,
    "keyed_trip_updates": q_keyed_trip_updates,
    "recent_by_route": q_recent_by_route,
    "export_trip_updates": q_export_trip_updates,
    "export_written": q_export_written,
    "recent_any_route": q_recent_any_route,
    "store_upsert": q_store_upsert,
    "store_levels": q_store_levels,
    "recent_by_route_files": q_recent_by_route_files,
    "archive_files": q_archive_files,
    "archive_index": q_archive_index,
    "timetable_summary": q_timetable_summary,
    "training_table": q_training_table,
    # quality and filters
    "valid_vehicles": lambda s, sf: quality.validate_vehicle_positions(_v(s, sf, "vehicle_positions")),
    "valid_trip_updates": lambda s, sf: quality.validate_trip_updates(_v(s, sf, "trip_updates")),
    "dedup_vehicles": lambda s, sf: quality.deduplicate_vehicle_positions(_v(s, sf, "vehicle_positions")),
    "dedup_trip_updates": lambda s, sf: quality.deduplicate_trip_updates(_v(s, sf, "trip_updates")),
    "clean_vehicles": lambda s, sf: quality.clean_vehicles(_v(s, sf, "vehicle_positions")),
    "clean_trip_updates": lambda s, sf: quality.clean_trip_updates(_v(s, sf, "trip_updates")),
    "quality_stats": q_quality_stats,
    "route_filter": lambda s, sf: quality.filter_routes(_v(s, sf, "trip_updates"), SELECTED_ROUTES),
    "time_range_filter": q_time_range_filter,
    "map_points": q_map_points,
    "raw_preview": q_raw_preview,
    "vehicle_preview": lambda s, sf: quality.preview(_live_vehicles(s, sf), ["vehicle_id"], 100),
    "route_filter_vehicles": lambda s, sf: quality.filter_routes(_v(s, sf, "vehicle_positions"), SELECTED_ROUTES),
    # joins
    "schedule_calendar": lambda s, sf: schedule.trip_service_dates(_v(s, sf, "trips"), _v(s, sf, "calendar_dates")),
    "schedule_calendar_active": lambda s, sf: schedule.trip_service_dates(
        _v(s, sf, "trips"), _v(s, sf, "calendar_dates"), active_only=True),
    "master_schedule": _master,
    "updates_with_schedule": q_updates_with_schedule,
    "vehicles_with_delay": q_vehicles_with_delay,
    # delays and aggregates
    "delays": _tu_delays,
    "calculate_delays": _sched_delays,
    "delay_statistics": lambda s, sf: delays.delay_statistics(
        delays.calculate_delay_from_trip_updates(_v(s, sf, "schedule_updates"))),
    "delay_by_route": lambda s, sf: delays.delay_by_route(_sched_delays(s, sf)),
    # the same statistics with exact medians over ranges instead of a value map
    "delay_statistics_ranges": lambda s, sf: delays.delay_statistics(
        delays.calculate_delay_from_trip_updates(_v(s, sf, "schedule_updates")), median="ranges"),
    "delay_by_route_ranges": lambda s, sf: delays.delay_by_route(_sched_delays(s, sf), median="ranges"),
    "delay_by_hour_ranges": lambda s, sf: delays.delay_by_hour(_tu_delays(s, sf), median="ranges"),
    "delay_by_hour": lambda s, sf: delays.delay_by_hour(_tu_delays(s, sf)),
    "delay_histogram": lambda s, sf: delays.delay_histogram(
        delays.calculate_delay_from_trip_updates(_v(s, sf, "schedule_updates"))),
    "hourly_trend": lambda s, sf: delays.hourly_trend(_tu_delays(s, sf)),
    "schedule_summary": lambda s, sf: delays.schedule_summary_from_timetable(
        *_timetable(s, sf), _v(s, sf, "calendar_dates")),
    "kpis": q_kpis,
    "filtered_kpis": q_filtered_kpis,
    "heatmap_long": lambda s, sf: reports.heatmap_long(_tu_delays(s, sf)),
    "heatmap_pivot": lambda s, sf: reports.heatmap_pivot(_tu_delays(s, sf)),
    "heatmap_peaks": lambda s, sf: reports.heatmap_peaks(_tu_delays(s, sf)),
    "latest_delay": q_latest_delay,
    "status_summary": q_status_summary,
    "route_ranking": q_route_ranking,
    "route_ranking_display": lambda s, sf: reports.route_ranking_display(q_route_ranking(s, sf)),
    # live views
    "live_vehicles": _live_vehicles,
    "live_trip_delays": _live_trips,
    # the same views with the original freshness windows (10 minutes / 1 hour before the newest row)
    "live_vehicles_default_window": lambda s, sf: live.live_vehicle_positions(_v(s, sf, "vehicle_positions")),
    "live_trip_delays_default_window": lambda s, sf: live.live_trip_delays(_v(s, sf, "trip_updates")),
    # scalar functions
    "arrival_seconds": q_arrival_seconds,
    "calendar_weekday": q_calendar_weekday,
    "temporal_features": q_temporal_features,
    "archive_keys": q_archive_keys,
    # features and models
    "route_encoding": q_route_encoding,
    "weather_feature": q_weather_feature,
    "feature_set": q_feature_set,
    "training_rows": q_training_rows,
    "regression_metrics": q_regression_metrics,
    "route_encoding_reuse": q_route_encoding_reuse,
    "weather_hourly": q_weather_hourly,
    "split_counts": q_split_counts,
    "forest_round_trip": _model_round_trip("random_forest", n_estimators=5, max_depth=5),
    "boosted_round_trip": _model_round_trip("boosted_trees"),
    "train_from_table": q_train_from_table,
    "delay_model_scores": q_delay_model_scores,
    "delay_model_metrics": q_delay_model_metrics,
    # streaming
    "ingest_vehicles_stream": _ingest_stream("vehicles", VEHICLE_STORED),
    "ingest_trip_updates_stream": _ingest_stream("trip_updates", UPDATE_STORED),
    # the newest files first, in several micro-batches: everything after the first one is late
    "ingest_out_of_order": _ingest_stream("vehicles", VEHICLE_STORED, max_files_per_trigger=2, latest_first=True),
    "ingest_summary": q_ingest_summary,
    "ingest_memory": q_ingest_memory,
    "recent_delays_stream": q_recent_delays_stream,
    "fresh_vehicles_stream": q_fresh_vehicles_stream,
}

# Scores of trained models: rows-only checks (tree ensembles have no SQL equivalent).
ROWS_ONLY = ("delay_model_scores", "delay_model_metrics")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        return lambda spark, sf_dir: rounded(fn(spark, sf_dir))
    return {name: wrap(fn) for name, fn in QUERIES.items()}
