import pytest
from pyspark.sql import functions as F

from conftest import ts
from transitlab.functions.timefuncs import time_of_day
from transitlab.operators import features, model

DELAYS = "trip_id string, route_id string, stop_id string, feed_timestamp timestamp, delay_minutes double"


def _delays(spark):
    rows = [("t1", "10", "s1", ts("2024-01-01T08:30:00"), 2.0),   # Monday
            ("t2", "2", "s2", ts("2024-01-01T17:45:00"), 5.0),    # Monday
            ("t3", None, "s3", ts("2024-01-06T14:00:00"), 1.0)]   # Saturday
    return spark.createDataFrame(rows, DELAYS)


def test_temporal_features(spark):
    out = features.extract_temporal_features(_delays(spark)).orderBy("trip_id").collect()
    assert [r.hour_of_day for r in out] == [8, 17, 14]
    assert [r.is_rush_hour for r in out] == [1, 1, 0]
    assert [r.day_of_week for r in out] == [0, 0, 5]
    assert [r.is_weekend for r in out] == [0, 0, 1]
    assert [r.time_of_day for r in out] == ["morning", "afternoon", "afternoon"]


def test_rush_hour_and_time_of_day_edges(spark):
    hours = [0, 6, 7, 9, 10, 12, 13, 15, 16, 18, 19, 23]
    df = spark.createDataFrame([(ts(f"2024-01-01T{h:02d}:59:00"),) for h in hours], "t timestamp")
    out = features.extract_temporal_features(df, "t").collect()
    assert [r.is_rush_hour for r in out] == [0, 0, 1, 1, 0, 0, 0, 0, 1, 1, 0, 0]
    assert [r.time_of_day for r in out] == ["night", "night", "morning", "morning", "morning", "morning",
                                            "afternoon", "afternoon", "afternoon", "afternoon", "evening", "evening"]


def test_route_encoding_code_point_order_and_null_class(spark):
    # T16: '10' < '2' < 'None'
    enc, m = features.encode_categorical_features(_delays(spark))
    codes = {r.trip_id: r.route_id_encoded for r in enc.collect()}
    assert codes == {"t1": 0, "t2": 1, "t3": 2}
    assert dict(enc.dtypes)["route_id_encoded"] == "int"
    unseen = spark.createDataFrame([("t9", "99", "s", ts("2024-01-01T00:00:00"), 0.0)], DELAYS)
    with pytest.raises(Exception):
        features.encode_categorical_features(unseen, fit=False, model=m)[0].collect()
    kept = features.encode_route(unseen, m, handle_invalid="keep").first()
    assert kept.route_id_encoded == 3
    with pytest.raises(ValueError):
        features.encode_categorical_features(unseen, fit=False, model=None)


def test_weather_feature(spark):
    df = _delays(spark)
    assert {r.weather_temp for r in features.add_weather_feature(df, -12.5).collect()} == {-12.5}
    with pytest.raises(ValueError):
        features.add_weather_feature(df, None)                     # T17
    hourly = spark.createDataFrame([(ts("2024-01-01T08:00:00"), 10.0), (ts("2024-01-01T17:00:00"), None),
                                    (ts("2024-01-06T14:00:00"), 20.0)], "hour timestamp, temperature double")
    got = {r.trip_id: r.weather_temp for r in features.add_weather_feature(df, hourly).collect()}
    assert got == {"t1": 10.0, "t2": 15.0, "t3": 20.0}


def test_feature_set_columns(spark):
    fs, _ = features.create_feature_set(_delays(spark))
    assert fs.columns == ["trip_id", "route_id", "stop_id", "feed_timestamp", "hour_of_day", "day_of_week",
                          "is_weekend", "is_rush_hour", "route_id_encoded", "delay_minutes"]
    with_seq, _ = features.create_feature_set(_delays(spark).withColumn("stop_sequence", __import__("pyspark.sql.functions", fromlist=["lit"]).lit(3)),
                                              include_weather=True, temperature=1.0)
    assert with_seq.columns[-3:] == ["stop_sequence", "weather_temp", "delay_minutes"]


def _matrix(spark, n=400):
    import random
    rnd = random.Random(42)
    rows = []
    for i in range(n):
        h, d, r = rnd.randrange(24), rnd.randrange(7), rnd.randrange(10)
        rush = int(7 <= h <= 9 or 16 <= h <= 18)
        rows.append((i, h, d, rush, r, 3.0 + 2.0 * rush + 0.3 * r + rnd.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "id long, hour_of_day int, day_of_week int, is_rush_hour int, "
                                       "route_id_encoded int, delay_minutes double")


FEATS = ["hour_of_day", "day_of_week", "is_rush_hour", "route_id_encoded"]


def test_split_is_deterministic_and_about_80_20(spark):
    df = _matrix(spark, 1000)
    train, test = model.prepare_data(df, FEATS, exact=False)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 1000 and 150 <= n_test <= 250
    again = model.prepare_data(df, FEATS, exact=False)[1]
    assert sorted(r.id for r in test.collect()) == sorted(r.id for r in again.collect())
    with_null = df.union(spark.createDataFrame([(9999, None, 1, 0, 1, 1.0)], df.schema))
    assert sum(x.count() for x in model.prepare_data(with_null, FEATS)) == 1000


def test_train_evaluate_importance_save_load_predict(spark, tmp_dir):
    df = _matrix(spark)
    train, test = model.prepare_data(df, FEATS)
    rf = model.train_random_forest(train, FEATS, n_estimators=10, max_depth=5)
    pred = model.predict(rf, test)
    assert pred.count() == test.count()
    assert dict(pred.dtypes)["prediction"] == "double"
    m = model.evaluate(rf, test).first()
    assert abs(m.rmse ** 2 - m.mse) < 1e-9 and m.test_samples == test.count() and m.r2_score > 0.5
    assert 0 <= m.within_1min <= m.within_2min <= m.within_5min <= 100
    imp = model.feature_importance(spark, rf, FEATS).collect()
    # the route effect spans 2.7 min and the rush effect 2.0 min; weekday is noise
    assert {imp[0].feature, imp[1].feature} == {"route_id_encoded", "is_rush_hour"}
    assert abs(sum(r.importance for r in imp) - 1.0) < 1e-9
    path = model.save_model(spark, rf, tmp_dir, "random_forest", FEATS, {"r2_score": m.r2_score})
    loaded, meta = model.load_model(spark, path)
    assert model.model_info(meta).first().feature_names == FEATS
    assert model.model_info(None) == {"status": "no model"}
    one = test.limit(1)
    assert model.predict(loaded, one).count() == 1                 # T19: one row is still a table
    with pytest.raises(ValueError, match="lacks model inputs"):
        model.predict(loaded, test.drop("route_id_encoded"))


def test_regression_metrics_identity(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 6.0)], "delay_minutes double, prediction double")
    m = model.regression_metrics(df).first()
    assert m.mae == pytest.approx((0.5 + 0 + 3) / 3) and m.mse == pytest.approx((0.25 + 9) / 3)
    assert m.r2_score == pytest.approx(1 - 9.25 / 2.0)
    assert m.within_1min == pytest.approx(200 / 3) and m.within_5min == 100.0


def test_boosted_trees_and_unknown_type(spark):
    df = _matrix(spark, 200)
    out = model.train_and_evaluate(spark, df, FEATS, model_type="boosted_trees", n_estimators=5)
    assert out["metrics"]["test_samples"] == 40                     # exact 20 % of 200
    assert model.train_and_evaluate(spark, df, FEATS, model_type="xgboost", n_estimators=2)["metrics"]
    with pytest.raises(ValueError):
        model.train_and_evaluate(spark, df, FEATS, model_type="svm")


def test_exact_split_sizes_and_disjoint(spark):
    for n in (100, 7, 1):
        df = _matrix(spark, n)
        train, test = model.prepare_data(df, FEATS, exact=True)
        tr, te = [r.id for r in train.collect()], [r.id for r in test.collect()]
        assert len(te) == __import__("math").ceil(0.2 * n) and len(tr) + len(te) == n   # 100 -> 80/20 exactly
        assert not set(tr) & set(te)


def test_exact_split_with_many_identical_rows(spark):
    # 90 copies of one row and 10 distinct rows: the tie at the threshold is split by copy counts
    rows = [(1, 2, 3, 4, 5.0)] * 90 + [(i, 0, 0, 0, float(i)) for i in range(10, 20)]
    df = spark.createDataFrame(rows, "hour_of_day int, day_of_week int, is_rush_hour int, route_id_encoded int, "
                                     "delay_minutes double")
    train, test = model.prepare_data(df, FEATS, exact=True)
    assert test.count() == 20 and train.count() == 80
    both = sorted(train.union(test).collect())
    assert both == sorted(df.collect())


def test_training_reads_its_table_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b
    rows = spark.range(200).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("delay_minutes"))
    df = rows.mapInArrow(count, rows.schema)
    done = model.train_and_evaluate(spark, df, ["a"], n_estimators=2, max_depth=2)
    assert done["metrics"]["test_samples"] == 40 and read.value == 200
    assert not df.storageLevel.useMemory
    # what the caller keeps stays kept
    kept = rows.persist()
    model.train_and_evaluate(spark, kept, ["a"], n_estimators=2, max_depth=2)
    assert kept.storageLevel.useMemory
    kept.unpersist()
