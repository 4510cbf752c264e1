"""Feature engineering for delay prediction."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefuncs import hour_of_day, is_rush_hour, is_weekend, time_of_day, weekday_monday0
from ..session import shared_dir
from .delays import _ts
from .joins import left_join_dimension
from .ranks import dense_ranks

# Model inputs in order, identifier columns kept beside them.
BASE_FEATURES = ["hour_of_day", "day_of_week", "is_weekend", "is_rush_hour", "route_id_encoded"]
ID_COLUMNS = ["trip_id", "route_id", "stop_id", "feed_timestamp"]


def extract_temporal_features(df: DataFrame, timestamp_col: str = "feed_timestamp") -> DataFrame:
    """hour_of_day, day_of_week (Monday = 0), is_weekend, is_rush_hour, time_of_day."""
    ts = _ts(df, timestamp_col)
    return df.withColumn(timestamp_col, ts).withColumns({
        "hour_of_day": hour_of_day(timestamp_col),
        "day_of_week": weekday_monday0(timestamp_col),
        "is_weekend": is_weekend(timestamp_col),
        "is_rush_hour": is_rush_hour(timestamp_col),
        "time_of_day": time_of_day(timestamp_col),
    })


def route_text(df: DataFrame, col: str = "route_id"):
    """Route id as text with null as its own class ``None``."""
    return F.coalesce(F.col(col).cast("string"), F.lit("None"))


class RouteEncoder:
    """Fitted labels as a written table (label, code): as many rows as labels, none of them on the driver."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @property
    def labels(self) -> DataFrame:
        return self.spark.read.schema("label string, code long").parquet(self.path)


def fit_route_encoder(df: DataFrame, col: str = "route_id") -> RouteEncoder:
    """E2 fit: labels in code-point order get codes 0, 1, ... (``'10' < '2'``), ranked over range partitions."""
    path = shared_dir(df.sparkSession, "encoders", uuid.uuid4().hex)
    ranks = dense_ranks(df.select(route_text(df, col).alias("label")), "label", "code")
    ranks.write.parquet(path)
    return RouteEncoder(df.sparkSession, path)


def encode_route(df: DataFrame, model: RouteEncoder | None, col: str = "route_id", handle_invalid: str = "error") -> DataFrame:
    """E2/E3 transform: add ``route_id_encoded`` (INT, a plain number) by a join with the labels.

    Unseen labels fail unless ``handle_invalid='keep'`` (they then get the next free code). Whether the labels are broadcast is left to
    the planner, which goes by the size of their file.
    """
    if model is None:
        raise ValueError("no fitted route encoder was given")
    labels = model.labels
    out = df.withColumn("_route_text", route_text(df, col)).join(
        labels.select(F.col("label").alias("_label"), F.col("code").alias("_code")), F.col("_route_text") == F.col("_label"), "left")
    if handle_invalid == "keep":
        unseen = labels.select(F.count(F.lit(1))).scalar()
    else:
        unseen = F.raise_error(F.concat(F.lit("label the encoder was not fitted on: "), F.col("_route_text"))).cast("long")
    code = F.when(F.col("_code").isNotNull(), F.col("_code")).otherwise(unseen)
    return out.withColumn("route_id_encoded", code.cast("int")).drop("_route_text", "_label", "_code")


def encode_categorical_features(df: DataFrame, fit: bool = True, model: RouteEncoder | None = None,
                                col: str = "route_id"):
    """Returns ``(frame, encoder)``; ``fit=False`` reuses ``model``."""
    if col not in df.columns:
        return df, model
    if fit:
        model = fit_route_encoder(df, col)
    return encode_route(df, model, col), model


def add_weather_feature(df: DataFrame, temperature=None, hour_col: str = "feed_timestamp") -> DataFrame:
    """``weather_temp`` from one temperature (float) or an hourly table (``hour``, ``temperature``).

    Missing hourly readings are filled with the mean reading. With no temperature at all the column
    would be entirely null and every row would later be dropped for it, so that is an error.
    """
    if temperature is None:
        raise ValueError("no temperature given: weather_temp would be null on every row")
    if isinstance(temperature, (int, float)):
        return df.withColumn("weather_temp", F.lit(float(temperature)))
    weather = temperature.select(F.date_trunc("hour", F.col("hour")).alias("_wh"),
                                 F.col("temperature").cast("double").alias("_wt"))
    mean = weather.select(F.avg("_wt")).scalar()
    joined = left_join_dimension(df.withColumn("_wh", F.date_trunc("hour", F.col(hour_col))), weather, "_wh")
    return joined.withColumn("weather_temp", F.coalesce(F.col("_wt"), mean)).drop("_wh", "_wt")


def feature_columns(df: DataFrame, include_weather: bool = False) -> list[str]:
    cols = list(BASE_FEATURES)
    if "stop_sequence" in df.columns:
        cols.append("stop_sequence")
    if include_weather and "weather_temp" in df.columns:
        cols.append("weather_temp")
    return cols


def create_feature_set(df: DataFrame, target_col: str = "delay_minutes", include_weather: bool = False,
                       temperature=None, fit_encoders: bool = True, encoder: RouteEncoder | None = None):
    """E5: identifiers + features (+ stop_sequence when present, + weather when asked) + target.

    Returns ``(frame, encoder)`` so scoring can reuse the fitted route codes.
    """
    out = extract_temporal_features(df)
    out, encoder = encode_categorical_features(out, fit=fit_encoders, model=encoder)
    if include_weather:
        out = add_weather_feature(out, temperature)
    feats = feature_columns(out, include_weather)
    ids = [c for c in ID_COLUMNS if c in out.columns]
    cols = ids + feats + ([target_col] if target_col in out.columns else [])
    return out.select(*cols), encoder
