"""Training table scan (S17): a features file with declared column types."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INT_FEATURES = ("hour_of_day", "day_of_week", "is_weekend", "is_rush_hour", "route_id_encoded", "stop_sequence")


def read_training_table(spark: SparkSession, path: str, target_col: str = "delay_minutes",
                        fmt: str = "csv", extra_double: Sequence[str] = ("weather_temp",)) -> DataFrame:
    """Scan a written feature table; CSV text columns are cast by name (INT features, DOUBLE target)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    cols = []
    for c in raw.columns:
        if c in INT_FEATURES:
            cols.append(F.col(c).try_cast("int").alias(c))
        elif c == target_col or c in extra_double:
            cols.append(F.col(c).try_cast("double").alias(c))
        elif c == "feed_timestamp":
            cols.append(F.col(c).try_cast("timestamp").alias(c))
        else:
            cols.append(F.col(c))
    return raw.select(*cols)
