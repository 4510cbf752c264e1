"""Static timetable text files (S1-S6): comma separated with a header line, one folder or file per table.

Columns are looked up by header name (files may order them differently or carry extra columns) and cast
to the declared types; identifiers stay text. Nothing is inferred.
"""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import OPTIONAL_TIMETABLE_FILES, REQUIRED_TIMETABLE_FILES, TIMETABLE


def _path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.txt"


def _typed(raw: DataFrame, name: str) -> DataFrame:
    schema = TIMETABLE[name]
    present = {c.strip().lower(): c for c in raw.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name)
        col = F.col(f"`{src}`") if src is not None else F.lit(None)
        # try_cast: a malformed number becomes null instead of failing the whole scan.
        cols.append(col.try_cast(f.dataType).alias(f.name))
    return raw.select(*cols)


def read_timetable_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one timetable table. A missing required file is an error; a missing optional one is an
    empty table with the declared schema."""
    try:
        raw = spark.read.option("header", True).option("inferSchema", False).csv(_path(root, name))
        return _typed(raw, name)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        if name in REQUIRED_TIMETABLE_FILES:
            raise FileNotFoundError(f"Required file {name}.txt not found under {root}") from e
        return spark.createDataFrame([], TIMETABLE[name])


def load_routes(spark, root):          # S1
    return read_timetable_table(spark, root, "routes")


def load_trips(spark, root):           # S2
    return read_timetable_table(spark, root, "trips")


def load_stops(spark, root):           # S3
    return read_timetable_table(spark, root, "stops")


def load_stop_times(spark, root):      # S4
    return read_timetable_table(spark, root, "stop_times")


def load_calendar_dates(spark, root):  # S5 (optional file)
    return read_timetable_table(spark, root, "calendar_dates")


def load_timetable(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four required tables (error if one is missing) and the optional calendar."""
    return {n: read_timetable_table(spark, root, n) for n in REQUIRED_TIMETABLE_FILES + OPTIONAL_TIMETABLE_FILES}


def write_timetable_table(df: DataFrame, root: str, name: str) -> str:
    """Write a table in the same text form (a folder of part files named ``{name}.txt``)."""
    path = _path(root, name)
    df.select(*[f.name for f in TIMETABLE[name].fields if f.name in df.columns]) \
        .write.mode("overwrite").option("header", True).csv(path)
    return path


def load_master_schedule(spark: SparkSession, root: str, active_only: bool = False) -> DataFrame:
    """S6 then J5: read the timetable folder and build the master schedule in one call."""
    from ..operators.schedule import build_master_schedule
    t = load_timetable(spark, root)
    return build_master_schedule(t["stop_times"], t["trips"], t["routes"], t["stops"], t["calendar_dates"],
                                 active_only=active_only)
