"""Files that Spark derives from the supplied tables, for queries that exercise a file source.

Everything is written under the shared checkpoint location (``spark.checkpoint.dir``), never to a
machine-local folder: one folder per application and input folder, written once (with overwrite, so a
rerun after a failure replaces partial output) and then reused by every query of that application.
"""
from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import file_system, shared_dir
from ..sources.gtfs_static import write_timetable_table
from . import views

# A feed message holds at most this many entities of each kind (bounded groups, never one per hour).
ENTITIES_PER_MESSAGE = 256
# Days are dealt over at most so many landed files, whole days each.
FEED_FILES = 8


# Derived inputs are written once per process and input folder; the signature re-stages them if the tables change.
_STAGED: dict[tuple, str] = {}


def _signature(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    """Files, bytes and modification time of the input tables, asked of their file system (no job)."""
    sig = []
    for t in tables:
        fs, path = file_system(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        summary = fs.getContentSummary(path)
        sig.append((t, summary.getFileCount(), summary.getLength(), fs.getFileStatus(path).getModificationTime()))
    return tuple(sig)


def once(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], build) -> str:
    key = (spark.conf.get("spark.app.id", ""), sf_dir, name, _signature(spark, sf_dir, tables))
    if key not in _STAGED:          # only the folder's name is kept
        _STAGED[key] = build()
    return _STAGED[key]


def _tag(sf_dir: str) -> str:
    base = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    return f"{base}-{hashlib.sha1(sf_dir.encode()).hexdigest()[:8]}"


def staging_path(spark: SparkSession, sf_dir: str, *parts: str) -> str:
    # one folder per application, so two jobs staging the same inputs never overwrite each other's files
    app = spark.conf.get("spark.app.id", "app")
    return shared_dir(spark, "staging", app, _tag(sf_dir), *parts)


def stage_timetable_table(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Write one timetable view as a header CSV text table; returns the timetable root folder."""
    root = staging_path(spark, sf_dir, "timetable")

    def build():
        write_timetable_table(views.view(spark, sf_dir, name), root, name)
        return root
    return once(spark, sf_dir, f"timetable/{name}", views.VIEWS[name][0], build)


def _vehicle_entity() -> Column:
    return F.struct(
        F.concat(F.lit("v"), F.col("event_id").cast("string")).alias("id"),
        F.struct(
            F.when(F.col("vehicle_id").isNotNull(), F.struct(F.col("vehicle_id").alias("id"))).alias("vehicle"),
            F.struct(F.lit(None).cast("string").alias("trip_id"), F.col("route_id").alias("route_id")).alias("trip"),
            F.struct(F.col("latitude"), F.col("longitude"), F.lit(None).cast("double").alias("bearing"),
                     F.col("speed")).alias("position"),
            F.unix_seconds(F.col("timestamp")).alias("timestamp"),
            F.lit(None).cast("int").alias("current_stop_sequence"),
            F.lit(None).cast("int").alias("current_status"),
            F.lit(None).cast("int").alias("congestion_level"),
        ).alias("vehicle"),
        F.lit(None).alias("trip_update"),
    )


def _stop_time(delay: str, every: int):
    """Epoch seconds of the stop event on every ``every``-th update (a fixture's choice), null on the others."""
    return F.when(F.col("event_id") % every == 0, F.unix_seconds("feed_timestamp") + F.col(delay))


def _trip_update_entity() -> Column:
    stu = F.struct(
        F.col("stop_id"), F.col("stop_sequence"),
        F.when(F.col("arrival_delay").isNotNull(), F.struct(F.col("arrival_delay").alias("delay"),
                                                            _stop_time("arrival_delay", 4).alias("time"))).alias("arrival"),
        F.when(F.col("departure_delay").isNotNull(), F.struct(F.col("departure_delay").alias("delay"),
                                                              _stop_time("departure_delay", 5).alias("time"))).alias("departure"),
        F.lit(None).cast("int").alias("schedule_relationship"),
    )
    return F.struct(
        F.concat(F.lit("t"), F.col("event_id").cast("string")).alias("id"),
        F.lit(None).alias("vehicle"),
        F.struct(F.struct(F.col("trip_id"), F.col("route_id")).alias("trip"),
                 F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
                 F.array(stu).alias("stop_time_update")).alias("trip_update"),
    )


def _empty_update_entity() -> Column:
    """An extra entity without any stop time update beside every 60th update (the flattener has to skip it)."""
    return F.struct(F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"), F.lit(None).alias("vehicle"),
                   F.struct(F.struct(F.col("trip_id"), F.col("route_id")).alias("trip"),
                            F.struct(F.col("vehicle_id").alias("id")).alias("vehicle"),
                            F.array().alias("stop_time_update")).alias("trip_update"))


def stage_feed_messages(spark: SparkSession, sf_dir: str) -> str:
    """Land the events-derived vehicle positions and trip updates as feed messages (JSON lines).

    Each message mixes both entity kinds of one snapshot hour, at most ``ENTITIES_PER_MESSAGE`` of
    each, so the flatteners meet entities they must skip.
    """
    return once(spark, sf_dir, "feed", ("events",), lambda: _write_feed(spark, sf_dir))


def _feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..schemas import FEED_MESSAGE
    entity_type = FEED_MESSAGE["entity"].dataType.elementType
    vp, tu = (views.view(spark, sf_dir, n) for n in ("vehicle_positions", "trip_updates"))
    kinds = {"v": (vp, _vehicle_entity()), "t": (tu, _trip_update_entity()), "e": (tu.filter(F.col("event_id") % 60 == 0), _empty_update_entity())}
    rows, entity = None, None
    for kind, (one, made) in kinds.items():
        one, is_kind = one.withColumn("_kind", F.lit(kind)), F.col("_kind") == kind
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
        entity = F.when(is_kind, made.cast(entity_type)) if entity is None else entity.when(is_kind, made.cast(entity_type))
    # flat rows are dealt by day, once: a message's rows are together then, and entities and messages are made where they are written
    dealt = rows.withColumn("_day", F.date_trunc("day", "feed_timestamp")).repartitionByRange(FEED_FILES, "_day")
    block = F.floor(F.col("event_id") / ENTITIES_PER_MESSAGE)
    # entities stand in the order of their events, and a day's messages share a file, in the order of hour and block
    entities = F.transform(F.array_sort(F.collect_list(F.struct("event_id", F.col("entity.id").alias("id"), "entity"))), lambda x: x["entity"])
    msgs = dealt.select("event_id", "feed_timestamp", "_day", entity.alias("entity")) \
        .groupBy("_day", "feed_timestamp", block.alias("block")).agg(entities.alias("entity"))
    return msgs.sortWithinPartitions("feed_timestamp", "block") \
        .select(F.struct(F.unix_seconds("feed_timestamp").alias("timestamp")).alias("header"), "entity")


def _write_feed(spark: SparkSession, sf_dir: str) -> str:
    path = staging_path(spark, sf_dir, "feed")
    _feed_messages(spark, sf_dir).write.mode("overwrite").json(path)
    return path


def stage_vehicle_archive(spark: SparkSession, sf_dir: str, clean_vehicles: DataFrame) -> str:
    """The cleaned vehicle positions written through the archive sink (batch 0, idempotent)."""
    from ..sources import archive
    root = staging_path(spark, sf_dir, "archive")

    def build():
        archive.write_archive(clean_vehicles, root, "vehicles", "feed_timestamp", batch_id=0)
        return root
    return once(spark, sf_dir, "archive/vehicles", ("events",), build)
