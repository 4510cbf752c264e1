"""Streaming live views (L1, L2) on keyed state with event-time timers.

Both views keep, per key, only what later results can still need, and leave by a timer of the watermark: L2 the sums of 2-minute
cells until the last window over a cell has closed, L1 the few newest rows of a vehicle until they are no longer fresh. State lies in
RocksDB and moves with the checkpoint, so a lost executor or a restarted driver goes on where the last batch ended. Keys are
held in ``PARTS`` parts by their hash, so a batch costs some state calls a part, not some for every key.

The engine drops rows behind the watermark before the state sees them, though windows over them may be open. The
watermark is therefore declared on an event time ``FAR`` days ahead with a delay that is ``FAR`` days longer: it runs as the plain one would, but
no row is behind it, and the processors decide (and count) what is too late.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.live import TRIP_GROUP, VEHICLE_WINDOW, last_non_null, with_delay_minutes
from . import processors

# the processors travel to the workers (also to the one beside the driver) as code, not as a module those would have to find
cloudpickle.register_pickle_by_value(processors)

TRIP_WINDOW, TRIP_SLIDE, LATE_DELAY = "1 hour", "2 minutes", "10 minutes"
FAR = 365_250                # days
PARTS = 1024                 # parts of the keys; a part's open cells or fresh rows are in a worker's memory at a time
ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep state in RocksDB; the caller's session stays as it is."""
    own = spark.newSession()
    for k, v in ROCKS.items():
        own.conf.set(k, v)
    return own


def _millis(spark: SparkSession, span: str) -> int:
    """Length of an interval text such as '2 minutes'."""
    start = F.lit("2000-01-01 00:00:00").cast("timestamp")
    return spark.range(1).select(F.unix_millis(start + F.expr(f"INTERVAL {span}")) - F.unix_millis(start)).first()[0]


def _far_watermark(df: DataFrame, time_col: str, late: str) -> DataFrame:
    ahead = F.col(time_col) + F.expr(f"INTERVAL {FAR} DAYS")
    return df.withColumn("_event", ahead).withWatermark("_event", f"{FAR} days {late}")


def _part(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int").alias("part")


def live_vehicles_stream(positions: DataFrame, order_cols=("timestamp",)) -> DataFrame:
    """L1 on a stream without expiry: per vehicle the last non-null value of every column (complete output mode).

    Rows with equal ``order_cols`` are settled by their other columns, so the result does not depend on the order of
    arrival. State holds one row per vehicle for ever; ``fresh_vehicles_stream`` lets idle vehicles go.
    """
    value_cols = [c for c in positions.columns if c != "vehicle_id"]
    order = [*order_cols, *[c for c in value_cols if c not in order_cols]]
    return positions.filter(F.col("vehicle_id").isNotNull()).groupBy("vehicle_id") \
        .agg(*[last_non_null(c, order).alias(c) for c in value_cols])


def recent_trip_delays_stream(updates: DataFrame, window: str = TRIP_WINDOW, slide: str = TRIP_SLIDE, late: str = LATE_DELAY) -> DataFrame:
    """L2 on a stream: per sliding hour (2-minute slide) and (route, trip, vehicle) the mean delay and earliest feed time (append mode).

    A window comes out once the watermark (newest feed time less ``late``) passes its end, with every row that arrived while it was open.
    ``late_rows`` is 0 in these rows; rows that were too late for all of their windows come out as a count, with a null window. ``window`` has to be a
    multiple of ``slide``. Rows with a null key or time are dropped, as in the batch view. The stream has to be read in a
    ``stateful_session``.
    """
    spark = updates.sparkSession
    window_ms, slide_ms = _millis(spark, window), _millis(spark, slide)
    if window_ms % slide_ms:
        raise ValueError(f"the window ({window}) has to be a multiple of the slide ({slide})")
    known = F.col("feed_timestamp").isNotNull()
    for c in TRIP_GROUP:
        known = known & F.col(c).isNotNull()
    keyed = _far_watermark(with_delay_minutes(updates).filter(known), "feed_timestamp", late) \
        .select("_event", _part(*TRIP_GROUP), *TRIP_GROUP, "delay_minutes", F.unix_micros("feed_timestamp").alias("at"))
    keys = ", ".join(f"{c} {updates.schema[c].dataType.simpleString()}" for c in TRIP_GROUP)
    out = keyed.groupBy("part").transformWithState(
        statefulProcessor=processors.WindowedDelays(window_ms, slide_ms, keys), outputMode="Append", timeMode="EventTime",
        outputStructType=f"{keys}, begin long, until long, windows long, delay_minutes double, first long, late_rows long")
    # windows with the same rows come out of the state as one
    out = out.withColumn("_after", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("windows") - 1) * slide_ms, F.lit(slide_ms).cast("long"))))
    span = F.struct(F.timestamp_millis(F.col("begin") + F.col("_after")).alias("start"), F.timestamp_millis(F.col("until") + F.col("_after")).alias("end"))
    return out.select(F.when(F.col("until").isNotNull(), span).alias("window"), *TRIP_GROUP, "delay_minutes",
                      F.timestamp_micros("first").alias("feed_timestamp"), "late_rows")


def fresh_vehicles_stream(positions: DataFrame, window: str = VEHICLE_WINDOW, order_cols: Sequence[str] = ("timestamp", "event_id"),
                          late: str = "0 seconds") -> DataFrame:
    """L1 on a stream (update mode): per vehicle the last non-null value of every column among its rows newer than ``as_of`` - ``window``.

    ``as_of`` is the watermark, the newest time seen less ``late``. A vehicle's row comes out when it changes, by new rows or because a
    row stopped being fresh; with ``gone`` set once none is left, and then its state is gone too. Keep the last row of each vehicle
    (``apply_updates``) to have the live view. ``order_cols`` after the time break ties and are not part of the result. Rows with a null vehicle or
    time are not part of it. The stream has to be read in a ``stateful_session``.
    """
    spark = positions.sparkSession
    order = [c for c in order_cols if c in positions.columns]
    time_col, hidden = order[0], order[1:]
    columns = [c for c in positions.columns if c != "vehicle_id" and c not in hidden]
    # rows without a vehicle move the watermark too, as they move the batch view's cutoff; the processor leaves them out
    rows = _far_watermark(positions, time_col, late).withColumn("at", F.unix_micros(time_col))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    state = ", ".join(f"`{c}` {types[c]}" for c in ["vehicle_id", "at", *columns, *hidden])
    out = ", ".join(f"`{c}` {types[c]}" for c in ["vehicle_id", *columns])
    part = F.when(F.col("vehicle_id").isNotNull(), _part("vehicle_id")).otherwise(_part(*order)).alias("part")
    return rows.select("_event", part, "vehicle_id", "at", *columns, *hidden).groupBy("part").transformWithState(
        statefulProcessor=processors.FreshVehicle(columns, ["at", *hidden, *[c for c in columns if c != time_col]], _millis(spark, window), state),
        outputMode="Update", timeMode="EventTime", outputStructType=f"{out}, gone boolean, as_of long, seq int")


def apply_updates(updates: DataFrame, order_col: str = "batch_id") -> DataFrame:
    """The live view from the written updates of ``fresh_vehicles_stream``: the last row of each vehicle, without those gone.

    ``order_col`` numbers the batches; inside a batch the row with the larger ``seq`` (timers run after new rows) wins.
    """
    values = [c for c in updates.columns if c not in ("vehicle_id", order_col, "gone", "as_of", "seq")]
    last = F.max_by(F.struct("gone", *values), F.struct(order_col, "seq")).alias("_r")
    return updates.groupBy("vehicle_id").agg(last).filter(~F.col("_r.gone")).select("vehicle_id", *[F.col(f"_r.`{c}`").alias(c) for c in values])
