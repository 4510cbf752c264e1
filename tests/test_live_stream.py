"""The live views as streams with state: every batch is a scheduled run over the files landed since the last one."""
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from transitlab.operators import live
from transitlab.streaming import live_stream
from transitlab.streaming.processors import FreshVehicle, WindowedDelays

UPDATES = "route_id string, trip_id string, vehicle_id string, arrival_delay int, feed_timestamp timestamp"
POSITIONS = "vehicle_id string, route_id string, latitude double, timestamp timestamp, event_id long"
BASE = datetime(2024, 1, 1, 12, 0, 10)


def at(minutes, seconds=0):
    return BASE + timedelta(minutes=minutes, seconds=seconds)


def run_batches(spark, folder, schema, batches, make, mode, **options):
    """Land each batch, drain it, go on with the same checkpoint; the output with its batch."""
    s = live_stream.stateful_session(spark)
    s.conf.set("spark.sql.shuffle.partitions", "2")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/landed/run={i}")
        stream = s.readStream.schema(schema).parquet(f"{folder}/landed/*")

        def keep(df, batch_id):
            df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{folder}/out/part={batch_id}")
        q = make(stream, **options).writeStream.foreachBatch(keep).outputMode(mode) \
            .option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
    return spark.read.parquet(f"{folder}/out/*"), q


def expected_windows(batches, late, window=60, slide=2):
    """(windows, late rows) of plain loops: a row counts in its windows that the watermark had not reached when its batch began."""
    found, too_late, watermark = defaultdict(list), defaultdict(int), datetime(1970, 1, 1)
    newest = datetime(1970, 1, 1)
    for rows in batches:
        for r, t, v, d, ts in rows:
            if None in (r, t, v, ts):
                continue
            minutes = int((ts - datetime(2024, 1, 1)).total_seconds() // 60) // slide * slide
            ends = [datetime(2024, 1, 1) + timedelta(minutes=minutes + k) for k in range(slide, window + 1, slide)]
            is_open = [e for e in ends if e > watermark]
            for e in is_open:
                found[(e, r, t, v)].append((d, ts))
            if not is_open:
                too_late[(r, t, v)] += 1
        newest = max([newest] + [x[4] for x in rows if None not in (x[0], x[1], x[2], x[4])])
        watermark = max(watermark, newest - late)
    out = {}
    for (e, *key), rows in found.items():
        if e <= watermark:
            ds = [d / 60 for d, _ in rows if d is not None]
            out[(e, *key)] = (round(sum(ds) / len(ds), 9) if ds else None, min(ts for _, ts in rows))
    return out, dict(too_late)


def collected(df):
    rows = df.collect()
    windows = {(r.window.end, r.route_id, r.trip_id, r.vehicle_id): (None if r.delay_minutes is None else round(r.delay_minutes, 9), r.feed_timestamp)
               for r in rows if r.window is not None}
    late = defaultdict(int)
    for r in rows:
        if r.window is None:
            late[(r.route_id, r.trip_id, r.vehicle_id)] += r.late_rows
    assert len(windows) == sum(r.window is not None for r in rows)            # no window comes out twice
    return windows, dict(late)


def test_late_rows_count_in_every_open_window(spark, tmp_dir):
    key = ("r", "t", "v")
    batches = [[(*key, 60, at(0))], [(*key, 120, at(40))], [(*key, 180, at(41))], [(*key, 5000, at(20))], [(*key, 7, at(-40))],
               [("r", "end", "v", 0, at(300))]]
    out, q = run_batches(spark, tmp_dir, UPDATES, batches, live_stream.recent_trip_delays_stream, "append", late="90 seconds")
    windows, late = collected(out)
    want, too_late = expected_windows(batches, timedelta(seconds=90))
    assert windows == want and late == too_late == {key: 1}
    # the hourly window of the first trial holds all four rows
    assert windows[(datetime(2024, 1, 1, 13), *key)] == (round((60 + 120 + 180 + 5000) / 240, 9), at(0))
    # nothing is held of keys whose windows have all closed
    assert all(o.numRowsDroppedByWatermark == 0 for p in q.recentProgress for o in p.stateOperators)


def test_random_batches_equal_plain_loops(spark, tmp_dir):
    rnd = random.Random(3)
    batches = []
    for b in range(6):
        rows = [("r", f"t{rnd.randrange(4)}", rnd.choice(["v", "w", None]), rnd.choice([None, rnd.randrange(600)]),
                 rnd.choice([at(45 * b - rnd.randrange(0, 140), rnd.randrange(60))] * 9 + [None])) for _ in range(40)]
        batches.append(rows)
    batches.append([("end", "end", "end", None, at(1000))])
    out, _ = run_batches(spark, tmp_dir, UPDATES, batches, live_stream.recent_trip_delays_stream, "append")
    want, too_late = expected_windows(batches, timedelta(minutes=10))
    windows, late = collected(out)
    assert windows == want and late == too_late and late


def test_windows_must_be_multiples_of_the_slide(spark, tmp_dir):
    s = spark.readStream.schema(UPDATES).parquet(tmp_dir)
    with pytest.raises(ValueError, match="multiple"):
        live_stream.recent_trip_delays_stream(s, "1 hour", "7 minutes")


def test_fresh_vehicles_equal_the_batch_view_after_every_run(spark, tmp_dir):
    rnd = random.Random(8)
    batches, n = [], 0
    for b in range(6):
        rows = []
        for _ in range(25):
            n += 1
            rows.append((rnd.choice(["a", "b", "c", "d", f"x{b}", None]), rnd.choice([None, "r1", "r2"]), rnd.choice([None, float(rnd.randrange(9))]),
                         rnd.choice([at(4 * b - rnd.randrange(0, 14), rnd.randrange(60))] * 9 + [None]), n))
        batches.append(rows)
    s = live_stream.stateful_session(spark)
    s.conf.set("spark.sql.shuffle.partitions", "2")
    seen = []
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, POSITIONS).coalesce(1).write.parquet(f"{tmp_dir}/landed/run={i}")
        seen += rows
        stream = s.readStream.schema(POSITIONS).parquet(f"{tmp_dir}/landed/*")

        def keep(df, batch_id):
            df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{tmp_dir}/out/part={batch_id}")
        q = live_stream.fresh_vehicles_stream(stream).writeStream.foreachBatch(keep).outputMode("update") \
            .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
        q.awaitTermination(180)
        assert q.exception() is None
        view = live_stream.apply_updates(spark.read.parquet(f"{tmp_dir}/out/*"))
        want = live.live_vehicle_positions(spark.createDataFrame(seen, POSITIONS))
        assert view.columns == want.columns
        assert sorted(map(tuple, view.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    gone = spark.read.parquet(f"{tmp_dir}/out/*").filter("gone").select("vehicle_id").distinct().count()
    assert gone >= 2                                # idle vehicles left, and their state with them


def test_vehicle_state_is_removed(spark, tmp_dir):
    batches = [[(f"v{i}", "r", 1.0, at(0), i) for i in range(20)], [("z", "r", 1.0, at(30), 99)]]
    out, q = run_batches(spark, tmp_dir, POSITIONS, batches, live_stream.fresh_vehicles_stream, "update")
    assert [r.vehicle_id for r in live_stream.apply_updates(out).collect()] == ["z"]
    sizes = [p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators]
    assert sizes[-1] < 20


class Calls:
    """State variables and timers of one part in memory; every call is counted."""

    def __init__(self):
        self.n, self.held, self.timers = 0, {}, []

    def _variable(self, name):
        return type("State", (), {
            "get": lambda s: self._count(iter(self.held[name]) if isinstance(self.held.get(name), list) else self.held.get(name)),
            "put": lambda s, v: self._count(self.held.update({name: list(v)})), "update": lambda s, v: self._count(self.held.update({name: v})),
            "exists": lambda s: self._count(name in self.held), "clear": lambda s: self._count(self.held.pop(name, None)),
        })()

    def _count(self, value):
        self.n += 1
        return value

    def getListState(self, name, schema):
        self.held.setdefault(name, [])
        return self._variable(name)

    def getValueState(self, name, schema):
        return self._variable(name)

    def registerTimer(self, at):
        self._count(self.timers.append(at))

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_state_calls_do_not_grow_with_the_keys():
    row = Row("route_id", "trip_id", "vehicle_id", "delay_minutes", "at")
    state, p = Calls(), WindowedDelays(3_600_000, 120_000, "route_id string, trip_id string, vehicle_id string")
    p.init(state)
    state.watermark = 0
    rows = [row("r", f"t{k}", "v", float(k), 7_200_000_000 + 60_000_000 * (k % 2)) for k in range(300)]
    assert list(p.handleInputRows((0,), iter(rows), state)) == [] and state.n <= 6
    state.n, state.watermark = 0, 100_000_000
    out = list(p.handleExpiredTimer((0,), state, None))
    # a key with one cell: 30 equal windows in one row, and no state left
    assert state.n <= 6 and len(out) == 300 and {r.windows for r in out} == {30} and state.held == {}

    position = Row("vehicle_id", "at", "latitude", "event_id")
    state, p = Calls(), FreshVehicle(["latitude"], ["at", "event_id"], 600_000, "")
    p.init(state)
    state.watermark = 0
    out = list(p.handleInputRows((0,), iter([position(f"v{k}", 60_000_000, 1.0, k) for k in range(300)]), state))
    assert state.n <= 4 and len(out) == 300 and not any(r.gone for r in out)
    state.n, state.watermark = 0, 10_000_000
    out = list(p.handleExpiredTimer((0,), state, None))
    assert state.n <= 4 and len(out) == 300 and all(r.gone for r in out)
