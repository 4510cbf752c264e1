"""Stateful processors of the live streams: plain classes, run by Spark once per part of the keys with that part's state.

A state call from Python is a message to the executor, so state is kept for a part (keys with equal hash, modulo a number of parts) instead of
for every key: the rows held by all keys of a part are read by one call and written by one call a batch.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# ``windows`` equal windows, the first from ``begin`` to ``until``, each next one a slide later
WINDOW_ROW = Row("route_id", "trip_id", "vehicle_id", "begin", "until", "windows", "delay_minutes", "first", "late_rows")
MANY = 64                    # rows of one vehicle after which those no column needs are dropped


class WindowedDelays(StatefulProcessor):
    """Per (route, trip, vehicle): cells of ``slide`` with sum, count and earliest time; windows are combined from them when they close.

    A window is closed once the watermark has reached its end; a row counts in every window that was open when its batch began. A row
    all of whose windows are closed is late, and reported as such. Windows in a row that hold the same cells come out as one row.
    """

    def __init__(self, window: int, slide: int, keys: str):
        self.window, self.slide, self.keys = window, slide, keys

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cells = handle.getListState("cells", f"{self.keys}, cell long, total double, n long, first long")
        self.due = handle.getValueState("due", "next_end long")

    def _held(self) -> dict[tuple, dict[int, tuple]]:
        held: dict[tuple, dict[int, tuple]] = {}
        for *key, cell, total, n, first in self.cells.get():
            held.setdefault(tuple(key), {})[cell] = (total, n, first)
        return held

    def _closed(self, key: tuple, mine: dict[int, tuple], due: int, watermark: int) -> Iterator[Row]:
        """The windows of one key that end from ``due`` on and that the watermark has reached."""
        cells = sorted((c, *v) for c, v in mine.items())
        last = min(watermark // self.slide * self.slide, cells[-1][0] + self.window)
        # ends at which a cell enters the window or has left it
        turns = sorted({c[0] + w for c in cells for w in (self.slide, self.window + self.slide)})
        end, lo, hi, turn = max(due, cells[0][0] + self.slide), 0, 0, 0
        while end <= last:
            while hi < len(cells) and cells[hi][0] < end:
                hi += 1
            while lo < hi and cells[lo][0] < end - self.window:
                lo += 1
            while turn < len(turns) and turns[turn] <= end:
                turn += 1
            after = min(turns[turn], last + self.slide) if turn < len(turns) else last + self.slide
            if lo < hi:
                inside = cells[lo:hi]
                n = sum(c[2] for c in inside)
                yield WINDOW_ROW(*key, end - self.window, end, (after - end) // self.slide, sum(c[1] for c in inside) / n if n else None,
                                 min(c[3] for c in inside), 0)
            end = after

    def _close(self, held: dict, due: int, watermark: int) -> Iterator[Row]:
        """All windows the watermark has reached; what can go with them leaves ``held``."""
        for key in list(held):
            yield from self._closed(key, held[key], due, watermark)
            held[key] = {c: v for c, v in held[key].items() if c + self.window > watermark}
            if not held[key]:
                del held[key]

    def _store(self, held: dict, watermark: int) -> None:
        """The held cells, the next end that can have a window, and a timer for it; no state is left without cells."""
        if not held:
            self.cells.clear()
            self.due.clear()
            return
        self.cells.put([(*key, c, *v) for key, mine in held.items() for c, v in mine.items()])
        open_from = watermark // self.slide * self.slide + self.slide
        self.due.update((open_from,))
        self.handle.registerTimer(max(open_from, min(min(mine) for mine in held.values()) + self.slide))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due = self.due.get()
        held = self._held() if due else {}
        if held:
            yield from self._close(held, due[0], watermark)
        late: dict[tuple, int] = {}
        for r in rows:
            of, cell = (r.route_id, r.trip_id, r.vehicle_id), r.at // 1000 // self.slide * self.slide
            if cell + self.window <= watermark:
                late[of] = late.get(of, 0) + 1
                continue
            mine = held.setdefault(of, {})
            total, n, first = mine.get(cell, (0.0, 0, r.at))
            delay = r.delay_minutes
            mine[cell] = (total, n, min(first, r.at)) if delay is None else (total + delay, n + 1, min(first, r.at))
        if due or held:
            self._store(held, watermark)
        for of, n in late.items():
            yield WINDOW_ROW(*of, None, None, 1, None, None, n)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due = self.due.get()
        if due and due[0] <= watermark:
            held = self._held()
            yield from self._close(held, due[0], watermark)
            self._store(held, watermark)

    def close(self) -> None:
        pass


class FreshVehicle(StatefulProcessor):
    """Per vehicle the fresh rows that still provide the last non-null value of some column, newest first (mostly one row)."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], window: int, schema: str):
        self.columns, self.order, self.window, self.schema = list(columns), list(order), window, schema
        self.fields = ["at", *self.columns, *[c for c in self.order if c != "at" and c not in self.columns]]
        self.values = [self.fields.index(c) for c in self.columns]
        self.ranks = [self.fields.index(c) for c in self.order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", self.schema)
        self._out = Row("vehicle_id", *self.columns, "gone", "as_of", "seq")

    def _key(self, row: tuple):
        # as structs compare: null first; text by its bytes
        return tuple((v is not None, v.encode() if isinstance(v, str) else v if v is not None else 0) for v in (row[i] for i in self.ranks))

    def _needed(self, rows: list[tuple]) -> list[tuple]:
        """Without the rows whose every value has a newer one: those go later, so they are never asked again."""
        kept, missing = [], set(self.values)
        for r in sorted(rows, key=self._key, reverse=True):
            gives = {i for i in missing if r[i] is not None}
            if gives or not kept:
                kept.append(r)
                missing -= gives
        return kept

    def _expiry(self, row: tuple) -> int:
        return -(-row[0] // 1000) + self.window

    def _view(self, vehicle, rows: list[tuple], watermark: int, seq: int) -> Row:
        if not rows:
            return self._out(vehicle, *[None] * len(self.columns), True, watermark, seq)
        return self._out(vehicle, *[next((r[i] for r in rows if r[i] is not None), None) for i in self.values], False, watermark, seq)

    def _held(self) -> dict[object, list[tuple]]:
        held: dict[object, list[tuple]] = {}
        for vehicle, *values in self.rows.get():
            held.setdefault(vehicle, []).append(tuple(values))
        return held

    def _store(self, held: dict) -> None:
        """The held rows, with a timer for the first that will not be fresh; no state is left without rows."""
        if not held:
            self.rows.clear()
            return
        self.rows.put([(vehicle, *r) for vehicle, rows in held.items() for r in rows])
        self.handle.registerTimer(min(self._expiry(r) for rows in held.values() for r in rows))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._held() if self.rows.exists() else {}
        stored, at, new = bool(held), None, {}
        for r in rows:
            if r["vehicle_id"] is None:
                continue
            at = at or [r.__fields__.index(c) for c in self.fields]
            of = new.get(r["vehicle_id"])
            if of is None:
                of = new[r["vehicle_id"]] = [h for h in held.get(r["vehicle_id"], ()) if self._expiry(h) > watermark]
            values = tuple(r[i] for i in at)
            if values[0] is not None and self._expiry(values) > watermark:
                of.append(values)
                if len(of) >= MANY:
                    of[:] = self._needed(of)
        for vehicle, fresh in new.items():
            fresh = self._needed(fresh)
            if fresh or vehicle in held:
                yield self._view(vehicle, fresh, watermark, 0)
            if fresh:
                held[vehicle] = fresh
            else:
                held.pop(vehicle, None)
        if new and (stored or held):
            self._store(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held = self._held() if self.rows.exists() else {}
        if not held:
            return
        kept = {}
        for vehicle, rows in held.items():
            fresh = [r for r in rows if self._expiry(r) > watermark]
            if len(fresh) < len(rows):
                # an older row that a newer one covered went with it or before it, so the rest needs no second look
                yield self._view(vehicle, fresh, watermark, 1)
            if fresh:
                kept[vehicle] = fresh
        self._store(kept)

    def close(self) -> None:
        pass
