"""Keyed stateful processors.

Rows reach a processor with ``us``, their event time in microseconds, so no time zone
conversion takes place between Spark and Python.  State names are part of a query's
checkpoint: keep them when changing a processor.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType

from tidewatch.operators.occupancy import FULL_ENTER, FULL_EXIT, HIGH_ENTER, HIGH_EXIT

TICK_US = 1_000
#: rows of a waiting piece that ends with its slot, and of one that ends anywhere
PIECE_ROWS, MOST_ROWS = 2_000, 16_000
#: rows of a key that are held in memory at once
STRETCH_ROWS = 100_000


def plain(column: pd.Series, kind: str) -> list:
    """Column values as Python objects of the state's type, null as None."""
    read = {"bigint": int, "int": int, "double": float, "boolean": bool}.get(kind, lambda v: v)
    return [None if pd.isna(v) else read(v) for v in column]


def arrow_type(kind: str) -> pa.DataType:
    """Type of a waiting column; instants stay as pandas shows them, without a zone."""
    read = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string()}.get(kind)
    read = read or to_arrow_type(DataType.fromDDL(kind))
    return pa.timestamp("us") if pa.types.is_timestamp(read) else read


def plain_rows(rows: pa.Table) -> list[tuple]:
    """Rows as tuples of Python objects, null as None."""
    whole = [c.null_count == 0 and (pa.types.is_integer(c.type) or pa.types.is_floating(c.type)) for c in rows.columns]
    return list(zip(*(c.to_numpy().tolist() if fast else c.to_pylist() for c, fast in zip(rows.columns, whole))))


def up_to_ms(us: int) -> int:
    """The first whole millisecond at or after a time; watermarks and timers count in those."""
    return -(-us // TICK_US)


class Buffered(StatefulProcessor):
    """Holds each row until the watermark reaches it, then applies rows in event-time order.

    Whatever order rows arrive in within the watermark delay, the result is that of the
    sorted rows.  Rows wait in pieces: the rows of an arrival in time order, cut at the end of
    a slot of ``slot_ms`` once a piece has PIECE_ROWS rows.  A piece is one map entry under its
    earliest time, written once and not added to.  A key has one timer, at the earliest of
    what waits; when it fires, pieces are read in time order as far as the watermark goes and
    the rows are applied in stretches, so state calls grow with rows / PIECE_ROWS and with
    keys, not with slots, and what is in memory with STRETCH_ROWS.
    """

    order = 2  # rows are sorted by this many leading columns
    alarms = False  # whether something may fall due between rows

    def __init__(self, key: str, payload: Sequence[tuple[str, str]], slot_ms: int = 60_000):
        self.key = key
        self.names = [name for name, _ in payload]
        self.layout = pa.schema([("us", pa.int64()), *((name, arrow_type(kind)) for name, kind in payload)])
        self.slot_ms = slot_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getMapState("pending", "us bigint, part bigint", "rows binary")
        self.clock = handle.getValueState("clock", "wake_ms bigint, parts bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wake_ms, parts = self.clock.get() or (None, 0)
        first, held, size = None, [], 0

        def put() -> None:
            nonlocal first, parts, held, size
            earliest, parts = self.hold(pa.Table.from_batches(held, self.layout), parts)
            first, held, size = earliest if first is None else min(first, earliest), [], 0

        for batch in rows:
            batch = batch[batch["us"].notna()]
            held.append(pa.RecordBatch.from_arrays([pa.array(batch[f.name], f.type, from_pandas=True) for f in self.layout], schema=self.layout))
            size += len(batch)
            if size >= STRETCH_ROWS:
                put()
        if size:
            put()
        if first is not None:
            self.wake(wake_ms, up_to_ms(first) if wake_ms is None else min(wake_ms, up_to_ms(first)), parts)
        return iter([])

    def hold(self, rows: pa.Table, parts: int) -> tuple[int, int]:
        """Write rows as pieces; their earliest time and the number of the next piece."""
        us = rows.column("us").to_numpy()
        order = np.argsort(us, kind="stable")
        us = us[order]
        (rows,) = rows.take(order).combine_chunks().to_batches()
        ends = np.flatnonzero(np.diff(up_to_ms(us) // self.slot_ms)) + 1
        at = 0
        while at < len(us):
            full = ends[np.searchsorted(ends, at + PIECE_ROWS) :][:1]
            end = min([len(us), at + MOST_ROWS, *full.tolist()])
            self.pending.updateValue((int(us[at]), parts), (rows.slice(at, end - at).serialize().to_pybytes(),))
            at, parts = end, parts + 1
        return int(us[0]), parts

    def wake(self, old_ms: int | None, new_ms: int, parts: int) -> None:
        """Move the key's one timer."""
        if new_ms != old_ms:
            if old_ms is not None:
                self.handle.deleteTimer(old_ms)
            self.handle.registerTimer(new_ms)
        self.clock.update((new_ms, parts))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark_ms = timerValues.getCurrentWatermarkInMs()
        _, parts = self.clock.get()
        places = sorted(tuple(place) for place in self.pending.keys())
        n = sum(up_to_ms(us) <= mark_ms for us, _ in places)
        ready, later = places[:n], places[n:]
        self.due_ms = None
        self.opened(key)
        held = self.layout.empty_table()
        at = 0
        while True:
            # at least as much is read as waits, so rows of pieces that overlap are not sorted again and again
            fresh, size = [], 0
            while at < n and size < max(STRETCH_ROWS, held.num_rows):
                (piece,) = self.pending.getValue(ready[at])
                fresh.append(pa.ipc.read_record_batch(pa.py_buffer(piece), self.layout))
                size += fresh[-1].num_rows
                self.pending.removeKey(ready[at])
                at += 1
            if fresh:
                held = pa.concat_tables([held, pa.Table.from_batches(fresh, self.layout)])
                held = held.take(pc.sort_indices(held, sort_keys=[(name, "ascending") for name in self.layout.names[: self.order]]))
            # what may be applied: nothing unread is earlier
            until_us = mark_ms * TICK_US + 1 if at == n else min(ready[at][0], mark_ms * TICK_US + 1)
            cut = int(np.searchsorted(held.column("us").to_numpy(), until_us))
            if cut or at == n:
                rows, held = plain_rows(held.slice(0, cut)), held.slice(cut)
                out = list(self.apply(key, rows, (until_us - 1) // TICK_US)) if rows or self.alarms else []
                if out:
                    yield pd.DataFrame(out)
            if at == n:
                break
        self.closed(key)
        waiting = [up_to_ms(us) for us, _ in later[:1]]
        if held.num_rows:
            earliest, parts = self.hold(held, parts)
            waiting.append(up_to_ms(earliest))
        if self.due_ms is not None:
            waiting.append(self.due_ms)
        if waiting:
            self.wake(None, min(waiting), parts)
        else:
            self.clock.clear()

    def opened(self, key) -> None:
        """Called before the stretches of a timer: read state that they share."""

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        """Apply released rows; nothing else of the key happens up to ``ms``.

        A processor that waits for a time sets ``due_ms`` to it, or to None, each time.
        """
        raise NotImplementedError

    def closed(self, key) -> None:
        """Called after the stretches of a timer: write state that they shared."""

    def close(self) -> None:
        pass


class ReleasedSteps(Buffered):
    """Pending steps of a shard, passed on when the watermark reaches them; rows are (us, last, tie, capacity, region)."""

    order = 3
    OUTPUT = "{key} string, due timestamp, us bigint, last int, tie bigint, capacity int, region string"

    def __init__(self, key: str, slot_ms: int):
        super().__init__(key, [("last", "int"), ("tie", "bigint"), ("capacity", "int"), ("region", "string")], slot_ms)

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        for us, last, tie, capacity, region in rows:
            yield {self.key: key[0], "due": pd.Timestamp(us, unit="us"), "us": us, "last": last, "tie": tie, "capacity": capacity, "region": region}


class OccupancyMonitor(StatefulProcessor):
    """Beds in use per key and its status changes, from released steps.

    All shards of a key release what the watermark has reached in one micro-batch, and later
    batches hold later steps, so a batch's steps are put in order and applied; nothing waits here
    and the state of a key is two numbers and a status.
    """

    OUTPUT = "{key} string, region string, us bigint, tie bigint, previous_status string, status string, occupied bigint, capacity int"

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.occupied = handle.getValueState("occupiedBeds", "n bigint, underflows bigint")
        self.status = handle.getValueState("bedOccupancyStatus", "status string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, underflows = self.occupied.get() if self.occupied.exists() else (0, 0)
        status = self.status.get()[0] if self.status.exists() else "NORMAL"
        steps = pd.concat(list(rows)).sort_values(["us", "last", "tie"])
        out = []
        for us, last, tie, capacity, region in steps[["us", "last", "tie", "capacity", "region"]].itertuples(index=False):
            n -= last
            if n < 0:
                n, underflows = 0, underflows + 1
            after = next_status(status, n / capacity)
            if after != status:
                out.append((key[0], region, us, tie, status, after, n, capacity))
            status = after
        self.occupied.update((int(n), int(underflows)))
        self.status.update((status,))
        if out:
            yield pd.DataFrame(out, columns=[self.key, "region", "us", "tie", "previous_status", "status", "occupied", "capacity"])

    def close(self) -> None:
        pass


def next_status(status: str, ratio: float) -> str:
    """Hysteresis between NORMAL, HIGH and FULL; one step may skip HIGH either way."""
    if ratio >= (FULL_EXIT if status == "FULL" else FULL_ENTER):
        return "FULL"
    if ratio >= (HIGH_ENTER if status == "NORMAL" else HIGH_EXIT):
        return "HIGH"
    return "NORMAL"


class CapacityAlert(StatefulProcessor):
    """Forwards every admission and raises one alert per key when its count reaches the ratio.

    Rows of a micro-batch count in event-time order, however they are split into Arrow
    batches: of those that may hold the alert row, the earliest ones are kept, at most as many
    as the key has beds.
    """

    def __init__(self, key: str, ratio: float):
        self.columns = [key, "us", "tie", "capacity", "tag", "occupied"]
        self.ratio = ratio

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("occupiedBeds", "n bigint")
        self.alerted = handle.getValueState("capacityAlerted", "yes boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.count.get()[0] if self.count.exists() else 0
        open_alert, n, first = not self.alerted.exists(), before, None
        for batch in rows:
            yield batch.assign(tag="main", occupied=None)[self.columns]
            n += len(batch)
            if open_alert:
                most = max(int(batch["capacity"].max()), 0 if first is None else int(first["capacity"].max()))
                first = batch if first is None else pd.concat([first, batch])
                # the alert comes at the latest when every bed is counted
                first = first.sort_values(["us", "tie"], ignore_index=True).head(max(most - before, 1))
        if open_alert and first is not None:
            counts = before + 1 + np.arange(len(first))
            capacity = first["capacity"].to_numpy()
            reached = (capacity > 0) & (counts / np.where(capacity > 0, capacity, 1) >= self.ratio)
            if reached.any():
                at = int(np.argmax(reached))
                yield first.iloc[[at]].assign(tag="alert", occupied=int(counts[at]))[self.columns]
                self.alerted.update((True,))
        self.count.update((n,))

    def close(self) -> None:
        pass


class DeferredEmit(Buffered):
    """Emits every row once the watermark reaches its due time; nothing pending is overwritten."""

    order = 1

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        for row in rows:
            yield {self.key: key[0], **dict(zip(["us", *self.names], row))}


class DeferredSlot(StatefulProcessor):
    """One pending record per key: a later arrival overwrites it, a timer emits and empties it.

    The slot is the value state; timers stay registered when it is overwritten.
    """

    def __init__(self, key: str, payload: Sequence[tuple[str, str]]):
        self.key = key
        self.columns = [("due_us", "bigint"), *payload]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        kinds = ", ".join(f"{n} {k}" for n, k in self.columns)
        self.slot = handle.getValueState("pendingDischarge", kinds)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        newest = None
        for batch in rows:
            for due in batch["due_us"]:
                self.handle.registerTimer(up_to_ms(int(due)))
            # the latest row of the whole micro-batch, however it is split into Arrow batches
            newest = batch if newest is None else pd.concat([newest, batch])
            newest = newest.sort_values("us", kind="stable").tail(1)
        if newest is not None:
            self.slot.update(tuple(plain(newest[n], kind)[0] for n, kind in self.columns))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.slot.exists():
            held = self.slot.get()
            self.slot.clear()
            names = [n for n, _ in self.columns]
            yield pd.DataFrame([{self.key: key[0], **dict(zip(names, held)), "fired_ms": expiredTimerInfo.getExpiryTimeInMs()}])

    def close(self) -> None:
        pass


class SilenceDetector(Buffered):
    """SILENT one gap after the last row of a key, RESUMED at the next one, in event time."""

    alarms = True

    def __init__(self, key: str, gap_us: int, slot_ms: int):
        super().__init__(key, [], slot_ms)
        self.gap_us = gap_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("lastSeen", "us bigint, silent boolean")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        last, silent = self.last.get() if self.last.exists() else (None, False)
        for (us,) in rows:
            # rows of one key within a millisecond of the deadline: the earlier time goes first
            if last is not None and not silent and us > last + self.gap_us:
                yield {self.key: key[0], "alert": "SILENT", "us": last + self.gap_us}
                silent = True
            if silent:
                yield {self.key: key[0], "alert": "RESUMED", "us": us}
            last, silent = us, False
        if last is not None and not silent and up_to_ms(last + self.gap_us) <= ms:
            yield {self.key: key[0], "alert": "SILENT", "us": last + self.gap_us}
            silent = True
        if last is not None:
            self.last.update((last, silent))
        self.due_ms = None if last is None or silent else up_to_ms(last + self.gap_us)


class IdleDetector(StatefulProcessor):
    """SILENT when a key sends nothing for ``gap_ms`` of processing time, RESUMED when it does again."""

    def __init__(self, key: str, gap_ms: int):
        self.key = key
        self.gap_ms = gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", "ms bigint")
        self.silent = handle.getValueState("silent", "yes boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for _ in rows:
            pass
        now = timerValues.getCurrentProcessingTimeInMs()
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(now + self.gap_ms)
        self.timer.update((now + self.gap_ms,))
        if self.silent.exists():
            self.silent.clear()
            yield pd.DataFrame([{self.key: key[0], "alert": "RESUMED", "ms": now}])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.timer.clear()
        self.silent.update((True,))
        yield pd.DataFrame([{self.key: key[0], "alert": "SILENT", "ms": expiredTimerInfo.getExpiryTimeInMs()}])

    def close(self) -> None:
        pass


class SustainedBreach(Buffered):
    """One alert per episode that outlasts its sustain time, also if no further row comes.

    Rows are (us, tie, rule, breach, wait_us, limit_us); one key may carry several rules.
    An alert is not raised if its time is not before ``limit_us`` (the rule's delete).
    """

    alarms = True

    def __init__(self, key: str, slot_ms: int):
        payload = [("tie", "bigint"), ("rule", "string"), ("breach", "boolean"), ("wait_us", "bigint"), ("limit_us", "bigint")]
        super().__init__(key, payload, slot_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.episodes = handle.getMapState(
            "breachStart", "rule string, life bigint", "start_us bigint, due_us bigint, alerted boolean"
        )

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        episodes = {tuple(e): tuple(v) for e, v in self.episodes.iterator()}
        before = dict(episodes)
        for us, _, rule, breach, wait_us, limit_us in rows:
            yield from self.expired(key, episodes, us)
            episode = (rule, limit_us)
            if not breach:
                episodes.pop(episode, None)
            elif episode not in episodes:
                episodes[episode] = (us, us + wait_us, False)
        yield from self.expired(key, episodes, ms * TICK_US)
        for episode in before.keys() - episodes.keys():
            self.episodes.removeKey(episode)
        for episode, state in episodes.items():
            if before.get(episode) != state:
                self.episodes.updateValue(episode, state)
        # one timer for the next deadline; a deadline that was reset finds its episode gone
        waiting = [due for _, due, alerted in episodes.values() if not alerted]
        self.due_ms = up_to_ms(min(waiting)) if waiting else None

    def expired(self, key, episodes: dict, until_us: int) -> Iterator[dict]:
        due_now = [(due, e) for e, (_, due, alerted) in episodes.items() if not alerted and due <= until_us]
        for due, episode in sorted(due_now):
            start = episodes[episode][0]
            if due < episode[1]:
                yield {self.key: key[0], "rule": episode[0], "start_us": start, "us": due}
            episodes[episode] = (start, due, True)


class News2Scorer(Buffered):
    """Latest reading per vital sign; a row per change of total or band, and missing-sign notices.

    Rows are (us, tie, code, points).  Readings older than ``evict_us`` are removed by a timer.
    """

    alarms = True
    SIGNS = ["RR", "SPO2", "O2", "SBP", "HR", "CONSC", "TEMP"]

    def __init__(self, key: str, fresh_us: int, notice_us: int, evict_us: int, slot_ms: int):
        super().__init__(key, [("tie", "bigint"), ("code", "string"), ("points", "int")], slot_ms)
        self.fresh_us, self.notice_us, self.evict_us = fresh_us, notice_us, evict_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.latest = handle.getMapState("latestVitals", "code string", "us bigint, points int")
        self.scored = handle.getValueState("lastScore", "total int, band string")
        self.noticed = handle.getValueState("lastUnavailable", "us bigint")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        signs = {code[0]: tuple(value) for code, value in self.latest.iterator()}
        before = dict(signs)
        last = tuple(self.scored.get()) if self.scored.exists() else None
        noticed = self.noticed.get()[0] if self.noticed.exists() else None
        for us, tie, code, points in rows:
            signs[code] = (us, points)
            missing = [c for c in self.SIGNS if c not in signs or us - signs[c][0] > min(self.fresh_us, self.evict_us)]
            if missing:
                if noticed is None or us - noticed >= self.notice_us:
                    noticed = us
                    yield self.output(key, us, tie, "unavailable", None, None, ",".join(missing))
                continue
            points = [signs[c][1] for c in self.SIGNS]
            score = self.score(points)
            if score != last:
                last = score
                yield self.output(key, us, tie, "score", *score, None, points)
        signs = {c: v for c, v in signs.items() if up_to_ms(v[0] + self.evict_us) > ms}
        for code in before.keys() - signs.keys():
            self.latest.removeKey((code,))
        for code, state in signs.items():
            if before.get(code) != state:
                self.latest.updateValue((code,), state)
        if last is not None:
            self.scored.update(last)
        if noticed is not None:
            self.noticed.update((noticed,))
        self.due_ms = up_to_ms(min(us for us, _ in signs.values()) + self.evict_us) if signs else None

    @staticmethod
    def score(points: list[int]) -> tuple[int, str]:
        total = sum(points)
        if total >= 7:
            return total, "HIGH"
        if total >= 5:
            return total, "MEDIUM"
        return total, "LOW-MEDIUM" if 3 in points else "LOW"

    def output(self, key, us, tie, tag, total, band, missing, points=(None,) * len(SIGNS)) -> dict:
        named = {f"{c.lower()}_points": p for c, p in zip(self.SIGNS, points)}
        return {self.key: key[0], "us": us, "tie": tie, "tag": tag, "total": total, "band": band, "missing": missing, **named}


class Pager(Buffered):
    """Suppresses repeats per sender, then pages in batches of ``size`` or at once when urgent.

    Rows are (us, tie, who, urgent).  The buffer and the last paged times are keyed state of
    the shard, so both survive a restart and move with the shard.
    """

    alarms = True

    def __init__(self, key: str, within_us: int, size: int, slot_ms: int):
        super().__init__(key, [("tie", "bigint"), ("who", "string"), ("urgent", "boolean")], slot_ms)
        self.within_us, self.size = within_us, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.paged = handle.getMapState("lastPaged", "who string", "us bigint")
        self.buffer = handle.getListState("buffer", "us bigint, tie bigint, who string")
        self.page = handle.getValueState("page", "n bigint")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        held = [tuple(x) for x in self.buffer.get()] if self.buffer.exists() else []
        page = self.page.get()[0] if self.page.exists() else 0
        before = {who[0]: us[0] for who, us in self.paged.iterator()}
        paged = dict(before)
        for us, tie, who, urgent in rows:
            if who in paged and us - paged[who] < self.within_us:
                continue
            paged[who] = us
            held.append((us, tie, who))
            if urgent or len(held) == self.size:
                page += 1
                for alert in held:
                    yield {self.key: key[0], "page": page, "us": alert[0], "tie": alert[1], "who": alert[2], "flushed_us": us}
                held = []
        self.page.update((page,))
        if held:
            self.buffer.put(held)
        else:
            self.buffer.clear()
        live = {who: us for who, us in paged.items() if up_to_ms(us + self.within_us) > ms}
        for who in before.keys() - live.keys():
            self.paged.removeKey((who,))
        for who, us in live.items():
            if before.get(who) != us:
                self.paged.updateValue((who,), (us,))
        self.due_ms = up_to_ms(min(live.values()) + self.within_us) if live else None


class ExpiringSum(Buffered):
    """Running sum per key that starts over after ``ttl_us`` without a row; state goes when it expires."""

    alarms = True

    def __init__(self, key: str, ttl_us: int, slot_ms: int):
        super().__init__(key, [("tie", "bigint"), ("amount", "bigint")], slot_ms)
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.spend = handle.getValueState("rollingSpend", "total bigint, n bigint, us bigint")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        total, n, last = self.spend.get() or (0, 0, None)
        for us, tie, amount in rows:
            if last is not None and us - last >= self.ttl_us:
                total, n = 0, 0
            total, n, last = total + amount, n + 1, us
            yield {self.key: key[0], "us": us, "tie": tie, "live_sum": total, "live_count": n}
        self.due_ms = None if last is None else up_to_ms(last + self.ttl_us)
        if self.due_ms is None or self.due_ms <= ms:
            self.due_ms = None
            self.spend.clear()
            return
        self.spend.update((total, n, last))


class CountTrigger(StatefulProcessor):
    """Early result of a window each time its count reaches a multiple of ``nth``, final one at its end."""

    def __init__(self, key: str, nth: int, width_us: int):
        self.key, self.nth, self.width_us = key, nth, width_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.count.get()[0] if self.count.exists() else 0
        fired = []
        for batch in rows:
            fired += [m for m in range(n + 1, n + len(batch) + 1) if m % self.nth == 0]
            n += len(batch)
        self.count.update((n,))
        self.handle.registerTimer(up_to_ms(key[1] + self.width_us))
        if fired:
            yield pd.DataFrame([self.output(key, m, False) for m in fired])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([self.output(key, self.count.get()[0], True)])
        self.count.clear()

    def output(self, key, n: int, final: bool) -> dict:
        return {self.key: key[0], "start_us": key[1], "n": n, "is_final": final}

    def close(self) -> None:
        pass


class LateRouter(StatefulProcessor):
    """Routes rows by how far their window lies behind the logical watermark.

    The query declares a generous watermark so Spark keeps late rows; the logical one runs
    ``ahead_ms`` in front of it.
    """

    def __init__(self, key: str, ahead_ms: int, width_us: int, lateness_us: int):
        self.columns = [key, "us", "tie", "route"]
        self.ahead_ms, self.width_us, self.lateness_us = ahead_ms, width_us, lateness_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        mark_us = (mark + self.ahead_ms) * TICK_US if mark > 0 else -1
        for batch in rows:
            end = batch["us"] - batch["us"] % self.width_us + self.width_us
            route = np.where(end > mark_us, "on_time", np.where(end + self.lateness_us > mark_us, "refire", "late"))
            yield batch.assign(route=route)[self.columns]

    def close(self) -> None:
        pass


class BaselineOutliers(Buffered):
    """Flags a reading far from the key's own earlier readings, from n, sum and square sum around the first."""

    def __init__(self, key: str, sigmas: float, slot_ms: int):
        super().__init__(key, [("tie", "bigint"), ("x", "double")], slot_ms)
        self.sigmas = sigmas

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.stats = handle.getValueState("runningStats", "n bigint, first double, s double, q double")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        n, first, s, q = self.stats.get() if self.stats.exists() else (0, rows[0][2] if rows else 0.0, 0.0, 0.0)
        for us, tie, x in rows:
            d = x - first
            off, spread = n * d - s, n * q - s * s
            yield {
                self.key: key[0], "us": us, "tie": tie, "baseline_n": n,
                "is_outlier": bool(n >= 2 and spread > 0 and off * off > self.sigmas**2 * spread),
            }
            n, s, q = n + 1, s + d, q + d * d
        self.stats.update((n, first, s, q))


class CrossingAlert(StatefulProcessor):
    """Alerts when a key's value rises above the limit after one that was not above it.

    Values come from closed windows, so each batch holds later windows than the one before.
    """

    def __init__(self, key: str, limit: float):
        self.key, self.limit = key, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.before = handle.getValueState("previousAverage", "x double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        before = self.before.get()[0] if self.before.exists() else None
        values = pd.concat(list(rows)).sort_values("us")
        out = []
        for us, x in zip(values["us"], values["x"]):
            if before is not None and x > self.limit and before <= self.limit:
                out.append({self.key: key[0], "us": us, "x": x, "previous_value": before})
            before = x
        self.before.update((float(before),))
        if out:
            yield pd.DataFrame(out)

    def close(self) -> None:
        pass
