"""Processors on a state kept in memory: what they read and write, and that stretches do not show."""

from __future__ import annotations

import random

import pandas as pd
import pytest

from tidewatch.streaming import live
from tidewatch.streaming import processors as p

HOUR_US = 3_600_000_000
START_US = 1_704_067_200_000_000


class Map:
    def __init__(self, handle):
        self.handle, self.held = handle, {}

    def getValue(self, k):
        self.handle.calls += 1
        return self.held.get(tuple(k))

    def updateValue(self, k, v):
        self.handle.calls += 1
        self.held[tuple(k)] = tuple(v)

    def removeKey(self, k):
        self.handle.calls += 1
        self.held.pop(tuple(k), None)

    def keys(self):
        self.handle.calls += 1
        return iter(list(self.held))

    def iterator(self):
        self.handle.calls += 1
        self.handle.read += len(self.held)
        return iter(list(self.held.items()))


class Value:
    def __init__(self, handle):
        self.handle, self.held = handle, None

    def exists(self):
        self.handle.calls += 1
        return self.held is not None

    def get(self):
        self.handle.calls += 1
        return self.held

    def update(self, v):
        self.handle.calls += 1
        self.held = tuple(v)

    def clear(self):
        self.handle.calls += 1
        self.held = None


class Handle:
    """One key's state, its timers and the number of state calls."""

    def __init__(self):
        self.calls, self.read, self.timers = 0, 0, set()

    def getMapState(self, name, key, value):
        return Map(self)

    def getValueState(self, name, value):
        return Value(self)

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.calls += 1
        self.timers.discard(ms)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    def getExpiryTimeInMs(self):
        return self.ms


def played(processor, arrivals: list[tuple[list[pd.DataFrame], int]]) -> tuple[list[dict], Handle]:
    """Rows out of arrivals (their Arrow batches, the watermark after them) of one key."""
    handle, out = Handle(), []
    processor.init(handle)
    for batches, mark_ms in arrivals:
        list(processor.handleInputRows(("k",), iter(batches), At(mark_ms)))
        for ms in sorted(t for t in handle.timers if t <= mark_ms):
            if ms in handle.timers:
                for rows in processor.handleExpiredTimer(("k",), At(mark_ms), At(ms)):
                    out += rows.to_dict("records")
                handle.timers.discard(ms)
    return out, handle


def amounts(hours: list[int]) -> pd.DataFrame:
    return pd.DataFrame({"us": [START_US + h * HOUR_US + h for h in hours], "tie": hours, "amount": [1] * len(hours)})


def end_ms(hours: int) -> int:
    return (START_US + hours * HOUR_US) // 1000


@pytest.mark.parametrize("name", ["expiring", "rolling"])
def test_state_calls_do_not_grow_with_slots(name):
    """One arrival in 500 hourly slots: a few calls, not some for every slot and pane."""
    processor = p.ExpiringSum("k", 24 * HOUR_US, 3_600_000) if name == "expiring" else live.RollingPanes("k", HOUR_US, 24, 3_600_000)
    out, handle = played(processor, [([amounts(list(range(500)))], end_ms(499))])
    assert len(out) == 499
    last = out[-1]
    assert (last["live_sum"] if name == "expiring" else last["rolling_sum"]) == (499 if name == "expiring" else 24)
    assert handle.calls < 60 and len(handle.timers) == 1


def test_an_arrival_in_many_batches_is_written_once():
    """Capacity and bed steps in 100 Arrow batches over all slots: pieces are not read and written for every batch."""
    rows = pd.DataFrame({"us": [START_US + i % 200 * HOUR_US + i for i in range(10_000)], "turn": [0 if i < 200 else 1 + i % 2 for i in range(10_000)]})
    rows = rows.assign(tie=rows.index, delta=rows["turn"].map({0: 0, 1: 1, 2: -1}), size=[50.0 if t == 0 else None for t in rows["turn"]])
    batches = [rows.iloc[i : i + 100] for i in range(0, 10_000, 100)]
    _, handle = played(live.DynamicCapacity("k", 3_600_000), [(batches, end_ms(100)), ([], end_ms(200))])
    assert handle.calls < 100


def reading(i: int, us: int, who: str, value: float) -> tuple:
    return (us, 1, i, "READING", who, "W", "hr", value, None, None, None, None)


def monitored(rows: list[tuple], arrivals: int = 1) -> tuple[list[dict], Handle]:
    names = ["us", *(n for n, _ in live.RuleMonitor.PAYLOAD)]
    frame = pd.DataFrame(rows, columns=names)
    monitor = live.RuleMonitor("k", [("R", "*", "hr", 0.0, 100.0, 2 * HOUR_US)], 3_600_000)
    return played(monitor, [([frame], max(r[0] for r in rows) // 1000 + 1)])


def test_open_episodes_are_read_once():
    """300 patients stay in breach over 100 slots: their episodes are not gone over in every slot."""
    rows = [reading(h * 300 + w, START_US + h * HOUR_US + w, f"P-{w}", 200.0) for h in range(100) for w in range(300)]
    out, handle = monitored(rows)
    assert sum(r["tag"] == "alert" for r in out) == 30_000 and sum(r["tag"] == "sustained" for r in out) == 300
    assert handle.read <= 300 and handle.calls < 400


def test_an_episode_begun_anew_has_its_own_deadline():
    hours = [(0, 200.0), (1, 50.0), (1.5, 200.0), (2.5, 200.0), (6, 50.0)]
    out, _ = monitored([reading(i, START_US + int(h * HOUR_US), "P-1", v) for i, (h, v) in enumerate(hours)])
    assert [(r["start_us"], r["us"]) for r in out if r["tag"] == "sustained"] == [(START_US + int(1.5 * HOUR_US), START_US + int(3.5 * HOUR_US))]


@pytest.mark.parametrize("seed", range(4))
def test_pieces_and_stretches_do_not_show(monkeypatch, seed):
    """Rows in any order within the delay, in small pieces that overlap: sums are those of the sorted rows."""
    monkeypatch.setattr(p, "PIECE_ROWS", 3)
    monkeypatch.setattr(p, "MOST_ROWS", 5)
    monkeypatch.setattr(p, "STRETCH_ROWS", 7)
    draw = random.Random(seed)
    hours = sorted(draw.sample(range(2_000), 300))
    arrivals, waiting, mark = [], list(hours), 0
    while waiting:
        # what comes now is later than the watermark, not in order, in batches of four
        come = draw.sample(waiting, min(len(waiting), 40))
        waiting = [h for h in waiting if h not in come]
        mark = max(mark, (min(waiting) if waiting else 2_100) - 1)
        arrivals.append(([amounts(come[i : i + 4]) for i in range(0, len(come), 4)], end_ms(mark)))
    for make in (lambda: p.ExpiringSum("k", 9 * HOUR_US, 7_200_000), lambda: live.RollingPanes("k", HOUR_US, 9, 7_200_000)):
        out, handle = played(make(), arrivals)
        whole, _ = played(make(), [([amounts(hours)], end_ms(2_100))])
        assert out == whole and len(out) == 300
        assert not handle.timers


def test_rows_without_a_time_wait_for_nothing():
    rows = amounts([1, 2, 3]).astype({"us": "float64"})
    rows.loc[1, "us"] = None
    out, _ = played(p.ExpiringSum("k", 24 * HOUR_US, 3_600_000), [([rows], end_ms(50))])
    assert [r["tie"] for r in out] == [1, 3]
