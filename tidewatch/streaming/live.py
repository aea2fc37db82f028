"""Processors that take control rows in step with data rows: capacities, rules and care plans.

Control and data rows come as one tagged union.  They wait together until the watermark
reaches them and are applied in event-time order, control rows first at equal times, so a
change holds from its own time on, whenever it arrives within the watermark delay.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.streaming.processors import TICK_US, Buffered, next_status, up_to_ms

ANY_WARD = "*"


class DynamicCapacity(Buffered):
    """Beds in use per key under capacities that change; a status row on every change of status.

    Rows are (us, turn, tie, delta, size): turn 0 sets the capacity to ``size``, 1 is an
    admission, 2 a discharge.  Steps are not counted while the capacity is unknown or not positive.
    """

    order = 3
    OUTPUT = "{key} string, us bigint, tie bigint, previous_status string, status string, occupied bigint, capacity int"

    def __init__(self, key: str, slot_ms: int):
        super().__init__(key, [("turn", "int"), ("tie", "bigint"), ("delta", "int"), ("size", "int")], slot_ms)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.beds = handle.getValueState("occupiedBeds", "n bigint, capacity int, status string")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        n, capacity, status = self.beds.get() if self.beds.exists() else (0, -1, "NORMAL")
        for us, turn, tie, delta, size in rows:
            if turn == 0:
                capacity = capacity if size is None else size
            if capacity <= 0:
                continue
            n = max(n + delta, 0)
            after = next_status(status, n / capacity)
            if after != status:
                yield {self.key: key[0], "us": us, "tie": tie, "previous_status": status, "status": after, "occupied": n, "capacity": capacity}
            status = after
        self.beds.update((n, capacity, status))


class RuleMonitor(Buffered):
    """Threshold, suppressed and sustained alerts under rules and care plans that change live.

    Keyed by a shard of patients; control rows are copied to every shard.  Rows are (us, turn,
    tie, kind, who, ward, vital, value, rule, low, high, wait_us).  Turn 0 is a control row: kind
    RULE or CAREPLAN sets, kind RULE_DELETE or CAREPLAN_DELETE takes away; turn 1 is a reading.
    Rules in force are held per rule, plans per patient and vital, episodes per patient and
    rule.  Default rules hold until the first rule is set.

    A reading is judged by the rules for its vital and ward, by the ``*`` rules only if its ward
    has none.  A breach that lasts gives one ``sustained`` row at start + wait, also if no
    further reading comes; the rule is looked up again at that time, and a delete at or before
    it ends the episode without an alert.
    """

    order = 3
    alarms = True
    PAYLOAD = [
        ("turn", "int"), ("tie", "bigint"), ("kind", "string"), ("who", "string"), ("ward", "string"), ("vital", "string"),
        ("value", "double"), ("rule", "string"), ("low", "double"), ("high", "double"), ("wait_us", "bigint"),
    ]
    OUTPUT = "{key} bigint, tag string, who string, rule string, us bigint, start_us bigint, tie bigint, value double, by_plan boolean"

    def __init__(self, key: str, defaults: list[tuple], slot_ms: int):
        super().__init__(key, self.PAYLOAD, slot_ms)
        self.defaults = {rule: tuple(rest) for rule, *rest in defaults}

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.rules = handle.getMapState("rules", "rule string", "ward string, vital string, low double, high double, wait_us bigint")
        self.started = handle.getValueState("rulesStarted", "yes boolean")
        self.plans = handle.getMapState("carePlans", "who string, vital string", "low double, high double")
        self.episodes = handle.getMapState("breachStart", "who string, rule string", "start_us bigint, due_us bigint, alerted boolean, by_plan boolean")

    def opened(self, key) -> None:
        self.known = [{tuple(k): tuple(v) for k, v in state.iterator()} for state in (self.rules, self.plans, self.episodes)]
        self.live = [dict(held) for held in self.known]
        self.first_set = self.started.exists()
        if not self.first_set:
            self.live[0] = {(r,): v for r, v in self.defaults.items()}
        #: deadlines, earliest first; one whose episode has ended or begun anew finds another start
        self.deadlines = [(due, who or "", rule, start, who) for (who, rule), (start, due, alerted, _) in self.live[2].items() if not alerted]
        heapify(self.deadlines)
        self.by_vital = {}

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        rules, plans, episodes = self.live
        for us, turn, tie, kind, who, ward, vital, value, rule, low, high, wait_us in rows:
            # a control row at the deadline comes before the deadline
            yield from self.fired(key, us - 1 if turn == 0 else us)
            if turn == 0:
                self.by_vital = {}
            if kind == "RULE":
                if not self.first_set:
                    self.first_set = True
                    rules.clear()
                    episodes.clear()
                rules[(rule,)] = (ward, vital, low, high, wait_us)
            elif kind == "RULE_DELETE":
                rules.pop((rule,), None)
                for episode in [e for e in episodes if e[1] == rule]:
                    del episodes[episode]
            elif kind == "CAREPLAN":
                plans[who, vital] = (low, high)
            elif kind == "CAREPLAN_DELETE":
                plans.pop((who, vital), None)
            else:
                yield from self.judged(key, us, tie, who, ward, vital, value)
        yield from self.fired(key, ms * TICK_US)
        while self.deadlines and not self.holds(self.deadlines[0]):
            heappop(self.deadlines)
        self.due_ms = up_to_ms(self.deadlines[0][0]) if self.deadlines else None

    def closed(self, key) -> None:
        if self.first_set and not self.started.exists():
            self.started.update((True,))
        if not self.first_set:
            self.live[0] = {}  # defaults are not state
        for state, old, new in zip((self.rules, self.plans, self.episodes), self.known, self.live):
            for k in old.keys() - new.keys():
                state.removeKey(k)
            for k, v in new.items():
                if old.get(k) != v:
                    state.updateValue(k, v)
        self.known = self.live = self.deadlines = None

    def in_force(self, ward, vital) -> list[tuple]:
        """Rules for a vital and ward in order of their names, looked up once until a control row comes."""
        found = self.by_vital.get((ward, vital))
        if found is None:
            rules = [(r, v) for (r,), v in self.live[0].items() if v[1] == vital]
            own = [(r, v) for r, v in rules if v[0] == ward and ward != ANY_WARD]
            found = self.by_vital[ward, vital] = sorted(own or [(r, v) for r, v in rules if v[0] == ANY_WARD])
        return found

    def judged(self, key, us, tie, who, ward, vital, value) -> Iterator[dict]:
        _, plans, episodes = self.live
        plan = plans.get((who, vital))
        for rule, (_, _, low, high, wait_us) in self.in_force(ward, vital):
            low_now, high_now = (low, high) if plan is None else (low if plan[0] is None else plan[0], high if plan[1] is None else plan[1])
            ruled, breach = outside(value, low, high), outside(value, low_now, high_now)
            if ruled or breach:
                yield self.output(key, "alert" if breach else "suppressed", who, rule, us, None, tie, value, plan is not None)
            if not breach:
                episodes.pop((who, rule), None)
            elif (who, rule) not in episodes:
                episodes[who, rule] = (us, us + wait_us, False, plan is not None)
                heappush(self.deadlines, (us + wait_us, who or "", rule, us, who))

    def holds(self, deadline: tuple) -> bool:
        due, _, rule, start, who = deadline
        held = self.live[2].get((who, rule))
        return held is not None and held[:3] == (start, due, False)

    def fired(self, key, until_us: int) -> Iterator[dict]:
        rules, _, episodes = self.live
        while self.deadlines and self.deadlines[0][0] <= until_us:
            deadline = heappop(self.deadlines)
            if not self.holds(deadline):
                continue
            due, _, rule, start, who = deadline
            by_plan = episodes[who, rule][3]
            if (rule,) in rules:
                yield self.output(key, "sustained", who, rule, due, start, None, None, by_plan)
            episodes[who, rule] = (start, due, True, by_plan)

    def output(self, key, tag, who, rule, us, start_us, tie, value, by_plan) -> dict:
        return {self.key: key[0], "tag": tag, "who": who, "rule": rule, "us": us, "start_us": start_us, "tie": tie, "value": value, "by_plan": by_plan}


def outside(value: float | None, low: float | None, high: float | None) -> bool:
    """Whether a value is known to lie outside; an open bound holds nothing back."""
    return value is not None and ((low is not None and value < low) or (high is not None and value > high))


class RollingPanes(Buffered):
    """Sum and count of the last ``panes`` panes of time, the present one included, at every row.

    State is a ring of panes: a map entry per pane that has rows, and a timer at the oldest one's eviction.
    It does not grow with the rows of a pane.
    """

    alarms = True

    def __init__(self, key: str, pane_us: int, panes: int, slot_ms: int):
        super().__init__(key, [("tie", "bigint"), ("amount", "bigint")], slot_ms)
        self.pane_us, self.panes = pane_us, panes

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.ring = handle.getMapState("panes", "pane bigint", "s bigint, n bigint")

    def apply(self, key, rows: list[tuple], ms: int) -> Iterator[dict]:
        ring = {k[0]: tuple(v) for k, v in self.ring.iterator()}
        before = dict(ring)
        s, n, newest = sum(v[0] for v in ring.values()), sum(v[1] for v in ring.values()), None
        for us, tie, amount in rows:
            pane = us // self.pane_us
            if pane != newest:
                for old in [p for p in ring if p <= pane - self.panes]:
                    gone = ring.pop(old)
                    s, n = s - gone[0], n - gone[1]
                newest = pane
            held = ring.get(pane, (0, 0))
            ring[pane] = (held[0] + (amount or 0), held[1] + 1)
            s, n = s + (amount or 0), n + 1
            yield {self.key: key[0], "us": us, "tie": tie, "rolling_sum": s, "rolling_count": n}
        # a pane is out once no row at or after this moment can see it
        for old in [p for p in ring if self.out_ms(p) <= ms]:
            ring.pop(old)
        for pane in before.keys() - ring.keys():
            self.ring.removeKey((pane,))
        for pane, held in ring.items():
            if before.get(pane) != held:
                self.ring.updateValue((pane,), held)
        self.due_ms = self.out_ms(min(ring)) if ring else None

    def out_ms(self, pane: int) -> int:
        return up_to_ms((pane + self.panes) * self.pane_us)


class RunningMoments(StatefulProcessor):
    """Count, mean, variance and maximum so far per key from parts (us, n, s, q, hi) of closed windows.

    Parts come from closed windows, so each batch holds later windows than the one before;
    parts of one window and key are merged first.  Sums are whole numbers, so merging in any
    order gives one result.
    """

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        # the sums may outgrow 64 bits, so they are kept as text
        self.state = handle.getValueState("moments", "n bigint, s string, q string, hi bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, s, q, hi = self.state.get() if self.state.exists() else (0, "0", "0", None)
        s, q = int(s), int(q)
        merged: dict[int, list[int]] = {}
        for batch in rows:
            for us, n_part, s_part, q_part, hi_part in zip(batch["us"], batch["n"], batch["s"], batch["q"], batch["hi"]):
                held = merged.setdefault(int(us), [0, 0, 0, int(hi_part)])
                merged[int(us)] = [held[0] + int(n_part), held[1] + int(s_part), held[2] + int(q_part), max(held[3], int(hi_part))]
        out = []
        for us, (n_part, s_part, q_part, hi_part) in sorted(merged.items()):
            n, s, q, hi = n + n_part, s + s_part, q + q_part, hi_part if hi is None else max(hi, hi_part)
            out.append({self.key: key[0], "us": us, "n": n, "mean": s / n, "variance": (n * q - s * s) / (n * n), "max": int(hi)})
        self.state.update((n, str(s), str(q), int(hi)))
        yield pd.DataFrame(out)

    def close(self) -> None:
        pass
