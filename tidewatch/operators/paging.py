"""Paging: one alert model, repeat suppression, batches of ten with urgent flush."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.operators.timeline import SEG, Timeline, latest, previous, tally
from tidewatch.operators.windows import span_us

ALERT_COLUMNS = ["patient_id", "alert_type", "severity", "alert_time"]
PAGE_SIZE = 10
REPEAT_WITHIN = "2 minutes"
NOWHERE = 2**63 - 1


def union_alerts(*streams: DataFrame) -> DataFrame:
    """Alert streams of different kinds as one frame of the common columns."""
    return reduce(lambda a, b: a.unionByName(b), [s.select(*ALERT_COLUMNS) for s in streams])


def page_batches(
    alerts: DataFrame, shard: Sequence[str], ts: str, urgent: Column, ties: Sequence[str] = (), size: int = PAGE_SIZE, hot_rows: int | None = None
) -> DataFrame:
    """Alerts with the page they go out on; alerts still buffered at the end are left out.

    A page closes on its ``size``-th alert or on an urgent one, and counting restarts after
    it.  So with u the number of urgent alerts before a row and p the row's position since
    the last of them, the page is (u, (p - 1) div size).
    """
    line = Timeline.of(alerts.withColumn("__urgent", urgent), shard, ts, ties, hot_rows)
    line = line.scan(__seen=tally(F.lit(True)), urgent_before=tally(F.col("__urgent"), before=True))
    line = line.scan(__start=latest(F.when(F.col("__urgent"), F.col("__seen")), before=True))
    place = F.col("__seen") - F.coalesce(F.col("__start"), F.lit(0))
    rows = line.with_columns(
        urgent_before=F.coalesce(F.col("urgent_before"), F.lit(0)),
        page_in_run=F.expr(f"(__seen - coalesce(__start, 0) - 1) div {size}"),
        position=F.pmod(place - 1, F.lit(size)) + 1,
    ).frame()
    closes = F.max(F.when(F.col("__urgent") | (F.col("position") == size), 1).otherwise(0))
    pages = (
        rows.groupBy(*shard, "urgent_before", "page_in_run")
        .agg(
            F.count(F.lit(1)).alias("alerts"),
            F.max(F.col("__urgent").cast("int")).alias("has_urgent"),
            F.min(ts).alias("first_alert"),
            F.max(ts).alias("flushed_at"),
            closes.alias("__closed"),
        )
        .where(F.col("__closed") == 1)
        .drop("__closed")
    )
    return pages


def suppress_repeats(
    alerts: DataFrame | Timeline, keys: Sequence[str], ts: str, within: str = REPEAT_WITHIN, ties: Sequence[str] = (), hot_rows: int | None = None
) -> DataFrame:
    """Keep an alert only if the key's last *kept* alert is at least ``within`` back.

    The choice depends on what was kept, not on the row before, so it is a walk: from a
    kept alert to the first one ``within`` or more later.  An alert that is ``within``
    after its predecessor is always kept, which cuts a key into independent runs.  The
    opener of a run is kept and everything closer than ``within`` to it is not; only the
    rest of a run has to be walked.  A run inside a hot key is cut into the segments of
    its timeline: each segment lists, for every alert the walk could enter at, where the
    walk leaves it; the (short) lists are chained per run, and every segment then walks
    from its entry.
    """
    step = span_us(within)
    line = alerts if isinstance(alerts, Timeline) else Timeline.of(alerts, keys, ts, ties, hot_rows)
    names = [c for c in line.rows.columns if c != SEG]
    line = line.scan(__prev=previous(ts))
    apart = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__prev"))
    line = line.with_columns(__us=F.unix_micros(F.col(ts)), __opens=F.coalesce(apart >= step, F.lit(True)))
    line = line.scan(__run=latest(F.when(F.col("__opens"), F.col("__us"))))
    walked = line.rows.where(F.col("__opens") | (F.col("__us") - F.col("__run") >= step)).drop("__prev", "__opens")
    group = [*keys, "__run"]
    if line.segments:
        group.append(SEG)
        starts = _chain(_segment_exits(walked, group, step), group, step)
        walked = walked.join(starts, _same(group), "left").drop(*[f"__s_{c}" for c in group])
        # a segment that is not entered keeps nothing
        skipped = F.when(F.col(SEG).isNull(), F.col("__run")).otherwise(F.lit(NOWHERE))
        walked = walked.withColumn("__enter", F.coalesce("__enter", skipped))
    else:
        walked = walked.withColumn("__enter", F.col("__run"))
    # rows of a group lie together and in order; the walk is one pass that holds one number
    order = ["__us", *ties]
    placed = walked.repartition(*group).sortWithinPartitions(*group, *order)
    first = F.row_number().over(Window.partitionBy(*group).orderBy(*order)) == 1
    marked = placed.withColumn("__first", first).select(*names, "__us", "__enter", "__first")
    out = marked.select(*names).schema

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        need = 0
        for batch in batches:
            picked = []
            us, enter, opens = batch["__us"].tolist(), batch["__enter"].tolist(), batch["__first"].to_numpy()
            cuts = [0, *(k for k in opens.nonzero()[0].tolist() if k), len(us)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if start < end and opens[start]:
                    need = enter[start]
                # from one kept row to the next, over what lies between
                at = bisect_left(us, need, start, end)
                while at < end:
                    picked.append(at)
                    need = us[at] + step
                    at = bisect_left(us, need, at + 1, end)
            yield batch.iloc[picked][names]

    return marked.mapInPandas(keep, out)


def _same(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__s_{c}")) for c in columns])


def _segment_exits(rows: DataFrame, group: Sequence[str], step: int) -> DataFrame:
    """Per segment and possible entry time: the last kept time if the walk enters there.

    A walk coming from an earlier segment enters no later than the first alert one step
    after the segment's first alert, so only those entries are listed.
    """
    fields = [rows.schema[c] for c in group]
    out = T.StructType([*fields, T.StructField("__entry", T.LongType()), T.StructField("__exit", T.LongType())])

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches))
        us = np.unique(pdf["__us"].to_numpy(dtype=np.int64))
        after = np.searchsorted(us, us + step)
        last = us.copy()
        for i in range(len(us) - 1, -1, -1):
            if after[i] < len(us):
                last[i] = last[after[i]]
        heads = min(int(after[0]) + 1, len(us))
        first = pdf[list(group)].iloc[[0] * heads].reset_index(drop=True)
        yield first.assign(__entry=us[:heads], __exit=last[:heads])

    hot = rows.where(F.col(SEG).isNotNull()).select(*group, "__us")
    return hot.groupBy(*group).applyInPandas(exits, out)


def _chain(entries: DataFrame, group: Sequence[str], step: int) -> DataFrame:
    """Entry time of every segment of a run that the walk enters, in one ordered pass over the lists."""
    run = [c for c in group if c != SEG]
    order = [SEG, "__entry"]
    placed = entries.repartition(*run).sortWithinPartitions(*run, *order)
    first = F.row_number().over(Window.partitionBy(*run).orderBy(*order)) == 1
    listed = placed.withColumn("__first", first)
    fields = [T.StructField(f"__s_{c}", entries.schema[c].dataType) for c in group]
    out = T.StructType([*fields, T.StructField("__enter", T.LongType())])

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        need, entered = 0, None
        for batch in batches:
            picked = []
            columns = zip(*[batch[c].tolist() for c in ("__first", "__run", SEG, "__entry", "__exit")])
            for i, (opens, start, segment, entry, leave) in enumerate(columns):
                if opens:
                    need, entered = start, None
                if segment != entered and entry >= need:
                    picked.append(i)
                    need, entered = leave + step, segment
            found = batch.iloc[picked][[*group, "__entry"]]
            found.columns = out.names
            yield found

    return listed.mapInPandas(walk, out)
