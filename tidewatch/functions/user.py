"""Doors for user code over Arrow batches: map and flatMap, lookups, window functions, aggregates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import groupby
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import windows

#: accumulators a task holds before it sends them on
HELD = 10_000
#: middle merges of one key; its last merge reads at most so many rows
SALTS = 64


def map_batches(
    df: DataFrame,
    fn: Callable[..., pd.DataFrame],
    schema: str,
    open: Callable[[], Any] | None = None,
    close: Callable[[Any], None] | None = None,
) -> DataFrame:
    """A user map, flatMap or filter: ``fn`` turns each batch of rows into any number of rows.

    With ``open``, its result (a connection, a model, a table) is made once per partition on
    the worker and handed to ``fn(batch, resource)``, so a lookup goes out once per batch;
    ``close`` gets it when the partition ends, also when it fails or is cut short.  An empty
    partition opens and closes too.  Works on bounded tables and streams alike.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if open is None:
            yield from map(fn, batches)
            return
        resource = open()
        try:
            for batch in batches:
                yield fn(batch, resource)
        finally:
            if close is not None:
                close(resource)

    return df.mapInPandas(task, schema)


def window_apply(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    aggs: Mapping[str, Column],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """A user window function over what the windows' rows were reduced to.

    Rows are aggregated per tumbling window and key before and after the shuffle; ``fn`` gets
    batches of finished windows: their bounds, keys and aggregates.
    """
    return map_batches(windows.tumbling(df, ts, width, keys, aggs), fn, schema)


def window_rows_apply(
    df: DataFrame,
    ts: str,
    width: str,
    keys: Sequence[str],
    fn: Callable[[dict, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
    order: Sequence[str] = (),
) -> DataFrame:
    """A user window function over all rows of each tumbling window and key, in order.

    Rows are shuffled by window and key and sorted by ``order`` (by ``ts`` if none is given).
    ``fn`` gets the window's start, end and keys, and its rows as an iterator of pieces that
    stream in, so a window of any size is never held whole unless ``fn`` holds it; it may stop
    early, and gives any number of frames.  For bounded tables.
    """
    start = windows.window_start(ts, width)
    names = ["window_start", "window_end", *keys]
    placed = df.withColumn("window_start", start).withColumn("window_end", windows.shift("window_start", windows.span_us(width)))
    ranked = placed.repartition(*names).sortWithinPartitions(*names, *(order or [ts]))

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for values, group in groupby(runs_of(batches, names), key=lambda run: run[0]):
            yield from fn(dict(zip(names, values)), (rows for _, rows in group))

    return ranked.mapInPandas(task, schema)


def runs_of(batches: Iterator[pd.DataFrame], names: Sequence[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Sorted batches cut where the named values change; nulls are alike."""
    for batch in batches:
        if batch.empty:
            continue
        held = batch[list(names)]
        before = held.shift()
        changed = ((held != before) & ~(held.isna() & before.isna())).any(axis=1).to_numpy()
        changed[0] = True
        cuts = [*changed.nonzero()[0], len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            values = tuple(None if pd.isna(v) else v for v in held.iloc[a])
            yield values, batch.iloc[a:b].reset_index(drop=True)


def aggregate_with(
    df: DataFrame,
    key: str,
    accumulator: Mapping[str, str],
    add: Callable[[pd.DataFrame], dict],
    merge: Callable[[dict, dict], dict],
    result: Callable[[dict], dict],
    output: Mapping[str, str],
    held_keys: int = HELD,
) -> DataFrame:
    """A user aggregate as add / merge / result; ``merge`` takes accumulators in any order.

    ``add`` turns the rows of one key in one Arrow batch into an accumulator, and a task merges
    those of a key before the shuffle.  A busy key's accumulators then meet in ``SALTS`` tasks
    and at last in one.  They are merged as they stream in; no group is ever held whole.
    """
    kind = df.schema[key].dataType.simpleString()
    state = ", ".join([f"{key} {kind}", *[f"{n} {t}" for n, t in accumulator.items()]])
    final = ", ".join([f"{key} {kind}", *[f"{n} {t}" for n, t in output.items()]])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}
        for batch in batches:
            for k, rows in batch.groupby(key, dropna=False):
                k = None if pd.isna(k) else k
                held[k] = merge(held[k], add(rows)) if k in held else add(rows)
            if len(held) > held_keys:
                yield pd.DataFrame([{key: k, **parts} for k, parts in held.items()])
                held = {}
        if held:
            yield pd.DataFrame([{key: k, **parts} for k, parts in held.items()])

    def merged(batches: Iterator[pd.DataFrame]) -> dict:
        return reduce(merge, (row for batch in batches for row in batch[list(accumulator)].to_dict("records")))

    def middle(groups: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([{key: groups[0], **merged(batches)}])

    def combine(groups: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame([{key: groups[0], **result(merged(batches))}])

    salted = df.mapInPandas(partial, state).withColumn("__salt", F.spark_partition_id() % SALTS)
    return salted.groupBy(key, "__salt").applyInPandas(middle, state).groupBy(key).applyInPandas(combine, final)
