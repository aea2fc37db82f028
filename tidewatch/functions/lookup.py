"""Asynchronous lookups: a bounded number of calls to an outside service in flight per task."""

from __future__ import annotations

import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, Future, wait
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

#: calls in flight per task, and rows of one call
IN_FLIGHT = 8
CALL_ROWS = 256


class Call:
    """One lookup of some rows: the attempt that runs, and how many are left."""

    def __init__(self, rows: pd.DataFrame, fetch: Callable[[pd.DataFrame], pd.DataFrame], tries: int, timeout: float | None):
        self.rows, self.fetch, self.left, self.timeout = rows, fetch, tries, timeout
        self.start()

    def start(self) -> None:
        self.left -= 1
        self.future: Future = Future()
        self.deadline = None if self.timeout is None else time.monotonic() + self.timeout
        # a thread of its own: one that hangs holds up no other call, nor the end of the process
        threading.Thread(target=self.work, args=(self.future,), daemon=True).start()

    def work(self, future: Future) -> None:
        try:
            future.set_result(self.fetch(self.rows))
        except BaseException as error:  # noqa: BLE001 - handed to the task
            future.set_exception(error)

    def late(self) -> bool:
        return self.deadline is not None and time.monotonic() >= self.deadline

    def settled(self, missing: Callable[[pd.DataFrame], pd.DataFrame] | None) -> tuple[bool, pd.DataFrame | None]:
        """(whether the call is over, its rows): a failed or late attempt is made again while tries are left."""
        if self.future.done():
            error = self.future.exception()
            if error is None:
                return True, self.future.result()
        elif self.late():
            error = TimeoutError(f"no answer in {self.timeout} s")
        else:
            return False, None
        if self.left > 0:
            self.start()
            return False, None
        if missing is None:
            raise error
        return True, missing(self.rows)


def lookup_async(
    df: DataFrame,
    fetch: Callable[..., pd.DataFrame],
    schema: str,
    open: Callable[[], Any] | None = None,
    close: Callable[[Any], None] | None = None,
    in_flight: int = IN_FLIGHT,
    call_rows: int = CALL_ROWS,
    ordered: bool = True,
    timeout: float | None = None,
    retries: int = 0,
    missing: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
) -> DataFrame:
    """Rows enriched by an outside service without waiting for each answer.

    ``fetch(rows)``, or ``fetch(rows, resource)`` with ``open``, turns up to ``call_rows`` rows into
    rows of ``schema``; it runs in threads, at most ``in_flight`` calls at a time per task, so that
    many answers and no more are held.  ``ordered`` keeps the order of the input; else answers go
    on as they come.  An attempt that fails or takes over ``timeout`` seconds is made ``retries``
    times again (a hanging attempt is left to itself); after that ``missing(rows)`` gives the rows,
    or the task fails.  Works on bounded tables and streams alike.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open() if open is not None else None
        ask = fetch if open is None else (lambda rows: fetch(rows, resource))
        pending: deque[Call] = deque()

        def next_answer() -> pd.DataFrame:
            while True:
                for call in [pending[0]] if ordered else list(pending):
                    over, rows = call.settled(missing)
                    if over:
                        pending.remove(call)
                        return rows
                watched = [pending[0]] if ordered else list(pending)
                ends = [c.deadline for c in watched if c.deadline is not None]
                wait([c.future for c in watched], max(min(ends) - time.monotonic(), 0) if ends else None, FIRST_COMPLETED)

        try:
            for batch in batches:
                for start in range(0, len(batch), call_rows):
                    while len(pending) >= in_flight:
                        yield next_answer()
                    pending.append(Call(batch.iloc[start : start + call_rows].reset_index(drop=True), ask, retries + 1, timeout))
            while pending:
                yield next_answer()
        finally:
            if close is not None:
                close(resource)

    return df.mapInPandas(task, schema)
