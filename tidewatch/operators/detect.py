"""Silence, resumption and sustained-breach detection over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.timeline import Sample, Timeline, latest, previous
from tidewatch.operators.windows import shift, span_us


def silence_resume(df: DataFrame, keys: Sequence[str], ts: str, gap: str, until_us: int, ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """SILENT one gap after a key's last row, RESUMED at the next row; one pair per silence.

    A key that stays silent gives SILENT only once the watermark ``until_us`` is a gap past
    its last row.
    """
    line = Timeline.of(df.select(*keys, ts, *ties), keys, ts, ties, hot_rows, measure=Sample(df)).scan(__prev=previous(ts))
    apart = F.unix_micros(F.col(ts)) - F.unix_micros(F.col("__prev"))
    # a row exactly at the deadline still counts as in time; the end of the stream at the deadline does not
    silent = F.struct(F.lit("SILENT").alias("alert"), shift("__prev", span_us(gap)).alias("alert_time"))
    resumed = F.struct(F.lit("RESUMED").alias("alert"), F.col(ts).alias("alert_time"))
    broken = line.frame().where(apart > span_us(gap)).select(*keys, F.inline(F.array(silent, resumed)))
    last = df.groupBy(*keys).agg(shift(F.max(ts), span_us(gap)).alias("alert_time")).where(F.unix_micros("alert_time") <= F.lit(until_us))
    return broken.unionByName(last.select(*keys, F.lit("SILENT").alias("alert"), "alert_time"))


def sustained_breach(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    breach: Column,
    sustain_us: Column | int,
    until_us: int,
    ties: Sequence[str] = (),
    deadline_before: Column | None = None,
    carry: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """One alert per episode in which ``breach`` holds without interruption for the sustain time.

    The alert time is episode start + sustain, even if no row arrives then.  It needs the
    watermark ``until_us`` to have passed, and, if ``deadline_before`` (microseconds) is
    given, the alert time to be before that.  ``carry`` columns keep the value of the row that
    opens the episode.
    """
    wait = F.lit(sustain_us) if isinstance(sustain_us, int) else sustain_us
    limit = deadline_before if deadline_before is not None else F.lit(None).cast("bigint")
    rows = df.select(
        *keys, ts, *ties, *carry, F.coalesce(breach, F.lit(False)).alias("__breach"), wait.alias("__wait"), limit.alias("__limit")
    )
    line = Timeline.of(rows, keys, ts, ties, hot_rows).scan(__was=previous("__breach"))
    was = F.coalesce(F.col("__was"), F.lit(False))
    start = F.struct(F.unix_micros(F.col(ts)).alias("us"), F.col("__wait").alias("wait"), F.col("__limit").alias("limit"), *carry)
    seen = line.scan(__episode=latest(F.when(F.col("__breach") & ~was, start))).frame()
    due = F.col("__episode.us") + F.col("__episode.wait")
    ended = seen.where(was & ~F.col("__breach") & (due <= F.unix_micros(F.col(ts)))).select(*keys, "__episode")
    # an episode that is open at a key's last row goes on until the watermark
    last = seen.groupBy(*keys).agg(F.max_by(F.struct("__breach", "__episode"), F.struct(ts, *ties)).alias("__last"))
    lasting = last.where("__last.__breach").select(*keys, F.col("__last.__episode").alias("__episode"))
    alive = F.col("__episode.limit").isNull() | (due < F.col("__episode.limit"))
    return (
        ended.unionByName(lasting)
        .where(alive & (due <= F.lit(until_us)))
        .select(*keys, F.timestamp_micros("__episode.us").alias("breach_start"), F.timestamp_micros(due).alias("alert_time"), *[F.col(f"__episode.{c}").alias(c) for c in carry])
    )
