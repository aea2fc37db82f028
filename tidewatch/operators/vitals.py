"""Early-warning scoring over the latest reading of every vital sign."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import news2
from tidewatch.operators.paging import suppress_repeats
from tidewatch.operators.timeline import Timeline, latest, previous
from tidewatch.operators.windows import span_us

FRESH_FOR = "5 minutes"
NOTICE_EVERY = "1 minute"


def latest_vitals(
    readings: DataFrame, patient: str, ts: str, code: str, value: str, ties: Sequence[str] = (), hot_rows: int | None = None
) -> Timeline:
    """After every reading: value and time of the latest reading of each vital sign."""
    line = Timeline.of(readings, [patient], ts, ties, hot_rows)
    reading = F.struct(F.col(value).cast("double").alias("value"), F.unix_micros(F.col(ts)).alias("us"))
    return line.scan(**{f"__{name}": latest(F.when(F.col(code) == name, reading)) for name in news2.VITALS})


def _fresh(name: str, ts: str, fresh_for: str) -> Column:
    age = F.unix_micros(F.col(ts)) - F.col(f"__{name}.us")
    return F.coalesce(age <= span_us(fresh_for), F.lit(False))


def news2_changes(
    readings: DataFrame,
    patient: str,
    ts: str,
    code: str,
    value: str,
    ties: Sequence[str] = (),
    fresh_for: str = FRESH_FOR,
    hot_rows: int | None = None,
) -> DataFrame:
    """A row each time a patient's total or band changes; only readings with all seven signs fresh are scored."""
    line = latest_vitals(readings, patient, ts, code, value, ties, hot_rows)
    scores = {name: news2.points(name, F.col(f"__{name}.value")) for name in news2.VITALS}
    ready = F.lit(True)
    for name in news2.VITALS:
        ready = ready & _fresh(name, ts, fresh_for)
    line = line.with_columns(**{f"{name.lower()}_points": scores[name] for name in news2.VITALS})
    named = {name: F.col(f"{name.lower()}_points") for name in news2.VITALS}
    line = line.with_columns(total=F.when(ready, news2.total_points(named)))
    line = line.with_columns(band=news2.band(F.col("total"), news2.any_three(named)))
    scored = F.when(F.col("total").isNotNull(), F.struct("total", "band"))
    done = line.scan(__before=latest(scored, before=True)).frame()
    moved = F.col("total").isNotNull() & (
        F.col("__before").isNull() | (F.col("__before.total") != F.col("total")) | (F.col("__before.band") != F.col("band"))
    )
    return done.where(moved).drop("__before", *[f"__{name}" for name in news2.VITALS])


def band_changes(changes: DataFrame, patient: str, ts: str, ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Of the rows of :func:`news2_changes`, those on which the band is not the one before."""
    line = Timeline.of(changes, [patient], ts, ties, hot_rows).scan(previous_band=previous("band"))
    return line.frame().where(~F.col("band").eqNullSafe(F.col("previous_band")))


def news2_unavailable(
    readings: DataFrame,
    patient: str,
    ts: str,
    code: str,
    value: str,
    ties: Sequence[str] = (),
    fresh_for: str = FRESH_FOR,
    notice_every: str = NOTICE_EVERY,
    hot_rows: int | None = None,
) -> DataFrame:
    """Which signs keep a patient from being scored, at most one notice per ``notice_every``."""
    line = latest_vitals(readings, patient, ts, code, value, ties, hot_rows)
    missing = F.array_compact(F.array(*[F.when(~_fresh(name, ts, fresh_for), F.lit(name)) for name in news2.VITALS]))
    gaps = line.with_columns(missing=F.concat_ws(",", missing)).where(F.col("missing") != "")
    notices = gaps.drop(*[f"__{name}" for name in news2.VITALS])
    kept = suppress_repeats(notices, [patient], ts, notice_every, ties)
    return kept.select(patient, ts, *ties, "missing")
