"""Running keyed aggregates: a result after every record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators.timeline import Sample, Timeline, highest, latest, tally, total
from tidewatch.operators.windows import session_marks


def running(df: DataFrame, keys: Sequence[str], order: str, value: str, ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Add ``running_total``, ``running_count`` and ``running_avg`` of the key so far."""
    line = Timeline.of(df, keys, order, ties, hot_rows)
    summed = line.scan(running_total=total(value), running_count=tally(F.col(value).isNotNull())).frame()
    return summed.withColumn("running_avg", F.try_divide(F.col("running_total"), F.col("running_count")))


def running_count(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str] = (), name: str = "running_count", hot_rows: int | None = None, measure: Sample | None = None) -> DataFrame:
    return Timeline.of(df, keys, order, ties, hot_rows, measure).scan(**{name: tally(F.lit(True))}).frame()


def running_stats(df: DataFrame, keys: Sequence[str], order: str, value: str, ties: Sequence[str] = (), hot_rows: int | None = None, measure: Sample | None = None) -> DataFrame:
    """Count, mean and maximum of the key so far."""
    line = Timeline.of(df, keys, order, ties, hot_rows, measure)
    done = line.scan(n=tally(F.lit(True)), __sum=total(value), max_value=highest(value)).frame()
    return done.withColumn("mean_value", F.col("__sum") / F.col("n")).drop("__sum")


def expiring_sum(df: DataFrame, keys: Sequence[str], ts: str, value: str, ttl: str, ties: Sequence[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Running sum and count that start over once the key was silent for ``ttl``.

    Every write renews the lifetime, so a lifetime is a session with gap ``ttl``.
    """
    line = session_marks(Timeline.of(df, keys, ts, ties, hot_rows), ttl, at_gap=True)
    line = line.scan(__total=total(value), __count=tally(F.lit(True)))
    # the first row of a lifetime stores what had been summed before it
    fresh = F.col("session_opens")
    earlier = F.when(fresh, F.col("__total") - F.col(value))
    earlier_count = F.when(fresh, F.col("__count") - 1)
    line = line.scan(__base=latest(earlier), __base_count=latest(earlier_count))
    done = line.frame().withColumns(
        {"live_sum": F.col("__total") - F.col("__base"), "live_count": F.col("__count") - F.col("__base_count")}
    )
    return done.drop("__total", "__count", "__base", "__base_count", "session_start", "session_opens")


def baseline_outliers(df: DataFrame, keys: Sequence[str], ts: str, value: str, ties: Sequence[str] = (), sigmas: float = 3.0, hot_rows: int | None = None) -> DataFrame:
    """Flag a reading more than ``sigmas`` standard deviations from the key's own earlier readings.

    Sums are taken of d = x - the key's first reading, so a large common level cancels before
    anything is squared: with n, S, Q the count, sum and square sum of the earlier d,
    ``|x - mean| > k * sd`` is ``(n*d - S)^2 > k^2 * (n*Q - S^2)``.  Readings without any spread
    flag nothing.
    """
    number = F.col(value).cast("double")
    line = Timeline.of(df, keys, ts, ties, hot_rows)
    line = line.scan(__place=tally(F.lit(True))).scan(__first=latest(F.when(F.col("__place") == 1, F.coalesce(number, F.lit(0.0)))))
    off_first = number - F.col("__first")
    line = line.scan(
        __n=tally(F.lit(True), before=True),
        __sum=total(number, before=True),
        __s=total(off_first, before=True),
        __q=total(off_first * off_first, before=True),
    )
    n, s, q = F.col("__n"), F.col("__s"), F.col("__q")
    spread = n * q - s * s
    off = n * off_first - s
    done = line.frame().withColumns(
        {
            "baseline_n": F.coalesce(n, F.lit(0)),
            "baseline_mean": F.col("__sum") / n,
            "is_outlier": F.coalesce((n >= 2) & (spread > 0) & (off * off > F.lit(sigmas * sigmas) * spread), F.lit(False)),
        }
    )
    return done.drop("__place", "__first", "__n", "__sum", "__s", "__q")
