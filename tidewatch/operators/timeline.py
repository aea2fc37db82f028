"""Ordered running computations per key that stay parallel when one key is huge.

A plain window ``partitionBy(key).orderBy(ts)`` puts a whole key into one task.  A
``Timeline`` first measures the keys (one map-side-combined count).  Keys up to
``hot_rows`` rows keep the plain window.  Longer keys are cut along the order column
into segments; each segment is scanned on its own, one summary row per segment is
carried forward in order, and the carry is joined back.  The result is the same for
every segmentation, and nothing is dropped.

Size of what is broadcast: one row per hot key and one per segment, both bounded by
``rows / hot_rows`` times a constant; the count is known here and checked before the hint.
More hot keys or segments than the hint allows are joined by a shuffle; all of them are cut.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.session import hot_rows as configured_hot_rows

SEG = "__segment"
OVERSPLIT = 4
#: cuts up to this many are collected and hinted; more are joined where they lie
MAX_COLLECTED_CUTS = 50_000
MAX_BROADCAST_SEGMENTS = 1_000_000


@dataclass(frozen=True)
class Running:
    """One running value: how rows combine, and whether the current row counts."""

    kind: str
    value: Column
    before: bool = False
    nullable_row: bool = False


@dataclass(frozen=True)
class Sample:
    """Rows that stand for ``weight`` times as many when keys are counted for cutting."""

    rows: DataFrame
    weight: float = 1.0


def planning_sample(table: DataFrame, rows: int = 100_000_000) -> Sample:
    """About ``rows`` rows of a plain table, to count keys on where counting them all needs a join.

    Only where hot keys are cut depends on it; every cut gives the same result.  The table's
    own count comes from its file footers.
    """
    n = table.count()
    return Sample(table) if n <= rows else Sample(table.sample(rows / n, seed=7), n / rows)


def total(value: Column | str, before: bool = False) -> Running:
    return Running("sum", _col(value), before)


def tally(condition: Column, before: bool = False) -> Running:
    """Running number of rows for which the condition holds."""
    return Running("sum", F.when(condition, F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")), before)


def latest(value: Column | str, before: bool = False) -> Running:
    """Most recent non-null value."""
    return Running("last", _col(value), before)


def previous(value: Column | str) -> Running:
    """Value of the row just before, null included."""
    return Running("last", F.struct(_col(value).alias("v")), True, nullable_row=True)


def lowest(value: Column | str, before: bool = False) -> Running:
    return Running("min", _col(value), before)


def highest(value: Column | str, before: bool = False) -> Running:
    return Running("max", _col(value), before)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def order_number(df: DataFrame, order: str) -> Column:
    """The order column as a long: microseconds for times, the number itself otherwise."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(order))
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(order).cast("timestamp"))
    return F.col(order).cast("long")


def null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


class Timeline:
    """Rows of a bounded table in key and time order."""

    def __init__(self, rows: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str], segments: int):
        self.rows = rows
        self.keys = list(keys)
        self.order = order
        self.ties = list(ties)
        self.segments = segments

    @classmethod
    def of(
        cls,
        df: DataFrame,
        keys: Sequence[str],
        order: str,
        ties: Sequence[str] = (),
        hot_rows: int | None = None,
        measure: Sample | None = None,
    ) -> Timeline:
        """Order ``df`` by ``order`` (then ``ties``) within ``keys``, cutting long keys.

        ``measure`` may be cheaper rows with the same key and order columns to count instead of
        ``df``.  Where the cuts fall does not change any result.
        """
        limit = hot_rows or configured_hot_rows(df.sparkSession)
        rows, segments = _cut(df, list(keys), order, limit, measure or Sample(df))
        return cls(rows, keys, order, ties, segments)

    def frame(self) -> DataFrame:
        return self.rows.drop(SEG)

    def where(self, condition: Column) -> Timeline:
        """Fewer rows on the same segments."""
        return self._with(self.rows.where(condition))

    def drop(self, *columns: str) -> Timeline:
        return self._with(self.rows.drop(*columns))

    def with_columns(self, **columns: Column) -> Timeline:
        return self._with(self.rows.withColumns(columns))

    def scan(self, **ops: Running) -> Timeline:
        """Add one running column per op."""
        inputs = {f"__in_{name}": op.value for name, op in ops.items()}
        base = self.rows.withColumns(inputs)
        local = base.withColumns(
            {name: _aggregate(op, F.col(f"__in_{name}")).over(self._window(op.before)) for name, op in ops.items()}
        )
        if self.segments:
            position = F.struct(self.order, *self.ties)
            summary = (
                base.where(F.col(SEG).isNotNull())
                .groupBy(*self.keys, SEG)
                .agg(*[_summary(op, F.col(f"__in_{name}"), position).alias(name) for name, op in ops.items()])
            )
            earlier = Window.partitionBy(*self.keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
            carry = summary.select(
                *self.keys, SEG, *[_aggregate(op, F.col(name)).over(earlier).alias(f"__carry_{name}") for name, op in ops.items()]
            )
            local = self._join_carry(local, carry).withColumns(
                {name: _merge(op, F.col(f"__carry_{name}"), F.col(name)) for name, op in ops.items()}
            )
            local = local.drop(*[f"__carry_{name}" for name in ops])
        opened = {name: F.col(name)["v"] for name, op in ops.items() if op.nullable_row}
        if opened:
            local = local.withColumns(opened)
        return self._with(local.drop(*inputs))

    def clamped_total(self, delta: str, name: str, underflow: str) -> Timeline:
        """Running sum that never goes below 0, and a flag on each row that was floored.

        With S the plain running sum, the floored sum is ``S - min(0, lowest S so far)``.
        """
        base = self.rows.withColumn("__sum", F.sum(delta).over(self._window(False)))
        local = base.withColumns(
            {
                "__low": F.min("__sum").over(self._window(False)),
                "__low_before": F.min("__sum").over(self._window(True)),
            }
        )
        if self.segments:
            summary = (
                base.where(F.col(SEG).isNotNull())
                .groupBy(*self.keys, SEG)
                .agg(F.sum(delta).alias("__seg_sum"), F.min("__sum").alias("__seg_low"))
            )
            earlier = Window.partitionBy(*self.keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
            carry = (
                summary.withColumn("__carry_sum", F.coalesce(F.sum("__seg_sum").over(earlier), F.lit(0)))
                .withColumn("__carry_low", F.min(F.col("__carry_sum") + F.col("__seg_low")).over(earlier))
                .select(*self.keys, SEG, "__carry_sum", "__carry_low")
            )
            shift = F.coalesce(F.col("__carry_sum"), F.lit(0))
            local = self._join_carry(local, carry).withColumns(
                {
                    "__sum": F.col("__sum") + shift,
                    "__low": F.least(F.col("__carry_low"), F.col("__low") + shift),
                    "__low_before": F.least(F.col("__carry_low"), F.col("__low_before") + shift),
                }
            )
            local = local.drop("__carry_sum", "__carry_low")
        done = local.withColumns(
            {
                name: F.col("__sum") - F.least(F.lit(0), F.col("__low")),
                underflow: F.col("__sum") < F.least(F.lit(0), F.col("__low_before")),
            }
        )
        return self._with(done.drop("__sum", "__low", "__low_before"))

    def _with(self, rows: DataFrame) -> Timeline:
        return Timeline(rows, self.keys, self.order, self.ties, self.segments)

    def _window(self, before: bool):
        parts = [*self.keys, SEG] if self.segments else self.keys
        ordered = Window.partitionBy(*parts).orderBy(self.order, *self.ties)
        return ordered.rowsBetween(Window.unboundedPreceding, -1 if before else Window.currentRow)

    def _join_carry(self, rows: DataFrame, carry: DataFrame) -> DataFrame:
        names = [*self.keys, SEG]
        side = carry.withColumnsRenamed({n: f"__c_{n}" for n in names})
        on = reduce(
            lambda a, b: a & b,
            [F.col(SEG) == F.col(f"__c_{SEG}")] + [F.col(k).eqNullSafe(F.col(f"__c_{k}")) for k in self.keys],
        )
        if self.segments <= MAX_BROADCAST_SEGMENTS:
            side = F.broadcast(side)
        return rows.join(side, on, "left").drop(*[f"__c_{n}" for n in names])


def _aggregate(op: Running, value: Column) -> Column:
    if op.kind == "last":
        return F.last(value, ignorenulls=True)
    return {"sum": F.sum, "min": F.min, "max": F.max}[op.kind](value)


def _summary(op: Running, value: Column, position: Column) -> Column:
    if op.kind == "last":
        return F.max_by(value, F.when(value.isNotNull(), position))
    return _aggregate(op, value)


def _merge(op: Running, carry: Column, local: Column) -> Column:
    if op.kind == "last":
        return F.coalesce(local, carry)
    if op.kind == "sum":
        return F.coalesce(carry + local, local, carry)
    return F.least(carry, local) if op.kind == "min" else F.greatest(carry, local)


def _cut(df: DataFrame, keys: list[str], order: str, limit: int, sample: Sample) -> tuple[DataFrame, int]:
    """Add the segment number of rows that belong to a hot key (null for all other rows).

    Each level cuts the groups that are still too long into equal spans of the order
    column, so a burst inside one span is cut again at the next level, until no group is too
    long, or its rows share one time, or segment numbers would leave 62 bits.
    """
    place = order_number(df, order)
    rows, segments, numbers, measure = df, 0, 1, sample.rows
    size = F.col("__n") * F.lit(sample.weight)
    for level in count():
        groups = keys if level == 0 else [*keys, SEG]
        profiled = measure if level == 0 else measure.where(F.col(SEG).isNotNull())
        measured = profiled.select(*groups, place.alias("__place")).groupBy(*groups)
        hot = (
            measured.agg(F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__lo"), F.max("__place").alias("__hi"))
            .where((size > limit) & (F.col("__hi") > F.col("__lo")))
            .withColumn("__pieces", F.least(F.ceil(size / limit) * OVERSPLIT, F.col("__hi") - F.col("__lo") + 1).cast("long"))
            .select(
                *[F.col(g).alias(f"__h_{g}") for g in groups],
                F.col("__lo").alias("__h_lo"),
                F.expr("(__hi - __lo + __pieces) div __pieces").alias("__h_width"),
                (F.col("__pieces") - 1).alias("__h_last"),
            )
        )
        found = hot.limit(MAX_COLLECTED_CUTS + 1).collect()
        if not found:
            break
        few = len(found) <= MAX_COLLECTED_CUTS
        if few:
            added, widest = sum(r["__h_last"] + 1 for r in found), max(r["__h_last"] + 1 for r in found)
        else:
            added, widest = hot.agg(F.sum(F.col("__h_last") + 1), F.max(F.col("__h_last") + 1)).first()
        numbers *= widest + 1
        if numbers >= 2**62:
            break
        segments += added
        cuts = F.broadcast(df.sparkSession.createDataFrame(found, hot.schema)) if few else hot
        scale = None if level == 0 else widest + 1
        same = measure is rows
        rows = _number(rows, groups, place, cuts, found, scale)
        measure = rows if same else _number(measure, groups, place, cuts, found, scale)
    return rows, segments


def _number(rows: DataFrame, groups: list[str], place: Column, cuts: DataFrame, found: list[Row], scale: int | None) -> DataFrame:
    placed = rows.withColumn("__place", place)
    if groups:
        on = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__h_{g}")) for g in groups])
        placed = placed.join(cuts, on, "left")
    else:
        placed = placed.withColumns({name: F.lit(found[0][name]) for name in ("__h_lo", "__h_width", "__h_last")})
    # a row outside the measured span goes to the first or last piece, so order is kept
    piece = F.expr("greatest(0, least(__h_last, (__place - __h_lo) div __h_width))")
    piece = F.when(F.col("__h_lo").isNotNull(), piece)
    segment = piece if scale is None else F.col(SEG) * scale + F.coalesce(piece, F.lit(0))
    return placed.withColumn(SEG, segment).drop("__place", "__h_lo", "__h_width", "__h_last", *[f"__h_{g}" for g in groups])
