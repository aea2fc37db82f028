"""Stateless row operators: filter, map, flatMap, parse, route.  All narrow, all columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAULTY = -999
WARM_FROM = 28
HOT_ABOVE = 32


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A plain column is copied into every filter pushed below it; a generated one is not.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def drop_faulty(df: DataFrame, column: str, sentinel: float = FAULTY) -> DataFrame:
    return df.where(F.col(column) != F.lit(sentinel))


def round_half_up(value: Column, places: int = 1) -> Column:
    """Round with ties toward positive infinity."""
    scale = 10**places
    return F.floor(value * scale + F.lit(0.5)) / F.lit(float(scale))


def to_fahrenheit(celsius: Column) -> Column:
    return round_half_up(celsius * 9 / 5 + 32)


def fan_rows(df: DataFrame, *outputs: Column, name: str = "output") -> DataFrame:
    """flatMap: one output row per non-null entry of ``outputs``, none if all are null."""
    return df.withColumn(name, F.explode(F.filter(F.array(*outputs), lambda x: x.isNotNull())))


def temperature_warnings(df: DataFrame, sensor: str, temperature: str, warm: float = WARM_FROM, hot: float = HOT_ABOVE) -> DataFrame:
    """No line below ``warm``, one from ``warm``, a second one above ``hot``."""
    reading = F.concat(F.lit(" ("), F.col(temperature).cast("string"), F.lit("C)"))
    who = F.col(sensor).cast("string")
    return fan_rows(
        df,
        F.when(F.col(temperature) >= warm, F.concat(who, F.lit(" is warm"), reading)),
        F.when(F.col(temperature) > hot, F.concat(who, F.lit(" is DANGEROUSLY HOT"), reading)),
        name="warning",
    )


def split_words(df: DataFrame, text: str, word: str = "word", position: str = "position") -> DataFrame:
    """One row per piece of the text between single spaces; empty pieces at the end do not count."""
    kept = F.rtrim(F.col(text))
    others = [c for c in df.columns if c != text]
    rows = df.where((kept != "") | (F.col(text) == ""))
    return rows.select(*others, F.posexplode(F.split(kept, " ", -1)).alias(position, word))


def unnest(df: DataFrame, records: str) -> DataFrame:
    """One row per entry of an array of records; the record's fields become columns."""
    others = [c for c in df.columns if c != records]
    return df.select(*others, F.inline(records))


def parse_delimited(df: DataFrame, line: str, fields: Sequence[tuple[str, str]], separator: str = ",") -> DataFrame:
    """Typed columns from a delimited line; a wrong field count or an unreadable field drops the row."""
    pattern = "\\" + separator if separator in "|.$*+?()[]{}^\\" else separator
    parsed = once(df, "__parts", F.split(F.col(line), pattern, -1)).where(F.size("__parts") == len(fields))
    parsed = parsed.withColumns({name: F.col("__parts")[i].try_cast(kind) for i, (name, kind) in enumerate(fields)})
    complete = F.lit(True)
    for name, _ in fields:
        complete = complete & F.col(name).isNotNull()
    return parsed.where(complete).drop("__parts", line)


def route_by_type(df: DataFrame, line: str) -> DataFrame:
    """LOGIN,customer / PURCHASE,customer,product,amount / LOGOUT,customer lines as one event model.

    Lines of any other type, or without the fields of their type, give no row.
    """
    df = once(df, "__parts", F.split(F.col(line), ",", -1))
    parts = F.col("__parts")
    kind = parts[0]
    purchase = kind == "PURCHASE"
    well_formed = (kind.isin("LOGIN", "LOGOUT") & (F.size(parts) >= 2)) | (purchase & (F.size(parts) >= 4))
    amount = F.when(purchase, F.try_element_at(parts, F.lit(4)).try_cast("double"))
    return (
        df.where(well_formed)
        .withColumns(
            {
                "kind": kind,
                "customer": F.try_element_at(parts, F.lit(2)),
                "product": F.when(purchase, F.try_element_at(parts, F.lit(3))),
                "amount": amount,
            }
        )
        .where((F.col("kind") != "PURCHASE") | F.col("amount").isNotNull())
        .drop("__parts", line)
    )


def wide_to_long(df: DataFrame, ids: Sequence[str], measures: Sequence[str], name: str = "measure", value: str = "reading") -> DataFrame:
    return df.unpivot(list(ids), list(measures), name, value)


def extract_entities(df: DataFrame, text: str, patterns: Mapping[str, str]) -> DataFrame:
    """One row per match of any of the named patterns in the whole text."""

    def matches(kind: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
        return F.transform(hits, lambda hit: F.struct(F.lit(kind).alias("entity_type"), hit.alias("entity")))

    others = [c for c in df.columns if c != text]
    return df.select(*others, F.inline(F.concat(*[matches(kind, pattern) for kind, pattern in patterns.items()])))


def route(df: DataFrame, tag: str, column: str = "route") -> DataFrame:
    """One named side of a routed output."""
    return df.where(F.col(column) == tag).drop(column)
