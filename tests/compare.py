"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return repr(value + 0.0) if not value.is_integer() else str(int(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return None if value is None else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    done = sorted(tuple(cell(row[i]) or "" for i in order) for row in rows)
    return [names[i] for i in order], done


def compare(spark_df, con, sql: str) -> tuple[int, str | None]:
    """Number of rows, and what differs (None if nothing)."""
    pdf = spark_df.toArrow()
    table = con.execute(sql).to_arrow_table()
    a_names, a = rows_of(pdf.column_names, list(zip(*[c.to_pylist() for c in pdf.columns])))
    b_names, b = rows_of(table.column_names, list(zip(*[c.to_pylist() for c in table.columns])))
    if a_names != b_names:
        return len(a), f"columns {a_names} vs {b_names}"
    if len(a) != len(b):
        left, right = set(a), set(b)
        return len(a), f"{len(a)} vs {len(b)} rows; only ours {sorted(left - right)[:2]}; only SQL {sorted(right - left)[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return len(a), f"first difference {x} vs {y}"
    kinds = {n: (str(pdf.schema.field(n).type), str(table.schema.field(n).type)) for n in a_names}
    odd = {n: k for n, k in kinds.items() if k[0] != k[1]}
    return len(a), None if not odd else f"TYPES {odd}"
