"""National Early Warning Score 2: points per vital sign and risk bands (SpO2 scale 1)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (upper bound, points) in ascending order, then the points above the last bound.
POINTS = {
    "RR": ([(8, 3), (11, 1), (20, 0), (24, 2)], 3),
    "SPO2": ([(91, 3), (93, 2), (95, 1)], 0),
    "O2": ([(0, 0)], 2),
    "SBP": ([(90, 3), (100, 2), (110, 1), (219, 0)], 3),
    "HR": ([(40, 3), (50, 1), (90, 0), (110, 1), (130, 2)], 3),
    "CONSC": ([(0, 0)], 3),
    "TEMP": ([(35.0, 3), (36.0, 1), (38.0, 0), (39.0, 1)], 2),
}
VITALS = list(POINTS)


def points(code: str, value: Column) -> Column:
    """Points of one vital sign; null for a missing reading."""
    bounds, above = POINTS[code]
    chain = F.when(value.isNull(), F.lit(None).cast("int"))
    for bound, score in bounds:
        chain = chain.when(value <= F.lit(float(bound)), F.lit(score))
    return chain.otherwise(F.lit(above))


def points_by_code(code: Column, value: Column) -> Column:
    """Points of a reading whose vital code is a column; null for an unknown code."""
    chain = None
    for name in VITALS:
        chain = F.when(code == name, points(name, value)) if chain is None else chain.when(code == name, points(name, value))
    return chain


def band(total: Column, any_three: Column) -> Column:
    """Risk band: the total decides first; 0-4 with a single 3 is LOW-MEDIUM."""
    return (
        F.when(total >= 7, "HIGH").when(total >= 5, "MEDIUM").when(any_three, "LOW-MEDIUM").when(total.isNotNull(), "LOW")
    )


def total_points(scores: Mapping[str, Column]) -> Column:
    """Sum over all seven vital signs; null if one is missing."""
    result = F.lit(0)
    for name in VITALS:
        result = result + scores[name]
    return result


def any_three(scores: Mapping[str, Column]) -> Column:
    return F.greatest(*[scores[name] for name in VITALS]) == 3
