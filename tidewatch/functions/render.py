"""Result records as text lines.  The patterns are fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = "HH:mm:ss"


def clock(ts: Column | str) -> Column:
    return F.date_format(ts, CLOCK)


def regional_line(start: str, end: str, region: str, count: str) -> Column:
    return F.format_string("[%s - %s] Region %-2s -> %3d admissions", clock(start), clock(end), F.col(region), F.col(count))


def capacity_line(at: str, hospital: str, region: str, occupied: str, capacity: str, pct: str) -> Column:
    return F.format_string(
        "[%s] ALERT: Hospital %s (Region %s) at %d/%d beds (%.1f%% capacity)",
        clock(at), F.col(hospital), F.col(region), F.col(occupied), F.col(capacity), F.col(pct),
    )


def occupancy_line(at: str, before: str, after: str, hospital: str, region: str, occupied: str, capacity: str, pct: str) -> Column:
    return F.format_string(
        "[%s] %s -> %s: Hospital %s (Region %s) at %d/%d beds (%.1f%% occupancy)",
        clock(at), F.col(before), F.col(after), F.col(hospital), F.col(region), F.col(occupied), F.col(capacity), F.col(pct),
    )


def network_report(start: str, end: str, total: str, regions: list[str], count_of: str = "{}") -> Column:
    """Multi-line report: the total, then every region with its share in percent."""
    def share(region: str) -> Column:
        count = F.col(count_of.format(region))
        pct = F.when(F.col(total) > 0, count * 100.0 / F.col(total)).otherwise(0.0)
        return F.format_string("    - Region %-2s: %3d admissions (%5.1f%%)", F.lit(region), count, pct)

    rule = "=" * 50
    return F.concat_ws(
        "\n",
        F.lit(""),
        F.lit(rule),
        F.format_string("  Admission Interval [%s - %s]", clock(start), clock(end)),
        F.format_string(f"  Total Admissions Across All {len(regions)} Regions: %d", F.col(total)),
        F.lit("  " + "-" * 48),
        *[share(region) for region in regions],
        F.lit(rule),
    )


def gps_line(bus: str, route: str, latitude: str, longitude: str, speed: str, passengers: str) -> Column:
    return F.format_string(
        "Bus %s | Route %s | Location (%.4f, %.4f) | Speed %.1f mph | Passengers %d",
        F.col(bus), F.col(route), F.col(latitude), F.col(longitude), F.col(speed), F.col(passengers),
    )


def reading_line(sensor: str, temperature: str, at: str) -> Column:
    return F.concat(F.col(sensor), F.lit(" "), F.col(temperature).cast("string"), F.lit("C @"), clock(at))
