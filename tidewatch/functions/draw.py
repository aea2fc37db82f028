"""Deterministic uniform draws: the same key always gets the same number."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stay of a patient in milliseconds, by region; "*" is any other region.
MINUTE_MS = 60_000
STAY_PROFILES = {"S": (20 * MINUTE_MS, 60 * MINUTE_MS), "*": (5 * MINUTE_MS, 15 * MINUTE_MS)}


def key_number(key: Column | str) -> Column:
    """A non-negative 60-bit number from the MD5 of the key."""
    text = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(text.cast("string").cast("binary")), 1, 15), 16, 10).cast("bigint")


def keyed_draw(key: Column | str, low: Column | int, high: Column | int) -> Column:
    """A whole number in [low, high], both ends included."""
    low = F.lit(low).cast("bigint") if isinstance(low, int) else low
    high = F.lit(high).cast("bigint") if isinstance(high, int) else high
    return low + F.pmod(key_number(key), high - low + 1)


def length_of_stay_ms(key: Column | str, group: Column | str, profiles: Mapping[str, tuple[int, int]] = STAY_PROFILES) -> Column:
    """Draw within the range of the row's group; an unknown or null group uses ``"*"``."""
    if "*" not in profiles:
        raise ValueError('profiles need a fallback entry "*"')
    for name, (low, high) in profiles.items():
        if not 0 < low <= high:
            raise ValueError(f"profile {name}: need 0 < min <= max, got {low}..{high}")
    group = F.col(group) if isinstance(group, str) else group
    low, high = F.lit(profiles["*"][0]), F.lit(profiles["*"][1])
    for name, (lo, hi) in profiles.items():
        if name != "*":
            low = F.when(group == name, F.lit(lo)).otherwise(low)
            high = F.when(group == name, F.lit(hi)).otherwise(high)
    return keyed_draw(key, low.cast("bigint"), high.cast("bigint"))


def milliseconds_after(ts: Column | str, ms: Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.unix_micros(ts) + ms * 1000)
