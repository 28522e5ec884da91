"""Times as text. Seconds are doubles from the start of a recording; milliseconds round half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def millis(seconds: Column) -> Column:
    return F.bround(seconds * 1000, 0).cast("long")


def dash(seconds: Column) -> Column:
    """HH-MM-SS.mmm"""
    s = F.floor(seconds).cast("long")
    whole = F.format_string("%02d-%02d-", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"))
    return F.concat(whole, F.format_string("%06.3f", seconds - F.floor(seconds / 60) * 60))


def clock(seconds: Column, hours: bool = False, marker: str = ".") -> Column:
    """HH:MM:SS.mmm; hours only where they are over 0, unless always asked for."""
    ms = millis(seconds)
    h, m = F.floor(ms / 3_600_000).cast("long"), F.floor(ms % 3_600_000 / 60_000).cast("long")
    s, rest = F.floor(ms % 60_000 / 1000).cast("long"), (ms % 1000).cast("long")
    tail = F.format_string(f"%02d:%02d{marker}%03d", m, s, rest)
    lead = F.format_string("%02d:", h)
    return F.concat(lead, tail) if hours else F.when(h > 0, F.concat(lead, tail)).otherwise(tail)
