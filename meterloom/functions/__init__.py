"""Column expressions that several operators use."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of reading times, tried in order: fixed values.
TIME_PATTERNS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy HH:mm")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0; also where it is unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def parsed_time(text: Column, patterns=TIME_PATTERNS, ntz: bool = False) -> Column:
    """The first pattern that fits; null where none does. Never raises, whatever the ANSI setting."""
    tried = [F.try_to_timestamp(text, F.lit(p)) for p in patterns]
    out = F.coalesce(*tried) if len(tried) > 1 else tried[0]
    return out.cast("timestamp_ntz") if ntz else out


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)


def usable_energy(x: Column) -> Column:
    """Present, finite and not negative."""
    return finite(x) & (x >= 0)


def share(part: Column, whole: Column, scale: float = 1.0) -> Column:
    """part / whole * scale; null where whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * scale


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * (2.0 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def is_weekend(day_of_week: Column) -> Column:
    """Of 1 (Sunday) to 7 (Saturday)."""
    return flag(day_of_week.isin(1, 7))
