"""Validation with reasons, quarantine, duplicates and guards."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import FEATURES, HOURS, READINGS, Series


@dataclass(frozen=True)
class Limits:
    """Bounds of sound readings. Without dates, times are only required to be there."""

    first: str | None = None
    last: str | None = None
    energy: tuple[float, float] = (0.0, 0.5)
    voltage: tuple[float, float] = (0.0, 700.0)
    current: tuple[float, float] = (0.0, 150.0)
    freq: tuple[float, float] = (0.0, 60.0)
    least_running_freq: float = 40.0


@dataclass(frozen=True)
class Rule:
    reason: str
    broken: Column


def outside(name: str, bounds: tuple[float, float]) -> Column:
    """NaN counts as above every bound."""
    return (F.col(name) < bounds[0]) | (F.col(name) > bounds[1])


def reading_rules(limits: Limits = Limits(), time: str = "ts") -> list[Rule]:
    ts, freq = F.col(time), F.col("freq")
    late = F.lit(False)
    if limits.first:
        late = late | (ts < F.lit(limits.first).cast("timestamp"))
    if limits.last:
        late = late | (ts > F.lit(limits.last).cast("timestamp"))
    stalled = (freq > 0) & (freq < limits.least_running_freq)
    # The reasons and their order.
    return [
        Rule("INVALID_OR_UNPARSEABLE_TIMESTAMP", ts.isNull()),
        Rule("TIMESTAMP_OUT_OF_BOUNDS", late),
        Rule("EMPTY_OR_NULL_METER_ID", F.coalesce(F.col("meter_id"), F.lit("")) == ""),
        Rule("NULL_ACTIVE_ENERGY", F.col("t_kwh").isNull()),
        Rule("ACTIVE_ENERGY_OUT_OF_BOUNDS", outside("t_kwh", limits.energy)),
        Rule("NULL_VOLTAGE", F.col("voltage").isNull()),
        Rule("VOLTAGE_OUT_OF_BOUNDS", outside("voltage", limits.voltage)),
        Rule("NULL_CURRENT", F.col("current").isNull()),
        Rule("CURRENT_OUT_OF_BOUNDS", outside("current", limits.current)),
        Rule("NULL_FREQUENCY", freq.isNull()),
        Rule("FREQUENCY_OUT_OF_BOUNDS", outside("freq", limits.freq) | stalled),
    ]


def reasons(rules: Iterable[Rule]) -> Column:
    """Array of the reasons of all broken rules, in order; empty for a sound row."""
    return F.array_compact(F.array(*[F.when(r.broken, F.lit(r.reason)) for r in rules]))


def assessed(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """df with rejection_reasons (array) and rejection_reason (joined by "; ", empty for a sound row)."""
    return df.withColumn("rejection_reasons", reasons(rules)).withColumn("rejection_reason", F.array_join("rejection_reasons", "; "))


def sound(df: DataFrame) -> DataFrame:
    return df.filter(F.size("rejection_reasons") == 0).drop("rejection_reasons", "rejection_reason")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.size("rejection_reasons") > 0)


def numbered(df: DataFrame, series: Series = READINGS, order: Iterable[str] = ()) -> DataFrame:
    """df with copy: 1 for the row of each key that stays. Ties are settled by `order`, else by all columns, so reruns agree."""
    by = list(order) or [c for c in df.columns if c not in (*series.keys, series.time)]
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*series.keys, series.time).orderBy(*by)))


def distinct_readings(df: DataFrame, series: Series = READINGS, order: Iterable[str] = ()) -> DataFrame:
    return numbered(df, series, order).filter("copy = 1").drop("copy")


def duplicate_readings(df: DataFrame, series: Series = READINGS, order: Iterable[str] = ()) -> DataFrame:
    """The rows that distinct_readings drops, with a reason, for the quarantine."""
    return numbered(df, series, order).filter("copy > 1").drop("copy").withColumns({"rejection_reasons": F.array(F.lit("DUPLICATE_KEY")), "rejection_reason": F.lit("DUPLICATE_KEY")})


# -- guards ------------------------------------------------------------------------------------------------------------


def require_unique(df: DataFrame, series: Series = HOURS) -> None:
    """ValueError if a part of the key is null or a key occurs twice; one pass for both."""
    key = [*series.keys, series.time]
    bad = df.groupBy(*key).agg(F.count("*").alias("n")).filter(F.greatest(*[F.col(c).isNull().cast("int") for c in key]).cast("boolean") | (F.col("n") > 1))
    for row in bad.limit(1).collect():
        where = ", ".join(f"{c}={row[c]!r}" for c in key)
        if any(row[c] is None for c in key):
            raise ValueError(f"Null primary key component detected: {where}")
        raise ValueError(f"Duplicate primary key detected: {where} occurs {row['n']} times; a lookup on it would multiply rows")


def require_rows(df: DataFrame, expected: int | None = None) -> int:
    n = df.count()
    if n == 0 or (expected is not None and n != expected):
        raise ValueError(f"{n} rows, expected {'some' if expected is None else expected}")
    return n


def feature_audit(features: DataFrame) -> DataFrame:
    """One row: rows, rows of each split, eligible rows, and nulls in model columns of eligible rows. A single aggregate."""
    eligible = F.col("is_valid_forecast_instance") == 1
    checked = [c for c in FEATURES if c in features.columns]
    return features.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col("split") == s).alias(f"rows_{s.lower()}") for s in ("TRAIN", "VAL", "TEST")],
        F.count_if(eligible).alias("eligible"),
        F.sum(sum((F.when(eligible & F.col(c).isNull(), 1).otherwise(0) for c in checked), F.lit(0))).alias("nulls_in_eligible"),
    )


def require_feature_invariants(features: DataFrame, rows: int | None = None) -> dict:
    found = feature_audit(features).first().asDict()
    wrong = []
    if list(features.columns) != list(FEATURES):
        wrong.append("columns differ from the contract")
    if rows is not None and found["rows"] != rows:
        wrong.append(f"{found['rows']} rows instead of {rows}")
    if sum(found[f"rows_{s}"] for s in ("train", "val", "test")) != found["rows"]:
        wrong.append("rows without a split")
    if found["nulls_in_eligible"]:
        wrong.append(f"{found['nulls_in_eligible']} nulls in eligible rows")
    if wrong:
        raise ValueError("; ".join(wrong))
    return found
