"""Checks that hold for every run, as functions that return what is wrong."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FEATURES, GOLD, HOURS, READINGS, SILVER, Series, deviations


def _violations(df: DataFrame, checks: dict) -> list[str]:
    """Names of the checks that some row breaks; all in one pass."""
    row = df.agg(*[F.count_if(F.coalesce(~c, F.lit(False))).alias(n) for n, c in checks.items()]).first()
    return [f"{n}: {row[n]} rows" for n in checks if row[n]]


def _keys(df: DataFrame, series: Series) -> list[str]:
    bad = df.groupBy(*series.keys, series.time).count().filter("count > 1").limit(1).count()
    return ["key occurs twice"] if bad else []


def of_silver(df: DataFrame) -> list[str]:
    v = F.col("voltage")
    checks = {
        "state is closed": F.col("operating_state").between(1, 5),
        "outage flag": (F.col("is_outage") == 1) == (v == 0),
        "brownout flag": (F.col("is_brownout") == 1) == ((v > 0) & (v < 180)),
        "spike flag": (F.col("is_voltage_spike") == 1) == (v > 300),
        "energy in bounds": F.col("t_kwh").between(0, 0.5),
    }
    return deviations(df, SILVER) + _keys(df, READINGS) + _violations(df, checks)


def of_gold(df: DataFrame, expected: float = 20.0, complete_at: int = 18) -> list[str]:
    n = F.col("sample_count")
    checks = {
        "window is an hour": F.unix_timestamp("window_end") - F.unix_timestamp("window_start") == 3600,
        "ratios are shares": F.least(*[F.col(f"{c}_ratio") for c in ("outage", "standby", "brownout", "spike")]).between(0, 1) & (F.greatest(*[F.col(f"{c}_ratio") for c in ("outage", "standby", "brownout", "spike")]) <= 1),
        "energy is scaled": F.abs(F.col("hourly_kwh") - F.col("raw_kwh_sum") * expected / n) < 1e-4,
        "complete hours": (F.col("is_complete_hour") == 1) == (n >= complete_at),
        "valid targets": (F.col("is_valid_forecast_target") == 1) == ((F.col("is_complete_hour") == 1) & (F.col("is_outage_hour") == 0)),
    }
    return deviations(df, GOLD) + _keys(df, HOURS) + _violations(df, checks)


def of_features(df: DataFrame, train_before: str, val_before: str) -> list[str]:
    t = F.col("target_window_start")
    unit = lambda n: F.abs(F.col(f"{n}_sin") ** 2 + F.col(f"{n}_cos") ** 2 - 1) < 1e-5
    checks = {
        "target is the next hour": F.unix_timestamp(t) - F.unix_timestamp("window_start") == 3600,
        "cyclic features": unit("hour") & unit("dow") & unit("month"),
        "training targets are early": (F.col("split") != "TRAIN") | (t < F.lit(train_before).cast("timestamp_ntz")),
        "test targets are late": (F.col("split") != "TEST") | (t >= F.lit(val_before).cast("timestamp_ntz")),
        "eligible rows have history": (F.col("is_valid_forecast_instance") == 0) | (F.col("has_complete_history") == 1),
        "eligible rows have targets": (F.col("is_valid_forecast_instance") == 0) | F.col("target_hourly_kwh").isNotNull(),
        "missing targets aren't valid": F.col("target_hourly_kwh").isNotNull() | (F.col("target_is_valid") == 0),
    }
    return deviations(df, FEATURES) + _keys(df, HOURS) + _violations(df, checks)


def conserved(readings: DataFrame, hours: DataFrame, tolerance: float = 1e-3) -> bool:
    from .resample import conservation

    return (conservation(readings, hours).first()["difference"] or 0.0) < tolerance


def no_fan_out(eligible: DataFrame, aligned: DataFrame, series: Series = HOURS) -> bool:
    """Alignment neither adds nor loses a row."""
    key = [*series.keys, series.time]
    return eligible.select(*key).exceptAll(aligned.select(*key)).isEmpty() and aligned.select(*key).exceptAll(eligible.select(*key)).isEmpty()
