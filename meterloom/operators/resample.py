"""Readings into windows of time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag
from ..schema import GOLD, READINGS, Series, conformed


@dataclass(frozen=True)
class ResamplePolicy:
    """Windows and what makes one whole.

    align: "epoch" counts windows from the UTC epoch, so an hour begins at HH:30 where the zone is half an hour off; "local" begins
    them on the session zone's clock hour. Both agree for times without a zone.
    """

    width: str = "1 hour"
    expected: float = 20.0
    complete_at: int = 18
    outage_at: float = 0.5
    spike_over: float = 270.0
    align: str = "epoch"
    energy_digits: int = 6
    ratio_digits: int = 4
    mean_digits: int = 4


def hourly(readings: DataFrame, policy: ResamplePolicy = ResamplePolicy(), series: Series = READINGS) -> DataFrame:
    """The gold layer. Energy is scaled as if missing samples were like those that are there; ratios are rounded before they are
    compared. One shuffle, of partial aggregates."""
    if policy.align not in ("epoch", "local"):
        raise ValueError("align is epoch or local")
    zoned = dict(readings.dtypes)[series.time] == "timestamp"
    time = F.col(series.time)
    local = zoned and policy.align == "local"
    rows = readings.withColumn("_time", time.cast("timestamp_ntz") if local else time)
    grouped = rows.groupBy(*series.keys, F.window("_time", policy.width).alias("w")).agg(*aggregates(policy))
    out = derived(grouped, policy)
    if local:
        out = out.withColumns({c: F.col(c).cast("timestamp") for c in ("window_start", "window_end")})
    return conformed(out, GOLD)


def aggregates(policy: ResamplePolicy) -> list[Column]:
    return [
        F.min("file_year").alias("file_year"),
        F.sum("t_kwh").alias("energy"),
        F.count("*").alias("n"),
        *[F.avg(c).alias(f"avg_{c}") for c in ("voltage", "current", "freq")],
        *[F.sum(f"is_{c}").alias(f"{c}_n") for c in ("outage", "standby", "brownout")],
        F.count_if(F.col("voltage") > policy.spike_over).alias("spike_n"),
    ]


def derived(grouped: DataFrame, policy: ResamplePolicy) -> DataFrame:
    energy = lambda c: F.round(c, policy.energy_digits)
    ratio = lambda c: F.round(c, policy.ratio_digits)
    whole = F.col("n") >= policy.complete_at
    out = grouped.withColumns(
        {"window_start": F.col("w.start"), "window_end": F.col("w.end"), "sample_count": F.col("n"), "hourly_kwh": energy(F.col("energy") * (F.lit(float(policy.expected)) / F.col("n"))), "raw_kwh_sum": energy(F.col("energy"))}
        | {f"mean_{c}": F.round(F.col(f"avg_{c}"), policy.mean_digits) for c in ("voltage", "current", "freq")}
        | {f"{c}_ratio": ratio(F.col(f"{c}_n") / F.col("n")) for c in ("outage", "standby", "brownout", "spike")}
    )
    dark = F.col("outage_ratio") >= policy.outage_at
    return out.withColumns({"is_complete_hour": flag(whole), "is_outage_hour": flag(dark), "is_valid_forecast_target": flag(whole & ~dark)})


def resampled(readings: DataFrame, width: str, series: Series = READINGS) -> DataFrame:
    """Energy and samples of each window; rows without a time belong to none."""
    return readings.groupBy(*series.keys, F.window(series.time, width).alias("w")).agg(F.sum(series.value).alias("energy"), F.count("*").alias("samples")).select(*series.keys, F.col("w.start").alias("window_start"), "energy", "samples")


def conservation(readings: DataFrame, hours: DataFrame) -> DataFrame:
    """One row: energy of the readings, of the hours, and the difference."""
    a, b = readings.agg(F.sum("t_kwh").alias("readings_kwh")), hours.agg(F.sum("raw_kwh_sum").alias("hours_kwh"))
    return a.join(b, F.lit(True), "inner").withColumn("difference", F.abs(F.col("readings_kwh") - F.col("hours_kwh")))
