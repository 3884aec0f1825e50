"""Lifespans, coverage, gaps, signal quality at several resolutions, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_seconds, share
from ..schema import READINGS, Series
from .states import cascade

#: Seconds between readings, and the bounds and labels of the gap categories: fixed values.
CADENCE = 180
GAP_BOUNDS = (180, 900, 3600, 86400)
GAP_LABELS = [
    "0. Anomaly (< 3 min)",
    "1. Exact 3-min (Nominal)",
    "2. Short Gap (3m - 15m)",
    "3. Medium Gap (15m - 1h)",
    "4. Long Gap (1h - 24h)",
    "5. Extended Dropout (> 24h)",
]


def time_bounds(df: DataFrame, cadence: int = CADENCE, time: str = "ts") -> DataFrame:
    """One row: first and last time, and how many readings there could be between."""
    span = epoch_seconds(F.col("last")) - epoch_seconds(F.col("first"))
    return df.agg(F.min(time).alias("first"), F.max(time).alias("last")).withColumn("slots", (F.floor(span / cadence) + 1).cast("long"))


def lifespans(df: DataFrame, series: Series = READINGS) -> DataFrame:
    """One row per series: readings, first and last time and the days between, mean energy, readings in outage and standby."""
    v, i, f = F.col("voltage"), F.col("current"), F.col("freq")
    days = F.round((epoch_seconds(F.col("last")) - epoch_seconds(F.col("first"))) / 86400, 1)
    got = df.groupBy(*series.keys).agg(
        F.count("*").alias("readings"), F.min(series.time).alias("first"), F.max(series.time).alias("last"), F.avg(series.value).alias("mean_kwh"),
        F.count_if((v == 0) & (f == 0)).alias("outages"), F.count_if((F.col(series.value) == 0) & (v > 180) & (i == 0)).alias("standbys"),
    )
    return got.withColumn("lifespan_days", days)


def coverage(df: DataFrame, cadence: int = CADENCE, series: Series = READINGS) -> DataFrame:
    """lifespans with the readings that there could be over the series' own span and over the whole table's, and shares in percent.

    The table's span comes from the lifespans, not from another scan; it is one row.
    """
    rows = lifespans(df, series)
    whole = rows.agg(F.min("first").alias("a"), F.max("last").alias("z")).select((F.floor((epoch_seconds(F.col("z")) - epoch_seconds(F.col("a"))) / cadence) + 1).cast("long").alias("slots"))
    own = (F.floor((epoch_seconds(F.col("last")) - epoch_seconds(F.col("first"))) / cadence) + 1).cast("long")
    percent = lambda a, b: F.round(share(F.col(a), F.col(b), 100.0), 4)
    out = rows.withColumn("expected", own).join(F.broadcast(whole), F.lit(True))
    return out.withColumns({"coverage_pct": percent("readings", "expected"), "global_coverage_pct": percent("readings", "slots"), "outage_pct": percent("outages", "readings"), "standby_pct": percent("standbys", "readings")})


def deltas(df: DataFrame, series: Series = READINGS) -> DataFrame:
    """df with delta: seconds since the series' reading before; the first of each is dropped."""
    before = F.lag(series.time).over(Window.partitionBy(*series.keys).orderBy(series.time))
    return df.withColumn("delta", epoch_seconds(F.col(series.time)) - epoch_seconds(before)).filter(F.col("delta").isNotNull())


def gap_category(delta: Column) -> Column:
    less, *upto = GAP_LABELS[:-1]
    return cascade([(delta < GAP_BOUNDS[0], less), *((delta <= most, name) for most, name in zip(GAP_BOUNDS, upto, strict=True))], GAP_LABELS[-1])


def gap_distribution(df: DataFrame, series: Series = READINGS) -> DataFrame:
    d = F.col("delta")
    return deltas(df, series).groupBy(gap_category(d).alias("category")).agg(F.count("*").alias("gaps"), F.min(d).alias("least"), F.max(d).alias("most"), F.avg(d).alias("mean"))


def district_comparison(df: DataFrame) -> DataFrame:
    v, e = F.col("voltage"), F.col("t_kwh")
    return df.groupBy("district").agg(
        F.count("*").alias("rows"), F.count_distinct("meter_id").alias("meters"), F.avg(e).alias("mean_kwh"), F.stddev(e).alias("std_kwh"), F.count_if(e == 0).alias("zeros"),
        F.count_if(v < 180).alias("brownout_or_outage"), F.avg(F.when(v > 0, v)).alias("energised_voltage"),
    )


def signal(df: DataFrame, value: str, series: Series) -> DataFrame:
    """One row: mean, deviation, coefficient of variation, signal to noise (plain and in dB), share of zeros, and the correlation of
    neighbours, pooled over all series. What has no meaning because a divisor is 0 is 0."""
    before = F.lag(value).over(Window.partitionBy(*series.keys).orderBy(series.time))
    now = F.when(F.col("_before").isNotNull(), F.col(value))
    got = df.withColumn("_before", before).agg(
        F.count("*").alias("rows"), F.avg(value).alias("mean"), F.stddev(value).alias("std"), F.variance(value).alias("variance"),
        F.count_if(F.col(value) == 0).alias("zeros"), F.try_divide(F.covar_samp(now, F.col("_before")), F.stddev(now) * F.stddev("_before")).alias("lag1"),
    )
    ratio = lambda a, b: F.coalesce(F.when(F.col(b) > 0, F.try_divide(F.col(a), F.col(b))), F.lit(0.0))
    got = got.withColumns({"cv": ratio("std", "mean"), "snr": ratio("mean", "std"), "zero_pct": F.coalesce(share(F.col("zeros"), F.col("rows"), 100.0), F.lit(0.0))})
    return got.withColumn("snr_db", F.when(F.col("snr") > 0, 20 * F.log10("snr")).otherwise(0.0))


def reconciled(found: DataFrame, reference: DataFrame, keys: list[str], value: str, tolerance: float = 0.01) -> DataFrame:
    """Both aggregates side by side, their difference, and whether it is within a share of the reference."""
    a, b = found.select(*keys, F.col(value).alias("found")), reference.select(*keys, F.col(value).alias("reference"))
    gap = F.abs(F.col("found") - F.col("reference"))
    return a.join(b, keys).withColumns({"difference": gap, "within": gap <= tolerance * F.abs(F.col("reference"))})


def customer_profile(hours: DataFrame, readings: DataFrame, series: Series, brownout_below: float = 200.0, accuracy: int = 10_000) -> DataFrame:
    """One row per series: daily load, median (by a sketch), variation, peak to average, day to night, weekend to weekday, outage hours,
    and the share of readings whose voltage is below a bound."""
    x, hour, dow = F.col(series.value), F.hour(series.time), F.dayofweek(series.time)
    day, weekend = (hour >= 6) & (hour < 18), dow.isin(1, 7)
    per_day = hours.groupBy(*series.keys, F.to_date(series.time).alias("_day")).agg(F.sum(x).alias("kwh")).groupBy(*series.keys).agg(F.avg("kwh").alias("mean_daily_kwh"))
    mean = F.avg(x)
    rest = hours.groupBy(*series.keys).agg(
        F.percentile_approx(x, 0.5, accuracy).alias("median_kwh"), F.try_divide(F.stddev(x), mean).alias("cv"), F.try_divide(F.max(x), mean).alias("peak_to_average"),
        F.try_divide(F.sum(F.when(day, x)), F.sum(F.when(~day, x))).alias("day_night"), F.try_divide(F.avg(F.when(weekend, x)), F.avg(F.when(~weekend, x))).alias("weekend_weekday"),
        F.sum("is_outage_hour").alias("outage_hours"),
    )
    brown = readings.groupBy(*series.keys).agg(F.avg((F.col("voltage") < brownout_below).cast("int")).alias("brownout_share"))
    return rest.join(per_day, list(series.keys)).join(brown, list(series.keys))
