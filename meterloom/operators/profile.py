"""Numeric profiles, missing values, duplicates, moments, quantiles, bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import READINGS, Series

MEASURES = ("t_kwh", "voltage", "current", "freq")
#: Texts that stand for a missing value: fixed values.
MISSING = ("", "null", "NaN")


def numeric_profile(df: DataFrame, columns=MEASURES, spike_over: float = 300.0) -> DataFrame:
    """One row: bounds, mean, zeros and negatives of each measure, and voltage spikes. A single pass."""
    per = [f for c in columns for f in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_avg"), F.count_if(F.col(c) == 0).alias(f"{c}_zeros"), F.count_if(F.col(c) < 0).alias(f"{c}_negatives"))]
    spikes = [F.count_if(F.col("voltage") > spike_over).alias("voltage_spikes")] if "voltage" in columns else []
    return df.agg(F.count("*").alias("rows"), *per, *spikes)


def missing_tokens(df: DataFrame, columns=None) -> DataFrame:
    """One row: how many values of each column are null or a text that stands for it."""
    return df.agg(*[F.count_if(F.col(c).isNull() | F.col(c).cast("string").isin(*MISSING)).alias(c) for c in columns or df.columns])


def duplicate_keys(df: DataFrame, series: Series = READINGS) -> DataFrame:
    """One row: keys that occur more than once, and rows beyond the first of each."""
    n = df.groupBy(*series.keys, series.time).agg(F.count("*").alias("n")).filter("n > 1")
    return n.agg(F.count("*").alias("duplicate_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus_rows"))


def entities(df: DataFrame, column: str = "meter_id") -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def text_bounds(df: DataFrame, column: str = "ts_str") -> DataFrame:
    """The first and last text in lexical order, and how many there are."""
    return df.agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count(column).alias("present"))


def moments(df: DataFrame, column: str) -> DataFrame:
    """One row: bounds, mean, sample deviation and variance, skewness of the population."""
    return df.agg(F.min(column).alias("min"), F.max(column).alias("max"), F.avg(column).alias("mean"), F.stddev(column).alias("std"), F.variance(column).alias("variance"), F.skewness(column).alias("skewness"))


# The probabilities that profiles report.
PROBABILITIES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def quantiles(df: DataFrame, column: str, probabilities=PROBABILITIES, where: Column | None = None, accuracy: int | None = 10_000) -> DataFrame:
    """(p, value) from a mergeable sketch, whose ranks are wrong by a share of 1 / accuracy at most. Without an accuracy exact, by
    interpolation: all distinct values then meet in one task, so that is for small tables."""
    return population_quantiles(df, {"": (column, where)}, probabilities, accuracy).drop("population")


def population_quantiles(df: DataFrame, populations: dict[str, tuple[str, Column | None]], probabilities=PROBABILITIES, accuracy: int | None = 10_000) -> DataFrame:
    """(population, p, value) of several columns under conditions, in one pass."""
    ps = F.array(*[F.lit(p) for p in probabilities])
    one = lambda x: F.percentile_approx(x, ps, accuracy) if accuracy else F.percentile(x, ps)
    wanted = {name: F.col(c) if where is None else F.when(where, F.col(c)) for name, (c, where) in populations.items()}
    got = df.agg(*[one(x).alias(f"v{i}") for i, x in enumerate(wanted.values())])
    each = F.array(*[F.struct(F.lit(name).alias("population"), F.col(f"v{i}").alias("v")) for i, name in enumerate(wanted)])
    rows = got.select(F.inline(each)).select("population", F.posexplode("v").alias("i", "value"))
    return rows.select("population", F.get(ps, F.col("i")).alias("p"), "value")


def energy_and_voltage_quantiles(df: DataFrame, accuracy: int | None = 10_000) -> DataFrame:
    """All energy, energy above 0, and voltage above 0."""
    return population_quantiles(df, {"energy": ("t_kwh", None), "active_energy": ("t_kwh", F.col("t_kwh") > 0), "voltage": ("voltage", F.col("voltage") > 0)}, accuracy=accuracy)


def voltage_bands(df: DataFrame) -> DataFrame:
    """One row: readings in each band of voltage, and with a frequency near 50 Hz; means of voltage, frequency and current, and the most
    current."""
    v, f, i = F.col("voltage"), F.col("freq"), F.col("current")
    # The bands' bounds.
    bands = {"outage": v == 0, "below_180": (v > 0) & (v < 180), "from_180_to_200": (v >= 180) & (v < 200), "from_200_to_250": (v >= 200) & (v <= 250), "from_250_to_270": (v > 250) & (v <= 270), "over_270": v > 270, "over_300": v > 300, "freq_near_50": (f >= 49.90) & (f <= 50.05)}
    return df.agg(F.count("*").alias("rows"), F.avg(v).alias("mean_voltage"), F.avg(F.when(v > 0, v)).alias("energised_mean"), F.avg(F.when(f > 0, f)).alias("energised_freq"), F.avg(i).alias("mean_current"), F.max(i).alias("max_current"), *[F.count_if(c).alias(n) for n, c in bands.items()])


def state_distribution(df: DataFrame, state: Column) -> DataFrame:
    return df.groupBy(state.alias("state")).agg(F.count("*").alias("rows"), F.avg("t_kwh").alias("mean_kwh"), F.avg("voltage").alias("mean_voltage"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: nulls of every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def file_audit(frames: dict[str, DataFrame], series: Series = READINGS) -> DataFrame:
    """One row per file: rows, meters, bounds of the texts of time, surplus rows."""
    return reduce(
        lambda a, b: a.unionByName(b),
        [df.agg(F.lit(name).alias("file"), F.count("*").alias("rows"), F.count_distinct("meter_id").alias("meters"), F.min(series.time).cast("string").alias("first"), F.max(series.time).cast("string").alias("last")) for name, df in frames.items()],
    )
