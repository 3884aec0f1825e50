"""Layers from raw readings to reports, put together from the operators."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsed_time
from ..operators import baselines, forensics, profile
from ..operators.features import FeaturePolicy, feature_store
from ..operators.quality import Limits, assessed, distinct_readings, duplicate_readings, quarantined, reading_rules, require_feature_invariants, require_unique, sound
from ..operators.resample import ResamplePolicy, hourly, resampled
from ..operators.splits import SplitPolicy
from ..operators.states import StatePolicy, classified, forensic_state
from ..schema import HOURS, READINGS, SILVER, conformed
from ..sources import read_manifest, read_parquet, write_layer, write_quarantine, write_report


@dataclass(frozen=True)
class Config:
    """All that differs from one data set to the next."""

    limits: Limits = field(default_factory=Limits)
    states: StatePolicy = field(default_factory=StatePolicy)
    hours: ResamplePolicy = field(default_factory=ResamplePolicy)
    features: FeaturePolicy = field(default_factory=FeaturePolicy)
    splits: SplitPolicy = field(default_factory=lambda: SplitPolicy("2024-01-21 00:00:00", "2024-01-26 00:00:00"))
    survivor_order: tuple[str, ...] = ()


def silver(readings: DataFrame, config: Config = Config()) -> DataFrame:
    """Sound readings, one for each key, classified."""
    rows = distinct_readings(sound(assessed(readings, reading_rules(config.limits))), READINGS, config.survivor_order)
    return conformed(classified(rows, config.states), SILVER)


def quarantine(readings: DataFrame, config: Config = Config()) -> DataFrame:
    """Rejected readings with reasons, and surplus copies."""
    rows = assessed(readings, reading_rules(config.limits))
    return quarantined(rows).unionByName(duplicate_readings(sound(rows), READINGS, config.survivor_order))


def gold(readings: DataFrame, config: Config = Config()) -> DataFrame:
    return hourly(silver(readings, config), config.hours)


def features(readings: DataFrame, config: Config = Config()) -> DataFrame:
    return feature_store(gold(readings, config), config.splits, config.features)


# -- drivers: tables in, tables out ------------------------------------------------------------------------------------


def build_silver(spark: SparkSession, files: list[tuple[dict, str]], silver_path: str, quarantine_path: str, config: Config = Config()) -> None:
    """Raw files of a manifest to the silver table and the quarantine. Readings are parsed once for both."""
    raw = read_manifest(spark, files).withColumn("ts", parsed_time(F.col("ts_str"))).persist()
    try:
        write_layer(silver(raw, config), silver_path, ("district", "file_year"))
        write_quarantine(quarantine(raw, config), quarantine_path)
    finally:
        raw.unpersist()


def build_gold(spark: SparkSession, silver_path: str, gold_path: str, config: Config = Config()) -> None:
    write_layer(hourly(read_parquet(spark, silver_path), config.hours), gold_path, ("district", "file_year"))


def build_features(spark: SparkSession, gold_path: str, features_path: str, config: Config = Config()) -> dict:
    """The feature table, once its invariants hold; returns what they counted."""
    hours = read_parquet(spark, gold_path)
    require_unique(hours, HOURS)
    made = feature_store(hours, config.splits, config.features)
    found = require_feature_invariants(made, hours.count())
    write_layer(made, features_path, ("split", "district"))
    return found


def evaluate(spark: SparkSession, features_path: str, report_path: str | None = None, splits=("TRAIN", "VAL")) -> dict:
    """Baselines on each split's common cohort, as a report."""
    rows = baselines.aligned_by_frames(read_parquet(spark, features_path), splits).persist()
    try:
        report = {"metadata": {"spark": spark.version, "features": features_path}, "splits": {s: baselines.evaluated(rows, s) for s in splits}}
    finally:
        rows.unpersist()
    if report_path:
        write_report(report, report_path)
    return report


# -- analyses ----------------------------------------------------------------------------------------------------------


def audit(readings: DataFrame) -> dict[str, DataFrame]:
    return {"profile": profile.numeric_profile(readings), "missing": profile.missing_tokens(readings), "duplicates": profile.duplicate_keys(readings), "entities": profile.entities(readings)}


def temporal(readings: DataFrame, cadence: int = forensics.CADENCE) -> dict[str, DataFrame]:
    return {"bounds": forensics.time_bounds(readings, cadence), "coverage": forensics.coverage(readings, cadence), "gaps": forensics.gap_distribution(readings), "districts": forensics.district_comparison(readings)}


def resolution(readings: DataFrame, widths=("15 minutes", "30 minutes", "1 hour")) -> dict[str, DataFrame]:
    out = {"moments": profile.moments(readings, "t_kwh"), "quantiles": profile.energy_and_voltage_quantiles(readings), "bands": profile.voltage_bands(readings), "states": profile.state_distribution(readings, forensic_state()), "raw": forensics.signal(readings, "t_kwh", READINGS)}
    for width in widths:
        out[width] = forensics.signal(resampled(readings, width), "energy", HOURS.at("window_start", "energy"))
    return out
