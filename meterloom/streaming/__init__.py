"""The silver and gold layers over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import Limits, assessed, reading_rules, sound
from ..operators.resample import ResamplePolicy, aggregates, derived
from ..operators.states import StatePolicy, classified
from ..schema import GOLD, READINGS, Series, conformed


def stream_silver(readings: DataFrame, limits: Limits = Limits(), states: StatePolicy = StatePolicy(), late: str = "1 hour", series: Series = READINGS) -> DataFrame:
    """Sound, classified readings; of copies that arrive within the watermark one is kept. State is bounded by the watermark."""
    rows = sound(assessed(readings, reading_rules(limits, series.time))).withWatermark(series.time, late)
    return classified(rows.dropDuplicatesWithinWatermark([*series.keys, series.time]), states)


def stream_gold(silver: DataFrame, policy: ResamplePolicy = ResamplePolicy(), late: str = "1 hour", series: Series = READINGS) -> DataFrame:
    """Hours, each emitted once, when the watermark has passed it. Silver's watermark stands if there is one."""
    grouped = silver.withWatermark(series.time, late) if not _marked(silver, series.time) else silver
    got = grouped.groupBy(*series.keys, F.window(series.time, policy.width).alias("w")).agg(*aggregates(policy))
    return conformed(derived(got, policy), GOLD)


def _marked(df: DataFrame, time: str) -> bool:
    return "EventTimeWatermark" in df._jdf.queryExecution().analyzed().toString()
