import math

import pytest

from meterloom.operators import quality, states
from meterloom.plans import pipelines
from meterloom.schema import READINGS, Series
from pyspark.sql import functions as F

COLUMNS = "district string, meter_id string, ts timestamp, file_year int, t_kwh double, voltage double, current double, freq double"


def readings(spark, rows):
    """Sound readings but for what each row's dict changes; ts as text."""
    base = {"district": "A", "meter_id": "m", "ts": "2024-01-01 00:00:00", "file_year": 2024, "t_kwh": 0.1, "voltage": 230.0, "current": 1.0, "freq": 50.0}
    data = [tuple((base | r).values()) for r in rows]
    return spark.createDataFrame(data, COLUMNS.replace("ts timestamp", "ts string")).withColumn("ts", F.try_to_timestamp("ts"))


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"ts": None}, ["INVALID_OR_UNPARSEABLE_TIMESTAMP"]),
        ({"ts": "2019-01-01 00:00:00"}, ["TIMESTAMP_OUT_OF_BOUNDS"]),
        ({"meter_id": ""}, ["EMPTY_OR_NULL_METER_ID"]),
        ({"meter_id": None}, ["EMPTY_OR_NULL_METER_ID"]),
        ({"t_kwh": None}, ["NULL_ACTIVE_ENERGY"]),
        ({"t_kwh": math.nan}, ["ACTIVE_ENERGY_OUT_OF_BOUNDS"]),
        ({"t_kwh": 0.5}, []),
        ({"t_kwh": 0.5001}, ["ACTIVE_ENERGY_OUT_OF_BOUNDS"]),
        ({"voltage": 700.01, "current": -1.0}, ["VOLTAGE_OUT_OF_BOUNDS", "CURRENT_OUT_OF_BOUNDS"]),
        ({"voltage": None, "current": None, "freq": None}, ["NULL_VOLTAGE", "NULL_CURRENT", "NULL_FREQUENCY"]),
        ({"freq": 39.99}, ["FREQUENCY_OUT_OF_BOUNDS"]),
        ({"freq": 0.0}, []),
        ({"freq": 40.0}, []),
        ({"freq": 60.01}, ["FREQUENCY_OUT_OF_BOUNDS"]),
    ],
)
def test_reasons(spark, change, reasons):
    limits = quality.Limits(first="2020-01-01", last="2025-01-01")
    row = quality.assessed(readings(spark, [change]), quality.reading_rules(limits)).first()
    assert row.rejection_reasons == reasons
    assert row.rejection_reason == "; ".join(reasons)


def test_quarantine_and_duplicates(spark):
    df = readings(spark, [{}, {"t_kwh": 0.2}, {"meter_id": "n"}, {"voltage": -1.0}])
    config = pipelines.Config(survivor_order=("t_kwh",))
    kept = pipelines.silver(df, config)
    assert sorted((r.meter_id, r.t_kwh) for r in kept.collect()) == [("m", 0.1), ("n", 0.1)]
    assert sorted(r.rejection_reason for r in pipelines.quarantine(df, config).collect()) == ["DUPLICATE_KEY", "VOLTAGE_OUT_OF_BOUNDS"]


@pytest.mark.parametrize(
    "v, i, e, f, silver, forensic",
    [
        (0.0, 0.0, 0.0, 0.0, 1, "State 1: Grid Outage / Blackout"),
        (0.0, 0.0, 0.0, 50.0, 1, "State 6: Other Intermediate"),
        (280.0, 0.0, 0.0, 50.0, 2, "State 2: Voluntary Standby / Idle"),
        (280.0, 0.0501, 0.0, 50.0, 5, "State 5: Overvoltage Transient / Spike"),
        (180.0, 0.05, 0.0, 50.0, 2, "State 2: Voluntary Standby / Idle"),
        (0.01, 0.0, 0.0, 50.0, 3, "State 3: Brownout Supply"),
        (179.99, 1.0, 0.1, 50.0, 3, "State 3: Brownout Supply"),
        (180.0, 1.0, 0.1, 50.0, 4, "State 4: Normal Active Operation"),
        (260.0, 1.0, 0.1, 50.0, 4, "State 4: Normal Active Operation"),
        (260.01, 1.0, 0.1, 50.0, 5, "State 5: Overvoltage Transient / Spike"),
    ],
)
def test_states(spark, v, i, e, f, silver, forensic):
    row = readings(spark, [{"voltage": v, "current": i, "t_kwh": e, "freq": f}]).select(states.operating_state().alias("s"), states.forensic_state().alias("f")).first()
    assert (row.s, row.f) == (silver, forensic)


def test_flags(spark):
    df = states.classified(readings(spark, [{"voltage": x} for x in (300.0, 300.01, 260.0, 260.01)] + [{"t_kwh": 0.3}, {"t_kwh": 0.3001}]))
    assert [(r.is_voltage_high, r.is_voltage_spike, r.is_extreme_load) for r in df.collect()] == [(1, 0, 0), (0, 1, 0), (0, 0, 0), (1, 0, 0), (0, 0, 0), (0, 0, 1)]


def test_key_guard(spark):
    hours = "district string, meter_id string, window_start timestamp"
    one = spark.sql("SELECT 'A' AS district, 'm' AS meter_id, TIMESTAMP '2024-01-01' AS window_start")
    quality.require_unique(one)
    with pytest.raises(ValueError, match="Duplicate primary key detected"):
        quality.require_unique(one.union(one))
    with pytest.raises(ValueError, match="Null primary key component detected"):
        quality.require_unique(one.withColumn("meter_id", F.lit(None).cast("string")))
    quality.require_unique(spark.createDataFrame([], hours))
    with pytest.raises(ValueError, match="expected 2"):
        quality.require_rows(one, 2)


def test_dedup_agrees_between_runs(spark):
    df = readings(spark, [{"t_kwh": x / 100} for x in range(10)])
    assert quality.distinct_readings(df, READINGS).first().t_kwh == 0.0
    assert quality.distinct_readings(df, Series(), ("current", "t_kwh")).count() == 1
