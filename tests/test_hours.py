import pytest
from pyspark.sql import functions as F
from test_quality import readings

from meterloom.operators import baselines, features, forensics, invariants, profile, resample, states
from meterloom.operators.splits import SplitPolicy, split_of
from meterloom.schema import FEATURES, HOURS, READINGS, deviations


def hour_of(spark, n, dark=0):
    rows = [{"ts": f"2024-01-01 10:{3 * i:02d}:00", "voltage": 0.0 if i < dark else 230.0} for i in range(n)]
    return resample.hourly(states.classified(readings(spark, rows))).first()


@pytest.mark.parametrize("n, complete", [(1, 0), (17, 0), (18, 1), (19, 1), (20, 1)])
def test_scaling_and_completeness(spark, n, complete):
    row = hour_of(spark, n)
    assert row.sample_count == n and row.is_complete_hour == complete
    assert row.hourly_kwh == pytest.approx(2.0, abs=1e-6) and row.raw_kwh_sum == pytest.approx(0.1 * n)


@pytest.mark.parametrize("dark, outage, valid", [(9, 0, 1), (10, 1, 0)])
def test_outage_hours(spark, dark, outage, valid):
    row = hour_of(spark, 20, dark)
    assert (row.is_outage_hour, row.is_valid_forecast_target) == (outage, valid)


def test_alignment(spark):
    """Windows by the epoch begin at half past where the zone is half an hour off; local ones and those without a zone don't."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = states.classified(readings(spark, [{"ts": "2024-01-01 14:10:00"}]))
        text = lambda d, **p: resample.hourly(d, resample.ResamplePolicy(**p)).select(F.date_format("window_start", "HH:mm")).first()[0]
        assert text(df) == "13:30"
        assert text(df, align="local") == "14:00"
        plain = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        assert text(plain) == text(plain, align="local") == "14:00"
        with pytest.raises(ValueError):
            text(df, align="other")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def hours(spark, present, start="2024-01-01 00:00:00"):
    """One series with the given hours after the start; the value is the hour's number."""
    df = spark.createDataFrame([(h,) for h in present], "h int")
    cols = {"district": F.lit("A"), "meter_id": F.lit("m"), "window_start": F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h")), "hourly_kwh": F.col("h").cast("double")}
    more = {c: F.lit(0.0) for c in features.CONTEXT} | {"is_complete_hour": F.lit(1), "is_outage_hour": F.lit(0), "is_valid_forecast_target": F.lit(1)}
    return df.withColumns(cols | more)


POLICY = SplitPolicy("2024-01-08 12:00:00", "2024-01-09 00:00:00")


def test_lags_by_row_and_by_time(spark):
    df = hours(spark, [*range(100), *range(130, 230)])
    by_row = {r.h: r for r in df.withColumns(features.lags()).collect()}
    by_time = {r.h: r for r in df.withColumns(features.lags(features.FeaturePolicy(mode="time"))).collect()}
    assert by_row[130].lag_24h == 76 and by_time[130].lag_24h is None
    assert by_row[130].lag_1h == 99 and by_time[130].lag_1h is None
    assert by_row[99].lag_24h == by_time[99].lag_24h == 75
    assert by_time[200].lag_168h == 32 and by_row[0].lag_1h is None


def test_rolling_frames(spark):
    df = hours(spark, [*range(100), *range(130, 230)])
    rows = {r.h: r for r in df.withColumns(features.rolling()).collect()}
    assert rows[0].rolling_std_24h is None and rows[0].rolling_mean_24h == 0
    assert rows[50].rolling_mean_24h == sum(range(27, 51)) / 24 and rows[130].rolling_min_24h == 77
    by_time = {r.h: r for r in df.withColumns(features.rolling(features.FeaturePolicy(mode="time"))).collect()}
    assert by_time[130].rolling_min_24h == 130


def test_targets_stop_at_gaps(spark):
    rows = {r.h: r for r in hours(spark, [0, 1, 3]).withColumns(features.targets()).collect()}
    assert rows[0].target_hourly_kwh == 1 and rows[0].target_is_valid == 1
    assert rows[1].target_hourly_kwh is None and rows[1].target_is_valid == 0 and rows[1].target_is_complete is None
    assert rows[3].target_hourly_kwh is None
    far = {r.h: r for r in features.horizon_targets(hours(spark, [0, 1, 24, 168])).collect()}
    assert (far[0].target_h1, far[0].target_h24, far[0].target_h168, far[1].target_h24) == (1, 24, 168, None)


def test_splits(spark):
    times = ["2024-01-08 11:59:59", "2024-01-08 12:00:00", "2024-01-08 23:59:59", "2024-01-09 00:00:00", None]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert [r[0] for r in df.select(split_of(F.col("t"), POLICY)).collect()] == ["TRAIN", "VAL", "VAL", "TEST", None]


def test_feature_store(spark):
    df = features.feature_store(hours(spark, [*range(100), *range(130, 300)]), POLICY).cache()
    assert deviations(df, FEATURES) == [] and invariants.of_features(df, POLICY.train_before, POLICY.val_before) == []
    plans = df._jdf.queryExecution().executedPlan().toString()
    assert plans.count("Exchange hashpartitioning") <= 1
    eligible = df.filter("is_valid_forecast_instance = 1")
    assert eligible.count() == 101 and {r.split for r in eligible.select("split").distinct().collect()} <= {"TRAIN", "VAL", "TEST"}
    joined, framed = (f(df, ("TRAIN", "VAL", "TEST")) for f in (baselines.aligned, baselines.aligned_by_frames))
    assert joined.select(sorted(joined.columns)).exceptAll(framed.select(sorted(joined.columns))).isEmpty()
    assert invariants.no_fan_out(eligible, joined)


BASE = "district string, meter_id string, window_start timestamp, target_hourly_kwh double, target_is_valid int, split string, is_valid_forecast_instance int, lag_0h double, rolling_mean_24h double"


def instances(spark, rows):
    """(meter, hours from the origin, target, valid, split)"""
    df = spark.createDataFrame([("A", m, h, None if y is None else float(y), ok, s, int(s == "VAL"), 0.5, 0.5) for m, h, y, ok, s in rows], BASE.replace("window_start timestamp", "window_start int"))
    return df.withColumn("window_start", F.lit("2024-01-10").cast("timestamp") + F.make_dt_interval(F.lit(0), F.col("window_start")))


BOTH = pytest.mark.parametrize("align", [baselines.aligned, baselines.aligned_by_frames])


@BOTH
def test_series_are_apart(spark, align):
    df = instances(spark, [("A", 0, 1.25, 1, "TRAIN"), ("C", 0, 9.99, 1, "TRAIN"), ("A", 24, 2.0, 1, "VAL"), ("B", 24, 2.0, 1, "VAL")])
    assert {r.meter_id: r.b2_pred for r in align(df).collect()} == {"A": 1.25, "B": None}


@BOTH
def test_offsets_are_exact(spark, align):
    df = instances(spark, [("A", 0, 1.0, 1, "VAL"), *[("A", -h, h / 100, 1, "TRAIN") for h in (23, 24, 25, 167, 168, 169)]])
    row = align(df).first()
    assert (row.b2_pred, row.b3_pred, row.b1_pred, row.b4_pred) == (0.24, 1.68, 0.5, 0.5)


@BOTH
def test_missing_history_is_excluded(spark, align):
    rows = align(instances(spark, [("A", 0, 1.0, 1, "VAL")]))
    assert (rows.first().b2_pred, rows.first().b3_pred) == (None, None)
    audit = baselines.cohort_audit(rows).first()
    assert (audit.eligible, audit.common, audit.excluded, audit.both_missing) == (1, 0, 1, 1)
    report = baselines.evaluated(rows, "VAL")
    assert report["baselines"] == {} and report["target_summary"]["n"] == 0
    assert baselines.evaluated(rows, "TRAIN")["cohort_audit"]["eligible"] == 0


@BOTH
def test_unusable_history_is_null(spark, align):
    bad = [(0.5, 1), (0.5, 0), (-0.2, 1), (float("nan"), 1), (float("inf"), 1), (float("-inf"), 1), (None, 1)]
    df = instances(spark, [(f"m{i}", -24, y, ok, "TRAIN") for i, (y, ok) in enumerate(bad)] + [(f"m{i}", 0, 1.0, 1, "VAL") for i in range(len(bad))])
    assert {r.meter_id: r.b2_pred for r in align(df).collect()} == {f"m{i}": (0.5 if i == 0 else None) for i in range(len(bad))}


def predicted(spark, pairs):
    return spark.createDataFrame([("VAL", float(y), *[float(p)] * 4) for y, p in pairs], "split string, target_hourly_kwh double, b1_pred double, b2_pred double, b3_pred double, b4_pred double")


def test_metrics(spark):
    row = baselines.metrics(predicted(spark, [(1, 2), (3, 3)])).filter("baseline = 'b1'").first()
    assert (row.n, row.sse, row.sae, row.mae, row.r2, row.wape) == (2, 1.0, 1.0, 0.5, 0.5, 25.0)
    assert row.rmse == pytest.approx(0.707107) and row.std_kwh == pytest.approx(1.414214)
    flat = baselines.metrics(predicted(spark, [(1, 2), (1, 2)])).first()
    assert flat.r2 != flat.r2 and flat.wape == 100.0
    zero = baselines.metrics(predicted(spark, [(0, 1)])).first()
    assert zero.wape != zero.wape and zero.nrmse != zero.nrmse and zero.std_kwh == 0.0
    good, better = {"rmse": 1.0, "mae": 1.0}, {"rmse": 0.5, "mae": 0.5}
    assert baselines.beats_baselines(better, {"b1": good}) and not baselines.beats_baselines(good, {"b1": better})


@pytest.mark.parametrize("seconds, name", [(60, "0. Anomaly (< 3 min)"), (180, "1. Exact 3-min (Nominal)"), (181, "2. Short Gap (3m - 15m)"), (900, "2. Short Gap (3m - 15m)"), (901, "3. Medium Gap (15m - 1h)"), (3600, "3. Medium Gap (15m - 1h)"), (3601, "4. Long Gap (1h - 24h)"), (86400, "4. Long Gap (1h - 24h)"), (86401, "5. Extended Dropout (> 24h)")])
def test_gap_categories(spark, seconds, name):
    assert spark.range(1).select(forensics.gap_category(F.lit(seconds))).first()[0] == name


def test_profiles(spark):
    df = readings(spark, [{"ts": f"2024-01-01 00:{3 * i:02d}:00", "t_kwh": x} for i, x in enumerate((0.0, 0.1, 0.2, 0.3))])
    p = profile.numeric_profile(df).first()
    assert (p.rows, p.t_kwh_zeros, p.t_kwh_max, p.voltage_spikes) == (4, 1, 0.3, 0)
    assert {r.p: r.value for r in profile.quantiles(df, "t_kwh", (0.5,), accuracy=None).collect()} == {0.5: pytest.approx(0.15)}
    assert profile.quantiles(df, "t_kwh", (0.5,), accuracy=1000).count() == 1
    s = forensics.signal(df, "t_kwh", READINGS).first()
    assert s.lag1 == pytest.approx(1.0) and s.zero_pct == 25.0 and s.cv == pytest.approx(s.std / s["mean"])
    c = forensics.coverage(df).first()
    assert (c.expected, c.coverage_pct) == (4, 100.0)
    silent = forensics.signal(df.withColumn("t_kwh", F.lit(0.0)), "t_kwh", READINGS).first()
    assert (silent.cv, silent.snr, silent.snr_db) == (0.0, 0.0, 0.0)
    ref = df.withColumn("t_kwh", F.col("t_kwh") * 1.001)
    assert forensics.reconciled(df, ref, ["ts"], "t_kwh").filter("within").count() == 4
    assert resample.resampled(df, "15 minutes").first().samples == 4 and profile.duplicate_keys(df.union(df)).first().surplus_rows == 4
    assert HOURS.at("t").time == "t"
