"""Named queries over the given tables, each with the SQL that gives the same rows.

Telemetry is made from the event table (sources.telemetry); hours expect four samples there. Values are rounded more finely than the
layers' own digits, so that no engine meets an exact tie.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsed_time, share, usable_energy
from ..operators import baselines, features, forensics, ml, profile, quality, resample, states
from ..operators.splits import split_of
from ..schema import FEATURES, HOURS, READINGS
from ..sources import table, telemetry, typed, united
from . import pipelines
from .pipelines import Config


CONFIG = Config(
    hours=resample.ResamplePolicy(expected=4.0, complete_at=3, energy_digits=12, ratio_digits=12, mean_digits=10),
    features=features.FeaturePolicy(digits=9, ratio_digits=9),
    survivor_order=("event_id",),
)

#: The sketch of quantiles is exact up to so many rows; the layers' own default is coarser.
RANKS = 1_000_000
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def _readings(spark: SparkSession, d: str) -> DataFrame:
    return telemetry(table(spark, d, "events"))


def _silver(spark, d):
    return pipelines.silver(_readings(spark, d), CONFIG)


def _gold(spark, d):
    return pipelines.gold(_readings(spark, d), CONFIG)


def _features(spark, d):
    return pipelines.features(_readings(spark, d), CONFIG)


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded; other columns as they are."""
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


# -- shared SQL --------------------------------------------------------------------------------------------------------

TEL = """tel AS (SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN 'A' ELSE 'B' END AS district, event_type AS meter_id, ts,
  CAST(year(ts) AS INT) AS file_year, value / 1000e0 AS t_kwh, CAST(json_extract_string(props, '$.k') AS INT) AS k,
  value / 10e0 AS tenth FROM events),
raw AS (SELECT event_id, district, meter_id, ts, file_year, t_kwh,
  CASE WHEN k % 12 = 0 THEN 0e0 ELSE 170e0 + 1.4e0 * k END AS voltage, CASE WHEN k % 7 = 0 THEN 0e0 ELSE tenth END AS current,
  CASE WHEN k % 12 = 0 THEN 0e0 WHEN k = 13 THEN 19.4e0 ELSE 50e0 END AS freq FROM tel)"""
REASONS = """rated AS (SELECT *, concat_ws('; ',
  CASE WHEN ts IS NULL THEN 'INVALID_OR_UNPARSEABLE_TIMESTAMP' END,
  CASE WHEN coalesce(meter_id, '') = '' THEN 'EMPTY_OR_NULL_METER_ID' END,
  CASE WHEN t_kwh IS NULL THEN 'NULL_ACTIVE_ENERGY' END, CASE WHEN t_kwh < 0e0 OR t_kwh > 0.5e0 THEN 'ACTIVE_ENERGY_OUT_OF_BOUNDS' END,
  CASE WHEN voltage IS NULL THEN 'NULL_VOLTAGE' END, CASE WHEN voltage < 0e0 OR voltage > 700e0 THEN 'VOLTAGE_OUT_OF_BOUNDS' END,
  CASE WHEN current IS NULL THEN 'NULL_CURRENT' END, CASE WHEN current < 0e0 OR current > 150e0 THEN 'CURRENT_OUT_OF_BOUNDS' END,
  CASE WHEN freq IS NULL THEN 'NULL_FREQUENCY' END, CASE WHEN freq < 0e0 OR (freq > 0e0 AND freq < 40e0) OR freq > 60e0 THEN 'FREQUENCY_OUT_OF_BOUNDS' END)
  AS reason FROM raw)"""
SILVER_SQL = """silver AS (SELECT *, CASE WHEN voltage = 0 THEN 1 WHEN voltage >= 180 AND current <= 0.05e0 AND t_kwh = 0 THEN 2 WHEN voltage > 0 AND voltage < 180 THEN 3
  WHEN voltage BETWEEN 180 AND 260 THEN 4 WHEN voltage > 260 THEN 5 ELSE 6 END AS operating_state,
  CAST(voltage = 0 AS INT) AS is_outage, CAST(voltage >= 180 AND current <= 0.05e0 AND t_kwh = 0 AS INT) AS is_standby,
  CAST(voltage > 0 AND voltage < 180 AS INT) AS is_brownout, CAST(voltage > 260 AND voltage <= 300 AS INT) AS is_voltage_high,
  CAST(voltage > 300 AS INT) AS is_voltage_spike, CAST(t_kwh > 0.3e0 AS INT) AS is_extreme_load
  FROM rated WHERE reason = '' QUALIFY row_number() OVER (PARTITION BY district, meter_id, ts ORDER BY event_id) = 1)"""
GOLD_SQL = """sums AS (SELECT district, meter_id, date_trunc('hour', ts) AS window_start, min(file_year) AS file_year, sum(t_kwh) AS e, count(*) AS n, avg(voltage) AS v,
  avg(current) AS i, avg(freq) AS f, sum(is_outage) AS o, sum(is_standby) AS s, sum(is_brownout) AS b, count_if(voltage > 270) AS p FROM silver GROUP BY ALL),
gold AS (SELECT district, meter_id, window_start, window_start + INTERVAL 1 HOUR AS window_end, file_year, round(e * (4e0 / n), 12) AS hourly_kwh, round(e, 12) AS raw_kwh_sum,
  CAST(n AS INT) AS sample_count, round(v, 10) AS mean_voltage, round(i, 10) AS mean_current, round(f, 10) AS mean_freq, round(CAST(o AS DOUBLE) / n, 12) AS outage_ratio,
  round(CAST(s AS DOUBLE) / n, 12) AS standby_ratio, round(CAST(b AS DOUBLE) / n, 12) AS brownout_ratio, round(CAST(p AS DOUBLE) / n, 12) AS spike_ratio,
  CAST(n >= 3 AS INT) AS is_complete_hour, CAST(round(CAST(o AS DOUBLE) / n, 12) >= 0.5e0 AS INT) AS is_outage_hour,
  CAST(n >= 3 AND round(CAST(o AS DOUBLE) / n, 12) < 0.5e0 AS INT) AS is_valid_forecast_target FROM sums)"""
FEATURE_SQL = """moved AS (SELECT *, hourly_kwh AS lag_0h, lag(hourly_kwh, 1) OVER w AS lag_1h, lag(hourly_kwh, 2) OVER w AS lag_2h, lag(hourly_kwh, 24) OVER w AS lag_24h,
  lag(hourly_kwh, 168) OVER w AS lag_168h, round(avg(hourly_kwh) OVER r, 9) AS rolling_mean_24h, round(stddev_samp(hourly_kwh) OVER r, 9) AS rolling_std_24h,
  round(max(hourly_kwh) OVER r, 9) AS rolling_max_24h, round(min(hourly_kwh) OVER r, 9) AS rolling_min_24h, round(avg(outage_ratio) OVER r, 9) AS rolling_outage_ratio_24h,
  lead(window_start) OVER w = window_start + INTERVAL 1 HOUR AS follows, lead(hourly_kwh) OVER w AS next_kwh, lead(is_complete_hour) OVER w AS next_complete,
  lead(is_outage_hour) OVER w AS next_outage, lead(is_valid_forecast_target) OVER w AS next_valid, window_start + INTERVAL 1 HOUR AS target_window_start FROM gold
  WINDOW w AS (PARTITION BY district, meter_id ORDER BY window_start), r AS (PARTITION BY district, meter_id ORDER BY window_start ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)),
made AS (SELECT *, CAST(hour(target_window_start) AS INT) AS target_hour, CAST(dayofweek(target_window_start) + 1 AS INT) AS target_dow,
  CAST(month(target_window_start) AS INT) AS target_month, CASE WHEN follows THEN next_kwh END AS target_hourly_kwh, CASE WHEN follows THEN next_complete END AS target_is_complete,
  CASE WHEN follows THEN next_outage END AS target_is_outage, coalesce(CASE WHEN follows THEN next_valid END, 0) AS target_is_valid,
  CAST(lag_0h IS NOT NULL AND lag_1h IS NOT NULL AND lag_2h IS NOT NULL AND lag_24h IS NOT NULL AND lag_168h IS NOT NULL AND rolling_mean_24h IS NOT NULL
  AND rolling_std_24h IS NOT NULL AS INT) AS has_complete_history, CASE WHEN target_window_start < TIMESTAMP '2024-01-21' THEN 'TRAIN'
  WHEN target_window_start < TIMESTAMP '2024-01-26' THEN 'VAL' ELSE 'TEST' END AS split FROM moved),
feat AS (SELECT district, meter_id, window_start, target_window_start, split, CASE WHEN district = 'A' THEN 0e0 ELSE 1e0 END AS district_idx, lag_0h, lag_1h, lag_2h, lag_24h, lag_168h,
  rolling_mean_24h, rolling_std_24h, rolling_max_24h, rolling_min_24h, target_hour, target_dow, target_month, CAST(target_dow IN (1, 7) AS INT) AS target_is_weekend,
  sin(2 * pi() * target_hour / 24) AS hour_sin, cos(2 * pi() * target_hour / 24) AS hour_cos, sin(2 * pi() * (target_dow - 1) / 7) AS dow_sin, cos(2 * pi() * (target_dow - 1) / 7) AS dow_cos,
  sin(2 * pi() * (target_month - 1) / 12) AS month_sin, cos(2 * pi() * (target_month - 1) / 12) AS month_cos, mean_voltage AS mean_voltage_t, mean_current AS mean_current_t,
  mean_freq AS mean_freq_t, outage_ratio AS outage_ratio_t, standby_ratio AS standby_ratio_t, brownout_ratio AS brownout_ratio_t, spike_ratio AS spike_ratio_t, rolling_outage_ratio_24h,
  target_hourly_kwh, target_is_complete, target_is_outage, target_is_valid, has_complete_history,
  CAST(has_complete_history = 1 AND target_is_valid = 1 AND target_hourly_kwh IS NOT NULL AS INT) AS is_valid_forecast_instance FROM made)"""
ALIGNED_SQL = """ok AS (SELECT district, meter_id, window_start, CASE WHEN target_is_valid = 1 AND isfinite(target_hourly_kwh) AND target_hourly_kwh >= 0 THEN target_hourly_kwh END AS y FROM feat),
aligned AS (SELECT f.*, f.lag_0h AS b1_pred, a.y AS b2_pred, b.y AS b3_pred, f.rolling_mean_24h AS b4_pred FROM feat f
  LEFT JOIN ok a ON a.district = f.district AND a.meter_id = f.meter_id AND a.window_start + INTERVAL 24 HOUR = f.window_start
  LEFT JOIN ok b ON b.district = f.district AND b.meter_id = f.meter_id AND b.window_start + INTERVAL 168 HOUR = f.window_start
  WHERE f.is_valid_forecast_instance = 1 AND f.split IN ('TRAIN', 'VAL'))"""


def _sql(*parts: str, body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


_raw = partial(_sql, TEL)
_rated = partial(_sql, TEL, REASONS)
_silver_sql = partial(_sql, TEL, REASONS, SILVER_SQL)
_gold_sql = partial(_sql, TEL, REASONS, SILVER_SQL, GOLD_SQL)
_feature_sql = partial(_sql, TEL, REASONS, SILVER_SQL, GOLD_SQL, FEATURE_SQL)
_aligned_sql = partial(_sql, TEL, REASONS, SILVER_SQL, GOLD_SQL, FEATURE_SQL, ALIGNED_SQL)


def _is_angle(c: str) -> bool:
    return c.endswith(("_sin", "_cos"))


def _shown(columns) -> str:
    """Columns for SQL; sines and cosines rounded, all else as the layers round it."""
    return ", ".join(f"round({c}, 9) AS {c}" if _is_angle(c) else c for c in columns)


# -- scans and projections ---------------------------------------------------------------------------------------------


@query("q_scan_project", _raw(body="SELECT event_id, district, meter_id, ts, file_year, t_kwh, voltage, current, freq FROM raw"))
def q_scan_project(spark, d):
    return _readings(spark, d).withColumn("meter_id", F.trim("meter_id"))


@query(
    "q_multiformat_parse",
    """SELECT event_id, coalesce(try_strptime(t, '%Y-%m-%d %H:%M:%S'), try_strptime(t, '%Y-%m-%d %H:%M'), try_strptime(t, '%d-%m-%Y %H:%M:%S'), try_strptime(t, '%d-%m-%Y %H:%M')) AS ts
    FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 2 THEN strftime(ts, '%d-%m-%Y %H:%M:%S')
    WHEN 3 THEN strftime(ts, '%d-%m-%Y %H:%M') ELSE 'no time' END AS t FROM events)""",
)
def q_multiformat_parse(spark, d):
    kinds = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy HH:mm")
    text = F.lit("no time")
    for i, k in enumerate(kinds):
        text = F.when(F.col("event_id") % 5 == i, F.date_format("ts", k)).otherwise(text)
    return table(spark, d, "events").select("event_id", parsed_time(text, ntz=True).alias("ts"))


@query(
    "q_untyped_cast",
    """SELECT event_id, try_cast(CASE WHEN event_id % 10 = 0 THEN 'abc' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS t_kwh,
    try_strptime(strftime(ts, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS ts, CAST(ts >= TIMESTAMP '2024-01-15 00:00:00' AS INT) AS second_half FROM events""",
)
def q_untyped_cast(spark, d):
    text = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, "abc").otherwise(F.col("value").cast("string")).alias("t_kwh"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))
    out = typed(text).withColumn("ts", parsed_time(F.col("ts"), ("yyyy-MM-dd HH:mm:ss",), ntz=True))
    return out.withColumn("second_half", (F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).cast("int"))


# -- validation and states ---------------------------------------------------------------------------------------------


_DATES = "CASE WHEN ts < TIMESTAMP '2024-01-02' OR ts > TIMESTAMP '2024-01-29' THEN 'TIMESTAMP_OUT_OF_BOUNDS' END,\n  CASE WHEN coalesce(meter_id"


@query("q_quarantine_reasons", _sql(TEL, REASONS.replace("CASE WHEN coalesce(meter_id", _DATES), body="SELECT reason AS rejection_reason, CAST(count(*) AS BIGINT) AS n FROM rated WHERE reason <> '' GROUP BY 1"))
def q_quarantine_reasons(spark, d):
    rules = quality.reading_rules(quality.Limits(first="2024-01-02 00:00:00", last="2024-01-29 00:00:00"))
    rows = quality.assessed(_readings(spark, d), rules)
    return quality.quarantined(rows).groupBy("rejection_reason").agg(F.count("*").alias("n"))


@query("q_valid_split", _rated(body="SELECT event_id, reason = '' AS is_valid FROM rated"))
def q_valid_split(spark, d):
    rows = quality.assessed(_readings(spark, d), quality.reading_rules())
    good = quality.sound(rows).select("event_id", F.lit(True).alias("is_valid"))
    return good.unionByName(quality.quarantined(rows).select("event_id", F.lit(False).alias("is_valid")))


@query(
    "q_dedup",
    _raw(body="SELECT event_id, district, meter_id, ts, t_kwh FROM (SELECT * FROM raw UNION ALL SELECT * FROM raw) QUALIFY row_number() OVER (PARTITION BY district, meter_id, ts ORDER BY event_id) = 1"),
)
def q_dedup(spark, d):
    rows = _readings(spark, d)
    return quality.distinct_readings(united([rows, rows]), order=("event_id",)).select("event_id", "district", "meter_id", "ts", "t_kwh")


_SILVER_COLUMNS = "district, meter_id, ts, file_year, t_kwh, voltage, current, freq, operating_state, is_outage, is_standby, is_brownout, is_voltage_high, is_voltage_spike, is_extreme_load"


@query("q_state_classify", _silver_sql(body=f"SELECT {_SILVER_COLUMNS} FROM silver"))
def q_state_classify(spark, d):
    return _silver(spark, d)


@query("q_state_dist", _silver_sql(body="SELECT operating_state AS state, CAST(count(*) AS BIGINT) AS rows, round(avg(t_kwh), 9) AS mean_kwh, round(avg(voltage), 9) AS mean_voltage FROM silver GROUP BY 1"))
def q_state_dist(spark, d):
    return _rounded(profile.state_distribution(_silver(spark, d), F.col("operating_state")))


@query(
    "q_forensic_states",
    _raw(body="""SELECT state, CAST(count(*) AS BIGINT) AS rows, round(avg(t_kwh), 9) AS mean_kwh, round(avg(voltage), 9) AS mean_voltage FROM (SELECT *, CASE WHEN voltage = 0 AND freq = 0 THEN 'State 1: Grid Outage / Blackout'
    WHEN voltage >= 180 AND current <= 0.05e0 AND t_kwh = 0 THEN 'State 2: Voluntary Standby / Idle' WHEN voltage > 0 AND voltage < 180 THEN 'State 3: Brownout Supply' WHEN voltage BETWEEN 180 AND 260 THEN 'State 4: Normal Active Operation'
    WHEN voltage > 260 THEN 'State 5: Overvoltage Transient / Spike' ELSE 'State 6: Other Intermediate' END AS state FROM raw) GROUP BY 1"""),
)
def q_forensic_states(spark, d):
    return _rounded(profile.state_distribution(_readings(spark, d), states.forensic_state()))


@query("q_policy_flags", _raw(body="SELECT event_id, CAST(current > 50.0e0 AS INT) AS is_overcurrent, CAST(freq < 49.5e0 OR freq > 50.5e0 AS INT) AS is_frequency_abnormal, CAST(ts >= TIMESTAMP '2024-01-02' AND ts < TIMESTAMP '2024-01-29' AS INT) AS is_valid_timestamp FROM raw"))
def q_policy_flags(spark, d):
    return _readings(spark, d).select("event_id", *[c.alias(n) for n, c in states.policy_flags(dates=("2024-01-02 00:00:00", "2024-01-29 00:00:00")).items()])


@query(
    "q_zero_states",
    _raw(body="""SELECT CAST(count_if(t_kwh = 0 AND voltage > 180 AND current = 0) AS BIGINT) AS standby, CAST(count_if(voltage = 0 AND freq = 0 AND t_kwh = 0) AS BIGINT) AS blackout,
    CAST(count_if(voltage = 0 AND freq = 0) AS BIGINT) AS dark, CAST(count_if(voltage >= 180 AND current <= 0.05e0 AND t_kwh = 0) AS BIGINT) AS silver_standby FROM raw"""),
)
def q_zero_states(spark, d):
    z = states.ZeroStates()
    return _readings(spark, d).agg(*z.counts(True), z.counts(False)[1].alias("dark"), F.count_if((F.col("voltage") >= 180) & (F.col("current") <= 0.05) & (F.col("t_kwh") == 0)).alias("silver_standby"))


@query("q_finite_filter", "SELECT event_id, value FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN CAST('nan' AS DOUBLE) WHEN 2 THEN CAST('inf' AS DOUBLE) WHEN 3 THEN -value END AS value FROM events) WHERE isfinite(value) AND value >= 0")
def q_finite_filter(spark, d):
    m = F.col("event_id") % 5
    value = F.when(m == 0, F.col("value")).when(m == 1, F.lit(float("nan"))).when(m == 2, F.lit(float("inf"))).when(m == 3, -F.col("value"))
    return table(spark, d, "events").select("event_id", value.alias("value")).filter(usable_energy(F.col("value")))


# -- resampling --------------------------------------------------------------------------------------------------------


@query("q_gold_hourly", _gold_sql(body="SELECT * FROM gold"))
def q_gold_hourly(spark, d):
    return _gold(spark, d)


def _resample(name: str, width: str, bucket: str):
    @query(name, _silver_sql(body=f"SELECT district, meter_id, {bucket} AS window_start, round(sum(t_kwh), 10) AS energy, CAST(count(*) AS BIGINT) AS samples FROM silver GROUP BY ALL"))
    def run(spark, d):
        return _rounded(resample.resampled(_silver(spark, d), width), 10)


_resample("q_resample_15m", "15 minutes", "time_bucket(INTERVAL 15 MINUTE, ts)")
_resample("q_resample_30m", "30 minutes", "time_bucket(INTERVAL 30 MINUTE, ts)")
_resample("q_resample_1h", "1 hour", "date_trunc('hour', ts)")


@query("q_conservation", _gold_sql(body="SELECT round((SELECT sum(t_kwh) FROM silver), 6) AS readings_kwh, round((SELECT sum(raw_kwh_sum) FROM gold), 6) AS hours_kwh, true AS conserved"))
def q_conservation(spark, d):
    silver = _silver(spark, d)
    got = resample.conservation(silver, resample.hourly(silver, CONFIG.hours))
    return got.select(F.round("readings_kwh", 6).alias("readings_kwh"), F.round("hours_kwh", 6).alias("hours_kwh"), (F.col("difference") < 1e-3).alias("conserved"))


# -- profiles ----------------------------------------------------------------------------------------------------------

_M = ("t_kwh", "voltage", "current", "freq")


@query(
    "q_profile_numeric",
    _raw(
        body="SELECT CAST(count(*) AS BIGINT) AS rows, "
        + ", ".join(f"min({c}) AS {c}_min, max({c}) AS {c}_max, round(avg({c}), 9) AS {c}_avg, CAST(count_if({c} = 0) AS BIGINT) AS {c}_zeros, CAST(count_if({c} < 0) AS BIGINT) AS {c}_negatives" for c in _M)
        + ", CAST(count_if(voltage > 300) AS BIGINT) AS voltage_spikes FROM raw"
    ),
)
def q_profile_numeric(spark, d):
    got = profile.numeric_profile(_readings(spark, d))
    return got.select(*[F.round(c, 9).alias(c) if c.endswith("_avg") else F.col(c) for c in got.columns])


@query("q_missing_tokens", "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL OR CAST({c} AS VARCHAR) IN ('', 'null', 'NaN')) AS BIGINT) AS {c}" for c in ("event_id", "user_id", "event_type", "value", "props")) + " FROM events")
def q_missing_tokens(spark, d):
    return profile.missing_tokens(table(spark, d, "events"), ["event_id", "user_id", "event_type", "value", "props"])


@query("q_dup_keys", "SELECT CAST(count(*) AS BIGINT) AS duplicate_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS surplus_rows FROM (SELECT event_type, date_trunc('minute', ts) AS t, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1)")
def q_dup_keys(spark, d):
    rows = table(spark, d, "events").select("event_type", F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("t"))
    return profile.duplicate_keys(rows, READINGS.__class__(("event_type",), "t"))


@query("q_distinct_entities", _raw(body="SELECT DISTINCT meter_id FROM raw WHERE meter_id IS NOT NULL"))
def q_distinct_entities(spark, d):
    return profile.entities(_readings(spark, d))


@query("q_raw_bounds", "SELECT min(t) AS first, max(t) AS last, CAST(count(t) AS BIGINT) AS present FROM (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events)")
def q_raw_bounds(spark, d):
    return profile.text_bounds(table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_str")))


@query("q_series_lifespan", _raw(body="""SELECT district, meter_id, CAST(count(*) AS BIGINT) AS readings, min(ts) AS first, max(ts) AS last, round(avg(t_kwh), 9) AS mean_kwh,
    CAST(count_if(voltage = 0 AND freq = 0) AS BIGINT) AS outages, CAST(count_if(t_kwh = 0 AND voltage > 180 AND current = 0) AS BIGINT) AS standbys, round((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400, 1) AS lifespan_days FROM raw GROUP BY ALL"""))  # fmt: skip
def q_series_lifespan(spark, d):
    return _rounded(forensics.lifespans(_readings(spark, d)))


@query("q_time_bounds", _raw(body="SELECT min(ts) AS first, max(ts) AS last, CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 180) + 1 AS BIGINT) AS slots FROM raw"))
def q_time_bounds(spark, d):
    return forensics.time_bounds(_readings(spark, d))


@query(
    "q_coverage",
    _raw(body="""SELECT district, meter_id, readings, expected, round(readings * 100e0 / expected, 4) AS coverage_pct, round(readings * 100e0 / slots, 4) AS global_coverage_pct,
    round(o * 100e0 / readings, 4) AS outage_pct, round(s * 100e0 / readings, 4) AS standby_pct
    FROM (SELECT district, meter_id, CAST(count(*) AS BIGINT) AS readings, count_if(voltage = 0 AND freq = 0) AS o, count_if(t_kwh = 0 AND voltage > 180 AND current = 0) AS s, CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 180) + 1 AS BIGINT) AS expected FROM raw GROUP BY ALL),
    (SELECT CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 180) + 1 AS BIGINT) AS slots FROM raw)"""),
)
def q_coverage(spark, d):
    return forensics.coverage(_readings(spark, d)).select("district", "meter_id", "readings", "expected", "coverage_pct", "global_coverage_pct", "outage_pct", "standby_pct")


@query(
    "q_gap_distribution",
    _raw(body="""SELECT category, CAST(count(*) AS BIGINT) AS gaps, min(delta) AS least, max(delta) AS most, round(avg(delta), 6) AS mean FROM (SELECT delta, CASE WHEN delta < 180 THEN '0. Anomaly (< 3 min)'
    WHEN delta = 180 THEN '1. Exact 3-min (Nominal)' WHEN delta <= 900 THEN '2. Short Gap (3m - 15m)' WHEN delta <= 3600 THEN '3. Medium Gap (15m - 1h)' WHEN delta <= 86400 THEN '4. Long Gap (1h - 24h)' ELSE '5. Extended Dropout (> 24h)' END AS category
    FROM (SELECT CAST(floor(epoch(ts)) AS BIGINT) - CAST(floor(epoch(lag(ts) OVER (PARTITION BY district, meter_id ORDER BY ts))) AS BIGINT) AS delta FROM raw) WHERE delta IS NOT NULL) GROUP BY 1"""),
)
def q_gap_distribution(spark, d):
    return _rounded(forensics.gap_distribution(_readings(spark, d)), 6)


@query(
    "q_district_compare",
    _raw(body="""SELECT district, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT meter_id) AS BIGINT) AS meters, round(avg(t_kwh), 9) AS mean_kwh, round(stddev_samp(t_kwh), 9) AS std_kwh,
    CAST(count_if(t_kwh = 0) AS BIGINT) AS zeros, CAST(count_if(voltage < 180) AS BIGINT) AS brownout_or_outage, round(avg(CASE WHEN voltage > 0 THEN voltage END), 9) AS energised_voltage FROM raw GROUP BY 1"""),
)
def q_district_compare(spark, d):
    return _rounded(forensics.district_comparison(_readings(spark, d)))


@query(
    "q_quantiles",
    _raw(body=" UNION ALL ".join(f"SELECT '{n}' AS population, CAST({p} AS DOUBLE) AS p, quantile_disc({c}, {p}) AS value FROM raw WHERE {w}" for n, c, w in (("energy", "t_kwh", "true"), ("active_energy", "t_kwh", "t_kwh > 0"), ("voltage", "voltage", "voltage > 0")) for p in profile.PROBABILITIES)),
)
def q_quantiles(spark, d):
    return profile.energy_and_voltage_quantiles(_readings(spark, d), RANKS)


@query(
    "q_moments",
    _raw(body="""SELECT min(t_kwh) AS min, max(t_kwh) AS max, round(avg(t_kwh), 9) AS mean, round(stddev_samp(t_kwh), 9) AS std, round(var_samp(t_kwh), 9) AS variance,
    round(skewness(t_kwh) * (count(*) - 2) / sqrt(CAST(count(*) AS DOUBLE) * (count(*) - 1)), 6) AS skewness FROM raw"""),
)
def q_moments(spark, d):
    got = profile.moments(_readings(spark, d), "t_kwh")
    return got.select("min", "max", *[F.round(c, 9).alias(c) for c in ("mean", "std", "variance")], F.round("skewness", 6).alias("skewness"))


@query(
    "q_voltage_bands",
    _raw(body="""SELECT CAST(count(*) AS BIGINT) AS rows, round(avg(voltage), 9) AS mean_voltage, round(avg(CASE WHEN voltage > 0 THEN voltage END), 9) AS energised_mean, round(avg(CASE WHEN freq > 0 THEN freq END), 9) AS energised_freq, round(avg(current), 9) AS mean_current, round(max(current), 9) AS max_current, CAST(count_if(voltage = 0) AS BIGINT) AS outage,
    CAST(count_if(voltage > 0 AND voltage < 180) AS BIGINT) AS below_180, CAST(count_if(voltage >= 180 AND voltage < 200) AS BIGINT) AS from_180_to_200,
    CAST(count_if(voltage >= 200 AND voltage <= 250) AS BIGINT) AS from_200_to_250, CAST(count_if(voltage > 250 AND voltage <= 270) AS BIGINT) AS from_250_to_270,
    CAST(count_if(voltage > 270) AS BIGINT) AS over_270, CAST(count_if(voltage > 300) AS BIGINT) AS over_300, CAST(count_if(freq >= 49.9e0 AND freq <= 50.05e0) AS BIGINT) AS freq_near_50 FROM raw"""),
)
def q_voltage_bands(spark, d):
    return _rounded(profile.voltage_bands(_readings(spark, d)))


_SIGNAL = """SELECT CAST(count(*) AS BIGINT) AS rows, round(avg(x), 9) AS mean, round(stddev_samp(x), 9) AS std, round(var_samp(x), 9) AS variance, CAST(count_if(x = 0) AS BIGINT) AS zeros,
  round(corr(CASE WHEN b IS NOT NULL THEN x END, b), 7) AS lag1, round(stddev_samp(x) / avg(x), 9) AS cv, round(avg(x) / stddev_samp(x), 9) AS snr, round(count_if(x = 0) * 100e0 / count(*), 9) AS zero_pct,
  round(20 * log10(avg(x) / stddev_samp(x)), 6) AS snr_db"""


def _signal(df: DataFrame) -> DataFrame:
    digits = {"lag1": 7, "snr_db": 6}
    return df.select(*[F.round(c, digits.get(c, 9)).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])


@query("q_lag1_autocorr", _silver_sql(body=_SIGNAL + " FROM (SELECT t_kwh AS x, lag(t_kwh) OVER (PARTITION BY district, meter_id ORDER BY ts) AS b FROM silver)"))
def q_lag1_autocorr(spark, d):
    return _signal(forensics.signal(_silver(spark, d), "t_kwh", READINGS))


@query("q_snr", _gold_sql(body=_SIGNAL + " FROM (SELECT hourly_kwh AS x, lag(hourly_kwh) OVER (PARTITION BY district, meter_id ORDER BY window_start) AS b FROM gold)"))
def q_snr(spark, d):
    return _signal(forensics.signal(_gold(spark, d), "hourly_kwh", HOURS))


# -- features ----------------------------------------------------------------------------------------------------------

_KEY = "district, meter_id, window_start"


def _feature_query(name: str, columns: tuple[str, ...]):
    @query(name, _feature_sql(body=f"SELECT {_KEY}, {_shown(columns)} FROM feat"))
    def run(spark, d):
        return _angles_rounded(_features(spark, d).select("district", "meter_id", "window_start", *columns))


def _angles_rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 9).alias(c) if _is_angle(c) else F.col(c) for c in df.columns])


_feature_query("q_lags", ("lag_0h", "lag_1h", "lag_2h", "lag_24h", "lag_168h"))
_feature_query("q_rolling24", ("rolling_mean_24h", "rolling_std_24h", "rolling_max_24h", "rolling_min_24h", "rolling_outage_ratio_24h"))
_feature_query("q_target_attach", ("target_window_start", "target_hourly_kwh", "target_is_complete", "target_is_outage", "target_is_valid"))
_feature_query("q_calendar", ("target_hour", "target_dow", "target_month", "target_is_weekend"))
_feature_query("q_fourier", ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos"))
_feature_query("q_context", ("mean_voltage_t", "mean_current_t", "mean_freq_t", "outage_ratio_t", "standby_ratio_t", "brownout_ratio_t", "spike_ratio_t", "district_idx"))
_feature_query("q_eligibility", ("has_complete_history", "is_valid_forecast_instance"))


@query("q_feature_store", _feature_sql(body=f"SELECT {_shown(FEATURES)} FROM feat"))
def q_feature_store(spark, d):
    return _angles_rounded(_features(spark, d))


@query("q_split", _feature_sql(body="SELECT split, CAST(count(*) AS BIGINT) AS rows, CAST(sum(is_valid_forecast_instance) AS BIGINT) AS eligible, min(target_window_start) AS first, max(target_window_start) AS last FROM feat GROUP BY 1"))
def q_split(spark, d):
    hours = _features(spark, d).withColumn("split", split_of(F.col("target_window_start"), CONFIG.splits))
    return hours.groupBy("split").agg(F.count("*").alias("rows"), F.sum("is_valid_forecast_instance").alias("eligible"), F.min("target_window_start").alias("first"), F.max("target_window_start").alias("last"))


@query("q_null_audit", _feature_sql(body="SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in FEATURES) + " FROM feat"))
def q_null_audit(spark, d):
    return profile.null_counts(_features(spark, d))


@query(
    "q_time_lags",
    _gold_sql(body=f"""SELECT {_KEY}, max(hourly_kwh) OVER (PARTITION BY district, meter_id ORDER BY window_start RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS lag_1h,
    max(hourly_kwh) OVER (PARTITION BY district, meter_id ORDER BY window_start RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND INTERVAL 24 HOUR PRECEDING) AS lag_24h FROM gold"""),
)
def q_time_lags(spark, d):
    return _gold(spark, d).select("district", "meter_id", "window_start", *[features.back("hourly_kwh", h, mode="time").alias(f"lag_{h}h") for h in (1, 24)])


@query(
    "q_multi_horizon",
    _gold_sql(body=f"""SELECT g.district, g.meter_id, g.window_start, a.hourly_kwh AS target_h1, b.hourly_kwh AS target_h24, c.hourly_kwh AS target_h168 FROM gold g
    {" ".join(f"LEFT JOIN gold {x} ON {x}.district = g.district AND {x}.meter_id = g.meter_id AND {x}.window_start = g.window_start + INTERVAL {h} HOUR" for x, h in (("a", 1), ("b", 24), ("c", 168)))}"""),
)
def q_multi_horizon(spark, d):
    return features.horizon_targets(_gold(spark, d)).select("district", "meter_id", "window_start", "target_h1", "target_h24", "target_h168")


# -- baselines ---------------------------------------------------------------------------------------------------------

_PRED = "b1_pred, b2_pred, b3_pred, b4_pred"


def _predictions(rows: DataFrame) -> DataFrame:
    return rows.select("district", "meter_id", "window_start", "split", "b1_pred", "b2_pred", "b3_pred", "b4_pred")


@query("q_b2_b3_align", _aligned_sql(body=f"SELECT {_KEY}, split, {_PRED} FROM aligned"))
def q_b2_b3_align(spark, d):
    return _predictions(baselines.aligned(_features(spark, d), guard=False))


@query("q_b2_b3_frames", _aligned_sql(body=f"SELECT {_KEY}, split, {_PRED} FROM aligned"))
def q_b2_b3_frames(spark, d):
    return _predictions(baselines.aligned_by_frames(_features(spark, d)))


_U = {b: f"coalesce(isfinite({b}_pred) AND {b}_pred >= 0, false)" for b in baselines.BASELINES}
_COMMON = "coalesce(isfinite(target_hourly_kwh) AND target_hourly_kwh >= 0, false) AND " + " AND ".join(_U.values())


@query(
    "q_cohort_audit",
    _aligned_sql(
        body="SELECT split, CAST(count(*) AS BIGINT) AS eligible, CAST(count_if("
        + _COMMON
        + ") AS BIGINT) AS common, "
        + ", ".join(f"CAST(count_if({u}) AS BIGINT) AS {b}_matched, round(count_if({u}) * 100e0 / count(*), 4) AS {b}_matched_pct" for b, u in _U.items())
        + f", CAST(count_if(NOT {_U['b2']} AND {_U['b3']}) AS BIGINT) AS only_b2_missing, CAST(count_if({_U['b2']} AND NOT {_U['b3']}) AS BIGINT) AS only_b3_missing, CAST(count_if(NOT {_U['b2']} AND NOT {_U['b3']}) AS BIGINT) AS both_missing, CAST(count(*) - count_if({_COMMON}) AS BIGINT) AS excluded, round(count_if({_COMMON}) * 100e0 / count(*), 4) AS common_pct FROM aligned GROUP BY 1"
    ),
)
def q_cohort_audit(spark, d):
    return baselines.cohort_audit(baselines.aligned_by_frames(_features(spark, d), guard=False))


_EACH = " UNION ALL ".join(f"SELECT split, '{b}' AS baseline, target_hourly_kwh AS y, {b}_pred AS p FROM cohort" for b in baselines.BASELINES)


@query(
    "q_metrics",
    _aligned_sql(
        f"cohort AS (SELECT * FROM aligned WHERE {_COMMON}), each_one AS ({_EACH}), sums2 AS (SELECT split, baseline, count(*) AS n, sum(y) AS t, var_pop(y) * count(*) AS ss, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae FROM each_one GROUP BY ALL)",
        body="""SELECT split, baseline, CAST(n AS BIGINT) AS n, round(t / n, 6) AS mean_kwh, round(CASE WHEN n > 1 THEN sqrt(ss / (n - 1)) ELSE 0 END, 6) AS std_kwh, round(sse, 6) AS sse, round(sae, 6) AS sae,
    round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae, CASE WHEN ss > 0 THEN round(1 - sse / ss, 6) ELSE CAST('nan' AS DOUBLE) END AS r2,
    CASE WHEN t > 0 THEN round(sae / t * 100, 4) ELSE CAST('nan' AS DOUBLE) END AS wape, CASE WHEN t > 0 THEN round(sqrt(sse / n) / (t / n) * 100, 4) ELSE CAST('nan' AS DOUBLE) END AS nrmse FROM sums2""",
    ),
)
def q_metrics(spark, d):
    return baselines.metrics(baselines.aligned_by_frames(_features(spark, d), guard=False))


# -- series, reconciliation, ordering ----------------------------------------------------------------------------------


@query(
    "q_series_profile",
    _gold_sql(body="""SELECT a.*, round(m, 9) AS mean_daily_kwh, round(s, 9) AS brownout_share FROM (SELECT district, meter_id, round(quantile_disc(hourly_kwh, 0.5), 9) AS median_kwh, round(stddev_samp(hourly_kwh) / avg(hourly_kwh), 9) AS cv,
    round(max(hourly_kwh) / avg(hourly_kwh), 9) AS peak_to_average, round(sum(CASE WHEN hour(window_start) BETWEEN 6 AND 17 THEN hourly_kwh END) / sum(CASE WHEN NOT hour(window_start) BETWEEN 6 AND 17 THEN hourly_kwh END), 9) AS day_night,
    round(avg(CASE WHEN dayofweek(window_start) IN (0, 6) THEN hourly_kwh END) / avg(CASE WHEN NOT dayofweek(window_start) IN (0, 6) THEN hourly_kwh END), 9) AS weekend_weekday,
    CAST(sum(is_outage_hour) AS BIGINT) AS outage_hours FROM gold GROUP BY ALL) a JOIN (SELECT district, meter_id, avg(e) AS m FROM (SELECT district, meter_id,
    CAST(window_start AS DATE) AS day, sum(hourly_kwh) AS e FROM gold GROUP BY ALL) GROUP BY ALL) b USING (district, meter_id)
    JOIN (SELECT district, meter_id, avg(CAST(voltage < 200 AS INT)) AS s FROM silver GROUP BY ALL) c USING (district, meter_id)"""),
)
def q_series_profile(spark, d):
    silver = _silver(spark, d)
    return _rounded(forensics.customer_profile(resample.hourly(silver, CONFIG.hours), silver, HOURS, accuracy=RANKS))


@query(
    "q_reconcile",
    _gold_sql(body="""SELECT district, meter_id, round(f, 6) AS found, round(r, 6) AS reference, round(abs(f - r), 6) AS difference, abs(f - r) <= 0.05e0 * abs(r) AS within FROM
    (SELECT district, meter_id, sum(raw_kwh_sum) AS f FROM gold GROUP BY ALL) JOIN (SELECT district, meter_id, sum(t_kwh) AS r FROM raw GROUP BY ALL) USING (district, meter_id)"""),
)
def q_reconcile(spark, d):
    keys = ["district", "meter_id"]
    ours = _gold(spark, d).groupBy(*keys).agg(F.sum("raw_kwh_sum").alias("kwh"))
    given = _readings(spark, d).groupBy(*keys).agg(F.sum("t_kwh").alias("kwh"))
    return _rounded(forensics.reconciled(ours, given, keys, "kwh", 0.05), 6)


@query("q_topk", _gold_sql(body=f"SELECT {_KEY}, hourly_kwh FROM gold ORDER BY hourly_kwh DESC, {_KEY} LIMIT 20"))
def q_topk(spark, d):
    return _gold(spark, d).select("district", "meter_id", "window_start", "hourly_kwh").orderBy(F.desc("hourly_kwh"), "district", "meter_id", "window_start").limit(20)


@query("q_union", _raw(body="SELECT district, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT meter_id) AS BIGINT) AS meters FROM (SELECT district, meter_id FROM raw UNION ALL BY NAME SELECT meter_id, district FROM raw) GROUP BY 1"))
def q_union(spark, d):
    rows = _readings(spark, d)
    return united([rows.select("district", "meter_id"), rows.select("meter_id", "district")]).groupBy("district").agg(F.count("*").alias("rows"), F.count_distinct("meter_id").alias("meters"))


@query("q_share_of_states", _silver_sql(body="SELECT district, round(sum(is_outage) * 100e0 / count(*), 6) AS outage_pct, round(sum(is_standby) * 100e0 / count(*), 6) AS standby_pct, round(sum(is_brownout) * 100e0 / count(*), 6) AS brownout_pct FROM silver GROUP BY 1"))
def q_share_of_states(spark, d):
    n = F.count("*")
    return _silver(spark, d).groupBy("district").agg(*[F.round(share(F.sum(f"is_{c}"), n, 100.0), 6).alias(f"{c}_pct") for c in ("outage", "standby", "brownout")])
