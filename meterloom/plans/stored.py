"""More of the catalogue: tables written and read again, guards, drivers, models and streams.

Files go to a folder of their own, in the one that spark.checkpoint.dir names, and are written once for each session and input. Readings
come from CSV there, so their times are whole seconds and rows have no event_id: copies of a key are settled by all their columns.
"""

from __future__ import annotations

import json
import math
import tempfile
import uuid
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parsed_time
from ..operators import baselines, features, forensics, ml, quality, resample
from ..operators.features import FeaturePolicy
from ..schema import FEATURES, GOLD, HOURS, SILVER
from ..sources import canonical, inspect, read_csv, read_manifest, read_parquet, table, telemetry, typed, united
from ..streaming import stream_gold, stream_silver
from . import catalogue, pipelines
from .catalogue import ALIGNED_SQL, CONFIG, FEATURE_SQL, GOLD_SQL, REASONS, SILVER_SQL, TEL, _aligned_sql, _feature_sql, _features, _gold, _readings, _rounded, _shown, _silver_sql, _sql, query

_SECONDS = TEL.replace("raw AS (SELECT event_id, district, meter_id, ts,", "raw AS (SELECT event_id, district, meter_id, date_trunc('second', ts) AS ts,")
_SURVIVORS = SILVER_SQL.replace("ORDER BY event_id", "ORDER BY t_kwh, voltage, current, freq")
_file_rated = partial(_sql, _SECONDS, REASONS)
_file_silver = partial(_sql, _SECONDS, REASONS, _SURVIVORS)
_file_gold = partial(_sql, _SECONDS, REASONS, _SURVIVORS, GOLD_SQL)
_file_features = partial(_sql, _SECONDS, REASONS, _SURVIVORS, GOLD_SQL, FEATURE_SQL)
_file_aligned = partial(_sql, _SECONDS, REASONS, _SURVIVORS, GOLD_SQL, FEATURE_SQL, ALIGNED_SQL)
_FILES = replace(CONFIG, survivor_order=())
_made: dict[tuple, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share; local sessions without one get a temporary one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return f"{named.rstrip('/')}/stored-{uuid.uuid4().hex}" if named else "file://" + tempfile.mkdtemp(prefix="meterloom-")


def _once(spark: SparkSession, d: str, name: str, make) -> str:
    """The path of what make(path) has written; made once for each session and input."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _made:
        path = f"{scratch(spark)}/{name}"
        make(path)
        _made[key] = path
    return _made[key]


def _local_times(df: DataFrame) -> DataFrame:
    """Times without a zone, as the tables have them."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if kind == "timestamp" else F.col(c) for c, kind in df.dtypes])


# -- CSV ---------------------------------------------------------------------------------------------------------------


def _csv(spark: SparkSession, d: str) -> list[tuple[dict, str]]:
    """Raw files as they come from the meters, a folder for each district, and their manifest."""

    def make(path: str) -> None:
        rows = _readings(spark, d).select(
            "district", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("x_Timestamp"), F.col("t_kwh").alias("t_kWh"), F.col("voltage").alias("z_Avg Voltage (Volt)"),
            F.col("current").alias("z_Avg Current (Amp)"), F.col("freq").alias("y_Freq (Hz)"), F.concat(F.lit(" "), "meter_id", F.lit(" ")).alias("meter"),
        )
        rows.write.partitionBy("district").option("header", "true").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)

    root = _once(spark, d, "csv", make)
    return [({"district": x, "file_year": 2024}, f"{root}/district={x}") for x in ("A", "B")]


_COLUMNS = "district, meter_id, ts, file_year, t_kwh, voltage, current, freq"


@query("q_csv_manifest", _sql(_SECONDS, body=f"SELECT {_COLUMNS} FROM raw"))
def q_csv_manifest(spark, d):
    """CSV under a schema by a manifest: canonical names, constants of the files, trimmed ids, parsed times."""
    rows = read_manifest(spark, _csv(spark, d)).withColumn("ts", parsed_time(F.col("ts_str"), ntz=True))
    return rows.select(*_COLUMNS.split(", "))


@query("q_csv_untyped", _sql(_SECONDS, body="SELECT meter_id, ts, t_kwh, voltage, current, freq FROM raw"))
def q_csv_untyped(spark, d):
    """CSV without a schema: headers canonicalised, texts cast."""
    rows = united([typed(canonical(read_csv(spark, path, None))) for _, path in _csv(spark, d)])
    return rows.select(F.trim("meter_id").alias("meter_id"), parsed_time(F.col("ts_str"), ntz=True).alias("ts"), "t_kwh", "voltage", "current", "freq")


@query("q_inspect", "SELECT c.* FROM (SELECT CAST(count(*) AS BIGINT) AS rows FROM events), (SELECT * FROM (VALUES ('event_id', 'bigint'), ('ts', 'timestamp_ntz'), ('user_id', 'bigint'), ('event_type', 'string'), ('value', 'double'), ('props', 'string')) AS v(name, kind)) v2, LATERAL (SELECT name, kind, rows) c")
def q_inspect(spark, d):
    found = inspect(table(spark, d, "events"), 2)
    return spark.createDataFrame([(n, k, found["count"]) for n, k in found["schema"]], "name string, kind string, rows long")


@query("q_gap_boundaries", "SELECT * FROM (VALUES (179, '0. Anomaly (< 3 min)'), (180, '1. Exact 3-min (Nominal)'), (181, '2. Short Gap (3m - 15m)'), (900, '2. Short Gap (3m - 15m)'), (901, '3. Medium Gap (15m - 1h)'), (3600, '3. Medium Gap (15m - 1h)'), (3601, '4. Long Gap (1h - 24h)'), (86400, '4. Long Gap (1h - 24h)'), (86401, '5. Extended Dropout (> 24h)')) AS t(delta, category)")
def q_gap_boundaries(spark, d):
    """Rows from memory, at the bounds of the gap categories."""
    rows = spark.createDataFrame([(x,) for x in (179, 180, 181, 900, 901, 3600, 3601, 86400, 86401)], "delta int")
    return rows.select("delta", forensics.gap_category(F.col("delta")).alias("category"))


# -- layers ------------------------------------------------------------------------------------------------------------


def _silver_path(spark, d):
    return _once(spark, d, "silver", lambda p: pipelines.build_silver(spark, _csv(spark, d), p, f"{p}-quarantine", _FILES))


def _gold_path(spark, d):
    return _once(spark, d, "gold", lambda p: pipelines.build_gold(spark, _silver_path(spark, d), p, _FILES))


def _features_path(spark, d):
    return _once(spark, d, "features", lambda p: pipelines.build_features(spark, _gold_path(spark, d), p, _FILES))


@query("q_layer_silver", _file_silver(body=f"SELECT {', '.join(SILVER)} FROM silver"))
def q_layer_silver(spark, d):
    return _local_times(read_parquet(spark, _silver_path(spark, d)).select(*SILVER))


@query("q_layer_quarantine", _file_rated(body="SELECT reason AS rejection_reason, CAST(count(*) AS BIGINT) AS n FROM rated WHERE reason <> '' GROUP BY 1 UNION ALL SELECT 'DUPLICATE_KEY', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM rated WHERE reason = '' GROUP BY district, meter_id, ts) HAVING sum(n - 1) > 0"))
def q_layer_quarantine(spark, d):
    return read_parquet(spark, f"{_silver_path(spark, d)}-quarantine").groupBy("rejection_reason").agg(F.count("*").alias("n"))


@query("q_layer_gold", _file_gold(body=f"SELECT {', '.join(GOLD)} FROM gold"))
def q_layer_gold(spark, d):
    return _local_times(read_parquet(spark, _gold_path(spark, d)).select(*GOLD))


@query("q_layer_features", _file_features(body=f"SELECT {_shown(FEATURES)} FROM feat"))
def q_layer_features(spark, d):
    return catalogue._angles_rounded(_local_times(read_parquet(spark, _features_path(spark, d)).select(*FEATURES)))


@query(
    "q_report",
    _file_aligned(
        f"cohort AS (SELECT * FROM aligned WHERE {catalogue._COMMON}), each_one AS ({catalogue._EACH}), sums2 AS (SELECT split, baseline, count(*) AS n, sum(y) AS t, var_pop(y) * count(*) AS ss, sum((y - p) * (y - p)) AS sse, sum(abs(y - p)) AS sae FROM each_one GROUP BY ALL)",
        body="SELECT split, baseline, CAST(n AS BIGINT) AS n, round(sqrt(sse / n), 6) AS rmse, round(sae / n, 6) AS mae, round(1 - sse / ss, 6) AS r2, round(sae / t * 100, 4) AS wape, round(sqrt(sse / n) / (t / n) * 100, 4) AS nrmse FROM sums2",
    ),
)
def q_report(spark, d):
    """The evaluation's report, as its JSON file has it."""
    with tempfile.NamedTemporaryFile(suffix=".json") as f:
        pipelines.evaluate(spark, _features_path(spark, d), f.name)
        with open(f.name, encoding="utf-8") as g:
            report = json.load(g)
    rows = [(s, b, x["target_summary"]["n"], *(float(m[k]) for k in ("rmse", "mae", "r2", "wape", "nrmse"))) for s, x in report["splits"].items() for b, m in x["baselines"].items()]
    return spark.createDataFrame(rows, "split string, baseline string, n long, rmse double, mae double, r2 double, wape double, nrmse double")


@query("q_empty_cohort", "SELECT 'VAL' AS split, CAST(0 AS BIGINT) AS eligible, CAST(0 AS BIGINT) AS common, CAST(0 AS BIGINT) AS n, 0e0 AS sum_kwh, CAST(0 AS BIGINT) AS baselines")
def q_empty_cohort(spark, d):
    """A split in which no row has all forecasts."""
    got = baselines.evaluated(baselines.aligned_by_frames(_features(spark, d).filter("is_valid_forecast_instance = 0")), "VAL")
    return spark.createDataFrame([("VAL", got["cohort_audit"]["eligible"], got["cohort_audit"]["common"], got["target_summary"]["n"], got["target_summary"]["sum_kwh"], len(got["baselines"]))], "split string, eligible long, common long, n long, sum_kwh double, baselines long")


_KEY_OK = "(SELECT count(*) = count(DISTINCT (district, meter_id, window_start)) AND count_if(district IS NULL OR meter_id IS NULL OR window_start IS NULL) = 0 FROM {})"


@query(
    "q_guards",
    _feature_sql(
        "twice AS (SELECT district, meter_id, window_start FROM gold UNION ALL SELECT district, meter_id, window_start FROM gold), holed AS (SELECT district, CASE WHEN sample_count > 0 THEN NULL ELSE meter_id END AS meter_id, window_start FROM gold)",
        body=f"""SELECT 'keys are unique' AS name, {_KEY_OK.format("gold")} AS passed UNION ALL SELECT 'keys occur twice', {_KEY_OK.format("twice")} UNION ALL SELECT 'keys have nulls', {_KEY_OK.format("holed")}
    UNION ALL SELECT 'rows are as many', (SELECT count(*) FROM feat) = (SELECT count(*) FROM gold) UNION ALL SELECT 'rows are fewer', (SELECT count(*) FROM feat) = (SELECT count(*) + 1 FROM gold)
    UNION ALL SELECT 'rows are none', (SELECT count(*) > 0 FROM feat WHERE false)
    UNION ALL SELECT 'features hold', (SELECT count_if(split IS NULL OR (is_valid_forecast_instance = 1 AND (lag_168h IS NULL OR target_hourly_kwh IS NULL))) = 0 FROM feat) UNION ALL SELECT 'features lack a split', (SELECT count(*) = 0 FROM feat)""",
    ),
)
def q_guards(spark, d):
    """Guards on sound tables and on broken ones: whether each lets its table pass."""

    def passes(f, *args) -> bool:
        try:
            f(*args)
        except ValueError:
            return False
        return True

    hours, made = _gold(spark, d).persist(), _features(spark, d).persist()
    try:
        n = hours.count()
        found = {
            "keys are unique": passes(quality.require_unique, hours, HOURS),
            "keys occur twice": passes(quality.require_unique, hours.union(hours), HOURS),
            "keys have nulls": passes(quality.require_unique, hours.withColumn("meter_id", F.when(F.col("sample_count") > 0, None).otherwise(F.col("meter_id"))), HOURS),
            "rows are as many": passes(quality.require_rows, made, n),
            "rows are fewer": passes(quality.require_rows, made, n + 1),
            "rows are none": passes(quality.require_rows, made.filter("false")),
            "features hold": passes(quality.require_feature_invariants, made, n),
            "features lack a split": passes(quality.require_feature_invariants, made.withColumn("split", F.lit(None).cast("string")), n),
        }
    finally:
        hours.unpersist()
        made.unpersist()
    return spark.createDataFrame(list(found.items()), "name string, passed boolean")


@query(
    "q_drivers",
    _silver_sql(
        body="""SELECT name, CAST(rows AS BIGINT) AS rows FROM (SELECT unnest(['audit profile', 'audit missing', 'audit duplicates', 'temporal bounds', 'resolution moments', 'resolution bands', 'resolution raw', 'resolution 15 minutes', 'resolution 30 minutes', 'resolution 1 hour']) AS name, 1 AS rows
    UNION ALL SELECT 'resolution quantiles', 27 UNION ALL SELECT 'audit entities', count(DISTINCT meter_id) FROM silver UNION ALL SELECT 'temporal coverage', count(DISTINCT (district, meter_id)) FROM silver UNION ALL SELECT 'temporal districts', count(DISTINCT district) FROM silver
    UNION ALL SELECT 'resolution states', count(DISTINCT CASE WHEN voltage = 0 AND freq = 0 THEN 1 WHEN voltage >= 180 AND current <= 0.05e0 AND t_kwh = 0 THEN 2 WHEN voltage > 0 AND voltage < 180 THEN 3 WHEN voltage BETWEEN 180 AND 260 THEN 4 WHEN voltage > 260 THEN 5 ELSE 6 END) FROM silver
    UNION ALL SELECT 'temporal gaps', count(DISTINCT CASE WHEN x < 180 THEN 0 WHEN x = 180 THEN 1 WHEN x <= 900 THEN 2 WHEN x <= 3600 THEN 3 WHEN x <= 86400 THEN 4 ELSE 5 END) FROM (SELECT floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY district, meter_id ORDER BY ts))) AS x FROM silver) WHERE x IS NOT NULL)"""
    ),
)
def q_drivers(spark, d):
    """The analyses' drivers over silver: rows of each part of their reports."""
    rows = catalogue._silver(spark, d).persist()
    try:
        parts = {"audit": pipelines.audit(rows), "temporal": pipelines.temporal(rows), "resolution": pipelines.resolution(rows)}
        found = [(f"{kind} {name}", df.count()) for kind, made in parts.items() for name, df in made.items()]
    finally:
        rows.unpersist()
    return spark.createDataFrame(found, "name string, rows long")


# -- the layers' own digits --------------------------------------------------------------------------------------------

# Hours expect pi samples, so that no scaled energy is an exact tie; means of current, which may be, are left out.
_CONTRACT_GOLD = GOLD_SQL.replace("4e0 / n", "pi() / n").replace(", 12) AS hourly_kwh", ", 6) AS hourly_kwh").replace(", 12) AS raw_kwh_sum", ", 6) AS raw_kwh_sum").replace(", 12)", ", 4)").replace(", 10)", ", 4)")
_GOLD_COLUMNS = [c for c in GOLD if c != "mean_current"]


@query("q_gold_contract", _silver_sql(_CONTRACT_GOLD, body=f"SELECT {', '.join(_GOLD_COLUMNS)} FROM gold"))
def q_gold_contract(spark, d):
    policy = resample.ResamplePolicy(expected=math.pi, complete_at=3)
    return resample.hourly(catalogue._silver(spark, d), policy).select(*_GOLD_COLUMNS)


_ROLLED = ["district", "meter_id", "window_start", "rolling_mean_24h", "rolling_std_24h", "rolling_max_24h", "rolling_min_24h"]


@query("q_features_contract", _silver_sql(GOLD_SQL.replace("4e0 / n", "pi() / n"), FEATURE_SQL.replace(", 9) AS rolling", ", 6) AS rolling"), body=f"SELECT {', '.join(_ROLLED)} FROM feat"))
def q_features_contract(spark, d):
    config = replace(CONFIG, hours=replace(CONFIG.hours, expected=math.pi), features=FeaturePolicy())
    return features.feature_store(resample.hourly(catalogue._silver(spark, d), config.hours), config.splits, config.features).select(*_ROLLED)


# -- streams -----------------------------------------------------------------------------------------------------------


@query("q_stream_gold", catalogue._gold_sql(body="SELECT * FROM gold WHERE window_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM rated WHERE reason = '')"))
def q_stream_gold(spark, d):
    """Hours of a stream of events, as far as its watermark has come when the input ends."""

    def make(path: str) -> None:
        events = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parquet*")
        rows = telemetry(events).withColumn("ts", F.col("ts").cast("timestamp"))
        hours = stream_gold(stream_silver(rows, late="1 hour"), CONFIG.hours, late="1 hour")
        hours.writeStream.format("parquet").option("path", path).option("checkpointLocation", f"{path}-state").outputMode("append").trigger(availableNow=True).start().awaitTermination()

    return _local_times(spark.read.parquet(_once(spark, d, "hours", make)).select(*GOLD))


# -- models ------------------------------------------------------------------------------------------------------------

_LINE = "fitted AS (SELECT regr_slope(target_hourly_kwh, lag_0h) AS a, regr_intercept(target_hourly_kwh, lag_0h) AS b FROM feat WHERE split = 'TRAIN' AND is_valid_forecast_instance = 1)"


def _line(spark, d, rows):
    """Least squares on one input, scaled, saved and read again."""
    return ml.load(_once(spark, d, "line", lambda p: ml.save(ml.trained(rows, "ols", ["lag_0h"]), p)))


def _has_training_rows(rows: DataFrame) -> bool:
    return not rows.filter("split = 'TRAIN' and is_valid_forecast_instance = 1").isEmpty()


@query("q_least_squares", _feature_sql(_LINE, body="SELECT district, meter_id, window_start, round(a * lag_0h + b, 6) AS prediction FROM feat, fitted WHERE split = 'VAL' AND is_valid_forecast_instance = 1 AND a IS NOT NULL"))
def q_least_squares(spark, d):
    rows = _features(spark, d)
    if not _has_training_rows(rows):
        return spark.createDataFrame([], "district string, meter_id string, window_start timestamp_ntz, prediction double")
    val = rows.filter("split = 'VAL' and is_valid_forecast_instance = 1")
    return _line(spark, d, rows).transform(val).select("district", "meter_id", "window_start", F.round("prediction", 6).alias("prediction"))


@query(
    "q_model_gate",
    _aligned_sql(
        _LINE,
        f"cohort AS (SELECT * FROM aligned WHERE {catalogue._COMMON}), each_one AS ({catalogue._EACH}), b AS (SELECT baseline, round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, round(avg(abs(y - p)), 6) AS mae FROM each_one WHERE split = 'VAL' GROUP BY 1)",
        "m AS (SELECT round(sqrt(avg((target_hourly_kwh - a * lag_0h - b) ** 2)), 6) AS model_rmse, round(avg(abs(target_hourly_kwh - a * lag_0h - b)), 6) AS model_mae FROM cohort, fitted WHERE split = 'VAL' AND a IS NOT NULL)",
        body="SELECT baseline, rmse, mae, model_rmse, model_mae, model_rmse < rmse AND model_mae < mae AS beaten FROM b, m WHERE model_rmse IS NOT NULL",
    ),
)
def q_model_gate(spark, d):
    """Whether the fitted line beats each baseline on the validation cohort."""
    rows = _features(spark, d)
    if not _has_training_rows(rows):
        return spark.createDataFrame([], "baseline string, rmse double, mae double, model_rmse double, model_mae double, beaten boolean")
    aligned = baselines.aligned_by_frames(rows)
    predicted = _line(spark, d, rows).transform(aligned.filter(baselines.in_cohort()))
    return _rounded(ml.gate(predicted, baselines.metrics(aligned), "VAL"), 6)


@query("q_models")
def q_models(spark, d):
    """Errors on the validation split of linear models, boosted trees and a forest over all inputs; none without training rows."""
    rows = _features(spark, d)
    if not _has_training_rows(rows):
        return spark.createDataFrame([], "n long, rmse double, mae double, model string")
    path = _once(spark, d, "model-input", lambda p: rows.filter("split <> 'TEST' and is_valid_forecast_instance = 1").write.parquet(p))
    rows = spark.read.parquet(path)
    val = rows.filter("split = 'VAL'")
    more = {"trees": {"maxIter": 5, "maxDepth": 4}, "forest": {"numTrees": 10, "maxDepth": 6}}
    return united([ml.errors(ml.trained(rows, kind, **more.get(kind, {})).transform(val)).withColumn("model", F.lit(kind)) for kind in ("ols", "ridge", "elastic", "trees", "forest")])


@query("q_kmeans")
def q_kmeans(spark, d):
    """Series by user, as there are few meters: scores for each number of clusters from 3 to 8."""
    rows = telemetry(table(spark, d, "events"), keep=("user_id",))
    per = rows.groupBy("user_id").agg(F.avg("t_kwh").alias("mean"), F.coalesce(F.stddev("t_kwh"), F.lit(0.0)).alias("std"), F.avg((F.col("voltage") < 200).cast("int")).alias("brownout")).persist()
    try:
        found = [(x["k"], round(x["silhouette"], 6), round(x["davies_bouldin"], 6)) for x in ml.cluster_search(per, ["mean", "std", "brownout"], range(3, 9))]
    finally:
        per.unpersist()
    return spark.createDataFrame(found, "k int, silhouette double, davies_bouldin double")
