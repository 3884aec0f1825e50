import json
import os

import pytest
from pyspark.sql import functions as F
from test_hours import POLICY, hours
from test_quality import readings

from meterloom import sources
from meterloom.__main__ import main
from meterloom.functions import parsed_time
from meterloom.operators import features, invariants, ml, resample, states
from meterloom.plans import pipelines
from meterloom.schema import FEATURES, SILVER, conformed, deviations
from meterloom.session import session
from meterloom.streaming import stream_gold, stream_silver


def test_session_is_reused(spark):
    assert session("other", shuffle_partitions=4) is not None


def csv(path, rows, header="x_Timestamp,t_kWh,z_Avg Voltage (Volt),z_Avg Current (Amp),y_Freq (Hz),meter"):
    path.write_text("\n".join([header, *rows]))
    return str(path)


def test_layers_from_files(spark, tmp_path):
    a = csv(tmp_path / "a.csv", [f"2024-01-01 0{h}:{m:02d}:00,0.1,230,1,50, m1 " for h in range(3) for m in range(0, 60, 3)])
    b = csv(tmp_path / "b.csv", ["01-01-2024 00:00,0.2,230,1,50,m2", "no time,abc,230,1,50,m2"])
    files = [({"district": "A", "file_year": 2024}, a), ({"district": "B", "file_year": 2024}, b)]
    places = {x: str(tmp_path / x) for x in ("silver", "quarantine", "gold", "features")}
    pipelines.build_silver(spark, files, places["silver"], places["quarantine"])
    silver = sources.read_parquet(spark, places["silver"])
    assert silver.count() == 61 and {r.meter_id for r in silver.select("meter_id").distinct().collect()} == {"m1", "m2"}
    assert [r.rejection_reason for r in spark.read.parquet(places["quarantine"]).collect()] == ["INVALID_OR_UNPARSEABLE_TIMESTAMP; NULL_ACTIVE_ENERGY"]
    assert "district=A" in os.listdir(places["silver"])
    pipelines.build_gold(spark, places["silver"], places["gold"])
    gold = sources.read_parquet(spark, places["gold"])
    assert gold.count() == 4 and invariants.conserved(silver, gold)
    found = pipelines.build_features(spark, places["gold"], places["features"])
    assert found["rows"] == 4 and found["eligible"] == 0
    report = pipelines.evaluate(spark, places["features"], str(tmp_path / "r.json"))
    assert report["splits"]["VAL"]["baselines"] == {} and "cohort_audit" in (tmp_path / "r.json").read_text()
    assert "splits:" in sources.shown(report)
    with pytest.raises(FileNotFoundError):
        sources.read_parquet(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        sources.read_manifest(spark, [({}, str(tmp_path / "none.csv"))])
    for made in (pipelines.audit(silver), pipelines.temporal(silver), pipelines.resolution(silver)):
        assert all(df.count() for df in made.values())


def test_command_line(spark, tmp_path, capsys):
    """The same layers by commands."""
    a = csv(tmp_path / "a.csv", [f"2024-01-01 0{h}:{m:02d}:00,0.1,230,1,50,m1" for h in range(3) for m in range(0, 60, 3)])
    (tmp_path / "files.json").write_text(json.dumps([{"path": a, "district": "A", "file_year": 2024}]))
    at = lambda x: str(tmp_path / x)
    main(["silver", "--manifest", at("files.json"), "--output", at("s"), "--quarantine", at("q")])
    main(["gold", "--silver", at("s"), "--output", at("g")])
    main(["features", "--gold", at("g"), "--output", at("f")])
    main(["evaluate", "--features", at("f"), "--output-json", at("r.json")])
    main(["audit", "--silver", at("s")])
    assert "rows: 3" in capsys.readouterr().out and "cohort_audit" in (tmp_path / "r.json").read_text()


def test_layers_are_written_by_many_tasks(spark, tmp_path):
    """A folder larger than a partition should be is split; small ones aren't."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "65536")
    try:
        df = spark.range(200_000, numPartitions=4).select(F.lit("A").alias("district"), F.uuid().alias("x"))
        sources.write_layer(df.union(spark.createDataFrame([("B", "y")], df.schema)), str(tmp_path / "w"), ("district",))
    finally:
        spark.conf.set(key, before)
    files = {x: len([f for f in os.listdir(tmp_path / "w" / x) if f.endswith(".parquet")]) for x in ("district=A", "district=B")}
    assert files["district=A"] > 1 and files["district=B"] == 1 and spark.read.parquet(str(tmp_path / "w")).count() == 200_001


def test_names_and_casts(spark, tmp_path):
    assert sources.canonical_names(["Meter No", "x_Timestamp", "t_kWh", "z_Avg Voltage (Volt)", "Amp", "Hz", "note"]) == {"Meter No": "meter_id", "x_Timestamp": "ts_str", "t_kWh": "t_kwh", "z_Avg Voltage (Volt)": "voltage", "Amp": "current", "Hz": "freq"}
    path = csv(tmp_path / "u.csv", ["2024-01-01,x,1,2,50,m", "2024-01-01,0.5,1,2,50,m"])
    df = sources.typed(sources.canonical(sources.read_csv(spark, path, None)))
    assert [r.t_kwh for r in df.collect()] == [None, 0.5] and sources.inspect(df)["count"] == 2


@pytest.mark.parametrize("text, expected", [("2024-01-31 10:20:30", "2024-01-31 10:20:30"), ("2024-01-31 10:20", "2024-01-31 10:20:00"), ("31-01-2024 10:20:30", "2024-01-31 10:20:30"), ("31-01-2024 10:20", "2024-01-31 10:20:00"), ("31/01/2024", None), ("", None), (None, None)])
def test_time_formats(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(parsed_time(F.col("t")).cast("string").alias("t"))
    assert df.first().t == expected


def test_contracts(spark):
    silver = pipelines.silver(readings(spark, [{}]))
    assert deviations(silver, SILVER) == [] and invariants.of_silver(silver) == []
    assert deviations(silver.drop("freq"), SILVER) == ["freq: missing"]
    with pytest.raises(ValueError):
        conformed(silver.drop("freq"), SILVER)
    bad = silver.withColumn("operating_state", F.lit(6))
    assert invariants.of_silver(bad) == ["state is closed: 1 rows"]
    assert len(FEATURES) == 39


def test_models(spark, tmp_path):
    df = features.feature_store(hours(spark, range(300)), POLICY)
    inputs = ["lag_0h", "lag_1h", "hour_sin"]
    for kind in ("ols", "ridge", "elastic", "trees", "forest"):
        model = ml.trained(df, kind, inputs, **({"maxIter": 2} if kind == "trees" else {"numTrees": 2} if kind == "forest" else {}))
        assert ml.errors(model.transform(df.filter("is_valid_forecast_instance = 1"))).first().n > 0
    ols = ml.trained(df, "ols", inputs)
    assert ml.errors(ols.transform(df.filter("split = 'VAL' and is_valid_forecast_instance = 1"))).first().rmse < 1e-3
    ml.save(ols, str(tmp_path / "m"), {"kind": "ols"}, str(tmp_path / "m.json"))
    assert len(ml.load(str(tmp_path / "m")).stages) == 3 and "ols" in (tmp_path / "m.json").read_text()
    with pytest.raises(ValueError):
        ml.regressor("none")
    points = spark.createDataFrame([(float(x + 10 * (x % 2)), float(x % 2)) for x in range(12)], "a double, b double")
    scores = ml.cluster_search(points, ["a", "b"], range(2, 4))
    assert scores[0]["silhouette"] > 0.5 and scores[0]["davies_bouldin"] > 0


def test_streams(spark, tmp_path):
    rows = [{"ts": f"2024-01-01 {h:02d}:{m:02d}:00"} for h in range(4) for m in range(0, 60, 3)]
    batch = readings(spark, [*rows, rows[0], {"voltage": -1.0}])
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    out = stream_gold(stream_silver(stream, late="10 minutes"), late="10 minutes")
    q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = resample.hourly(states.classified(readings(spark, rows))).filter("hour(window_start) < 3")
    assert got.count() == 3 and got.exceptAll(want).isEmpty()
