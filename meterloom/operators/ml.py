"""Regression and clustering by MLlib: vectors, scaling fitted on training rows only, models, scores, persistence."""

from __future__ import annotations

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MODEL_INPUTS

TARGET = "target_hourly_kwh"


def assembly(inputs=MODEL_INPUTS, scaled: bool = True) -> list:
    """Stages to `features`; the scaler learns means and deviations from whatever it is fitted on."""
    parts = [VectorAssembler(inputCols=list(inputs), outputCol="raw" if scaled else "features", handleInvalid="skip")]
    return parts + [StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)] if scaled else parts


def regressor(kind: str, inputs=MODEL_INPUTS, label: str = TARGET, **more) -> Pipeline:
    """kind: ols, ridge, elastic, trees (gradient-boosted) or forest. Trees see unscaled vectors."""
    common = {"featuresCol": "features", "labelCol": label, "predictionCol": "prediction"}
    makers = {
        "ols": lambda: LinearRegression(**common, **({"regParam": 0.0} | more)),
        "ridge": lambda: LinearRegression(**common, **({"regParam": 0.1, "elasticNetParam": 0.0} | more)),
        "elastic": lambda: LinearRegression(**common, **({"regParam": 0.01, "elasticNetParam": 0.5} | more)),
        "trees": lambda: GBTRegressor(**common, **({"seed": 42} | more)),
        "forest": lambda: RandomForestRegressor(**common, **({"seed": 42} | more)),
    }
    if kind not in makers:
        raise ValueError(f"kind is one of {sorted(makers)}")
    return Pipeline(stages=[*assembly(inputs, kind not in ("trees", "forest")), makers[kind]()])


def trained(features: DataFrame, kind: str, inputs=MODEL_INPUTS, **more) -> PipelineModel:
    """Fitted on eligible training rows."""
    return regressor(kind, inputs, **more).fit(features.filter("split = 'TRAIN' and is_valid_forecast_instance = 1"))


def errors(predicted: DataFrame, label: str = TARGET) -> DataFrame:
    e = F.col(label) - F.col("prediction")
    return predicted.agg(F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"))


def gate(predicted: DataFrame, baselines: DataFrame, split: str, label: str = TARGET) -> DataFrame:
    """One row per baseline of a split (as baselines.metrics gives them): errors of the model and of the baseline, and whether the
    model's RMSE and MAE are both lower. A model passes if it beats them all."""
    own = errors(predicted.filter(F.col("split") == split), label).select(F.col("rmse").alias("model_rmse"), F.col("mae").alias("model_mae"))
    rows = baselines.filter(F.col("split") == split).select("baseline", "rmse", "mae").join(F.broadcast(own), F.lit(True))
    return rows.withColumn("beaten", (F.col("model_rmse") < F.col("rmse")) & (F.col("model_mae") < F.col("mae")))


def save(model: PipelineModel, path: str, sidecar: dict | None = None, sidecar_path: str | None = None) -> None:
    model.write().overwrite().save(path)
    if sidecar is not None and sidecar_path:
        with open(sidecar_path, "w", encoding="utf-8") as f:
            json.dump(sidecar, f, indent=2, default=str)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def clusters(profiles: DataFrame, inputs: list[str], k: int, seed: int = 42) -> tuple[PipelineModel, DataFrame]:
    stages = [*assembly(inputs), KMeans(featuresCol="features", predictionCol="cluster", k=k, seed=seed)]
    model = Pipeline(stages=stages).fit(profiles)
    return model, model.transform(profiles)


def silhouette(assigned: DataFrame) -> float:
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(assigned)


def davies_bouldin(assigned: DataFrame) -> float:
    """Mean over clusters of the worst (spread + spread) / distance of centres. Centres and spreads are aggregates; the last step has a
    row for each pair of clusters."""
    rows = assigned.select("cluster", F.posexplode(vector_to_array("features")).alias("j", "x"), F.monotonically_increasing_id().alias("r"))
    centre = rows.groupBy("cluster", "j").agg(F.avg("x").alias("c"))
    spread = rows.join(centre, ["cluster", "j"]).groupBy("cluster", "r").agg(F.sqrt(F.sum((F.col("x") - F.col("c")) ** 2)).alias("d")).groupBy("cluster").agg(F.avg("d").alias("s"))
    c = centre.select(F.col("cluster").alias("o"), "j", F.col("c").alias("oc"))
    pairs = centre.join(c, "j").filter("cluster <> o").groupBy("cluster", "o").agg(F.sqrt(F.sum((F.col("c") - F.col("oc")) ** 2)).alias("m"))
    both = pairs.join(spread, "cluster").join(spread.select(F.col("cluster").alias("o"), F.col("s").alias("t")), "o")
    worst = both.groupBy("cluster").agg(F.max(F.try_divide(F.col("s") + F.col("t"), F.col("m"))).alias("r"))
    return float(worst.agg(F.avg("r")).first()[0] or 0.0)


def cluster_search(profiles: DataFrame, inputs: list[str], ks=range(3, 9)) -> list[dict]:
    """Scores for each number of clusters that the rows allow."""
    n = profiles.count()
    out = []
    for k in ks:
        if k < n:
            model, assigned = clusters(profiles, inputs, k)
            out.append({"k": k, "silhouette": silhouette(assigned), "davies_bouldin": davies_bouldin(assigned), "model": model})
    return out
