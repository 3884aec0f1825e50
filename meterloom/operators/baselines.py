"""Seasonal-naive forecasts and their errors on one common cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_seconds, share, usable_energy
from ..schema import HOURS, Series
from .quality import require_unique

BASELINES = ("b1", "b2", "b3", "b4")
#: Hours after which the day's and the week's forecasts look back.
OFFSETS = {"b2": 24, "b3": 168}


def valid_target() -> Column:
    """The target, where it is flagged valid and usable."""
    return F.when((F.col("target_is_valid") == 1) & usable_energy(F.col("target_hourly_kwh")), F.col("target_hourly_kwh"))


def lookup(features: DataFrame, hours: int, name: str, series: Series = HOURS) -> DataFrame:
    """(keys, time, name): each valid target, at the time from which it is looked up."""
    return features.select(*series.keys, (F.col(series.time) + F.expr(f"INTERVAL {hours} HOURS")).alias(series.time), valid_target().alias(name))


def lookups(features: DataFrame, series: Series = HOURS) -> dict[str, DataFrame]:
    require_unique(features, series)
    return {b: lookup(features, h, f"{b}_pred", series) for b, h in OFFSETS.items()}


def _chosen(features: DataFrame, splits) -> DataFrame:
    return features.filter((F.col("is_valid_forecast_instance") == 1) & F.col("split").isin(*splits))


def aligned(features: DataFrame, splits=("TRAIN", "VAL"), series: Series = HOURS, guard: bool = True) -> DataFrame:
    """Eligible rows of the splits with b1_pred to b4_pred; history comes from all splits. By joins on the exact time."""
    tables = lookups(features, series) if guard else {b: lookup(features, h, f"{b}_pred", series) for b, h in OFFSETS.items()}
    out = _chosen(features, splits)
    for t in tables.values():
        out = out.join(t, [*series.keys, series.time], "left")
    return out.withColumns({"b1_pred": F.col("lag_0h"), "b4_pred": F.col("rolling_mean_24h")})


def aligned_by_frames(features: DataFrame, splits=("TRAIN", "VAL"), series: Series = HOURS, guard: bool = True) -> DataFrame:
    """The same by range frames: one shuffle and no join. Frames run over all splits before the rows are chosen."""
    if guard:
        require_unique(features, series)
    w = Window.partitionBy(*series.keys).orderBy(epoch_seconds(F.col(series.time)))
    rows = features.withColumn("_valid", valid_target())
    rows = rows.withColumns({f"{b}_pred": F.max("_valid").over(w.rangeBetween(-h * 3600, -h * 3600)) for b, h in OFFSETS.items()})
    return _chosen(rows, splits).drop("_valid").withColumns({"b1_pred": F.col("lag_0h"), "b4_pred": F.col("rolling_mean_24h")})


def in_cohort() -> Column:
    """Target and all four forecasts are usable."""
    out = usable_energy(F.col("target_hourly_kwh"))
    for b in BASELINES:
        out = out & usable_energy(F.col(f"{b}_pred"))
    return out


def cohort_audit(rows: DataFrame) -> DataFrame:
    """One row per split: eligible, common and excluded rows, and matches of each forecast. One aggregate."""
    ok = {b: usable_energy(F.col(f"{b}_pred")) for b in BASELINES}
    counted = rows.groupBy("split").agg(
        F.count("*").alias("eligible"),
        F.count_if(in_cohort()).alias("common"),
        *[F.count_if(c).alias(f"{b}_matched") for b, c in ok.items()],
        F.count_if(~ok["b2"] & ok["b3"]).alias("only_b2_missing"),
        F.count_if(ok["b2"] & ~ok["b3"]).alias("only_b3_missing"),
        F.count_if(~ok["b2"] & ~ok["b3"]).alias("both_missing"),
    )
    whole = F.col("eligible")
    return counted.withColumns({"excluded": whole - F.col("common"), "common_pct": F.round(share(F.col("common"), whole, 100.0), 4)} | {f"{b}_matched_pct": F.round(share(F.col(f"{b}_matched"), whole, 100.0), 4) for b in BASELINES})


def error_sums(rows: DataFrame) -> DataFrame:
    """One row per split over the cohort: N, sums of the target, its spread, and squared and absolute errors of each forecast."""
    y = F.col("target_hourly_kwh")
    errors = []
    for b in BASELINES:
        e = y - F.col(f"{b}_pred")
        errors += [F.sum(e * e).alias(f"{b}_sse"), F.sum(F.abs(e)).alias(f"{b}_sae")]
    return rows.filter(in_cohort()).groupBy("split").agg(F.count("*").alias("n"), F.sum(y).alias("sum_kwh"), F.min(y).alias("min_kwh"), F.max(y).alias("max_kwh"), (F.var_pop(y) * F.count("*")).alias("ss_tot"), *errors)


def metrics(rows: DataFrame, digits: int = 6, pct_digits: int = 4) -> DataFrame:
    """One row per split and baseline. Measures whose divisor isn't positive are NaN. An empty cohort has no rows."""
    sums = error_sums(rows)
    n, total, ss = F.col("n").cast("double"), F.col("sum_kwh"), F.col("ss_tot")
    nan = F.lit(float("nan"))
    each = [F.struct(F.lit(b).alias("baseline"), F.col(f"{b}_sse").alias("sse"), F.col(f"{b}_sae").alias("sae")) for b in BASELINES]
    long = sums.withColumn("_e", F.explode(F.array(*each))).select("*", "_e.*").drop("_e")
    rmse = F.sqrt(F.col("sse") / n)
    return long.select(
        "split",
        "baseline",
        F.col("n"),
        F.round(total / n, digits).alias("mean_kwh"),
        F.round(F.when(n > 1, F.sqrt(ss / (n - 1))).otherwise(0.0), digits).alias("std_kwh"),
        F.round("sse", digits).alias("sse"),
        F.round("sae", digits).alias("sae"),
        F.round(rmse, digits).alias("rmse"),
        F.round(F.col("sae") / n, digits).alias("mae"),
        F.when(ss > 0, F.round(1 - F.try_divide(F.col("sse"), ss), digits)).otherwise(nan).alias("r2"),
        F.when(total > 0, F.round(F.try_divide(F.col("sae"), total) * 100, pct_digits)).otherwise(nan).alias("wape"),
        F.when(total > 0, F.round(F.try_divide(rmse, total / n) * 100, pct_digits)).otherwise(nan).alias("nrmse"),
    )


def evaluated(rows: DataFrame, split: str) -> dict:
    """Audit, target summary and measures of one split as a nested report; an empty cohort gives zeros and no baselines."""
    own = rows.filter(F.col("split") == split)
    audit = cohort_audit(own).collect()
    cohort = audit[0].asDict() if audit else {"split": split, "eligible": 0, "common": 0, "excluded": 0}
    found = [r.asDict() for r in metrics(own).collect()] if cohort["common"] else []
    summary = {"n": 0, "sum_kwh": 0.0, "mean_kwh": 0.0, "std_kwh": 0.0, "min_kwh": 0.0, "max_kwh": 0.0}
    if found:
        s = error_sums(own).first()
        summary = {"n": found[0]["n"], "sum_kwh": round(s["sum_kwh"], 4), "mean_kwh": found[0]["mean_kwh"], "std_kwh": found[0]["std_kwh"], "min_kwh": round(s["min_kwh"], 6), "max_kwh": round(s["max_kwh"], 6)}
    return {"cohort_audit": cohort, "target_summary": summary, "baselines": {r["baseline"]: {k: r[k] for k in ("rmse", "mae", "r2", "wape", "nrmse", "sse", "sae")} for r in found}}


def beats_baselines(model: dict[str, float], baselines: dict[str, dict[str, float]]) -> bool:
    """Whether a model's RMSE and MAE are below those of every baseline."""
    return all(model[m] < b[m] for b in baselines.values() for m in ("rmse", "mae"))
