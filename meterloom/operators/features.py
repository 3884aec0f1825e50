"""Lag, rolling, calendar and context features, and targets that don't reach across gaps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import cyclic, epoch_seconds, flag, is_weekend
from ..schema import FEATURES, HOURS, Series, conformed
from .splits import SplitPolicy, split_of

HOUR = 3600


@dataclass(frozen=True)
class FeaturePolicy:
    """mode: "rows" counts observed hours (a lag after a gap is that many observed hours ago); "time" goes by the clock, so such a lag
    is null. district_index: index of each district; others get `other_index`."""

    lags: tuple[int, ...] = (0, 1, 2, 24, 168)
    rolling: int = 24
    mode: str = "rows"
    digits: int = 6
    ratio_digits: int = 4
    district_index: tuple[tuple[str, float], ...] = (("A", 0.0),)
    other_index: float = 1.0


def _order(series: Series, by_time: bool):
    w = Window.partitionBy(*series.keys)
    return w.orderBy(epoch_seconds(F.col(series.time)) if by_time else F.col(series.time))


def back(value: str, hours: int, series: Series = HOURS, mode: str = "rows") -> Column:
    """value some hours ago."""
    if hours == 0:
        return F.col(value)
    if mode == "rows":
        return F.lag(value, hours).over(_order(series, False))
    return F.max(value).over(_order(series, True).rangeBetween(-hours * HOUR, -hours * HOUR))


def lags(policy: FeaturePolicy = FeaturePolicy(), series: Series = HOURS) -> dict[str, Column]:
    return {f"lag_{h}h": back(series.value, h, series, policy.mode) for h in policy.lags}


def rolling(policy: FeaturePolicy = FeaturePolicy(), series: Series = HOURS) -> dict[str, Column]:
    """Over the last hours with the present one; frames at a series' beginning are shorter, and a deviation needs two rows."""
    n = policy.rolling
    frame = _order(series, False).rowsBetween(1 - n, 0) if policy.mode == "rows" else _order(series, True).rangeBetween((1 - n) * HOUR, 0)
    made = {f"rolling_{name}_{n}h": F.round(f(series.value).over(frame), policy.digits) for name, f in (("mean", F.avg), ("std", F.stddev), ("max", F.max), ("min", F.min))}
    return made | {f"rolling_outage_ratio_{n}h": F.round(F.avg("outage_ratio").over(frame), policy.ratio_digits)}


def calendar(target: Column) -> dict[str, Column]:
    """Of the hour to be forecast; days of the week from 1, Sunday."""
    hour, day, month = F.hour(target), F.dayofweek(target), F.month(target)
    out = {"target_hour": hour, "target_dow": day, "target_month": month, "target_is_weekend": is_weekend(day)}
    for name, position, period in (("hour", hour, 24), ("dow", day - 1, 7), ("month", month - 1, 12)):
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(position, period)
    return out


CONTEXT = ("mean_voltage", "mean_current", "mean_freq", "outage_ratio", "standby_ratio", "brownout_ratio", "spike_ratio")


def context(policy: FeaturePolicy = FeaturePolicy()) -> dict[str, Column]:
    """What is known when the forecast is made, and the district's index."""
    index = F.lit(policy.other_index)
    for name, i in policy.district_index:
        index = F.when(F.col("district") == name, F.lit(i)).otherwise(index)
    return {f"{c}_t": F.col(c) for c in CONTEXT} | {"district_idx": index}


def targets(series: Series = HOURS, hours: int = 1) -> dict[str, Column]:
    """The next hour's value and flags, only where the next row is the hour after; else null, and not valid. Nothing is made up."""
    w = _order(series, False)
    follows = epoch_seconds(F.lead(series.time, hours).over(w)) == epoch_seconds(F.col(series.time)) + hours * HOUR
    ahead = lambda c: F.when(follows, F.lead(c, hours).over(w))
    return {
        "target_hourly_kwh": ahead(series.value),
        "target_is_complete": ahead("is_complete_hour"),
        "target_is_outage": ahead("is_outage_hour"),
        "target_is_valid": F.coalesce(ahead("is_valid_forecast_target"), F.lit(0)),
    }


def horizon_targets(hours: DataFrame, horizons=(1, 24, 168), series: Series = HOURS) -> DataFrame:
    """hours with target_h{n}: the value exactly n hours on, null where there is no such hour. One shuffle for all horizons."""
    w = _order(series, True)
    return hours.withColumns({f"target_h{n}": F.max(series.value).over(w.rangeBetween(n * HOUR, n * HOUR)) for n in horizons})


def eligibility(policy: FeaturePolicy = FeaturePolicy()) -> dict[str, Column]:
    needed = [f"lag_{h}h" for h in policy.lags] + [f"rolling_{x}_{policy.rolling}h" for x in ("mean", "std")]
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull()
    return {"has_complete_history": flag(whole), "is_valid_forecast_instance": flag(whole & (F.col("target_is_valid") == 1) & F.col("target_hourly_kwh").isNotNull())}


def feature_store(hours: DataFrame, splits: SplitPolicy, policy: FeaturePolicy = FeaturePolicy(), series: Series = HOURS) -> DataFrame:
    """All features of the contract. Windows of one kind of order share a single shuffle and sort."""
    out = hours.withColumns(lags(policy, series) | rolling(policy, series) | targets(series) | context(policy))
    out = out.withColumn("target_window_start", F.col(series.time) + F.expr("INTERVAL 1 HOUR"))
    out = out.withColumns(calendar(F.col("target_window_start")) | eligibility(policy) | {"split": split_of(F.col("target_window_start"), splits)})
    return conformed(out, FEATURES)
