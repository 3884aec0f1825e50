"""Column contracts of the layers, and conformance to them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    """What identifies a series, its time and its value."""

    keys: tuple[str, ...] = ("district", "meter_id")
    time: str = "ts"
    value: str = "t_kwh"

    def at(self, time: str, value: str | None = None) -> Series:
        return Series(self.keys, time, value or self.value)


READINGS, HOURS = Series(), Series(time="window_start", value="hourly_kwh")

# Names, order and types of the layers' columns.
RAW = "x_Timestamp string, t_kWh double, `z_Avg Voltage (Volt)` double, `z_Avg Current (Amp)` double, `y_Freq (Hz)` double, meter string"
SILVER = {
    "district": "string", "meter_id": "string", "ts": "timestamp", "file_year": "int", "t_kwh": "double", "voltage": "double",
    "current": "double", "freq": "double", "operating_state": "int", "is_outage": "int", "is_standby": "int", "is_brownout": "int",
    "is_voltage_high": "int", "is_voltage_spike": "int", "is_extreme_load": "int",
}
GOLD = {
    "district": "string", "meter_id": "string", "window_start": "timestamp", "window_end": "timestamp", "file_year": "int",
    "hourly_kwh": "double", "raw_kwh_sum": "double", "sample_count": "int", "mean_voltage": "double", "mean_current": "double",
    "mean_freq": "double", "outage_ratio": "double", "standby_ratio": "double", "brownout_ratio": "double", "spike_ratio": "double",
    "is_complete_hour": "int", "is_outage_hour": "int", "is_valid_forecast_target": "int",
}
FEATURES = {
    "district": "string", "meter_id": "string", "window_start": "timestamp", "target_window_start": "timestamp", "split": "string",
    "district_idx": "double", "lag_0h": "double", "lag_1h": "double", "lag_2h": "double", "lag_24h": "double", "lag_168h": "double",
    "rolling_mean_24h": "double", "rolling_std_24h": "double", "rolling_max_24h": "double", "rolling_min_24h": "double",
    "target_hour": "int", "target_dow": "int", "target_month": "int", "target_is_weekend": "int", "hour_sin": "double",
    "hour_cos": "double", "dow_sin": "double", "dow_cos": "double", "month_sin": "double", "month_cos": "double",
    "mean_voltage_t": "double", "mean_current_t": "double", "mean_freq_t": "double", "outage_ratio_t": "double",
    "standby_ratio_t": "double", "brownout_ratio_t": "double", "spike_ratio_t": "double", "rolling_outage_ratio_24h": "double",
    "target_hourly_kwh": "double", "target_is_complete": "int", "target_is_outage": "int", "target_is_valid": "int",
    "has_complete_history": "int", "is_valid_forecast_instance": "int",
}
#: The model's inputs: lags, rolling statistics, cyclic calendar, context, district.
MODEL_INPUTS = [
    "lag_0h", "lag_1h", "lag_2h", "lag_24h", "lag_168h", "rolling_mean_24h", "rolling_std_24h", "rolling_max_24h", "rolling_min_24h",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "mean_voltage_t", "mean_current_t", "mean_freq_t",
    "outage_ratio_t", "standby_ratio_t", "brownout_ratio_t", "spike_ratio_t", "rolling_outage_ratio_24h", "district_idx",
]


def conformed(df: DataFrame, contract: dict[str, str]) -> DataFrame:
    """Exactly the contract's columns, in order, of its types. `timestamp` takes either kind of timestamp as it is."""
    missing = [c for c in contract if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the contract: {missing}")
    return df.select(*[F.col(c) if kind == "timestamp" else F.col(c).cast(kind).alias(c) for c, kind in contract.items()])


def deviations(df: DataFrame, contract: dict[str, str]) -> list[str]:
    """How df's schema differs from the contract; empty if it conforms."""
    have = dict(df.dtypes)
    out = [f"{c}: missing" for c in contract if c not in have]
    out += [f"{c}: {have[c]} instead of {kind}" for c, kind in contract.items() if c in have and have[c] not in ({kind, "timestamp_ntz"} if kind == "timestamp" else {kind})]
    out += [f"{c}: not in the contract" for c in have if c not in contract]
    return out if out or df.columns == list(contract) else ["columns out of order"]
