"""Operating states and quality flags of readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flag


@dataclass(frozen=True)
class StatePolicy:
    """Thresholds of states and flags."""

    low: float = 180.0
    high: float = 260.0
    spike: float = 300.0
    idle_current: float = 0.05
    extreme_energy: float = 0.3


# Labels of the forensic states, in the order in which they are tried.
FORENSIC_LABELS = [
    "State 1: Grid Outage / Blackout",
    "State 2: Voluntary Standby / Idle",
    "State 3: Brownout Supply",
    "State 4: Normal Active Operation",
    "State 5: Overvoltage Transient / Spike",
    "State 6: Other Intermediate",
]


def cascade(branches: list[tuple[Column, object]], otherwise: object) -> Column:
    """The value of the first branch whose condition holds: the order is part of the meaning."""
    out = F.when(*branches[0])
    for condition, value in branches[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def _conditions(p: StatePolicy) -> dict[str, Column]:
    v, i, e = F.col("voltage"), F.col("current"), F.col("t_kwh")
    return {
        "outage": v == 0,
        "standby": (v >= p.low) & (i <= p.idle_current) & (e == 0),
        "brownout": (v > 0) & (v < p.low),
        "normal": v.between(p.low, p.high),
        "over": v > p.high,
    }


def operating_state(p: StatePolicy = StatePolicy()) -> Column:
    """1 outage, 2 standby (also above the normal range), 3 brownout, 4 normal, 5 overvoltage, 6 none of these."""
    return cascade([(c, i) for i, c in enumerate(_conditions(p).values(), 1)], 6)


def forensic_state(p: StatePolicy = StatePolicy()) -> Column:
    """The same, but an outage needs a frequency of 0 too."""
    c = _conditions(p)
    c["outage"] = c["outage"] & (F.col("freq") == 0)
    return cascade(list(zip(c.values(), FORENSIC_LABELS, strict=False)), FORENSIC_LABELS[-1])


def quality_flags(p: StatePolicy = StatePolicy()) -> dict[str, Column]:
    c, v = _conditions(p), F.col("voltage")
    return {
        "is_outage": flag(c["outage"]),
        "is_standby": flag(c["standby"]),
        "is_brownout": flag(c["brownout"]),
        "is_voltage_high": flag((v > p.high) & (v <= p.spike)),
        "is_voltage_spike": flag(v > p.spike),
        "is_extreme_load": flag(F.col("t_kwh") > p.extreme_energy),
    }


def policy_flags(overcurrent: float = 50.0, freq: tuple[float, float] = (49.5, 50.5), dates: tuple[str, str] | None = None, time: str = "ts") -> dict[str, Column]:
    """Flags that the data policy names beyond the silver contract. A frequency of 0 is abnormal too. dates: the first time that is valid
    and the first that no longer is."""
    f, t = F.col("freq"), F.col(time)
    valid = t.isNotNull() if dates is None else (t >= F.lit(dates[0]).cast("timestamp")) & (t < F.lit(dates[1]).cast("timestamp"))
    return {
        "is_overcurrent": flag(F.col("current") > overcurrent),
        "is_frequency_abnormal": flag(~f.between(*freq)),
        "is_valid_timestamp": flag(valid),
    }


def classified(df: DataFrame, p: StatePolicy = StatePolicy()) -> DataFrame:
    return df.withColumns({"operating_state": operating_state(p)} | quality_flags(p))


@dataclass(frozen=True)
class ZeroStates:
    """Standby and blackout as raw-data audits count them: neither threshold nor flags of the silver layer."""

    standby_over: float = 180.0

    def counts(self, energy_too: bool) -> list[Column]:
        v, i, e, f = (F.col(c) for c in ("voltage", "current", "t_kwh", "freq"))
        blackout = (v == 0) & (f == 0) & ((e == 0) if energy_too else F.lit(True))
        return [F.count_if((e == 0) & (v > self.standby_over) & (i == 0)).alias("standby"), F.count_if(blackout).alias("blackout")]
