"""Chronological splits, by the time of the target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitPolicy:
    """Times before `train_before` train, those before `val_before` validate, later ones test."""

    train_before: str
    val_before: str


def split_of(ts: Column, policy: SplitPolicy) -> Column:
    """TRAIN, VAL or TEST; null for a null time, which belongs to none."""
    t = ts.cast("timestamp_ntz")
    first, second = (F.lit(x).cast("timestamp_ntz") for x in (policy.train_before, policy.val_before))
    return F.when(t < first, "TRAIN").when(t < second, "VAL").when(t >= second, "TEST")
