"""Facts relative to a per-key milestone date, e.g. a membership start
(analyses 1.0, 1.6-1.12; survey ids J2, J4, J10, D9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import as_date
from quarry.operators._util import as_col, cols


def flag_milestone(df: DataFrame, milestones: DataFrame, key, ts: str, milestone_ts: str,
                   flag: str = "member", yes: str = "Y", no: str = "N") -> DataFrame:
    """Left-join the milestone and flag rows on or after it (J2 + J10).

    Keys without a milestone get ``no``.  ``milestones`` must hold one row per
    key; it grows with the key space, so no broadcast is forced (AQE decides)."""
    x = df.join(milestones, cols(key), "left")
    return x.withColumn(flag, F.when(as_col(ts) >= as_col(milestone_ts), yes).otherwise(no))


def split_at_milestone(df: DataFrame, milestones: DataFrame, key, ts: str,
                       milestone_ts: str, side: str = "after") -> DataFrame:
    """Rows of keys with a milestone, on/after it (``after``) or strictly before
    it (``before``) (1.6-1.8)."""
    x = df.join(milestones, cols(key), "inner")
    t, m = as_col(ts), as_col(milestone_ts)
    if side == "after":
        return x.where(t >= m)
    if side == "before":
        return x.where(t < m)
    raise ValueError(side)


def points(df: DataFrame, by, value: str, rules: list, default: int, name: str = "points"):
    """sum(value * factor) per ``by`` where factor comes from the first matching
    (condition, factor) rule, else ``default`` (1.9, D9 weighted sum)."""
    factor = None
    for cond, f in rules:
        factor = (F.when(cond, F.lit(f)) if factor is None else factor.when(cond, F.lit(f)))
    factor = F.lit(default) if factor is None else factor.otherwise(F.lit(default))
    return df.groupBy(*cols(by)).agg(F.sum(as_col(value) * factor).cast("double").alias(name))


def bonus_window_rule(ts: str, milestone_ts: str, days: int):
    """Condition: ts within [milestone, milestone + days - 1] (1.10, B5/H21)."""
    t, m = as_col(ts), as_col(milestone_ts)
    return t.between(m, F.date_add(m, days - 1))


def until(df: DataFrame, ts: str, cutoff) -> DataFrame:
    """Rows with ts <= cutoff (pushed to the scan when ts is a base column)."""
    return df.where(as_col(ts) <= as_date(cutoff))
