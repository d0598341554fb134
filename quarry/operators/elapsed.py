"""Elapsed times, speeds and change vs the previous event (analyses
2.11-2.15, 2.24; survey ids H22, D6, D8, E7, E14)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import ordered as O
from quarry.operators._util import as_col, cols, ratio


def with_elapsed(df: DataFrame, start: str, end: str, unit: str = "MINUTE",
                 name: str = "elapsed") -> DataFrame:
    """Whole units from start to end, truncated toward zero (ruling X5)."""
    return df.withColumn(name, F.timestamp_diff(unit, as_col(start), as_col(end)))


def elapsed_stats(df: DataFrame, value: str, by=None, agg: str = "avg",
                  name: str | None = None) -> DataFrame:
    """Mean (exact sum / count) or range (max - min) of a measure per group."""
    by = cols(by)
    g = df.groupBy(*by) if by else df.groupBy()
    v = as_col(value)
    if agg == "avg":
        return g.agg(ratio(F.sum(v), F.count(v)).alias(name or f"avg_{value}"))
    if agg == "range":
        return g.agg((F.max(v) - F.min(v)).alias(name or f"{value}_range"))
    raise ValueError(agg)


def speed(distance: str, duration_min: str) -> F.Column:
    """distance per hour from a distance and a duration in minutes (DOUBLE)."""
    return F.try_divide(as_col(distance).cast("double") * F.lit(60.0),
                        as_col(duration_min).cast("double"))


def change_vs_previous(df: DataFrame, value: str, by, order, tie=None,
                       prev: str = "previous", pct: str = "pct_change") -> DataFrame:
    """Previous value within ``by`` in ``order`` (then ``tie``) and the
    relative change (2.15, ruling X17: ordered by time, not by the value)."""
    x = O.stitched(df, by, cols(order) + cols(tie), prev=[value],
                   prefix=("_prev_", "_next_")).withColumnRenamed(f"_prev_{value}", prev)
    return x.withColumn(pct, ratio(F.col(value) - F.col(prev), F.col(prev)))
