"""Click-stream counts (analyses 6.1-6.5; survey ids D3, D4, D11, H19, H27)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import period_start
from quarry.operators._util import as_col, cols, ratio


def visits(df: DataFrame, user: str, ts: str, visit_date: str = "visit_date") -> DataFrame:
    """A visit is a (user, calendar day) pair."""
    return df.withColumn(visit_date, as_col(ts).cast("date"))


def distinct_visits_per_period(df: DataFrame, user: str, visit: str, ts: str,
                               period: str = "month") -> DataFrame:
    """Distinct visits per period (6.3; the users join adds nothing, X29)."""
    return (df.groupBy(period_start(ts, period).alias("period_start"))
              .agg(F.count_distinct(F.col(user), F.col(visit)).alias("n_visits")))


def visit_conversion(df: DataFrame, visit_keys, success, by=None) -> DataFrame:
    """Share of visits with at least one ``success`` event (6.5): one flag per
    visit via max, then count_if / count."""
    by = cols(by)
    per = df.groupBy(*by, *cols(visit_keys)).agg(F.max(as_col(success).cast("int")).alias("_hit"))
    g = per.groupBy(*by) if by else per.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_visits"),
                 F.count_if(F.col("_hit") == 1).alias("n_converted"),
                 ratio(F.count_if(F.col("_hit") == 1), F.count(F.lit(1))).alias("conversion"))
