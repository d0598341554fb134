"""Event impact and period coverage (analyses 3.12, 5.2, 5.8-5.11).

``before_after`` replaces the reference's tag-and-union-then-LAG pattern with
one filtered scan and a conditional aggregate: a single shuffle keyed by the
dimensions, with map-side partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.dates import as_col, as_date, iso_week_monday, week_number, week_year
from quarry.operators._util import cols, ratio


def _finish(g: DataFrame) -> DataFrame:
    """Exact (decimal) arithmetic first; doubles only in the output."""
    b = F.coalesce(F.col("before_value"), F.lit(0))
    a = F.coalesce(F.col("after_value"), F.lit(0))
    keep = [c for c in g.columns if c not in ("before_value", "after_value")]
    return g.select(*keep, b.cast("double").alias("before_value"),
                    a.cast("double").alias("after_value"),
                    (a - b).cast("double").alias("change"),
                    ratio(a - b, b).alias("pct_change"))


def before_after(df: DataFrame, date_col: str, event, metric: str, k: int,
                 dims=None, unit_days: int = 7) -> DataFrame:
    """Sum of ``metric`` in the k periods before ``event`` vs the k periods
    from ``event`` on, per ``dims`` (5.8, 5.10, 5.11).

    before = [event - k*unit, event), after = [event, event + k*unit).  A
    dimension value seen on one side only gets 0 on the other; a zero
    ``before`` gives a NULL pct_change."""
    d, ev = as_col(date_col), as_date(event)
    span = k * unit_days
    x = df.where((d >= F.date_sub(ev, span)) & (d < F.date_add(ev, span)))
    dims = cols(dims)
    g = x.groupBy(*dims) if dims else x.groupBy()
    g = g.agg(F.sum(F.when(d < ev, as_col(metric))).alias("before_value"),
              F.sum(F.when(d >= ev, as_col(metric))).alias("after_value"))
    return _finish(g)


def before_after_by_year(df: DataFrame, date_col: str, event, metric: str, k: int, dims=None,
                         year: str = "calendar_year") -> DataFrame:
    """Same comparison repeated for every year at the event's ISO week (5.9):
    k weeks before and from the Monday of that week on (ruling X27: one week
    rule for every year).

    Weeks are counted by date, so they run over the turn of the year; a row may
    be before one year's event and after another's.  Years without a row of
    their own in the window are left out."""
    d, w0 = as_col(date_col), week_number(as_date(event))
    own = week_year(d)
    x = df.withColumn("_own", own).withColumn(year, F.explode(F.array(own - 1, own, own + 1)))
    x = x.withColumn("_week", F.floor(F.datediff(d, iso_week_monday(year, w0)) / 7)) \
        .where((F.col("_week") >= -k) & (F.col("_week") < k))
    g = x.groupBy(year, *cols(dims)).agg(
        F.sum(F.when(F.col("_week") < 0, as_col(metric))).alias("before_value"),
        F.sum(F.when(F.col("_week") >= 0, as_col(metric))).alias("after_value"),
        F.count_if(F.col("_own") == F.col(year)).alias("_rows"))
    return _finish(g.where("_rows > 0").drop("_rows"))


def ranked_by_change(result: DataFrame, name: str = "change_rank") -> DataFrame:
    """Rank the groups of a comparison by relative change, the largest loss
    first (5.10); unknown changes last.  Runs on aggregated rows."""
    w = Window.orderBy(F.col("pct_change").asc_nulls_last())
    return result.withColumn(name, F.rank().over(w).cast("bigint")).orderBy(name)


def missing_periods(df: DataFrame, period_col: str, lo: int, hi, by=None) -> DataFrame:
    """Period numbers lo..hi absent from ``df`` per ``by`` group (5.2, J6);
    ``hi`` may be a column of the group (years have 52 or 53 weeks).

    The spine is the distinct groups times an integer sequence; absence is a
    left-anti join against the distinct (group, period) pairs."""
    by = cols(by)
    present = df.select(*by, F.col(period_col).cast("int").alias(period_col)).distinct()
    groups = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    last = hi if isinstance(hi, Column) else F.lit(hi)
    spine = groups.select(*by, F.explode(F.sequence(F.lit(lo), last)).alias(period_col))
    return spine.join(present, by + [period_col], "left_anti")


def period_growth(df: DataFrame, period_col: str, value: str, by=None,
                  name: str = "total") -> DataFrame:
    """Total per period and change vs the previous period (3.12, E7, E14).

    The LAG runs on the aggregated rows (one per group and period)."""
    by = cols(by)
    g = df.groupBy(*by, period_col).agg(F.sum(as_col(value)).alias(name))
    w = Window.partitionBy(*by).orderBy(period_col) if by else Window.orderBy(period_col)
    g = g.withColumn("_prev", F.lag(name).over(w))
    return g.select(*by, period_col, F.col(name).cast("double").alias(name),
                    F.col("_prev").cast("double").alias("previous"),
                    ratio(F.col(name) - F.col("_prev"), F.col("_prev")).alias("pct_change"))
