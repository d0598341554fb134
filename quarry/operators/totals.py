"""Grouped totals (survey ids D1-D8, D17; analyses 1.1, 1.2, 2.1-2.3, 3.1,
4.1, 4.2, 4.5, 5.3, 6.1, 6.4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import period_start
from quarry.operators._util import as_col, cols, exact_mean


def totals_by(df: DataFrame, by=None, sums: dict | None = None,
              counts: dict | None = None, distinct: dict | None = None,
              means: dict | None = None, rows: str | None = "n_rows",
              as_double: bool = True) -> DataFrame:
    """One pass ``groupBy(by).agg(...)``.

    sums / counts / distinct / means map output name -> column.  Sums are
    exact (decimal) and returned as double when ``as_double``.  An empty
    ``by`` gives one global row.  Partial aggregation runs map-side, so a hot
    group key costs one small partial row per task.
    """
    distinct = distinct or {}
    if len(distinct) > 1 and not (rows or sums or counts or means):
        # several distinct counts expand every row once per count: do so on
        # distinct rows only
        used = list(dict.fromkeys([*cols(by), *(x for c in distinct.values() for x in cols(c))]))
        df = df.select(*used).distinct()
    aggs = []
    if rows:
        aggs.append(F.count(F.lit(1)).alias(rows))
    for name, c in (counts or {}).items():
        aggs.append(F.count(as_col(c)).alias(name))
    for name, c in distinct.items():
        cs = [as_col(x) for x in cols(c)]
        aggs.append(F.count_distinct(*cs).alias(name))
    for name, c in (sums or {}).items():
        s = F.sum(as_col(c))
        aggs.append((s.cast("double") if as_double else s).alias(name))
    for name, c in (means or {}).items():
        aggs.append(exact_mean(c).alias(name))
    g = df.groupBy(*cols(by)) if cols(by) else df.groupBy()
    return g.agg(*aggs)


def avg_children_per_parent(df: DataFrame, parent, child, by=None) -> DataFrame:
    """Mean number of distinct children per parent (6.2, two-stage D11).

    Stage 1 dedupes (parent, child) and counts per parent; stage 2 averages.
    Both stages aggregate partially before shuffling."""
    by = cols(by)
    per = (df.select(*by, parent, child).distinct()
           .groupBy(*by, parent).agg(F.count(F.lit(1)).alias("_n")))
    g = per.groupBy(*by) if by else per.groupBy()
    return g.agg(F.try_divide(F.sum("_n").cast("double"), F.count(F.lit(1)).cast("double"))
                 .alias("avg_children"), F.count(F.lit(1)).alias("n_parents"))


def distinct_per_day(df: DataFrame, day: str, id_col: str, by=None) -> DataFrame:
    """Exact sets of the distinct ids of each day (and ``by``) as bitmaps, one row a
    day and bucket of 32,768 neighbouring ids: a table to keep, from which distinct
    counts of any longer period follow without the rows (``roll_up_distinct``).
    Ids are integers; NULL days, groups and ids stay out."""
    by = cols(by)
    i = F.col(id_col).cast("long")
    x = df.where(F.col(day).isNotNull() & F.col(id_col).isNotNull())
    return x.groupBy(*by, F.col(day).cast("date").alias("day"), F.bitmap_bucket_number(i).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(i)).alias("ids"))


def roll_up_distinct(days: DataFrame, period: str, by=None, name: str = "n") -> DataFrame:
    """Distinct ids per period (and ``by``) from the bitmaps of its days: an OR per
    bucket, then the bits counted.  Partial ORs leave each task with one row a period
    and bucket."""
    by = cols(by)
    start = period_start("day", period).alias("period_start")
    sets = days.groupBy(*by, start, "bucket").agg(F.bitmap_or_agg("ids").alias("ids"))
    return sets.groupBy(*by, "period_start").agg(F.sum(F.bitmap_count("ids")).alias(name))
