"""Shares, pivots and ratios (survey ids D9, D10, D12, D13; analyses 2.4,
3.4-3.7, 4.10, 5.4-5.7)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators._util import as_col, cols, ratio


def _safe(v) -> str:
    return re.sub(r"[^0-9A-Za-z]+", "_", str(v)).strip("_").lower()


def share_of_total(df: DataFrame, by, within=None, value=None,
                   count_distinct=None, name: str = "n",
                   share: str = "share", of=None, digits: int | None = None) -> DataFrame:
    """Count (or sum ``value``) per ``within + by`` and its share of the
    ``within`` total (D12), or of ``of`` where that is given.

    ``count_distinct`` counts distinct values of that column instead of rows
    (ruling X7: "share of customers" divides by customers, not rows).  The
    denominator is aggregated separately from the input (not from the grouped
    rows) so a distinct count is not double counted across groups.
    """
    by, within = cols(by), cols(within)
    if value is not None:
        measure = F.sum(as_col(value))
    elif count_distinct is not None:
        measure = F.count_distinct(as_col(count_distinct))
    else:
        measure = F.count(F.lit(1))
    agg = df.groupBy(*within, *by).agg(measure.alias(name))
    if of is not None:
        return agg.withColumn(share, ratio(name, of, digits))
    tot_src = df.groupBy(*within) if within else df.groupBy()
    tot = tot_src.agg(measure.alias("_total"))
    if within:
        out = agg.join(tot, within, "inner")
    else:
        # a one-row scalar subquery, evaluated once and inlined as a value
        out = agg.withColumn("_total", tot.scalar())
    return out.withColumn(share, ratio(name, "_total", digits)).drop("_total")


def pivot_share(df: DataFrame, rows, pivot_col: str, values: list, metric,
                prefix: str = "share_", digits: int | None = None) -> DataFrame:
    """One column per pivot value holding its share of the row total.

    One conditional aggregate; the total is over all rows, so values that are
    not listed count in it."""
    rows, m = cols(rows), as_col(metric)
    g = df.groupBy(*rows).agg(
        F.sum(m).alias("_total"),
        *[F.coalesce(F.sum(F.when(F.col(pivot_col) == v, m)), F.lit(0)).alias(f"_v{i}") for i, v in enumerate(values)])
    return g.select(*rows, *[ratio(f"_v{i}", "_total", digits).alias(prefix + _safe(v)) for i, v in enumerate(values)])


def ratio_of_sums(df: DataFrame, by, num, den, name: str = "ratio", digits: int | None = None) -> DataFrame:
    """sum(num) / sum(den) per group: the weighted mean."""
    by = cols(by)
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(ratio(F.sum(as_col(num)), F.sum(as_col(den)), digits).alias(name))


def rate(df: DataFrame, by, success, name: str = "rate") -> DataFrame:
    """Share of rows meeting ``success`` per group, plus both counts (2.16, 6.5)."""
    by = cols(by)
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_total"),
                 F.count_if(as_col(success)).alias("n_success"),
                 ratio(F.count_if(as_col(success)), F.count(F.lit(1))).alias(name))


def pivot_counts(df: DataFrame, rows, pivot_col: str, values: list,
                 prefix: str = "n_", total: str | None = None) -> DataFrame:
    """Row counts per pivot value as columns, 0 where absent (2.4); ``total``
    names a column with the count of all rows, listed or not."""
    extra = [F.count(F.lit(1)).alias(total)] if total else []
    return df.groupBy(*cols(rows)).agg(
        *[F.count_if(F.col(pivot_col) == v).alias(prefix + _safe(v)) for v in values], *extra)


def found_values(df: DataFrame, column: str, most: int = 100) -> list:
    """The distinct values of a column in order, NULL left out: the first step of a
    pivot over what is in the data.  More than ``most`` of them are an error, not a
    silent cut: a column per value is meant for few."""
    values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values; pivot fewer or raise the limit")
    return sorted(values)


def pivot_found(df: DataFrame, rows, pivot_col: str, most: int = 100, prefix: str = "n_", rest: str = "n_rest",
                total: str | None = None) -> DataFrame:
    """Row counts with a column for each value found in the data (2.4, D10), and
    ``rest`` for rows whose value is NULL or came in after the values were looked up.
    Values whose column names would be the same are an error."""
    values = found_values(df, pivot_col, most)
    names = [prefix + _safe(v) for v in values]
    clash = sorted({n for n in [*names, rest, *([total] if total else [])]
                    if [*names, rest, *([total] if total else []), *cols(rows)].count(n) > 1})
    if clash:
        raise ValueError(f"several values or columns are named {', '.join(clash)}")
    listed = F.coalesce(F.col(pivot_col).isin(values), F.lit(False)) if values else F.lit(False)
    extra = [F.count(F.lit(1)).alias(total)] if total else []
    return df.groupBy(*cols(rows)).agg(*[F.count_if(F.col(pivot_col) == v).alias(n) for v, n in zip(values, names, strict=True)],
                                       F.count_if(~listed).alias(rest), *extra)
