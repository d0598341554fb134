"""Firsts, lasts and top-k per group (survey ids E1-E6, E13, F2-F4; analyses
1.3-1.7, 1.12, 2.5).

``ties='all'`` keeps every row tied at the top (``rank``); ``ties='one'``
keeps exactly one per group and needs ``tie`` columns that make the order
total (ruling X2).  Filters ``rank <= k`` let Catalyst insert a partial
WindowGroupLimit before the shuffle, so each map task forwards at most its own
top rows per key -- a hot key is cut down before it is moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import ordered as O
from quarry.operators._util import as_col, cols


def _order(order, tie, descending: bool):
    out = []
    for o in cols(order):
        c = as_col(o)
        out.append(c.desc() if descending else c.asc())
    for t in cols(tie):
        out.append(as_col(t).asc())
    return out


def _rank_fn(ties: str):
    if ties == "all":
        return F.rank()
    if ties == "one":
        return F.row_number()
    if ties == "dense":
        return F.dense_rank()
    raise ValueError(f"ties must be 'all', 'one' or 'dense', not {ties!r}")


def top_k_per(df: DataFrame, by, order, k: int = 1, ties: str = "all", tie=None,
              descending: bool = True, rank_col: str | None = None) -> DataFrame:
    """Rows ranked within ``by`` by ``order`` (desc by default), rank <= k.

    Without ``by`` this is a global top-k: ``orderBy(...).limit(k)``
    (TakeOrderedAndProject: a bounded heap per task), which needs ``tie`` for a
    deterministic pick."""
    by = cols(by)
    if ties == "one" and not cols(tie):
        raise ValueError("ties='one' needs tie-break columns")
    if not by:
        if ties != "one":
            raise ValueError("a global top-k needs ties='one' and tie columns")
        return df.orderBy(*_order(order, tie, descending)).limit(k)
    w = Window.partitionBy(*by).orderBy(*_order(order, tie if ties == "one" else None,
                                               descending))
    name = rank_col or "_rk"
    out = df.withColumn(name, _rank_fn(ties).over(w)).where(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def first_per(df: DataFrame, key, ts, ties: str = "all", tie=None) -> DataFrame:
    """Earliest row(s) per key (1.3, 1.6)."""
    return top_k_per(df, key, ts, 1, ties=ties, tie=tie, descending=False)


def last_per(df: DataFrame, key, ts, ties: str = "all", tie=None) -> DataFrame:
    """Latest row(s) per key (1.7)."""
    return top_k_per(df, key, ts, 1, ties=ties, tie=tie, descending=True)


def count_top_k_per(df: DataFrame, by, item, k: int = 1, ties: str = "all",
                    name: str = "n") -> DataFrame:
    """Most frequent ``item`` per ``by`` (1.5): count per (by, item) with map-side
    partial aggregation, then rank the counts.  Without ``by`` the global
    winner is picked with ``item`` as tie-break (1.4)."""
    by, item = cols(by), cols(item)
    c = df.groupBy(*by, *item).agg(F.count(F.lit(1)).alias(name))
    if not by:
        return top_k_per(c, None, name, k, ties="one", tie=item)
    return top_k_per(c, by, name, k, ties=ties, tie=item if ties == "one" else None)


def sequence_number(df: DataFrame, key, order, tie, name: str = "seq",
                    kind: str = "row_number") -> DataFrame:
    """Position of each row within its key (E1), ordered by ``order`` then
    ``tie``.  row_number is skew-safe (per key and day, stitched); dense_rank
    of a single column goes by cells of one value."""
    if kind == "row_number":
        return O.row_number(df, key, cols(order) + cols(tie), name)
    if kind == "dense_rank" and len(cols(order)) == 1:
        return O.dense_rank_of(df, key, cols(order)[0], name)
    fn = {"rank": F.rank(), "dense_rank": F.dense_rank()}[kind]
    w = Window.partitionBy(*cols(key)).orderBy(*_order(order, tie, False))
    return df.withColumn(name, fn.over(w).cast("bigint"))


def masked_rank(df: DataFrame, by, order: str, where, name: str = "ranking") -> DataFrame:
    """DENSE_RANK of ``order`` among the rows meeting ``where``; NULL for the
    others (1.12, E13).  Distinct values are ranked across cells of one value each
    (``ordered.dense_rank_of``), so a hot key is spread over its values."""
    x = df.withColumn("_flag", as_col(where))
    x = O.dense_rank_of(x, cols(by) + ["_flag"], order, "_dr")
    return x.withColumn(name, F.when(F.col("_flag"), F.col("_dr"))).drop("_flag", "_dr")
