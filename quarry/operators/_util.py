from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def cols(names) -> list[str]:
    """Normalise None / str / iterable of str to a list of names."""
    if names is None:
        return []
    if isinstance(names, str):
        return [names]
    return list(names)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def order_cols(order: Iterable, descending: bool = False) -> list[Column]:
    out = []
    for o in cols(order) if not isinstance(order, Column) else [order]:
        c = as_col(o)
        out.append(c.desc() if descending else c.asc())
    return out


def ratio(num, den, digits: int | None = None) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (D13, H3 ruling X6).
    With ``digits`` it is rounded half up (H4)."""
    out = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return out if digits is None else F.round(out, digits)


def exact_mean(c, dtype: str = "decimal(18,2)", digits: int | None = None) -> Column:
    """Mean computed as exact-sum / count, returned as DOUBLE.

    Summing decimals is exact and order-independent, so the result is the same
    on every partitioning of the data (D6)."""
    x = as_col(c).cast(dtype)
    return ratio(F.sum(x), F.count(x), digits)
