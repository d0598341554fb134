"""Text cleaning helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.dates import as_col

# Text that stands for "no value" in dirty inputs.
NULL_SENTINELS = ("", "null", "NaN")

LEADING_NUMBER = r"^\s*(\d+\.?\d*|\.\d+)"


def null_if_sentinel(c, sentinels=NULL_SENTINELS) -> Column:
    """NULL when the trimmed text is one of ``sentinels``."""
    c = as_col(c)
    return F.when(F.trim(c).isin(list(sentinels)), F.lit(None)).otherwise(c)


def leading_number(c, dtype: str = "decimal(10,2)") -> Column:
    """Number at the start of a text with a unit glued on ('20km', '23.4 km',
    '25mins'); NULL when there is none (H8, H29)."""
    s = null_if_sentinel(c)
    num = F.regexp_extract(s, LEADING_NUMBER, 1)
    return F.when(num == "", F.lit(None)).otherwise(num.try_cast(dtype))


def split_ids(c, sep: str = ",", dtype: str = "int") -> Column:
    """'1, 4' -> array<int> [1, 4]; NULL / blank text -> NULL."""
    s = null_if_sentinel(c)
    parts = F.split(s, sep)
    return F.transform(parts, lambda p: F.trim(p).try_cast(dtype))


def code_band(c, mapping: dict[str, str], default: str = "unknown",
              position: str = "contains") -> Column:
    """Label from a substring of a code ('C1' -> 'Couples')."""
    c = as_col(c)
    out = None
    for needle, label in mapping.items():
        cond = c.contains(needle) if position == "contains" else c.startswith(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))
