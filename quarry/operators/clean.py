"""Cleaning operators (survey ids H28-H30, A9; analyses 2.0a, 2.0b, 5.0)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.dates import as_col, week_number, week_year
from quarry.functions.text import NULL_SENTINELS, code_band, null_if_sentinel
from quarry.operators._util import cols, ratio

# Segment code letters and digits and their labels.
DEMOGRAPHIC_BANDS = {"C": "Couples", "F": "Families"}
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}


def clean_sentinels(df: DataFrame, columns, sentinels=NULL_SENTINELS) -> DataFrame:
    """Replace null-like text ('', 'null', 'NaN') by NULL in ``columns`` (2.0a).

    One sentinel set for every column (ruling X3)."""
    out = df
    for c in cols(columns):
        out = out.withColumn(c, null_if_sentinel(c, sentinels))
    return out


def clean_weekly(df: DataFrame, date_col: str = "week_date", segment: str = "segment",
                 sales: str = "sales", transactions: str = "transactions",
                 week_scheme: str = "iso", demographic_bands: dict | None = None,
                 age_bands: dict | None = None) -> DataFrame:
    """Typed weekly table with calendar parts, bands and mean ticket (5.0).

    Adds week_number, month_number, calendar_year, week_year (the year the week
    number counts in), age_band, demographic and
    (when a transactions column is present) avg_transaction; segment 'null'
    becomes 'unknown'."""
    d = as_col(date_col)
    seg = F.when(null_if_sentinel(segment).isNull(), F.lit("unknown")).otherwise(F.col(segment))
    out = (df
           .withColumn(segment, seg)
           .withColumn("week_number", week_number(d, week_scheme))
           .withColumn("month_number", F.month(d))
           .withColumn("calendar_year", F.year(d))
           .withColumn("week_year", week_year(d, week_scheme))
           .withColumn("age_band", code_band(segment, age_bands or AGE_BANDS))
           .withColumn("demographic", code_band(segment, demographic_bands or DEMOGRAPHIC_BANDS)))
    if transactions in df.columns:
        out = out.withColumn("avg_transaction", ratio(sales, transactions))
    return out
