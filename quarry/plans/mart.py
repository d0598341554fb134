"""Supermarket analyses (5.0-5.11) on the weekly_sales stand-in."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quarry.functions.dates import day_name, iso_weeks_in, week_number, week_year
from quarry.operators.clean import clean_weekly
from quarry.operators.impact import (before_after, before_after_by_year, missing_periods,
                                     ranked_by_change)
from quarry.operators.share import pivot_share, ratio_of_sums, share_of_total
from quarry.operators.totals import totals_by
from quarry.plans.registry import register
from quarry.plans.standins import CLEAN_WEEKLY_SQL, weekly_sales
from quarry.sources.io import Tables

# The event date of the impact study and its window sizes.
EVENT = "1998-06-15"
KS = (4, 12)


def cw(spark, d, **kw):
    return clean_weekly(weekly_sales(Tables(spark, d), **kw))


def cws(spark, d, **kw):
    """Clean weekly sales without the distinct-order count (sales-only analyses)."""
    return cw(spark, d, transactions=False, **kw)


def _with(sql: str) -> str:
    return "WITH " + CLEAN_WEEKLY_SQL + "\n" + sql


register("clean_weekly", _with("""
SELECT week_date, region, platform, segment, customer_type, transactions,
       CAST(sales AS DOUBLE) AS sales, week_number, month_number, calendar_year, week_year,
       age_band, demographic, avg_transaction FROM clean_weekly"""))(
    lambda spark, d: cw(spark, d).withColumn("sales", F.col("sales").cast("double")))

register("weekday_of_week_date", _with("""
SELECT dayname(week_date) AS weekday, COUNT(*) AS n_rows FROM clean_weekly GROUP BY 1"""))(
    lambda spark, d: totals_by(cws(spark, d).withColumn("weekday", day_name("week_date")),
                               "weekday"))

def _weeks(spark, d, scheme: str):
    """Weeks with a sale, from the ship dates alone."""
    day = Tables(spark, d).lineitem.select(F.date_trunc("week", "l_shipdate").cast("date").alias("week_date")).distinct()
    return day.select(week_year("week_date", scheme).alias("week_year"),
                      week_number("week_date", scheme).alias("week_number"), "week_date")


register("missing_weeks", _with("""
SELECT y.week_year, CAST(w.week_number AS INTEGER) AS week_number
FROM (SELECT DISTINCT week_year, weekofyear(make_date(week_year, 12, 28)) AS weeks FROM clean_weekly) y
JOIN range(1, 54) w(week_number) ON w.week_number <= y.weeks
WHERE NOT EXISTS (SELECT 1 FROM clean_weekly c
                  WHERE c.week_year = y.week_year AND c.week_number = w.week_number)"""))(
    lambda spark, d: missing_periods(_weeks(spark, d, "iso"), "week_number", 1, iso_weeks_in("week_year"),
                                     by="week_year"))

register("weeks_by_monday_number", """
SELECT CAST(year(w) AS INTEGER) AS week_year, CAST(strftime(w, '%W') AS INTEGER) AS week_number, w AS week_date
FROM (SELECT DISTINCT CAST(date_trunc('week', l_shipdate) AS DATE) AS w FROM lineitem)""")(
    lambda spark, d: _weeks(spark, d, "monday"))


def _totals_sql(by: list[str]) -> str:
    b = ", ".join(by)
    return _with(f"""SELECT {b}, CAST(SUM(sales) AS DOUBLE) AS total_sales,
  CAST(SUM(transactions) AS BIGINT) AS total_transactions FROM clean_weekly GROUP BY {b}""")


for _name, _by in (("totals_by_year", ["calendar_year"]),
                   ("totals_by_region_month", ["region", "calendar_year", "month_number"]),
                   ("totals_by_platform", ["platform"])):
    register(_name, _totals_sql(_by))(
        (lambda by: lambda spark, d: totals_by(
            cw(spark, d), by, rows=None, as_double=False,
            sums={"total_sales": "sales", "total_transactions": "transactions"})
            .withColumn("total_sales", F.col("total_sales").cast("double")))(_by))


def _pivot_sql(rows: list[str], col: str, values: list[str], where: str = "") -> str:
    r = ", ".join(rows)
    parts = [f"CAST(SUM(CASE WHEN {col} = '{v}' THEN sales ELSE 0 END) AS DOUBLE) / "
             f"CAST(SUM(sales) AS DOUBLE) AS share_{v.lower().replace(' ', '_')}"
             for v in values]
    return _with(f"SELECT {r}, {', '.join(parts)} FROM clean_weekly {where} GROUP BY {r}")


register("platform_share_by_month",
         _pivot_sql(["calendar_year", "month_number"], "platform", ["Retail", "Shopify"]))(
    lambda spark, d: pivot_share(cws(spark, d), ["calendar_year", "month_number"], "platform",
                                 ["Retail", "Shopify"], "sales"))

register("demographic_share_by_year",
         _pivot_sql(["calendar_year"], "demographic", ["Couples", "Families", "unknown"]))(
    lambda spark, d: pivot_share(cws(spark, d), ["calendar_year"], "demographic",
                                 ["Couples", "Families", "unknown"], "sales"))

register("age_demographic_share_retail", _with("""
SELECT age_band, demographic, CAST(SUM(sales) AS DOUBLE) AS total_sales,
       CAST(SUM(sales) AS DOUBLE) / CAST((SELECT SUM(sales) FROM clean_weekly
                                           WHERE platform = 'Retail') AS DOUBLE) AS share
FROM clean_weekly WHERE platform = 'Retail' GROUP BY age_band, demographic"""))(
    lambda spark, d: share_of_total(cws(spark, d).where(F.col("platform") == "Retail"),
                                    ["age_band", "demographic"], value="sales",
                                    name="total_sales")
    .withColumn("total_sales", F.col("total_sales").cast("double")))

register("avg_transaction_by_year_platform", _with("""
SELECT calendar_year, platform,
       CAST(SUM(sales) AS DOUBLE) / CAST(SUM(transactions) AS DOUBLE) AS avg_transaction
FROM clean_weekly GROUP BY calendar_year, platform"""))(
    lambda spark, d: ratio_of_sums(cw(spark, d), ["calendar_year", "platform"],
                                   "sales", "transactions", name="avg_transaction"))


def _ba_sql(k: int, dims: list[str]) -> str:
    span = 7 * k
    rank = ", RANK() OVER (ORDER BY pct_change NULLS LAST) AS change_rank" if dims else ""
    sel = "".join(f"{x}, " for x in dims)
    grp = f"GROUP BY {', '.join(dims)}" if dims else ""
    return _with(f"""
SELECT {sel}before_value, after_value, change, pct_change{rank} FROM (
SELECT {sel}CAST(b AS DOUBLE) AS before_value, CAST(a AS DOUBLE) AS after_value,
       CAST(a - b AS DOUBLE) AS change,
       CASE WHEN b = 0 THEN NULL ELSE CAST(a - b AS DOUBLE) / CAST(b AS DOUBLE) END AS pct_change
FROM (SELECT {sel}COALESCE(SUM(CASE WHEN week_date < DATE '{EVENT}' THEN sales END), 0) AS b,
             COALESCE(SUM(CASE WHEN week_date >= DATE '{EVENT}' THEN sales END), 0) AS a
      FROM clean_weekly
      WHERE week_date >= DATE '{EVENT}' - {span} AND week_date < DATE '{EVENT}' + {span}
      {grp}))""")


def _ba_query(k: int, dims: list[str]):
    ev = dt.date.fromisoformat(EVENT)
    # widen by a week so the Monday-bucketed filter stays exact; pushed to parquet
    lo = (ev - dt.timedelta(days=7 * k + 7)).isoformat()
    hi = (ev + dt.timedelta(days=7 * k + 7)).isoformat()
    ranked = ranked_by_change if dims else (lambda x: x)
    return lambda spark, d: ranked(before_after(cws(spark, d, ship_from=lo, ship_to=hi), "week_date",
                                                EVENT, "sales", k, dims))


for _k in KS:
    register(f"before_after_{_k}w", _ba_sql(_k, []))(_ba_query(_k, []))

for _dim in ("region", "platform", "age_band", "demographic", "customer_type"):
    register(f"before_after_12w_by_{_dim}", _ba_sql(12, [_dim]))(_ba_query(12, [_dim]))


def _bay_sql(k: int) -> str:
    return _with(f"""
SELECT y AS calendar_year, CAST(b AS DOUBLE) AS before_value, CAST(a AS DOUBLE) AS after_value,
       CAST(a - b AS DOUBLE) AS change,
       CASE WHEN b = 0 THEN NULL ELSE CAST(a - b AS DOUBLE) / CAST(b AS DOUBLE) END AS pct_change
FROM (SELECT y, COALESCE(SUM(CASE WHEN week_date < anchor THEN sales END), 0) AS b,
             COALESCE(SUM(CASE WHEN week_date >= anchor THEN sales END), 0) AS a
      FROM clean_weekly
      JOIN (SELECT DISTINCT week_year AS y,
                   CAST(date_trunc('week', make_date(week_year, 1, 4)) AS DATE)
                     + CAST(7 * (weekofyear(DATE '{EVENT}') - 1) AS INTEGER) AS anchor
            FROM clean_weekly) ON week_date >= anchor - {7 * k} AND week_date < anchor + {7 * k}
      GROUP BY y HAVING COUNT(*) FILTER (WHERE week_year = y) > 0)""")


for _k in KS:
    register(f"before_after_by_year_{_k}w", _bay_sql(_k))(
        (lambda k: lambda spark, d: before_after_by_year(cws(spark, d), "week_date", EVENT, "sales", k))(_k))

register("avg_transaction_rounded", _with("""
SELECT calendar_year, platform,
       ROUND(CAST(SUM(sales) AS DOUBLE) / CAST(SUM(transactions) AS DOUBLE), 2) AS avg_transaction
FROM clean_weekly GROUP BY calendar_year, platform"""))(
    lambda spark, d: ratio_of_sums(cw(spark, d), ["calendar_year", "platform"],
                                   "sales", "transactions", name="avg_transaction", digits=2))
