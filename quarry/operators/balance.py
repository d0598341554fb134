"""Running balances and period closings (analyses 4.5-4.11; survey ids E8,
K1, D9, D12, E2).

Every balance operator first pre-aggregates to one row per (key, day) with
map-side partial sums, so the per-key window runs over at most one row per
active day -- a customer with a third of all transactions still contributes
only its number of active days to the window task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.dates import period_start
from quarry.operators._util import as_col, cols, ratio


def signed_amount(txn_type: str, amount: str, credit=("deposit",)) -> F.Column:
    """+amount for credit types, -amount otherwise (H1)."""
    a = as_col(amount)
    return F.when(F.col(txn_type).isin(list(credit)), a).otherwise(-a)


def running_balance(df: DataFrame, key, date: str, signed: str) -> DataFrame:
    """Per key and active day: net change and closing balance (4.8)."""
    daily = df.groupBy(*cols(key), date).agg(F.sum(as_col(signed)).alias("net_amount"))
    w = (Window.partitionBy(*cols(key)).orderBy(date)
         .rowsBetween(Window.unboundedPreceding, 0))
    return daily.withColumn("balance", F.sum("net_amount").over(w))


def period_close(balances: DataFrame, key, date: str, period: str = "month",
                 first_k: int | None = None) -> DataFrame:
    """Closing balance of each active period = balance on its last active day
    (ruling X23), with the period's rank among the key's active periods."""
    p = balances.withColumn("period_start", period_start(date, period))
    g = (p.groupBy(*cols(key), "period_start")
          .agg(F.max_by("balance", F.col(date)).alias("closing_balance")))
    w = Window.partitionBy(*cols(key)).orderBy("period_start")
    g = g.withColumn("period_rank", F.dense_rank().over(w).cast("bigint"))
    if first_k is not None:
        g = g.where(F.col("period_rank") <= first_k)
    return g


def qualified_by_period(df: DataFrame, key, date: str, txn_type: str, period: str,
                        min_credits: int = 2, credit: str = "deposit",
                        debits=("purchase", "withdrawal")) -> DataFrame:
    """Customers per period with >= min_credits credits and at least one
    debit (4.7, D9 + B8), grouped by the period's start date (ruling X9)."""
    per = (df.withColumn("period_start", period_start(date, period))
             .groupBy(*cols(key), "period_start")
             .agg(F.count_if(F.col(txn_type) == credit).alias("_c"),
                  F.count_if(F.col(txn_type).isin(list(debits))).alias("_d")))
    return (per.where((F.col("_c") >= min_credits) & (F.col("_d") >= 1))
               .groupBy("period_start").agg(F.count(F.lit(1)).alias("n_customers")))


def sign_share(closes: DataFrame, value: str = "closing_balance") -> DataFrame:
    """Share of keys whose value is negative / positive (4.10)."""
    lab = F.when(F.col(value) < 0, "negative").otherwise("positive")
    g = closes.groupBy(lab.alias("sign")).agg(F.count(F.lit(1)).alias("n_customers"))
    total = closes.select(F.count(F.lit(1))).scalar()
    return g.withColumn("share", ratio("n_customers", total))


def balance_change_classes(df: DataFrame, key, date: str, signed: str, period: str = "month",
                           pct: float = 0.05) -> DataFrame:
    """Compare each key's closing balance at the end of its first calendar
    period with the end of the period after it (4.11, rulings X21, X24).

    A period without transactions carries the balance forward (a closing
    balance persists), so the balance at the end of period n is simply the sum
    of all amounts dated before period n+1 -- no month spine is needed.
    Classes: increase (prev > 0, cur > (1+pct)*prev), decrease (prev > 0,
    cur < (1-pct)*prev), to_negative (prev > 0, cur < 0)."""
    daily = df.groupBy(*cols(key), date).agg(F.sum(as_col(signed)).alias("_net"))
    first = F.min(period_start(date, period)).over(Window.partitionBy(*cols(key)))
    unit = {"month": 1, "quarter": 3, "year": 12}
    x = daily.withColumn("_p1", first)
    if period in unit:
        e1, e2 = F.add_months("_p1", unit[period]), F.add_months("_p1", 2 * unit[period])
    elif period == "week":
        e1, e2 = F.date_add("_p1", 7), F.date_add("_p1", 14)
    else:
        e1, e2 = F.date_add("_p1", 1), F.date_add("_p1", 2)
    per = x.groupBy(*cols(key)).agg(
        F.sum(F.when(F.col(date) < e1, F.col("_net")).otherwise(0)).alias("_c1"),
        F.sum(F.when(F.col(date) < e2, F.col("_net")).otherwise(0)).alias("_c2"))
    c1, c2 = F.col("_c1"), F.col("_c2")
    up = F.lit(1 + pct).cast("decimal(6,4)")
    down = F.lit(1 - pct).cast("decimal(6,4)")
    n = F.count(F.lit(1))
    return per.agg(
        n.alias("n_customers"),
        F.count_if(c1 > 0).alias("n_positive_first"),
        F.count_if(c1 < 0).alias("n_negative_first"),
        ratio(F.count_if((c1 > 0) & (c2 > c1 * up)), n).alias("share_increase"),
        ratio(F.count_if((c1 > 0) & (c2 < c1 * down)), n).alias("share_decrease"),
        ratio(F.count_if((c1 > 0) & (c2 < 0)), n).alias("share_to_negative"))
