"""Bank analyses (4.1-4.11) on the customer_nodes / customer_transactions
stand-ins.  Transactions in the driver data span one month, so balances are
closed per week (the operators take any period)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import balance as B
from quarry.operators import runs as RU
from quarry.operators.totals import totals_by
from quarry.plans.registry import register
from quarry.plans.standins import BANK_SQL, customer_nodes, customer_transactions
from quarry.sources.io import Tables

PERIOD = "week"


def W(sql: str) -> str:
    body = sql.lstrip()
    return "WITH " + BANK_SQL + ("\n" + body if body.startswith(",") else "\n" + sql)


def _n(spark, d):
    return customer_nodes(Tables(spark, d))


def _t(spark, d):
    return customer_transactions(Tables(spark, d))


def _signed(spark, d):
    return _t(spark, d).withColumn("signed_amount", B.signed_amount("txn_type", "txn_amount"))


@register("distinct_region_nodes", W("""
SELECT COUNT(*) AS n_pairs FROM (SELECT DISTINCT region_id, node FROM customer_nodes)"""))
def distinct_region_nodes(spark, d):
    return totals_by(_n(spark, d), None, distinct={"n_pairs": ["region_id", "node"]}, rows=None)


@register("distinct_per_region", W("""
SELECT region_id, COUNT(DISTINCT node) AS n_nodes, COUNT(DISTINCT customer_id) AS n_customers
FROM customer_nodes GROUP BY 1"""))
def distinct_per_region(spark, d):
    return totals_by(_n(spark, d), "region_id", rows=None,
                     distinct={"n_nodes": "node", "n_customers": "customer_id"})


@register("run_durations", W("""
SELECT CAST(SUM(length) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_length,
       COUNT(*) AS n_runs FROM closed_runs"""))
def run_durations(spark, d):
    return RU.run_durations(customer_nodes(Tables(spark, d), region=False), "customer_id", "start_ts", "node", ["event_id"])


# Oracle: interpolation written out as (hi_pos - pos) * lo + (pos - lo_pos) * hi over
# pos = (n - 1) * p, the formula of Spark's exact percentile aggregate.
@register("run_duration_percentiles", W("""
, ranked AS (
  SELECT region_id, CAST(length AS DOUBLE) AS v,
         ROW_NUMBER() OVER (PARTITION BY region_id ORDER BY length) - 1 AS rn,
         COUNT(*) OVER (PARTITION BY region_id) AS n
  FROM closed_runs
),
pos AS (
  SELECT region_id, CAST(MAX(n) - 1 AS DOUBLE) * CAST(0.5 AS DOUBLE) AS pos_p50, CAST(MAX(n) - 1 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS pos_p80, CAST(MAX(n) - 1 AS DOUBLE) * CAST(0.95 AS DOUBLE) AS pos_p95
  FROM ranked GROUP BY 1
),
picked AS (
  SELECT p.*, MAX(CASE WHEN r.rn = floor(p.pos_p50) THEN r.v END) AS lo_p50, MAX(CASE WHEN r.rn = ceil(p.pos_p50) THEN r.v END) AS hi_p50, MAX(CASE WHEN r.rn = floor(p.pos_p80) THEN r.v END) AS lo_p80, MAX(CASE WHEN r.rn = ceil(p.pos_p80) THEN r.v END) AS hi_p80, MAX(CASE WHEN r.rn = floor(p.pos_p95) THEN r.v END) AS lo_p95, MAX(CASE WHEN r.rn = ceil(p.pos_p95) THEN r.v END) AS hi_p95
  FROM pos p JOIN ranked r ON r.region_id = p.region_id GROUP BY ALL
)
SELECT region_id,
       CASE WHEN floor(pos_p50) = ceil(pos_p50) OR lo_p50 = hi_p50 THEN lo_p50 ELSE (ceil(pos_p50) - pos_p50) * lo_p50 + (pos_p50 - floor(pos_p50)) * hi_p50 END AS p50,
       CASE WHEN floor(pos_p80) = ceil(pos_p80) OR lo_p80 = hi_p80 THEN lo_p80 ELSE (ceil(pos_p80) - pos_p80) * lo_p80 + (pos_p80 - floor(pos_p80)) * hi_p80 END AS p80,
       CASE WHEN floor(pos_p95) = ceil(pos_p95) OR lo_p95 = hi_p95 THEN lo_p95 ELSE (ceil(pos_p95) - pos_p95) * lo_p95 + (pos_p95 - floor(pos_p95)) * hi_p95 END AS p95
FROM picked"""))
def run_duration_percentiles(spark, d):
    r = RU.runs(_n(spark, d), "customer_id", "start_ts", "node", ["event_id"],
                extra=["region_id"])
    return RU.duration_percentiles(r, "region_id", "length")


@register("totals_per_type", W("""
SELECT txn_type, COUNT(DISTINCT txn_amount) AS n_distinct_amounts,
       CAST(SUM(txn_amount) AS DOUBLE) AS total_amount
FROM customer_transactions GROUP BY 1"""))
def totals_per_type(spark, d):
    return totals_by(_t(spark, d), "txn_type", rows=None,
                     distinct={"n_distinct_amounts": "txn_amount"},
                     sums={"total_amount": "txn_amount"})


@register("avg_deposits_per_customer", W("""
SELECT CAST(SUM(n) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_deposit_count,
       CAST(SUM(amount) AS DOUBLE) / CAST(SUM(n) AS DOUBLE) AS avg_deposit_amount
FROM (SELECT customer_id, COUNT(*) AS n, SUM(txn_amount) AS amount
      FROM customer_transactions WHERE txn_type = 'deposit' GROUP BY 1)"""))
def avg_deposits_per_customer(spark, d):
    per = (_t(spark, d).where(F.col("txn_type") == "deposit")
           .groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"),
                                       F.sum("txn_amount").alias("amount")))
    return per.agg(
        F.try_divide(F.sum("n").cast("double"), F.count(F.lit(1)).cast("double"))
        .alias("avg_deposit_count"),
        F.try_divide(F.sum("amount").cast("double"), F.sum("n").cast("double"))
        .alias("avg_deposit_amount"))


@register("qualified_customers_by_week", W("""
SELECT period_start, COUNT(*) AS n_customers FROM (
  SELECT customer_id, CAST(date_trunc('week', txn_date) AS DATE) AS period_start,
         COUNT(*) FILTER (WHERE txn_type = 'deposit') AS c,
         COUNT(*) FILTER (WHERE txn_type IN ('purchase', 'withdrawal')) AS dbt
  FROM customer_transactions GROUP BY 1, 2)
WHERE c >= 2 AND dbt >= 1 GROUP BY 1"""))
def qualified_customers_by_week(spark, d):
    return B.qualified_by_period(_t(spark, d), "customer_id", "txn_date", "txn_type", PERIOD)


@register("running_balance", W("""
SELECT customer_id, txn_date, CAST(net_amount AS DOUBLE) AS net_amount,
       CAST(balance AS DOUBLE) AS balance FROM daily"""))
def running_balance(spark, d):
    r = B.running_balance(_signed(spark, d), "customer_id", "txn_date", "signed_amount")
    return (r.withColumn("net_amount", F.col("net_amount").cast("double"))
             .withColumn("balance", F.col("balance").cast("double")))


_CLOSE_SQL = """
closes AS (
  SELECT customer_id, period_start, closing_balance,
         DENSE_RANK() OVER (PARTITION BY customer_id ORDER BY period_start) AS period_rank
  FROM (SELECT customer_id, CAST(date_trunc('week', txn_date) AS DATE) AS period_start,
               arg_max(balance, txn_date) AS closing_balance
        FROM daily GROUP BY 1, 2)
)"""


def _closes(spark, d, first_k=None):
    r = B.running_balance(_signed(spark, d), "customer_id", "txn_date", "signed_amount")
    return B.period_close(r, "customer_id", "txn_date", PERIOD, first_k)


@register("weekly_closing_balance", W(f""",{_CLOSE_SQL}
SELECT customer_id, period_start, CAST(closing_balance AS DOUBLE) AS closing_balance,
       period_rank FROM closes"""))
def weekly_closing_balance(spark, d):
    return _closes(spark, d).withColumn("closing_balance",
                                        F.col("closing_balance").cast("double"))


@register("first_two_periods_close", W(f""",{_CLOSE_SQL}
SELECT customer_id, period_start, CAST(closing_balance AS DOUBLE) AS closing_balance,
       period_rank FROM closes WHERE period_rank <= 2"""))
def first_two_periods_close(spark, d):
    return _closes(spark, d, 2).withColumn("closing_balance",
                                           F.col("closing_balance").cast("double"))


@register("opening_sign_share", W(f""",{_CLOSE_SQL}
SELECT CASE WHEN closing_balance < 0 THEN 'negative' ELSE 'positive' END AS sign,
       COUNT(*) AS n_customers,
       CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM closes WHERE period_rank = 1)
                                       AS DOUBLE) AS share
FROM closes WHERE period_rank = 1 GROUP BY 1"""))
def opening_sign_share(spark, d):
    return B.sign_share(_closes(spark, d, 1))


@register("balance_change_classes", W("""
, per AS (
  SELECT customer_id,
         SUM(CASE WHEN txn_date < p1 + 7 THEN net_amount ELSE 0 END) AS c1,
         SUM(CASE WHEN txn_date < p1 + 14 THEN net_amount ELSE 0 END) AS c2
  FROM (SELECT *, MIN(CAST(date_trunc('week', txn_date) AS DATE))
                    OVER (PARTITION BY customer_id) AS p1 FROM daily)
  GROUP BY 1)
SELECT COUNT(*) AS n_customers,
       COUNT(*) FILTER (WHERE c1 > 0) AS n_positive_first,
       COUNT(*) FILTER (WHERE c1 < 0) AS n_negative_first,
       CAST(COUNT(*) FILTER (WHERE c1 > 0 AND c2 > c1 * 1.05) AS DOUBLE) / COUNT(*)
         AS share_increase,
       CAST(COUNT(*) FILTER (WHERE c1 > 0 AND c2 < c1 * 0.95) AS DOUBLE) / COUNT(*)
         AS share_decrease,
       CAST(COUNT(*) FILTER (WHERE c1 > 0 AND c2 < 0) AS DOUBLE) / COUNT(*)
         AS share_to_negative
FROM per"""))
def balance_change_classes(spark, d):
    return B.balance_change_classes(_signed(spark, d), "customer_id", "txn_date",
                                    "signed_amount", PERIOD)
