"""Subscription analyses (3.0-3.12) on the subscriptions / plans stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.dates import month_name, month_start
from quarry.operators import states as S
from quarry.operators.impact import period_growth
from quarry.operators.share import share_of_total
from quarry.operators.totals import totals_by
from quarry.plans.registry import register
from quarry.plans.standins import SUBS_SQL, plans, subscriptions
from quarry.sources.io import Tables

# Plan ids of the state machine and the dates the questions use.
TRIAL, BASIC, PRO, ANNUAL, CHURN = 0, 1, 2, 3, 4
AFTER_DATE = "2000-12-31"
AS_OF = "1998-12-31"
YEAR_FROM, YEAR_TO = "1998-01-01", "1998-12-31"
CUTOFF = "2001-12-31"

K, T, ST, TIE = "customer_id", "start_date", "plan_id", ["sub_id"]


def W(sql: str) -> str:
    body = sql.lstrip()
    if body.startswith("WITH "):
        return "WITH " + SUBS_SQL + ",\n" + body[5:]
    return "WITH " + SUBS_SQL + "\n" + sql


def _s(spark, d):
    return subscriptions(Tables(spark, d))


@register("journey", W("""
SELECT s.customer_id, s.plan_id, p.plan_name, s.start_date, s.sub_id,
       ROW_NUMBER() OVER (PARTITION BY s.customer_id ORDER BY s.start_date, s.sub_id)
         AS state_seq
FROM subscriptions s JOIN plans p ON s.plan_id = p.plan_id"""))
def journey(spark, d):
    x = _s(spark, d).join(F.broadcast(plans(spark).select("plan_id", "plan_name")), "plan_id")
    x = S.with_neighbors(x, K, T, ST, TIE, prev=False, nxt=False)
    return x.select(K, ST, "plan_name", T, "sub_id", "state_seq")


@register("distinct_customers", W("""
SELECT COUNT(DISTINCT customer_id) AS n_customers FROM subscriptions"""))
def distinct_customers(spark, d):
    return totals_by(_s(spark, d), None, distinct={"n_customers": K}, rows=None)


@register("starts_per_month", W(f"""
SELECT CAST(date_trunc('month', start_date) AS DATE) AS month_start,
       monthname(date_trunc('month', start_date)) AS month_name, COUNT(*) AS n_starts
FROM subscriptions WHERE plan_id = {TRIAL} GROUP BY 1, 2"""))
def starts_per_month(spark, d):
    x = (_s(spark, d).where(F.col(ST) == TRIAL)
         .withColumn("month_start", month_start(T))
         .withColumn("month_name", month_name("month_start")))
    return totals_by(x, ["month_start", "month_name"], rows="n_starts")


@register("events_after_date", W(f"""
SELECT s.plan_id, p.plan_name, COUNT(*) AS n_events
FROM subscriptions s JOIN plans p ON s.plan_id = p.plan_id
WHERE s.start_date > DATE '{AFTER_DATE}' GROUP BY 1, 2"""))
def events_after_date(spark, d):
    x = (_s(spark, d).where(F.col(T) > F.lit(AFTER_DATE).cast("date"))
         .join(F.broadcast(plans(spark).select("plan_id", "plan_name")), ST))
    return totals_by(x, [ST, "plan_name"], rows="n_events")


@register("churn_share", W(f"""
SELECT COUNT(DISTINCT customer_id) AS n_customers,
       CAST(COUNT(DISTINCT customer_id) AS DOUBLE)
         / CAST((SELECT COUNT(DISTINCT customer_id) FROM subscriptions) AS DOUBLE) AS share
FROM subscriptions WHERE plan_id = {CHURN}"""))
def churn_share(spark, d):
    s = _s(spark, d)
    everyone = s.select(F.count_distinct(K)).scalar()
    return share_of_total(s.where(F.col(ST) == CHURN), None, count_distinct=K, name="n_customers", of=everyone)


@register("churn_after_trial", W(f"""
SELECT COUNT(DISTINCT customer_id) AS n_customers,
       CAST(COUNT(DISTINCT customer_id) AS DOUBLE)
         / CAST((SELECT COUNT(DISTINCT customer_id) FROM subscriptions) AS DOUBLE) AS share
FROM (SELECT customer_id, plan_id,
             LEAD(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, sub_id) AS nxt
      FROM subscriptions) WHERE plan_id = {TRIAL} AND nxt = {CHURN}"""))
def churn_after_trial(spark, d):
    return S.customers_with_transition(_s(spark, d), K, T, ST, TRIAL, CHURN, TIE)


@register("next_state_share", W(f"""
WITH x AS (SELECT plan_id, LEAD(plan_id) OVER (PARTITION BY customer_id
                                              ORDER BY start_date, sub_id) AS next_plan_id
           FROM subscriptions)
SELECT next_plan_id, COUNT(*) AS n,
       CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM x WHERE plan_id = {TRIAL}
                                         AND next_plan_id IS NOT NULL) AS DOUBLE) AS share
FROM x WHERE plan_id = {TRIAL} AND next_plan_id IS NOT NULL GROUP BY 1"""))
def next_state_share(spark, d):
    return S.next_state_share(_s(spark, d), K, T, ST, TRIAL, TIE)


@register("state_as_of", W(f"""
WITH last AS (
  SELECT customer_id, arg_max(plan_id, (start_date, sub_id)) AS plan_id
  FROM subscriptions WHERE start_date <= DATE '{AS_OF}' GROUP BY 1)
SELECT plan_id, COUNT(*) AS n,
       CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM last) AS DOUBLE) AS share
FROM last GROUP BY 1"""))
def state_as_of(spark, d):
    return S.state_as_of(_s(spark, d), K, T, ST, AS_OF, TIE)


@register("entered_state_in_range", W(f"""
SELECT COUNT(DISTINCT customer_id) AS n_customers FROM subscriptions
WHERE plan_id = {ANNUAL} AND start_date BETWEEN DATE '{YEAR_FROM}' AND DATE '{YEAR_TO}'"""))
def entered_state_in_range(spark, d):
    return S.entered_state_in_range(_s(spark, d), K, T, ST, ANNUAL, YEAR_FROM, YEAR_TO)


@register("days_between_states", W(f"""
SELECT CAST(SUM(days) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS avg_days,
       COUNT(*) AS n_customers
FROM (SELECT customer_id,
             datediff('day', MIN(start_date),
                      MIN(CASE WHEN plan_id = {ANNUAL} THEN start_date END)) AS days
      FROM subscriptions GROUP BY 1) WHERE days IS NOT NULL"""))
def days_between_states(spark, d):
    return S.days_between_states(_s(spark, d), K, T, ST, ANNUAL)


@register("transition_counts", W(f"""
SELECT from_plan_id, to_plan_id, COUNT(*) AS n_transitions FROM (
  SELECT LAG(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, sub_id)
           AS from_plan_id, plan_id AS to_plan_id, start_date FROM subscriptions)
WHERE from_plan_id IS NOT NULL
  AND start_date BETWEEN DATE '{YEAR_FROM}' AND DATE '{YEAR_TO}'
GROUP BY 1, 2"""))
def transition_counts(spark, d):
    return S.transition_counts(_s(spark, d), K, T, ST, TIE, YEAR_FROM, YEAR_TO)


PAYMENTS_SQL = SUBS_SQL + f""",
seq AS (
  SELECT s.*, LAG(plan_id) OVER w AS prev_plan, LAG(start_date) OVER w AS prev_start,
         LEAD(start_date) OVER w AS next_start
  FROM subscriptions s
  WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, sub_id)
),
billable AS (
  SELECT q.customer_id, q.plan_id, q.start_date, q.prev_plan, q.prev_start,
         p.plan_name, p.price, pp.price AS prev_price,
         CASE WHEN q.plan_id = {ANNUAL} AND q.prev_plan = {PRO} THEN
                CASE WHEN CAST(q.prev_start + to_months(q.mi) AS DATE) >= q.start_date
                     THEN CAST(q.prev_start + to_months(q.mi) AS DATE)
                     ELSE CAST(q.prev_start + to_months(q.mi + 1) AS DATE) END
              ELSE q.start_date END AS begin_date,
         CASE WHEN q.next_start IS NULL OR q.next_start - 1 > DATE '{CUTOFF}'
              THEN DATE '{CUTOFF}' ELSE q.next_start - 1 END AS last_date,
         CASE WHEN q.plan_id = {ANNUAL} THEN 12 ELSE 1 END AS step
  FROM (SELECT *, (year(start_date) - year(prev_start)) * 12
                  + month(start_date) - month(prev_start) AS mi FROM seq) q
  JOIN plans p ON q.plan_id = p.plan_id
  LEFT JOIN plans pp ON q.prev_plan = pp.plan_id
  WHERE q.plan_id IN ({BASIC}, {PRO}, {ANNUAL})
),
series AS (
  SELECT b.*, unnest(generate_series(0, CAST(floor(((year(last_date) - year(begin_date)) * 12
                     + month(last_date) - month(begin_date)) / step) AS BIGINT))) AS i
  FROM billable b
),
payments AS (
  SELECT customer_id, plan_id, plan_name,
         CAST(begin_date + to_months(CAST(i * step AS INTEGER)) AS DATE) AS payment_date,
         CAST(CASE WHEN i = 0 AND prev_plan = {BASIC} AND prev_start < start_date
                        AND price > prev_price THEN price - prev_price ELSE price END
              AS DOUBLE) AS amount, last_date
  FROM series
)"""


@register("payment_schedule", f"""WITH {PAYMENTS_SQL}
SELECT customer_id, plan_id, plan_name, payment_date, amount,
       ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY payment_date) AS payment_order
FROM payments WHERE payment_date <= last_date""")
def payment_schedule(spark, d):
    return S.payment_schedule(_s(spark, d), plans(spark), K, T, ST, CUTOFF, TIE)


@register("revenue_growth_by_month", f"""WITH {PAYMENTS_SQL}
SELECT month_start, CAST(total AS DOUBLE) AS total, CAST(prev AS DOUBLE) AS previous,
       CAST(total - prev AS DOUBLE) / CAST(prev AS DOUBLE) AS pct_change
FROM (SELECT month_start, total, LAG(total) OVER (ORDER BY month_start) AS prev
      FROM (SELECT CAST(date_trunc('month', payment_date) AS DATE) AS month_start,
                   SUM(CAST(amount AS DECIMAL(18,2))) AS total
            FROM payments WHERE payment_date <= last_date GROUP BY 1))""")
def revenue_growth_by_month(spark, d):
    p = payment_schedule(spark, d).withColumn("month_start", month_start("payment_date"))
    return period_growth(p.withColumn("amount", F.col("amount").cast("decimal(18,2)")),
                         "month_start", "amount")
