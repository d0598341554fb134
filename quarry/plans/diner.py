"""Diner analyses (1.0-1.12) on the sales / members stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import milestone as M
from quarry.operators import rank as R
from quarry.operators.totals import totals_by
from quarry.plans.registry import register
from quarry.plans.standins import SALES_SQL, members, sales
from quarry.sources.io import Tables

# The item that earns double points, and the points cut-off date.
DOUBLE_ITEM = "red plate"
CUTOFF = "1999-12-31"
LINE_KEY = ["order_id", "line_no", "product_id", "supplier_id"]


def W(sql: str) -> str:
    return "WITH " + SALES_SQL + "\n" + sql


def _s(spark, d):
    return sales(Tables(spark, d))


def _m(spark, d):
    return members(Tables(spark, d))


def _price_double(df):
    return df.withColumn("price", F.col("price").cast("double"))


@register("enrich_fact", W("""
SELECT s.customer_id, s.order_date, s.order_id, s.line_no, s.product_id, s.supplier_id,
       s.product_name, CAST(s.price AS DOUBLE) AS price,
       CASE WHEN s.order_date >= m.join_date THEN 'Y' ELSE 'N' END AS member,
       ROW_NUMBER() OVER (PARTITION BY s.customer_id
                          ORDER BY s.order_date, s.order_id, s.line_no, s.product_id,
                                   s.supplier_id) AS visit_seq
FROM sales s LEFT JOIN members m ON s.customer_id = m.customer_id"""))
def enrich_fact(spark, d):
    x = M.flag_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date", "join_date")
    x = R.sequence_number(x, "customer_id", "order_date", LINE_KEY, name="visit_seq")
    return _price_double(x.drop("join_date"))


@register("spend_per_customer", W("""
SELECT customer_id, CAST(SUM(price) AS DOUBLE) AS total_spend FROM sales GROUP BY 1"""))
def spend_per_customer(spark, d):
    return totals_by(_s(spark, d), "customer_id", sums={"total_spend": "price"}, rows=None)


@register("active_days", W("""
SELECT customer_id, COUNT(DISTINCT order_date) AS active_days FROM sales GROUP BY 1"""))
def active_days(spark, d):
    return totals_by(_s(spark, d), "customer_id", distinct={"active_days": "order_date"},
                     rows=None)


@register("first_item_per_customer", W("""
SELECT DISTINCT customer_id, order_date, product_name FROM (
  SELECT *, RANK() OVER (PARTITION BY customer_id ORDER BY order_date) AS rk FROM sales)
WHERE rk = 1"""))
def first_item_per_customer(spark, d):
    return (R.first_per(_s(spark, d), "customer_id", "order_date")
            .select("customer_id", "order_date", "product_name").distinct())


@register("top_item", W("""
SELECT product_name, COUNT(*) AS n_purchases FROM sales GROUP BY 1
ORDER BY n_purchases DESC, product_name LIMIT 1"""))
def top_item(spark, d):
    return R.count_top_k_per(_s(spark, d), None, "product_name", 1, name="n_purchases")


@register("top_item_per_customer", W("""
SELECT customer_id, product_name, n_purchases FROM (
  SELECT customer_id, product_name, COUNT(*) AS n_purchases,
         RANK() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC) AS rk
  FROM sales GROUP BY 1, 2) WHERE rk = 1"""))
def top_item_per_customer(spark, d):
    return R.count_top_k_per(_s(spark, d), "customer_id", "product_name", 1,
                             name="n_purchases")


@register("first_after_milestone", W("""
SELECT DISTINCT customer_id, order_date, product_name FROM (
  SELECT s.*, RANK() OVER (PARTITION BY s.customer_id ORDER BY s.order_date) AS rk
  FROM sales s JOIN members m ON s.customer_id = m.customer_id
  WHERE s.order_date >= m.join_date) WHERE rk = 1"""))
def first_after_milestone(spark, d):
    x = M.split_at_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date",
                             "join_date", "after")
    return (R.first_per(x, "customer_id", "order_date")
            .select("customer_id", "order_date", "product_name").distinct())


@register("last_before_milestone", W("""
SELECT DISTINCT customer_id, order_date, product_name FROM (
  SELECT s.*, RANK() OVER (PARTITION BY s.customer_id ORDER BY s.order_date DESC) AS rk
  FROM sales s JOIN members m ON s.customer_id = m.customer_id
  WHERE s.order_date < m.join_date) WHERE rk = 1"""))
def last_before_milestone(spark, d):
    x = M.split_at_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date",
                             "join_date", "before")
    return (R.last_per(x, "customer_id", "order_date")
            .select("customer_id", "order_date", "product_name").distinct())


@register("totals_before_milestone", W("""
SELECT s.customer_id, COUNT(*) AS n_items, CAST(SUM(s.price) AS DOUBLE) AS total_spend
FROM sales s JOIN members m ON s.customer_id = m.customer_id
WHERE s.order_date < m.join_date GROUP BY 1"""))
def totals_before_milestone(spark, d):
    x = M.split_at_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date",
                             "join_date", "before")
    return totals_by(x, "customer_id", sums={"total_spend": "price"}, rows="n_items")


@register("points_by_rule", W(f"""
SELECT customer_id,
       CAST(SUM(price * CASE WHEN product_name = '{DOUBLE_ITEM}' THEN 20 ELSE 10 END)
            AS DOUBLE) AS points
FROM sales GROUP BY 1"""))
def points_by_rule(spark, d):
    return M.points(_s(spark, d), "customer_id", "price",
                    [(F.col("product_name") == DOUBLE_ITEM, 20)], 10)


@register("points_with_bonus_window", W(f"""
SELECT s.customer_id,
       CAST(SUM(s.price * CASE WHEN s.order_date BETWEEN m.join_date AND m.join_date + 6 THEN 20
                               WHEN s.product_name = '{DOUBLE_ITEM}' THEN 20 ELSE 10 END)
            AS DOUBLE) AS points
FROM sales s JOIN members m ON s.customer_id = m.customer_id
WHERE s.order_date <= DATE '{CUTOFF}' GROUP BY 1"""))
def points_with_bonus_window(spark, d):
    x = M.until(_s(spark, d), "order_date", CUTOFF).join(_m(spark, d), "customer_id")
    return M.points(x, "customer_id", "price",
                    [(M.bonus_window_rule("order_date", "join_date", 7), 20),
                     (F.col("product_name") == DOUBLE_ITEM, 20)], 10)


@register("member_flag_listing", W("""
SELECT s.customer_id, s.order_date, s.product_name, CAST(s.price AS DOUBLE) AS price,
       CASE WHEN s.order_date >= m.join_date THEN 'Y' ELSE 'N' END AS member
FROM sales s LEFT JOIN members m ON s.customer_id = m.customer_id"""))
def member_flag_listing(spark, d):
    x = M.flag_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date", "join_date")
    return _price_double(x.select("customer_id", "order_date", "product_name", "price",
                                  "member"))


@register("masked_dense_rank", W("""
SELECT s.customer_id, s.order_date, s.order_id, s.line_no, s.product_id, s.supplier_id,
       s.product_name, CAST(s.price AS DOUBLE) AS price,
       CASE WHEN s.order_date >= m.join_date THEN 'Y' ELSE 'N' END AS member,
       CASE WHEN s.order_date >= m.join_date THEN
         DENSE_RANK() OVER (PARTITION BY s.customer_id, s.order_date >= m.join_date
                            ORDER BY s.order_date) END AS ranking
FROM sales s LEFT JOIN members m ON s.customer_id = m.customer_id"""))
def masked_dense_rank(spark, d):
    x = M.flag_milestone(_s(spark, d), _m(spark, d), "customer_id", "order_date", "join_date")
    x = R.masked_rank(x, "customer_id", "order_date", F.col("member") == "Y")
    return _price_double(x.drop("join_date"))
