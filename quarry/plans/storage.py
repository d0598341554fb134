"""Sources and sinks at work (A2, A3, A6, A8, A11): tables that are written in one
form and read back, in the folder that driver and executors share."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators.lists import append_all_items_row
from quarry.plans.delivery import RATING_SQL, W, cleaned, deliveries, delivered, rating_col
from quarry.plans.registry import register
from quarry.plans.standins import SUBS_SQL, pizza_recipes, pizza_toppings, runner_orders, subscriptions
from quarry.sources.dumps import BAD, read_dump, write_dump
from quarry.sources.io import Tables, read_csv, write_csv
from quarry.sources.layout import write_bucketed
from quarry.sources.shared import shared_folder
from quarry.sources.tables import Table


def _through_a_dump(spark, df, table: str):
    path = shared_folder(spark, "dump")
    write_dump(df, path, table)
    return read_dump(spark, path, df.schema, table).withColumnRenamed(BAD, "bad")


@register("subscriptions_from_dump", "WITH " + SUBS_SQL + """
SELECT customer_id, plan_id, start_date, sub_id, CAST(NULL AS VARCHAR) AS bad FROM subscriptions""")
def subscriptions_from_dump(spark, d):
    """One INSERT per subscription, read back (A2)."""
    return _through_a_dump(spark, subscriptions(Tables(spark, d)), "shop.subscriptions")


@register("texts_from_dump", """
SELECT doc_id, text, lang, CAST(NULL AS VARCHAR) AS bad FROM documents""")
def texts_from_dump(spark, d):
    """Texts with quotes, line feeds and semicolons, from statements of many lines (A2)."""
    return _through_a_dump(spark, Tables(spark, d).documents.select("doc_id", "text", "lang"), "shop.texts")


@register("deliveries_from_csv", W("""
SELECT order_id, runner_id, pickup_time, CAST(distance_km AS DOUBLE) AS distance_km, duration_min, cancellation
FROM deliveries"""))
def deliveries_from_csv(spark, d):
    """Header CSV with blank cells for NULL, read with its schema (A3)."""
    df, path = deliveries(spark, d), shared_folder(spark, "csv")
    write_csv(df, path)
    return read_csv(spark, path, df.schema).withColumn("distance_km", F.col("distance_km").cast("double"))


@register("ratings_appended", W("""
SELECT order_id, """ + RATING_SQL.format("order_id") + """ AS rating FROM delivered"""))
def ratings_appended(spark, d):
    """INSERT .. SELECT in two batches (A6); the second is run again, as after a
    failure, and adds nothing."""
    ratings = delivered(spark, d).select("order_id", rating_col("order_id").alias("rating"))
    table = Table(spark, shared_folder(spark, "ratings"))
    table.replace(ratings.where("order_id % 2 = 0"), batch="even")
    for _ in range(2):
        table.append(ratings.where("order_id % 2 <> 0"), "odd")
    return table.read()


@register("recipes_replaced", W("""
SELECT pizza_id, toppings FROM pizza_recipes
UNION ALL
SELECT (SELECT MAX(pizza_id) + 1 FROM pizza_recipes),
       string_agg(CAST(topping_id AS VARCHAR), ', ' ORDER BY topping_id) FROM pizza_toppings"""))
def recipes_replaced(spark, d):
    """CREATE TABLE AS (A8), then replaced by a query over itself."""
    t = Tables(spark, d)
    table = Table(spark, shared_folder(spark, "recipes"))
    table.replace(pizza_recipes(t))
    table.replace(append_all_items_row(table.read(), pizza_toppings(t), "pizza_id", "toppings", "topping_id"))
    return table.read()


def by_order(spark, d, buckets: int = 16) -> Tables:
    """The driver tables with both facts stored by order key."""
    t, folder = Tables(spark, d), shared_folder(spark, "by-order")
    t.lineitem = write_bucketed(t.lineitem, f"{folder}/lineitem", "l_orderkey", buckets)
    t.orders = write_bucketed(t.orders, f"{folder}/orders", "o_orderkey", buckets)
    return t


@register("deliveries_by_order_bucket", W("""
SELECT order_id, runner_id, pickup_time, CAST(distance_km AS DOUBLE) AS distance_km, duration_min, cancellation
FROM deliveries"""))
def deliveries_by_order_bucket(spark, d):
    """Lines grouped by order and joined with orders, bucket by bucket: nothing moves."""
    return cleaned(runner_orders(by_order(spark, d))).withColumn("distance_km", F.col("distance_km").cast("double"))
