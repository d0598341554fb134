"""Tiny inline inputs of the reference case studies (fixed values)."""

import datetime as dt

from pyspark.sql import functions as F

D = dt.date.fromisoformat

# Diner sales, menu and members rows.
SALES = [("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2),
         ("A", "2021-01-10", 3), ("A", "2021-01-11", 3), ("A", "2021-01-11", 3),
         ("B", "2021-01-01", 2), ("B", "2021-01-02", 2), ("B", "2021-01-04", 1),
         ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
         ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3)]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]

# Delivery runners, order lines, deliveries, items, recipes, toppings.
RUNNERS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2021-01-01 18:05:02"), (2, 101, 1, "", "", "2021-01-01 19:00:52"),
    (3, 102, 1, "", "", "2021-01-02 23:51:23"), (3, 102, 2, "", "NaN", "2021-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2021-01-01 18:05:02"), (4, 103, 1, "4", "", "2021-01-01 18:05:02"),
    (4, 103, 2, "4", "", "2021-01-01 18:05:02"), (5, 104, 1, "null", "1", "2021-01-01 18:05:02"),
    (6, 101, 2, "null", "null", "2021-01-01 18:05:02"),
    (7, 105, 2, "null", "1", "2021-01-01 18:05:02"),
    (8, 102, 1, "null", "null", "2021-01-01 18:05:02"),
    (9, 103, 1, "4", "1,5", "2021-01-01 18:05:02"),
    (10, 104, 1, "null", "null", "2021-01-01 18:05:02"),
    (10, 104, 1, "2,6", "1,4", "2021-01-01 18:05:02")]
RUNNER_ORDERS = [
    (1, 1, "2021-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2021-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2021-01-03 00:12:37", "13.4km", "20 mins", "NaN"),
    (4, 2, "2021-01-04 13:53:03", "23.4", "40", "NaN"),
    (5, 3, "2021-01-08 21:10:57", "10", "15", "NaN"),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null")]
PIZZA_NAMES = [(1, "Meat Lovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
                  (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"),
                  (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")]


def diner(spark):
    s = spark.createDataFrame(SALES, "customer_id string, order_date string, product_id int") \
        .withColumn("order_date", F.to_date("order_date"))
    m = spark.createDataFrame(MENU, "product_id int, product_name string, price int")
    mem = spark.createDataFrame(MEMBERS, "customer_id string, join_date string") \
        .withColumn("join_date", F.to_date("join_date"))
    return s.join(m, "product_id"), mem


def delivery(spark):
    co = spark.createDataFrame(CUSTOMER_ORDERS, "order_id int, customer_id int, pizza_id int, "
                               "exclusions string, extras string, order_time string") \
        .withColumn("order_time", F.to_timestamp("order_time")) \
        .withColumn("line_no", F.monotonically_increasing_id())
    ro = spark.createDataFrame(RUNNER_ORDERS, "order_id int, runner_id int, pickup_time string, "
                               "distance string, duration string, cancellation string")
    names = spark.createDataFrame(PIZZA_NAMES, "pizza_id int, pizza_name string")
    recipes = spark.createDataFrame(PIZZA_RECIPES, "pizza_id int, toppings string")
    tops = spark.createDataFrame(PIZZA_TOPPINGS, "topping_id int, topping_name string")
    runners = spark.createDataFrame(RUNNERS, "runner_id int, registration_date string") \
        .withColumn("registration_date", F.to_date("registration_date"))
    return co, ro, names, recipes, tops, runners


def rows(df, *cols):
    """Sorted list of tuples of the given columns."""
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
