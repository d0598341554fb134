"""Delivery analyses (2.0-2.26) on the order-line / delivery stand-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.dates import anchored_week, day_name
from quarry.functions.text import leading_number, null_if_sentinel
from quarry.operators import elapsed as EL
from quarry.operators import lists as L
from quarry.operators.clean import clean_sentinels
from quarry.operators.ordered import total_row_number
from quarry.operators.rank import count_top_k_per
from quarry.operators.share import pivot_counts, pivot_found, rate
from quarry.operators.totals import totals_by
from quarry.plans.registry import register
from quarry.plans.standins import (DELIVERY_SQL, pizza_lines, pizza_recipes, pizza_toppings,
                                   runner_orders)
from quarry.sources.io import Tables

# Price per item type, surcharge per extra (one topping costs
# double), pay per distance unit, the anchor of the sign-up weeks, the item
# types, and the rating hash constants.
PRICES = {"ECONOMY": 10, "LARGE": 14, "MEDIUM": 12, "PROMO": 10, "SMALL": 10, "STANDARD": 12}
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
EXTRA_CHARGE, SPECIAL_TOPPING, SPECIAL_CHARGE = 1, 4, 2
PAY_PER_KM = "0.30"
WEEK_ANCHOR = "2023-12-29"
LINE = ["order_id", "line_no", "pizza_id", "supplier_id"]


def _priced(lines, spark):
    """Lines with the price of their type (NULL for a type without one)."""
    prices = spark.createDataFrame([(k, str(v)) for k, v in PRICES.items()], "pizza_name string, price string")
    return lines.join(prices.select("pizza_name", F.col("price").cast("decimal(10,2)").alias("price")),
                      "pizza_name", "left")


PRICES_SQL = """, prices AS (
  SELECT pizza_name, CAST(price AS DECIMAL(10,2)) AS price
  FROM (VALUES """ + ", ".join(f"('{k}', {v})" for k, v in PRICES.items()) + """) p(pizza_name, price)
),
priced_lines AS (
  SELECT l.*, p.price FROM delivered_lines l LEFT JOIN prices p ON l.pizza_name = p.pizza_name
)"""

SENT = "('', 'null', 'NaN')"
NUM = r"'^\s*(\d+\.?\d*|\.\d+)'"
CLEAN_SQL = DELIVERY_SQL + f""",
lines_clean AS (
  SELECT order_id, line_no, pizza_id, supplier_id, customer_id, pizza_name,
         CASE WHEN trim(exclusions) IN {SENT} THEN NULL ELSE exclusions END AS exclusions,
         CASE WHEN trim(extras) IN {SENT} THEN NULL ELSE extras END AS extras, order_time,
         ROW_NUMBER() OVER (ORDER BY order_time, order_id, line_no, pizza_id, supplier_id,
                                     exclusions NULLS FIRST, extras NULLS FIRST) AS line_uid
  FROM pizza_lines
),
deliveries AS (
  SELECT order_id, runner_id,
         TRY_CAST(CASE WHEN trim(pickup_time) IN {SENT} THEN NULL ELSE pickup_time END
                  AS TIMESTAMP) AS pickup_time,
         TRY_CAST(NULLIF(regexp_extract(CASE WHEN trim(distance) IN {SENT} THEN NULL
                                             ELSE distance END, {NUM}, 1), '')
                  AS DECIMAL(10,2)) AS distance_km,
         TRY_CAST(NULLIF(regexp_extract(CASE WHEN trim(duration) IN {SENT} THEN NULL
                                             ELSE duration END, {NUM}, 1), '')
                  AS INTEGER) AS duration_min,
         CASE WHEN trim(cancellation) IN {SENT} THEN NULL ELSE cancellation END AS cancellation
  FROM runner_orders
),
delivered AS (SELECT * FROM deliveries WHERE cancellation IS NULL),
delivered_lines AS (
  SELECT l.* FROM lines_clean l JOIN delivered d ON l.order_id = d.order_id
),
excl AS (
  SELECT l.order_id, l.line_uid,
         TRY_CAST(trim(unnest(string_split(l.exclusions, ','))) AS INTEGER) AS topping_id
  FROM lines_clean l
),
extr AS (
  SELECT l.order_id, l.line_uid,
         TRY_CAST(trim(unnest(string_split(l.extras, ','))) AS INTEGER) AS topping_id
  FROM lines_clean l
),
recipe_items AS (
  SELECT pizza_id, TRY_CAST(trim(unnest(string_split(toppings, ','))) AS INTEGER) AS topping_id
  FROM pizza_recipes
)"""


def W(sql: str) -> str:
    body = sql.lstrip()
    if body.startswith(","):
        return "WITH " + CLEAN_SQL + "\n" + body
    return "WITH " + CLEAN_SQL + "\n" + sql


def lines(spark, d):
    return clean_sentinels(pizza_lines(Tables(spark, d)), ["exclusions", "extras"])


def lines_ids(spark, d):
    return L.with_id_lists(lines(spark, d), {"exclusions": "excl_ids", "extras": "extra_ids"})


def deliveries(spark, d):
    return cleaned(runner_orders(Tables(spark, d)))


def cleaned(r):
    """Deliveries with typed times, distances and durations."""
    return r.select("order_id", "runner_id",
                    # wall-clock time like every other timestamp column here
                    F.try_to_timestamp(null_if_sentinel("pickup_time")).cast("timestamp_ntz")
                    .alias("pickup_time"),
                    leading_number("distance", "decimal(10,2)").alias("distance_km"),
                    leading_number("duration", "int").alias("duration_min"),
                    null_if_sentinel("cancellation").alias("cancellation"))


def delivered(spark, d):
    return deliveries(spark, d).where(F.col("cancellation").isNull())


def delivered_lines(spark, d, with_ids: bool = False):
    src = lines_ids(spark, d) if with_ids else lines(spark, d)
    return src.join(delivered(spark, d).select("order_id"), "order_id", "left_semi")


def toppings(spark, d):
    return pizza_toppings(Tables(spark, d))


# Constants of the rating's hash (reduced first, so no id overflows).
def rating_col(order_id):
    return ((F.col(order_id) % 97 * 37 + 11) % 97 % 5 + 1).cast("int")


RATING_SQL = "CAST(({0} % 97 * 37 + 11) % 97 % 5 + 1 AS INTEGER)"


@register("clean_order_lines", W("SELECT * FROM lines_clean"))
def clean_order_lines(spark, d):
    """Cleaned lines, numbered in order over the whole table."""
    return total_row_number(lines(spark, d), ["order_time", *LINE, "exclusions", "extras"], "line_uid")


@register("clean_deliveries", W("""
SELECT order_id, runner_id, pickup_time, CAST(distance_km AS DOUBLE) AS distance_km,
       duration_min, cancellation FROM deliveries"""))
def clean_deliveries(spark, d):
    return deliveries(spark, d).withColumn("distance_km", F.col("distance_km").cast("double"))


@register("delivery_join", W("""
SELECT l.order_id, l.line_no, l.pizza_id, l.supplier_id, l.customer_id, l.pizza_name,
       d.runner_id, l.order_time, d.pickup_time,
       (epoch_us(d.pickup_time) - epoch_us(l.order_time)) // 60000000 AS pickup_minutes,
       CAST(d.distance_km AS DOUBLE) AS distance_km, d.duration_min, d.cancellation
FROM lines_clean l LEFT JOIN deliveries d ON l.order_id = d.order_id"""))
def delivery_join(spark, d):
    x = lines(spark, d).join(deliveries(spark, d), "order_id", "left")
    x = EL.with_elapsed(x, "order_time", "pickup_time", name="pickup_minutes")
    return x.select(*LINE, "customer_id", "pizza_name", "runner_id", "order_time",
                    "pickup_time", "pickup_minutes",
                    F.col("distance_km").cast("double").alias("distance_km"),
                    "duration_min", "cancellation")


@register("synthetic_rating", W("""
SELECT order_id, """ + RATING_SQL.format("order_id") + """ AS rating FROM delivered"""))
def synthetic_rating(spark, d):
    return delivered(spark, d).select("order_id", rating_col("order_id").alias("rating"))


@register("order_counts", W("""
SELECT COUNT(*) AS n_lines, COUNT(DISTINCT order_id) AS n_orders FROM lines_clean"""))
def order_counts(spark, d):
    return totals_by(lines(spark, d), None, rows="n_lines", distinct={"n_orders": "order_id"})


@register("deliveries_per_runner", W("""
SELECT runner_id, COUNT(order_id) AS n_delivered FROM delivered GROUP BY 1"""))
def deliveries_per_runner(spark, d):
    return totals_by(delivered(spark, d), "runner_id", rows=None,
                     counts={"n_delivered": "order_id"})


@register("delivered_per_type", W("""
SELECT pizza_name, COUNT(*) AS n_delivered FROM delivered_lines GROUP BY 1"""))
def delivered_per_type(spark, d):
    return totals_by(delivered_lines(spark, d), "pizza_name", rows="n_delivered")


@register("pivot_counts", W("SELECT customer_id, " + ", ".join(
    f"COUNT(*) FILTER (WHERE pizza_name = '{t}') AS n_{t.lower()}" for t in TYPES)
    + ", COUNT(*) AS n_total FROM lines_clean GROUP BY 1"))
def pivot_counts_q(spark, d):
    return pivot_counts(lines(spark, d), "customer_id", "pizza_name", TYPES, total="n_total")


@register("pivot_found_types", W("SELECT customer_id, " + ", ".join(
    f"COUNT(*) FILTER (WHERE pizza_name = '{t}') AS n_{t.lower()}" for t in TYPES)
    + ", COUNT(*) FILTER (WHERE pizza_name IS NULL) AS n_rest, COUNT(*) AS n_total FROM lines_clean GROUP BY 1"))
def pivot_found_types(spark, d):
    """A column for every item type found in the items themselves."""
    return pivot_found(lines(spark, d), "customer_id", "pizza_name", total="n_total")


@register("largest_order", W("""
SELECT order_id, COUNT(*) AS n_lines FROM delivered_lines GROUP BY 1
ORDER BY n_lines DESC, order_id LIMIT 1"""))
def largest_order(spark, d):
    return count_top_k_per(delivered_lines(spark, d), None, "order_id", 1, name="n_lines")


@register("changed_unchanged", W("""
SELECT customer_id,
       COUNT(*) FILTER (WHERE exclusions IS NOT NULL OR extras IS NOT NULL) AS n_changed,
       COUNT(*) FILTER (WHERE exclusions IS NULL AND extras IS NULL) AS n_unchanged
FROM delivered_lines GROUP BY 1"""))
def changed_unchanged(spark, d):
    changed = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    return (delivered_lines(spark, d).groupBy("customer_id")
            .agg(F.count_if(changed).alias("n_changed"),
                 F.count_if(~changed).alias("n_unchanged")))


@register("both_changes", W("""
SELECT COUNT(*) AS n_lines FROM delivered_lines
WHERE exclusions IS NOT NULL AND extras IS NOT NULL"""))
def both_changes(spark, d):
    x = delivered_lines(spark, d).where(F.col("exclusions").isNotNull()
                                        & F.col("extras").isNotNull())
    return totals_by(x, None, rows="n_lines")


@register("volume_by_hour", """
SELECT CAST(hour(ts) AS INTEGER) AS hour, COUNT(*) AS n_events FROM events GROUP BY 1""")
def volume_by_hour(spark, d):
    e = Tables(spark, d).events
    return totals_by(e.withColumn("hour", F.hour("ts")), "hour", rows="n_events")


@register("volume_by_weekday", W("""
SELECT dayname(order_time) AS weekday, CAST(isodow(order_time) AS INTEGER) AS day_number,
       COUNT(*) AS n_lines FROM lines_clean GROUP BY 1, 2"""))
def volume_by_weekday(spark, d):
    x = (lines(spark, d).withColumn("weekday", day_name("order_time"))
         .withColumn("day_number", F.weekday("order_time") + 1))
    return totals_by(x, ["weekday", "day_number"], rows="n_lines")


@register("signups_by_week", f"""
SELECT CAST(DATE '{WEEK_ANCHOR}' + CAST(floor(datediff('day', DATE '{WEEK_ANCHOR}',
            CAST(ts AS DATE)) / 7) * 7 AS INTEGER) AS DATE) AS week_start,
       COUNT(*) AS n_signups
FROM events WHERE event_type = 'signup' GROUP BY 1""")
def signups_by_week(spark, d):
    e = Tables(spark, d).events.where(F.col("event_type") == "signup")
    return totals_by(e.withColumn("week_start", anchored_week("ts", WEEK_ANCHOR)),
                     "week_start", rows="n_signups")


def _order_times(spark, d):
    o = Tables(spark, d).orders.select(F.col("o_orderkey").alias("order_id"),
                                       F.col("o_custkey").alias("customer_id"),
                                       F.col("o_orderdate").alias("order_time"))
    return EL.with_elapsed(delivered(spark, d).join(o, "order_id"), "order_time", "pickup_time",
                           name="pickup_minutes")


ORDER_TIMES_SQL = """
, order_times AS (
  SELECT d.*, o.o_custkey AS customer_id, o.o_orderdate AS order_time,
         (epoch_us(d.pickup_time) - epoch_us(o.o_orderdate)) // 60000000 AS pickup_minutes
  FROM delivered d JOIN orders o ON d.order_id = o.o_orderkey
)"""


@register("avg_pickup_minutes", W(ORDER_TIMES_SQL + """
SELECT runner_id, CAST(SUM(pickup_minutes) AS DOUBLE) / CAST(COUNT(pickup_minutes) AS DOUBLE)
  AS avg_pickup_minutes FROM order_times GROUP BY 1"""))
def avg_pickup_minutes(spark, d):
    return EL.elapsed_stats(_order_times(spark, d), "pickup_minutes", "runner_id")


@register("prep_time_by_size", W(ORDER_TIMES_SQL + """
SELECT n_lines, CAST(SUM(pickup_minutes) AS DOUBLE) / CAST(COUNT(pickup_minutes) AS DOUBLE)
  AS avg_pickup_minutes
FROM (SELECT t.order_id, t.pickup_minutes, COUNT(*) AS n_lines
      FROM order_times t JOIN lines_clean l ON t.order_id = l.order_id
      GROUP BY 1, 2) GROUP BY 1"""))
def prep_time_by_size(spark, d):
    size = lines(spark, d).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    x = _order_times(spark, d).join(size, "order_id")
    return EL.elapsed_stats(x, "pickup_minutes", "n_lines")


@register("avg_distance", W(ORDER_TIMES_SQL + """
SELECT customer_id, CAST(SUM(distance_km) AS DOUBLE) / CAST(COUNT(distance_km) AS DOUBLE)
  AS avg_distance_km FROM order_times GROUP BY 1"""))
def avg_distance(spark, d):
    return EL.elapsed_stats(_order_times(spark, d), "distance_km", "customer_id",
                            name="avg_distance_km")


@register("range_of_durations", W("""
SELECT MAX(duration_min) - MIN(duration_min) AS duration_range FROM delivered"""))
def range_of_durations(spark, d):
    return EL.elapsed_stats(delivered(spark, d), "duration_min", None, "range",
                            name="duration_range")


@register("speed_trend", W("""
SELECT order_id, runner_id, pickup_time, speed_kmh, previous,
       (speed_kmh - previous) / previous AS pct_change
FROM (SELECT order_id, runner_id, pickup_time,
             CAST(distance_km AS DOUBLE) * 60.0::DOUBLE / CAST(duration_min AS DOUBLE)
               AS speed_kmh,
             LAG(CAST(distance_km AS DOUBLE) * 60.0::DOUBLE / CAST(duration_min AS DOUBLE))
               OVER (PARTITION BY runner_id ORDER BY pickup_time, order_id) AS previous
      FROM delivered)"""))
def speed_trend(spark, d):
    x = delivered(spark, d).withColumn("speed_kmh", EL.speed("distance_km", "duration_min"))
    x = EL.change_vs_previous(x, "speed_kmh", "runner_id", "pickup_time", "order_id")
    return x.select("order_id", "runner_id", "pickup_time", "speed_kmh", "previous",
                    "pct_change")


@register("success_rate", W("""
SELECT runner_id, COUNT(*) AS n_total,
       COUNT(*) FILTER (WHERE cancellation IS NULL) AS n_success,
       CAST(COUNT(*) FILTER (WHERE cancellation IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)
         AS rate
FROM deliveries GROUP BY 1"""))
def success_rate(spark, d):
    return rate(deliveries(spark, d), "runner_id", F.col("cancellation").isNull())


@register("standard_ingredients", W("""
SELECT r.pizza_id, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS ingredients
FROM recipe_items r JOIN pizza_toppings t ON r.topping_id = t.topping_id GROUP BY 1"""))
def standard_ingredients(spark, d):
    r = L.with_id_lists(pizza_recipes(Tables(spark, d)), {"toppings": "ids"})
    x = L.with_names(r, "ids", toppings(spark, d), "topping_id", "topping_name", "ingredients")
    return x.where(F.col("ingredients").isNotNull()).select("pizza_id", "ingredients")


@register("extra_counts", W("""
SELECT e.topping_id, t.topping_name, COUNT(*) AS n FROM extr e
LEFT JOIN pizza_toppings t ON e.topping_id = t.topping_id
WHERE e.topping_id IS NOT NULL GROUP BY 1, 2"""))
def extra_counts(spark, d):
    return L.list_item_counts(lines_ids(spark, d), "extra_ids",
                              pizza_toppings(Tables(spark, d)), "topping_id", "topping_name")


@register("exclusion_counts", W("""
SELECT e.topping_id, t.topping_name, COUNT(*) AS n FROM excl e
LEFT JOIN pizza_toppings t ON e.topping_id = t.topping_id
WHERE e.topping_id IS NOT NULL GROUP BY 1, 2"""))
def exclusion_counts(spark, d):
    return L.list_item_counts(lines_ids(spark, d), "excl_ids",
                              pizza_toppings(Tables(spark, d)), "topping_id", "topping_name")


_LINE_NAMES_SQL = """
, ex_names AS (
  SELECT e.line_uid, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS names
  FROM excl e JOIN pizza_toppings t ON e.topping_id = t.topping_id GROUP BY 1
),
xt_names AS (
  SELECT e.line_uid, string_agg(t.topping_name, ', ' ORDER BY t.topping_name) AS names
  FROM extr e JOIN pizza_toppings t ON e.topping_id = t.topping_id GROUP BY 1
)"""


@register("order_line_label", W(_LINE_NAMES_SQL + """
SELECT l.order_id, l.line_no, l.pizza_id, l.supplier_id,
       l.pizza_name || COALESCE(' - Exclude ' || a.names, '') || COALESCE(' - Extra ' || b.names, '')
         AS label
FROM lines_clean l
LEFT JOIN ex_names a ON a.line_uid = l.line_uid
LEFT JOIN xt_names b ON b.line_uid = l.line_uid"""))
def order_line_label(spark, d):
    x = L.order_line_label(lines_ids(spark, d), "pizza_name", "excl_ids", "extra_ids",
                           toppings(spark, d), "topping_id", "topping_name")
    return x.select(*LINE, "label")


_MERGED_SQL = """
, merged AS (
  SELECT u.order_id, u.line_uid, u.topping_id
  FROM (SELECT l.order_id, l.line_uid, r.topping_id
        FROM lines_clean l JOIN recipe_items r ON l.pizza_id = r.pizza_id
        UNION ALL
        SELECT order_id, line_uid, topping_id FROM extr WHERE topping_id IS NOT NULL) u
  ANTI JOIN excl e ON e.line_uid = u.line_uid AND e.topping_id = u.topping_id
)"""


@register("merged_ingredient_list", W(_MERGED_SQL + """
SELECT l.order_id, l.line_no, l.pizza_id, l.supplier_id,
       l.pizza_name || ': ' || COALESCE(m.txt, '') AS ingredients
FROM lines_clean l LEFT JOIN (
  SELECT line_uid,
         string_agg(CASE WHEN n > 1 THEN CAST(n AS VARCHAR) || 'x' || topping_name
                         ELSE topping_name END, ', ' ORDER BY topping_name) AS txt
  FROM (SELECT m.line_uid, t.topping_name, COUNT(*) AS n
        FROM merged m JOIN pizza_toppings t ON m.topping_id = t.topping_id
        GROUP BY 1, 2)
  GROUP BY 1) m ON m.line_uid = l.line_uid"""))
def merged_ingredient_list(spark, d):
    r = L.with_id_lists(pizza_recipes(Tables(spark, d)), {"toppings": "recipe_ids"})
    # recipes grow with the items; a shuffled join also deals the lines out before the work on lists
    x = lines_ids(spark, d).join(r.select("pizza_id", "recipe_ids").hint("merge"), "pizza_id", "left")
    x = L.merged_ingredient_list(x, "pizza_name", "recipe_ids", "excl_ids", "extra_ids",
                                 toppings(spark, d), "topping_id", "topping_name")
    return x.select(*LINE, "ingredients")


@register("ingredient_totals", W(_MERGED_SQL + """
SELECT m.topping_id, t.topping_name, COUNT(*) AS n_used
FROM merged m JOIN delivered d ON m.order_id = d.order_id
LEFT JOIN pizza_toppings t ON m.topping_id = t.topping_id GROUP BY 1, 2"""))
def ingredient_totals(spark, d):
    r = L.with_id_lists(pizza_recipes(Tables(spark, d)), {"toppings": "recipe_ids"})
    x = delivered_lines(spark, d, with_ids=True).join(r.select("pizza_id", "recipe_ids"),
                                                      "pizza_id", "left")
    return L.ingredient_totals(x, "recipe_ids", "excl_ids", "extra_ids",
                               pizza_toppings(Tables(spark, d)), "topping_id", "topping_name")


@register("revenue_fixed", W(PRICES_SQL + """
SELECT CAST(SUM(COALESCE(price, 0)) AS DOUBLE) AS revenue, COUNT(*) FILTER (WHERE price IS NULL) AS n_unpriced
FROM priced_lines"""))
def revenue_fixed(spark, d):
    return L.revenue(_priced(delivered_lines(spark, d), spark), "price")


@register("revenue_with_surcharge", W(PRICES_SQL + f"""
SELECT CAST(SUM(p) AS DOUBLE) AS revenue,
       (SELECT COUNT(*) FROM priced_lines WHERE price IS NULL) AS n_unpriced
FROM (
  SELECT COALESCE(price, 0) AS p FROM priced_lines
  UNION ALL
  SELECT CAST(CASE WHEN e.topping_id = {SPECIAL_TOPPING} THEN {SPECIAL_CHARGE}
                   ELSE {EXTRA_CHARGE} END AS DECIMAL(10,2))
  FROM extr e JOIN delivered d ON e.order_id = d.order_id WHERE e.topping_id IS NOT NULL)"""))
def revenue_with_surcharge(spark, d):
    return L.revenue(_priced(delivered_lines(spark, d, with_ids=True), spark), "price", "extra_ids",
                     EXTRA_CHARGE, {SPECIAL_TOPPING: SPECIAL_CHARGE})


@register("delivery_report", W(ORDER_TIMES_SQL + """
SELECT t.order_id, t.customer_id, t.runner_id,
       """ + RATING_SQL.format("t.order_id") + """ AS rating,
       t.order_time, t.pickup_time, t.pickup_minutes, t.duration_min,
       CAST(t.distance_km AS DOUBLE) * 60.0::DOUBLE / CAST(t.duration_min AS DOUBLE) AS avg_speed,
       (SELECT COUNT(*) FROM lines_clean l WHERE l.order_id = t.order_id) AS n_lines
FROM order_times t"""))
def delivery_report(spark, d):
    size = lines(spark, d).groupBy("order_id").agg(F.count(F.lit(1)).alias("n_lines"))
    x = _order_times(spark, d).join(size, "order_id", "left")
    return x.select("order_id", "customer_id", "runner_id", rating_col("order_id").alias("rating"),
                    "order_time", "pickup_time", "pickup_minutes", "duration_min",
                    EL.speed("distance_km", "duration_min").alias("avg_speed"),
                    F.coalesce("n_lines", F.lit(0)).alias("n_lines"))


@register("margin_after_distance_pay", W(PRICES_SQL + f"""
SELECT CAST(r AS DOUBLE) AS revenue, CAST(p AS DOUBLE) AS runner_pay,
       CAST(r - p AS DOUBLE) AS margin, n_unpriced
FROM (SELECT SUM(COALESCE(price, 0)) AS r, COUNT(*) FILTER (WHERE price IS NULL) AS n_unpriced FROM priced_lines),
     (SELECT SUM(distance_km) * CAST({PAY_PER_KM} AS DECIMAL(4,2)) AS p FROM delivered)"""))
def margin_after_distance_pay(spark, d):
    """Both sums in one aggregate over the lines and the deliveries together."""
    sold = _priced(delivered_lines(spark, d), spark).select(
        "price", F.lit(None).cast("decimal(10,2)").alias("km"), F.lit(True).alias("line"))
    driven = delivered(spark, d).select(
        F.lit(None).cast("decimal(10,2)").alias("price"), F.col("distance_km").alias("km"), F.lit(False).alias("line"))
    g = sold.unionByName(driven).agg(
        F.sum("price").alias("r"), (F.sum("km") * F.lit(PAY_PER_KM).cast("decimal(4,2)")).alias("p"),
        F.count_if(F.col("line") & F.col("price").isNull()).alias("n_unpriced"))
    return g.select(F.col("r").cast("double").alias("revenue"), F.col("p").cast("double").alias("runner_pay"),
                    (F.col("r") - F.col("p")).cast("double").alias("margin"), "n_unpriced")


@register("append_derived_row", W("""
SELECT pizza_id, toppings FROM pizza_recipes
UNION ALL
SELECT (SELECT MAX(pizza_id) + 1 FROM pizza_recipes),
       string_agg(CAST(topping_id AS VARCHAR), ', ' ORDER BY topping_id) FROM pizza_toppings"""))
def append_derived_row(spark, d):
    t = Tables(spark, d)
    return L.append_all_items_row(pizza_recipes(t), pizza_toppings(t), "pizza_id", "toppings",
                                  "topping_id")
