"""Reference-shaped tables derived from the driver tables.

Each stand-in has a Spark builder and the equivalent DuckDB CTE text used by
the oracle, kept side by side so they cannot drift apart.  Dimensions of
fixed, tiny size (region, nation, parameter tables) are broadcast explicitly;
everything that grows with the data (customer, part, supplier, orders) is left
to AQE, which broadcasts only after measuring the runtime size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.clean import AGE_BANDS, DEMOGRAPHIC_BANDS
from quarry.sources.io import Tables
from quarry.sources.layout import dealt_by_key


def money(c) -> F.Column:
    """Doubles holding cents -> exact decimal, so sums do not depend on order."""
    return F.col(c).cast("decimal(15,2)") if isinstance(c, str) else c.cast("decimal(15,2)")


# ---------------------------------------------------------------- supermarket
def weekly_sales(t: Tables, ship_from=None, ship_to=None, transactions: bool = True) -> DataFrame:
    """weekly_sales: lineitem by Monday week of l_shipdate x region x platform
    x segment x customer_type, with distinct orders as transactions.

    ``ship_from`` / ``ship_to`` pre-filter the lineitem scan (pushed to parquet)
    when the caller only needs a date window.  ``transactions=False`` leaves
    out the distinct-order count and with it the per-order stage (one
    aggregation instead of two) for analyses that only need sales."""
    li = t.lineitem
    if transactions:        # the per-order stage groups by almost every line
        li = dealt_by_key(li, "l_orderkey")
    li = li.select("l_orderkey", "l_shipdate", "l_linestatus", "l_extendedprice", "l_discount")
    # date literals are coerced to the column's timestamp type on the literal
    # side, so the comparison stays a plain column predicate that parquet can
    # push down (a cast on the column would not be)
    if ship_from is not None:
        li = li.where(F.col("l_shipdate") >= F.to_date(F.lit(ship_from)))
    if ship_to is not None:
        li = li.where(F.col("l_shipdate") < F.to_date(F.lit(ship_to)))
    o = t.orders
    if transactions:
        o = dealt_by_key(o, "o_custkey")
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus")
    c = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    geo = (F.broadcast(t.nation.select("n_nationkey", "n_regionkey"))
           .join(F.broadcast(t.region.select("r_regionkey", "r_name")),
                 F.col("n_regionkey") == F.col("r_regionkey")))
    # the orders meet their customers first: the lines then stay dealt by order
    # for the per-order stage and move only once
    o = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
          .join(geo, F.col("c_nationkey") == F.col("n_nationkey")))
    x = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    # net price in exact 1/10000 units: cents x percent, both integral, so the
    # sums stay on 64-bit integers instead of wide decimals
    e4 = (F.round(F.col("l_extendedprice") * 100).cast("bigint")
          * F.round((1 - F.col("l_discount")) * 100).cast("bigint"))
    # stage 1: per order and raw key columns (labels are computed afterwards,
    # on far fewer rows); stage 2: per labelled group.  Two partial-aggregating
    # stages replace a distinct aggregate (no Expand).
    raw_keys = [F.date_trunc("week", "l_shipdate").cast("date").alias("week_date"),
                "r_name", "l_linestatus", "c_mktsegment",
                (F.col("c_nationkey") % 4 + 1).alias("_band"), "o_orderstatus"]
    if transactions:
        per = x.groupBy(*raw_keys, "l_orderkey").agg(F.sum(e4).alias("_e4"))
        counted = F.count(F.lit(1))
    else:
        per = x.groupBy(*raw_keys).agg(F.sum(e4).alias("_e4"))
        counted = None
    letter = (F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "FURNITURE"), F.lit("F"))
              .otherwise(F.lit("C")))
    segment = (F.when(F.col("c_mktsegment") == "BUILDING", F.lit("null"))
               .otherwise(F.concat(letter, F.col("_band").cast("string"))))
    ctype = (F.when(F.col("o_orderstatus") == "F", "Existing")
             .when(F.col("o_orderstatus") == "O", "New").otherwise("Guest"))
    aggs = [(F.sum("_e4").cast("decimal(22,0)") / 10000).cast("decimal(22,4)").alias("sales")]
    if counted is not None:
        aggs.insert(0, counted.alias("transactions"))
    return (per.groupBy(
                "week_date", F.col("r_name").alias("region"),
                F.when(F.col("l_linestatus") == "F", "Retail").otherwise("Shopify")
                .alias("platform"),
                segment.alias("segment"), ctype.alias("customer_type"))
            .agg(*aggs))


WEEKLY_SALES_SQL = """
weekly_sales AS (
  SELECT CAST(date_trunc('week', l.l_shipdate) AS DATE) AS week_date,
         r.r_name AS region,
         CASE WHEN l.l_linestatus = 'F' THEN 'Retail' ELSE 'Shopify' END AS platform,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'null'
              ELSE (CASE WHEN c.c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'F' ELSE 'C' END)
                   || CAST(c.c_nationkey % 4 + 1 AS VARCHAR) END AS segment,
         CASE o.o_orderstatus WHEN 'F' THEN 'Existing' WHEN 'O' THEN 'New' ELSE 'Guest' END
           AS customer_type,
         COUNT(DISTINCT l.l_orderkey) AS transactions,
         SUM(CAST(l.l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))))
           AS sales
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
)"""

def _band_sql(bands: dict, code: str) -> str:
    """The label of a code character, looked up in the operator's own mapping."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in bands.items())
    return f"COALESCE((SELECT label FROM (VALUES {rows}) b(code, label) WHERE b.code = {code}), 'unknown')"


CLEAN_WEEKLY_SQL = WEEKLY_SALES_SQL + """,
clean_weekly AS (
  SELECT week_date, region, platform,
         CASE WHEN trim(segment) IN ('', 'null', 'NaN') THEN 'unknown' ELSE segment END AS segment,
         customer_type, transactions, sales,
         CAST(weekofyear(week_date) AS INTEGER) AS week_number,
         CAST(month(week_date) AS INTEGER) AS month_number,
         CAST(year(week_date) AS INTEGER) AS calendar_year,
         CAST(isoyear(week_date) AS INTEGER) AS week_year,
         """ + _band_sql(AGE_BANDS, "substr(segment, 2, 1)") + """ AS age_band,
         """ + _band_sql(DEMOGRAPHIC_BANDS, "substr(segment, 1, 1)") + """ AS demographic,
         CAST(sales AS DOUBLE) / CAST(transactions AS DOUBLE) AS avg_transaction
  FROM weekly_sales
)"""


# ---------------------------------------------------------------------- diner
def sales(t: Tables) -> DataFrame:
    """sales + menu: one row per lineitem, priced from part.

    (order_id, line_no, product_id, supplier_id) is the unique line key."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = t.part.select("p_partkey", "p_name", "p_retailprice")
    return (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(p, F.col("l_partkey") == F.col("p_partkey"))
              .select(F.col("o_custkey").alias("customer_id"),
                      F.col("o_orderdate").cast("date").alias("order_date"),
                      F.col("l_orderkey").alias("order_id"),
                      F.col("l_linenumber").alias("line_no"),
                      F.col("l_partkey").alias("product_id"),
                      F.col("l_suppkey").alias("supplier_id"),
                      F.col("p_name").alias("product_name"),
                      money("p_retailprice").alias("price")))


def members(t: Tables) -> DataFrame:
    """members: join date = first urgent order of the customer."""
    return (t.orders.where(F.col("o_orderpriority") == "1-URGENT")
            .groupBy(F.col("o_custkey").alias("customer_id"))
            .agg(F.min(F.col("o_orderdate").cast("date")).alias("join_date")))


SALES_SQL = """
sales AS (
  SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
         l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS product_id,
         l.l_suppkey AS supplier_id, p.p_name AS product_name,
         CAST(p.p_retailprice AS DECIMAL(15,2)) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
members AS (
  SELECT o_custkey AS customer_id, MIN(CAST(o_orderdate AS DATE)) AS join_date
  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey
)"""


# -------------------------------------------------------------- subscriptions
# The plan price list (plan_id, plan_name, price; churn has none).
PLANS = [(0, "trial", "0.00"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"),
         (3, "pro annual", "199.00"), (4, "churn", None)]


def plans(spark) -> DataFrame:
    """The five-row price list: a parameter table of fixed size."""
    return spark.createDataFrame(
        [(i, n, p) for i, n, p in PLANS],
        "plan_id int, plan_name string, price string").select(
        "plan_id", "plan_name", F.col("price").cast("decimal(10,2)").alias("price"))


def subscriptions(t: Tables) -> DataFrame:
    """subscriptions: one state row per order; plan from the priority digit,
    o_orderkey as the tie-break for same-day rows."""
    o = t.orders
    return o.select(F.col("o_custkey").alias("customer_id"),
                    (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id"),
                    F.col("o_orderdate").cast("date").alias("start_date"),
                    F.col("o_orderkey").alias("sub_id"))


SUBS_SQL = """
plans AS (
  SELECT plan_id, plan_name, CAST(price AS DECIMAL(10,2)) AS price
  FROM (VALUES (0, 'trial', '0.00'), (1, 'basic monthly', '9.90'), (2, 'pro monthly', '19.90'),
               (3, 'pro annual', '199.00'), (4, 'churn', NULL)) t(plan_id, plan_name, price)
),
subscriptions AS (
  SELECT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
         CAST(o_orderdate AS DATE) AS start_date, o_orderkey AS sub_id
  FROM orders
)"""


# ----------------------------------------------------------------------- bank
def _user_region(t: Tables) -> DataFrame:
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(F.broadcast(t.nation.select("n_nationkey", "n_regionkey")),
                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("n_regionkey").alias("region_id")))


def customer_nodes(t: Tables, region: bool = True) -> DataFrame:
    """customer_nodes: each event is a stay start at node = event_type; the
    stay ends when the customer's next event starts.  ``region`` adds the
    customer's region (NULL for events without a customer)."""
    e = t.events.select(F.col("user_id").alias("customer_id"), F.col("event_type").alias("node"),
                        F.col("ts").alias("start_ts"), "event_id")
    return e.join(_user_region(t), "customer_id", "left") if region else e


def customer_transactions(t: Tables) -> DataFrame:
    """customer_transactions: events as signed money movements."""
    e = t.events
    ttype = (F.when(F.col("event_type").isin("signup", "view"), "deposit")
             .when(F.col("event_type") == "purchase", "purchase").otherwise("withdrawal"))
    return e.select(F.col("user_id").alias("customer_id"),
                    F.col("ts").cast("date").alias("txn_date"),
                    ttype.alias("txn_type"),
                    money("value").alias("txn_amount"), "event_id")


BANK_SQL = """
user_region AS (
  SELECT c.c_custkey AS customer_id, n.n_regionkey AS region_id
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
),
customer_nodes AS (
  SELECT e.user_id AS customer_id, e.event_type AS node, e.ts AS start_ts, e.event_id,
         u.region_id
  FROM events e LEFT JOIN user_region u ON e.user_id = u.customer_id
),
customer_transactions AS (
  SELECT user_id AS customer_id, CAST(ts AS DATE) AS txn_date,
         CASE WHEN event_type IN ('signup', 'view') THEN 'deposit'
              WHEN event_type = 'purchase' THEN 'purchase' ELSE 'withdrawal' END AS txn_type,
         CAST(value AS DECIMAL(15,2)) AS txn_amount, event_id
  FROM events
),
signed AS (
  SELECT *, CASE WHEN txn_type = 'deposit' THEN txn_amount ELSE -txn_amount END AS signed_amount
  FROM customer_transactions
),
daily AS (
  SELECT customer_id, txn_date, SUM(signed_amount) AS net_amount,
         SUM(SUM(signed_amount)) OVER (PARTITION BY customer_id ORDER BY txn_date
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS balance
  FROM signed GROUP BY 1, 2
),
runs AS (
  SELECT customer_id, run_id, MIN(region_id) AS region_id, MIN(start_ts) AS run_start,
         MAX(end_ts) AS run_end,
         SUM((epoch_us(end_ts) - epoch_us(start_ts)) // 60000000) AS length
  FROM (SELECT *, SUM(chg) OVER (PARTITION BY customer_id ORDER BY start_ts, event_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run_id
        FROM (SELECT *, CASE WHEN ROW_NUMBER() OVER w = 1 OR LAG(node) OVER w IS DISTINCT FROM node
                             THEN 1 ELSE 0 END AS chg
              FROM (SELECT *, LEAD(start_ts) OVER (PARTITION BY customer_id
                                                   ORDER BY start_ts, event_id) AS end_ts
                    FROM customer_nodes) ended
              WHERE end_ts IS NOT NULL
              WINDOW w AS (PARTITION BY customer_id ORDER BY start_ts, event_id)))
  GROUP BY 1, 2
),
closed_runs AS (SELECT * FROM runs)"""


# ------------------------------------------------------------------- delivery
def _s(c) -> F.Column:
    return c.cast("string")


def pizza_lines(t: Tables) -> DataFrame:
    """customer_orders (dirty): one line per lineitem; the item is the part,
    its type is the item name; exclusions / extras are comma lists of topping
    ids written with the usual junk ('', 'null', 'NaN')."""
    li = dealt_by_key(t.lineitem, "l_orderkey") \
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = t.part.select("p_partkey", "p_type", "p_size")
    x = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(p, F.col("l_partkey") == F.col("p_partkey")))
    s, q = F.col("p_size"), F.col("l_quantity").cast("int")
    excl = (F.when(q % 6 == 0, F.lit("")).when(q % 6 == 1, F.lit("null"))
            .when(q % 6 == 2, _s(s % 25 + 1))
            .when(q % 6 == 3, F.concat(_s(s % 25 + 1), F.lit(", "), _s((s + 3) % 25 + 1))))
    ln = F.col("l_linenumber")
    extra = (F.when(ln % 5 == 0, F.lit("NaN")).when(ln % 5 == 1, F.lit(""))
             .when(ln % 5 == 2, _s(s % 25 + 1))
             .when(ln % 5 == 3, F.concat(_s(s % 25 + 1), F.lit(", "), _s((s + 5) % 25 + 1))))
    return x.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                    F.col("l_partkey").alias("pizza_id"), F.col("l_suppkey").alias("supplier_id"),
                    F.col("o_custkey").alias("customer_id"), F.col("p_type").alias("pizza_name"),
                    excl.alias("exclusions"), extra.alias("extras"),
                    F.col("o_orderdate").alias("order_time"))


def pizza_recipes(t: Tables) -> DataFrame:
    """pizza_recipes: three distinct topping ids (1-25) per part, as comma text."""
    s = F.col("p_size")
    return t.part.select(F.col("p_partkey").alias("pizza_id"),
                         F.concat_ws(", ", _s(s % 25 + 1), _s((s + 3) % 25 + 1),
                                     _s((s + 7) % 25 + 1)).alias("toppings"))


def pizza_toppings(t: Tables) -> DataFrame:
    """pizza_toppings: one topping per nation row (a fixed 25-row table)."""
    return t.nation.select((F.col("n_nationkey") + 1).alias("topping_id"),
                           F.col("n_name").alias("topping_name"))


def runner_orders(t: Tables) -> DataFrame:
    """runner_orders (dirty): one delivery per order, runner = lowest supplier
    of its lines; text times, distances and durations with units and junk."""
    per = (t.lineitem.groupBy("l_orderkey")
           .agg(F.min("l_suppkey").alias("runner_id"), F.min("l_shipdate").alias("ship"),
                F.max("l_shipdate").alias("last_ship"),
                F.sum("l_quantity").cast("bigint").alias("q")))
    o = t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus")
    x = per.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    cancelled = st == "P"
    km = F.concat(_s(F.floor(F.col("q") / 10)), F.lit("."), _s(F.col("q") % 10))
    dist = (F.when(cancelled, F.lit("null")).when(k % 4 == 0, F.concat(km, F.lit("km")))
            .when(k % 4 == 1, F.concat(km, F.lit(" km"))).otherwise(km))
    mins = _s(F.abs(F.datediff(F.col("last_ship").cast("date"),
                               F.col("o_orderdate").cast("date"))) % 50 + 10)
    dur = (F.when(cancelled, F.lit("null")).when(k % 3 == 0, F.concat(mins, F.lit(" minutes")))
           .when(k % 3 == 1, F.concat(mins, F.lit("mins"))).otherwise(F.concat(mins, F.lit(" minute"))))
    # own texts: any text that is no null-like sentinel means cancelled
    canc = (F.when(cancelled & (k % 2 == 0), F.lit("kitchen closed"))
            .when(cancelled, F.lit("guest called it off"))
            .when(st == "F", F.lit(""))
            .when(k % 3 == 0, F.lit("null")).when(k % 3 == 1, F.lit("NaN")))
    pick = F.when(cancelled, F.lit("null")).otherwise(_s(F.col("ship")))
    return x.select(k.alias("order_id"), "runner_id", pick.alias("pickup_time"),
                    dist.alias("distance"), dur.alias("duration"), canc.alias("cancellation"))


DELIVERY_SQL = """
pizza_lines AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, l.l_partkey AS pizza_id,
         l.l_suppkey AS supplier_id, o.o_custkey AS customer_id, p.p_type AS pizza_name,
         CASE CAST(l.l_quantity AS INTEGER) % 6
              WHEN 0 THEN '' WHEN 1 THEN 'null'
              WHEN 2 THEN CAST(p.p_size % 25 + 1 AS VARCHAR)
              WHEN 3 THEN CAST(p.p_size % 25 + 1 AS VARCHAR) || ', '
                          || CAST((p.p_size + 3) % 25 + 1 AS VARCHAR) END AS exclusions,
         CASE l.l_linenumber % 5
              WHEN 0 THEN 'NaN' WHEN 1 THEN ''
              WHEN 2 THEN CAST(p.p_size % 25 + 1 AS VARCHAR)
              WHEN 3 THEN CAST(p.p_size % 25 + 1 AS VARCHAR) || ', '
                          || CAST((p.p_size + 5) % 25 + 1 AS VARCHAR) END AS extras,
         o.o_orderdate AS order_time
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
pizza_recipes AS (
  SELECT p_partkey AS pizza_id,
         CAST(p_size % 25 + 1 AS VARCHAR) || ', ' || CAST((p_size + 3) % 25 + 1 AS VARCHAR)
           || ', ' || CAST((p_size + 7) % 25 + 1 AS VARCHAR) AS toppings
  FROM part
),
pizza_toppings AS (
  SELECT n_nationkey + 1 AS topping_id, n_name AS topping_name FROM nation
),
runner_orders AS (
  SELECT o.o_orderkey AS order_id, a.runner_id,
         CASE WHEN o.o_orderstatus = 'P' THEN 'null' ELSE CAST(a.ship AS VARCHAR) END
           AS pickup_time,
         CASE WHEN o.o_orderstatus = 'P' THEN 'null'
              WHEN o.o_orderkey % 4 = 0 THEN CAST(a.q // 10 AS VARCHAR) || '.'
                   || CAST(a.q % 10 AS VARCHAR) || 'km'
              WHEN o.o_orderkey % 4 = 1 THEN CAST(a.q // 10 AS VARCHAR) || '.'
                   || CAST(a.q % 10 AS VARCHAR) || ' km'
              ELSE CAST(a.q // 10 AS VARCHAR) || '.' || CAST(a.q % 10 AS VARCHAR) END AS distance,
         CASE WHEN o.o_orderstatus = 'P' THEN 'null'
              WHEN o.o_orderkey % 3 = 0 THEN CAST(a.m AS VARCHAR) || ' minutes'
              WHEN o.o_orderkey % 3 = 1 THEN CAST(a.m AS VARCHAR) || 'mins'
              ELSE CAST(a.m AS VARCHAR) || ' minute' END AS duration,
         CASE WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0 THEN 'kitchen closed'
              WHEN o.o_orderstatus = 'P' THEN 'guest called it off'
              WHEN o.o_orderstatus = 'F' THEN ''
              WHEN o.o_orderkey % 3 = 0 THEN 'null'
              WHEN o.o_orderkey % 3 = 1 THEN 'NaN' END AS cancellation
  FROM (SELECT x.*, abs(datediff('day', CAST(oo.o_orderdate AS DATE),
                                    CAST(x.last_ship AS DATE))) % 50 + 10 AS m
        FROM (SELECT l_orderkey, MIN(l_suppkey) AS runner_id, MIN(l_shipdate) AS ship,
                     MAX(l_shipdate) AS last_ship, CAST(SUM(l_quantity) AS BIGINT) AS q
              FROM lineitem GROUP BY 1) x
        JOIN orders oo ON x.l_orderkey = oo.o_orderkey) a
  JOIN orders o ON a.l_orderkey = o.o_orderkey
)"""
