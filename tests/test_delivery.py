"""Delivery analyses on the reference's inline rows; expected values from FIXTURES.md 2b."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import delivery, rows
from quarry.functions.dates import anchored_week, day_name
from quarry.functions.text import leading_number, null_if_sentinel
from quarry.operators import elapsed as EL
from quarry.operators import lists as L
from quarry.operators.clean import clean_sentinels
from quarry.operators.rank import count_top_k_per
from quarry.operators.share import pivot_counts, rate
from quarry.operators.totals import totals_by

def price():
    return F.when(F.col("pizza_name") == "Meat Lovers", 12).otherwise(10).cast("decimal(10,2)")


@pytest.fixture(scope="module")
def d(spark):
    co, ro, names, recipes, tops, runners = delivery(spark)
    lines = clean_sentinels(co, ["exclusions", "extras"]).join(names, "pizza_id")
    lines = L.with_id_lists(lines, {"exclusions": "excl_ids", "extras": "extra_ids"})
    dl = ro.select("order_id", "runner_id",
                   F.try_to_timestamp(null_if_sentinel("pickup_time")).alias("pickup_time"),
                   leading_number("distance", "decimal(10,2)").alias("distance_km"),
                   leading_number("duration", "int").alias("duration_min"),
                   null_if_sentinel("cancellation").alias("cancellation"))
    ok = dl.where(F.col("cancellation").isNull())
    dlines = lines.join(ok.select("order_id"), "order_id", "left_semi")
    return dict(lines=lines, dl=dl, ok=ok, dlines=dlines, recipes=recipes, tops=tops,
                runners=runners)


def test_counts(d):
    t = totals_by(d["lines"], None, rows="n_lines", distinct={"n_orders": "order_id"})
    assert rows(t, "n_lines", "n_orders") == [(14, 10)]
    per = totals_by(d["ok"], "runner_id", rows="n")
    assert rows(per, "runner_id", "n") == [(1, 4), (2, 3), (3, 1)]
    typ = totals_by(d["dlines"], "pizza_name", rows="n")
    assert rows(typ, "pizza_name", "n") == [("Meat Lovers", 9), ("Vegetarian", 3)]


def test_pivot_and_largest(d):
    p = pivot_counts(d["lines"], "customer_id", "pizza_name", ["Meat Lovers", "Vegetarian"])
    assert rows(p, "customer_id", "n_meat_lovers", "n_vegetarian") == [
        (101, 2, 1), (102, 2, 1), (103, 3, 1), (104, 3, 0), (105, 0, 1)]
    big = count_top_k_per(d["dlines"], None, "order_id", 1, name="n")
    assert rows(big, "order_id", "n") == [(4, 3)]


def test_changes(d):
    ch = F.col("exclusions").isNotNull() | F.col("extras").isNotNull()
    g = d["dlines"].groupBy("customer_id").agg(F.count_if(ch).alias("c"),
                                               F.count_if(~ch).alias("u"))
    assert rows(g, "customer_id", "c", "u") == [(101, 0, 2), (102, 0, 3), (103, 3, 0),
                                                (104, 2, 1), (105, 1, 0)]
    both = d["dlines"].where(F.col("exclusions").isNotNull() & F.col("extras").isNotNull())
    assert both.count() == 1


def test_time_buckets(d):
    h = totals_by(d["lines"].withColumn("h", F.hour("order_time")), "h", rows="n")
    assert rows(h, "h", "n") == [(18, 11), (19, 1), (23, 2)]
    w = totals_by(d["lines"].withColumn("w", day_name("order_time")), "w", rows="n")
    assert rows(w, "w", "n") == [("Friday", 12), ("Saturday", 2)]
    s = totals_by(d["runners"].withColumn("wk", anchored_week("registration_date",
                                                              "2021-01-01")), "wk", rows="n")
    assert rows(s, "wk", "n") == [(dt.date(2021, 1, 1), 2), (dt.date(2021, 1, 8), 1),
                                  (dt.date(2021, 1, 15), 1)]


def test_elapsed(d):
    first = d["lines"].groupBy("order_id").agg(F.min("order_time").alias("order_time"))
    x = EL.with_elapsed(d["ok"].join(first, "order_id"), "order_time", "pickup_time",
                        name="m")
    got = dict(rows(x.where(F.col("order_id") <= 4), "order_id", "m"))
    assert got == {1: 10, 2: 10, 3: 21, 4: 4068}
    rng = EL.elapsed_stats(d["ok"], "duration_min", None, "range", name="r")
    assert rows(rng, "r") == [(30,)]
    cust = d["lines"].select("order_id", "customer_id").distinct()
    avg = EL.elapsed_stats(d["ok"].join(cust, "order_id"), "distance_km", "customer_id",
                           name="a")
    assert [(c, round(a, 6)) for c, a in rows(avg, "customer_id", "a")] == [
        (101, 20.0), (102, 18.4), (103, 23.4), (104, 10.0), (105, 25.0)]


def test_success_rate(d):
    r = rate(d["dl"], "runner_id", F.col("cancellation").isNull())
    assert rows(r, "runner_id", "rate") == [(1, 1.0), (2, 0.75), (3, 0.5)]


def test_list_counts(d):
    ex = L.list_item_counts(d["lines"], "extra_ids", d["tops"], "topping_id", "topping_name")
    assert rows(ex, "topping_name", "n") == [("Bacon", 4), ("Cheese", 1), ("Chicken", 1)]
    xc = L.list_item_counts(d["lines"], "excl_ids", d["tops"], "topping_id", "topping_name")
    assert rows(xc, "topping_name", "n") == [("BBQ Sauce", 1), ("Cheese", 4), ("Mushrooms", 1)]


def test_labels_and_merge(d):
    lab = L.order_line_label(d["lines"], "pizza_name", "excl_ids", "extra_ids",
                             d["tops"], "topping_id", "topping_name")
    got = set(r["label"] for r in lab.where(F.col("order_id").isin(9, 10)).collect())
    assert got == {"Meat Lovers - Exclude Cheese - Extra Bacon, Chicken", "Meat Lovers",
                   "Meat Lovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"}
    r = L.with_id_lists(d["recipes"], {"toppings": "recipe_ids"})
    x = d["lines"].join(r.select("pizza_id", "recipe_ids"), "pizza_id")
    m = L.merged_ingredient_list(x, "pizza_name", "recipe_ids", "excl_ids", "extra_ids",
                                 d["tops"], "topping_id", "topping_name")
    got = set(r["ingredients"] for r in m.where(F.col("order_id") == 10).collect())
    assert "Meat Lovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami" in got


def test_standard_ingredients(d):
    r = L.with_id_lists(d["recipes"], {"toppings": "ids"})
    x = L.with_names(r, "ids", d["tops"], "topping_id", "topping_name", "ing")
    assert rows(x, "pizza_id", "ing") == [
        (1, "BBQ Sauce, Bacon, Beef, Cheese, Chicken, Mushrooms, Pepperoni, Salami"),
        (2, "Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes")]


def test_revenue(d):
    all_lines = L.revenue(d["lines"], price())
    assert rows(all_lines, "revenue") == [(160.0,)]
    assert rows(L.revenue(d["dlines"], price()), "revenue") == [(138.0,)]
    s = L.revenue(d["dlines"], price(), "extra_ids", 1, {4: 2})
    assert rows(s, "revenue") == [(143.0,)]
    pay = d["ok"].select((F.sum("distance_km") * F.lit("0.30").cast("decimal(4,2)"))
                         .cast("double")).first()[0]
    assert round(138 - pay, 2) == 94.44


def test_merge_takes_exclusions_from_extras_too(spark):
    """Recipe and extras together, without the excluded; repeats stay; a line
    without a recipe has its extras."""
    dim = spark.createDataFrame([(1, "ham"), (2, "olive"), (3, "egg")], "k int, v string")
    x = spark.createDataFrame(
        [(1, "A", [1, 1, 2], [2], [3, 3, 2]), (2, "B", [1, 2], None, [2]), (3, "C", None, None, [3]),
         (4, "D", [1], [1], None), (5, "E", [1, 9], None, None), (6, "A", [1, 1, 2], [2], [3, 3, 2])],
        "id int, base string, recipe array<int>, minus array<int>, plus array<int>")
    m = L.merged_ingredient_list(x, "base", "recipe", "minus", "plus", dim, "k", "v")
    assert rows(m, "id", "ingredients") == [
        (1, "A: 2xegg, 2xham"), (2, "B: ham, 2xolive"), (3, "C: egg"), (4, "D: "), (5, "E: ham"),
        (6, "A: 2xegg, 2xham")]
    t = L.ingredient_totals(x, "recipe", "minus", "plus", dim, "k", "v")
    assert rows(t.where("v is not null"), "k", "n_used") == [(1, 6), (2, 2), (3, 5)]


def test_unpriced_lines_are_counted(spark):
    x = spark.createDataFrame([(10, [4]), (None, [1, 4]), (5, None)], "p int, extra_ids array<int>")
    r = L.revenue(x.withColumn("p", F.col("p").cast("decimal(10,2)")), F.col("p"), "extra_ids", 1, {4: 2})
    assert rows(r, "revenue", "n_unpriced") == [(20.0, 1)]


def test_append_row(d):
    out = L.append_all_items_row(d["recipes"], d["tops"], "pizza_id", "toppings", "topping_id")
    assert rows(out, "pizza_id", "toppings")[-1] == (3, "1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12")
