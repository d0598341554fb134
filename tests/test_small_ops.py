"""Hand-checked results for operators otherwise covered by the oracle runs."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from fixtures import rows
from quarry.operators import balance as B
from quarry.operators import lists as L
from quarry.operators.clicks import visit_conversion
from quarry.operators.impact import before_after_by_year, period_growth
from quarry.operators.share import pivot_share, ratio_of_sums
from quarry.operators.totals import avg_children_per_parent

D = dt.date.fromisoformat


def test_pivot_share_and_ratio(spark):
    df = spark.createDataFrame([(2020, "Retail", 30, 3), (2020, "Shopify", 10, 1),
                                (2021, "Retail", 5, 5)], "y int, p string, s int, t int")
    ps = pivot_share(df, "y", "p", ["Retail", "Shopify"], "s")
    assert rows(ps, "y", "share_retail", "share_shopify") == [(2020, 0.75, 0.25), (2021, 1.0, 0.0)]
    # values that are not listed count in the total; shares can be rounded
    third = pivot_share(df.withColumn("s", F.lit(1)), [], "p", ["Retail"], "s", digits=2)
    assert rows(third, "share_retail") == [(0.67,)]
    r = ratio_of_sums(df, "y", "s", "t", name="avg")
    assert rows(r, "y", "avg") == [(2020, 10.0), (2021, 1.0)]


def test_qualified_and_sign_share(spark):
    tx = spark.createDataFrame(
        [(1, D("2020-01-02"), "deposit", 10), (1, D("2020-01-03"), "deposit", 10),
         (1, D("2020-01-04"), "purchase", 50), (2, D("2020-01-02"), "deposit", 10),
         (2, D("2020-01-05"), "withdrawal", 5), (3, D("2020-02-02"), "deposit", 1),
         (3, D("2020-02-03"), "deposit", 1), (3, D("2020-02-04"), "withdrawal", 1)],
        "customer_id int, txn_date date, txn_type string, txn_amount int")
    q = B.qualified_by_period(tx, "customer_id", "txn_date", "txn_type", "month")
    assert rows(q, "period_start", "n_customers") == [(D("2020-01-01"), 1), (D("2020-02-01"), 1)]
    signed = tx.withColumn("v", B.signed_amount("txn_type", "txn_amount"))
    closes = B.period_close(B.running_balance(signed, "customer_id", "txn_date", "v"),
                            "customer_id", "txn_date", "month", first_k=1)
    s = B.sign_share(closes)
    assert rows(s, "sign", "n_customers") == [("negative", 1), ("positive", 2)]


def test_visits_and_children(spark):
    ev = spark.createDataFrame(
        [(1, D("2024-01-01"), "view"), (1, D("2024-01-01"), "purchase"),
         (1, D("2024-01-02"), "view"), (2, D("2024-01-01"), "view")],
        "user_id int, d date, event_type string")
    c = visit_conversion(ev, ["user_id", "d"], F.col("event_type") == "purchase").first()
    assert (c["n_visits"], c["n_converted"], c["conversion"]) == (3, 1, 1 / 3)
    a = avg_children_per_parent(ev, "user_id", "d").first()
    assert (a["avg_children"], a["n_parents"]) == (1.5, 2)


def test_before_after_by_year_and_growth(spark):
    df = spark.createDataFrame(
        [(D("2019-06-10"), 4), (D("2019-06-17"), 6), (D("2020-06-01"), 1), (D("2020-06-22"), 9),
         (D("2020-10-05"), 100)], "d date, s int")
    r = before_after_by_year(df, "d", "2020-06-15", "s", 2)     # ISO week 25
    assert rows(r, "calendar_year", "before_value", "after_value") == [(2019, 4.0, 6.0), (2020, 1.0, 9.0)]
    # an event in January: the weeks before it lie in the year before
    jan = spark.createDataFrame([(D("2019-12-16"), 7), (D("2019-12-30"), 5), (D("2020-01-06"), 8), (D("2020-12-28"), 3),
                                 (D("2021-01-04"), 2), (D("2021-01-11"), 4)], "d date, s int")
    r = before_after_by_year(jan, "d", "2020-01-06", "s", 1)    # ISO week 2
    assert rows(r, "calendar_year", "before_value", "after_value", "pct_change") == [
        (2020, 5.0, 8.0, 0.6), (2021, 2.0, 4.0, 1.0)]
    m = spark.createDataFrame([(D("2020-01-01"), 10), (D("2020-02-01"), 15),
                               (D("2020-02-01"), 5), (D("2020-03-01"), 10)], "m date, v int")
    g = period_growth(m, "m", "v")
    assert rows(g, "m", "total", "pct_change") == [(D("2020-01-01"), 10.0, None),
                                                   (D("2020-02-01"), 20.0, 1.0),
                                                   (D("2020-03-01"), 10.0, -0.5)]


def _lists(spark):
    rows = [(1, [1, 2]), (2, [2, 1, 2]), (3, []), (4, None), (5, [9, 1, None]), (6, [9]), (7, [2, 1]), (8, [-5, 40000])]
    return spark.createDataFrame([(i, x, f"r{i % 2}") for i, x in rows], "line int, ids array<int>, _name string")


@pytest.mark.parametrize("most", [4096, 0])
def test_names_by_position_and_by_dictionary(spark, monkeypatch, most):
    """Both ways of looking names up, with unknown and missing ids, and repeats."""
    monkeypatch.setattr(L.Names, "MOST_IDS", most)
    dim = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (None, "x")], "id int, name string")
    got = L.with_names(_lists(spark), "ids", dim, "id", "name", "t")
    assert rows(got, "line", "t") == [(1, "a, b"), (2, "a, a, b"), (3, None), (4, None), (5, "b"), (6, None), (7, "a, b"), (8, None)]
    merged = L.merged_ingredient_list(_lists(spark).withColumn("minus", F.array(F.lit(9))).withColumn("base", F.lit("P")),
                                      "base", "ids", "minus", "ids", dim, "id", "name", "t")
    assert rows(merged, "line", "t") == [(1, "P: 2xa, 2xb"), (2, "P: 4xa, 2xb"), (3, "P: "), (4, "P: "), (5, "P: 2xb"),
                                         (6, "P: "), (7, "P: 2xa, 2xb"), (8, "P: ")]
    assert merged.columns == ["line", "ids", "_name", "minus", "base", "t"]


@pytest.mark.parametrize("dim", [[(1, "a"), (1, "b")], [(1, "a"), (10 ** 9, "b")], [("1", "a")], []])
def test_names_of_other_dimensions(spark, dim):
    """Two names for an id, ids far apart, ids that are no integers, no names at all."""
    kind = "string" if dim and isinstance(dim[0][0], str) else "int"
    d = spark.createDataFrame(dim, f"id {kind}, name string")
    df = spark.createDataFrame([(1, [1, 10 ** 9])], "line int, ids array<int>") if kind == "int" else \
        spark.createDataFrame([(1, ["1", "7"])], "line int, ids array<string>")
    want = ", ".join(sorted(n for i, n in dim)) or None
    assert rows(L.with_names(df, "ids", d, "id", "name", "t"), "t") == [(want,)]


def test_labels_read_the_fact_once(spark, monkeypatch):
    """One scan of lineitem in the plan, by position and through the dictionary."""
    from quarry.plans.registry import all_queries
    for most in (4096, 0):
        monkeypatch.setattr(L.Names, "MOST_IDS", most)
        for name in ("order_line_label", "merged_ingredient_list"):
            old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as for tables that are all large
            try:
                plan = all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
            finally:
                for k, v in old.items():
                    spark.conf.set(k, v)
            assert sum("FileScan" in line and "l_orderkey" in line for line in plan.split("\n")) == 1


def test_distinct_counts_roll_up_without_the_rows(spark):
    from quarry.operators.totals import distinct_per_day, roll_up_distinct
    d = lambda m, x: dt.date(2024, m, x)
    data = [(d(1, 1), 5, "a"), (d(1, 1), 5, "a"), (d(1, 2), 5, "a"), (d(1, 2), -5, "a"), (d(1, 3), 10 ** 12, "b"),
            (d(2, 1), 5, "a"), (d(2, 1), 0, "a"), (d(2, 9), 40000, "a"), (None, 1, "a"), (d(2, 1), None, "a"), (d(2, 2), 3, None)]
    df = spark.createDataFrame(data, "day date, user long, kind string")
    days = distinct_per_day(df, "day", "user", "kind")
    for grain in ("day", "month", "year"):
        want = df.where("day is not null and user is not null").groupBy("kind", F.trunc("day", grain) if grain != "day" else F.col("day")) \
            .agg(F.count_distinct("user").alias("n"))
        got = roll_up_distinct(days, grain, "kind")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert rows(roll_up_distinct(distinct_per_day(df, "day", "user"), "year"), "n") == [(6,)]
    assert roll_up_distinct(distinct_per_day(df.limit(0), "day", "user"), "month").collect() == []


def test_pivot_of_values_found_in_the_data(spark):
    from quarry.operators.share import found_values, pivot_found
    df = spark.createDataFrame([(1, "x"), (1, "new one"), (1, None), (2, "x"), (2, "x")], "k int, item string")
    got = pivot_found(df, "k", "item", total="n_all")
    assert got.columns == ["k", "n_new_one", "n_x", "n_rest", "n_all"]
    assert rows(got, "k", "n_new_one", "n_x", "n_rest", "n_all") == [(1, 1, 1, 1, 3), (2, 0, 2, 0, 2)]
    with pytest.raises(ValueError, match="more than 1 values"):
        found_values(df, "item", most=1)
    with pytest.raises(ValueError, match="named n_new_one"):
        pivot_found(df.unionByName(spark.createDataFrame([(1, "new-one")], "k int, item string")), "k", "item")
    assert pivot_found(df.limit(0), "k", "item").columns == ["k", "n_rest"]
