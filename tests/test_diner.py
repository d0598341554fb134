"""Diner analyses on the reference's inline rows; expected values from FIXTURES.md 2a."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import diner, rows
from quarry.operators import milestone as M
from quarry.operators import rank as R
from quarry.operators.totals import totals_by


def test_spend_and_visit_days(spark):
    s, _ = diner(spark)
    t = totals_by(s, "customer_id", sums={"spend": "price"},
                  distinct={"days": "order_date"}, rows=None)
    assert rows(t, "customer_id", "spend", "days") == [("A", 76.0, 4), ("B", 74.0, 6),
                                                      ("C", 36.0, 2)]


def test_first_item_ties_kept(spark):
    s, _ = diner(spark)
    f = R.first_per(s, "customer_id", "order_date").select("customer_id", "product_name")
    assert sorted(set(rows(f, "customer_id", "product_name"))) == [
        ("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_first_item_one_needs_tie(spark):
    s, _ = diner(spark)
    f = R.first_per(s, "customer_id", "order_date", ties="one", tie=["product_id"])
    assert rows(f, "customer_id", "product_name") == [("A", "sushi"), ("B", "curry"),
                                                      ("C", "ramen")]


def test_top_item_and_per_customer(spark):
    s, _ = diner(spark)
    top = R.count_top_k_per(s, None, "product_name", 1, name="n")
    assert rows(top, "product_name", "n") == [("ramen", 8)]
    per = R.count_top_k_per(s, "customer_id", "product_name", 1, name="n")
    assert rows(per, "customer_id", "product_name", "n") == [
        ("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2), ("B", "sushi", 2),
        ("C", "ramen", 3)]


def test_milestone_splits(spark):
    s, m = diner(spark)
    after = R.first_per(M.split_at_milestone(s, m, "customer_id", "order_date", "join_date",
                                             "after"), "customer_id", "order_date")
    assert rows(after, "customer_id", "product_name") == [("A", "curry"), ("B", "sushi")]
    before = M.split_at_milestone(s, m, "customer_id", "order_date", "join_date", "before")
    last = R.last_per(before, "customer_id", "order_date")
    assert sorted(set(rows(last, "customer_id", "product_name"))) == [
        ("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    tot = totals_by(before, "customer_id", sums={"spend": "price"}, rows="n")
    assert rows(tot, "customer_id", "n", "spend") == [("A", 2, 25.0), ("B", 3, 40.0)]


def test_points(spark):
    s, m = diner(spark)
    p = M.points(s, "customer_id", "price", [(F.col("product_name") == "sushi", 20)], 10)
    assert rows(p, "customer_id", "points") == [("A", 860.0), ("B", 940.0), ("C", 360.0)]
    x = M.until(s, "order_date", "2021-01-31").join(m, "customer_id")
    p2 = M.points(x, "customer_id", "price",
                  [(M.bonus_window_rule("order_date", "join_date", 7), 20),
                   (F.col("product_name") == "sushi", 20)], 10)
    assert rows(p2, "customer_id", "points") == [("A", 1370.0), ("B", 820.0)]


def test_member_flag_and_masked_rank(spark):
    s, m = diner(spark)
    x = M.flag_milestone(s, m, "customer_id", "order_date", "join_date")
    x = R.masked_rank(x, "customer_id", "order_date", F.col("member") == "Y")
    got = rows(x.where(F.col("customer_id") == "B"), "order_date", "member", "ranking")
    assert got == [(dt.date(2021, 1, 1), "N", None), (dt.date(2021, 1, 2), "N", None),
                   (dt.date(2021, 1, 4), "N", None), (dt.date(2021, 1, 11), "Y", 1),
                   (dt.date(2021, 1, 16), "Y", 2), (dt.date(2021, 2, 1), "Y", 3)]
    assert x.where(F.col("customer_id") == "C").where(F.col("ranking").isNotNull()).count() == 0
