"""Edge cases from FIXTURES.md 2e and the survey's traps."""

import datetime as dt

from pyspark.sql import functions as F

from fixtures import rows
from quarry.functions.dates import week_number
from quarry.functions.text import leading_number, split_ids
from quarry.operators import balance as B
from quarry.operators import states as S
from quarry.operators.impact import before_after, missing_periods
from quarry.operators.share import share_of_total
from quarry.plans.standins import plans

D = dt.date.fromisoformat


def test_month_end_schedule_does_not_drift(spark):
    s = spark.createDataFrame([(1, 1, D("2020-01-31"), 1)],
                              "customer_id int, plan_id int, start_date date, sub_id int")
    p = S.payment_schedule(s, plans(spark), "customer_id", "start_date", "plan_id",
                           "2020-04-30", "sub_id")
    assert [r[0] for r in rows(p, "payment_date")] == [
        D("2020-01-31"), D("2020-02-29"), D("2020-03-31"), D("2020-04-30")]


def test_schedule_start_after_cutoff_is_empty(spark):
    s = spark.createDataFrame([(1, 2, D("2021-05-01"), 1)],
                              "customer_id int, plan_id int, start_date date, sub_id int")
    p = S.payment_schedule(s, plans(spark), "customer_id", "start_date", "plan_id",
                           "2020-12-31", "sub_id")
    assert p.count() == 0


def test_schedule_upgrade_and_deferral(spark):
    s = spark.createDataFrame(
        [(1, 1, D("2020-01-10"), 1), (1, 2, D("2020-02-20"), 2), (1, 3, D("2020-04-05"), 3),
         (1, 4, D("2020-09-01"), 4), (1, 1, D("2020-10-01"), 5)],
        "customer_id int, plan_id int, start_date date, sub_id int")
    p = S.payment_schedule(s, plans(spark), "customer_id", "start_date", "plan_id",
                           "2020-12-31", "sub_id")
    got = rows(p, "payment_date", "plan_id", "amount")
    assert got == [(D("2020-01-10"), 1, 9.9), (D("2020-02-10"), 1, 9.9),
                   (D("2020-02-20"), 2, 10.0), (D("2020-03-20"), 2, 19.9),
                   # annual waits for the end of the paid monthly period, then bills
                   (D("2020-04-20"), 3, 199.0),
                   # nothing while churned; billed again after the return
                   (D("2020-10-01"), 1, 9.9), (D("2020-11-01"), 1, 9.9), (D("2020-12-01"), 1, 9.9)]


def test_list_parsing(spark):
    df = spark.createDataFrame([(None,), ("",), ("null",), ("1",), ("1, 2",), ("3,x",)], "s string")
    got = [r[0] for r in df.select(split_ids("s")).collect()]
    assert got == [None, None, None, [1], [1, 2], [3, None]]


def test_units(spark):
    df = spark.createDataFrame([("20km",), ("23.4 km",), ("25mins",), ("null",), ("",),
                                (" 15 minute",), ("km",)], "s string")
    got = [r[0] for r in df.select(leading_number("s", "double")).collect()]
    assert got == [20.0, 23.4, 25.0, None, None, 15.0, None]


def test_week_numbers(spark):
    dates = ["2018-01-01", "2019-01-01", "2020-01-01", "2020-06-15", "2018-06-18",
             "2019-06-17"]
    df = spark.createDataFrame([(D(x),) for x in dates], "d date")
    got = [(r[0], r[1]) for r in df.select(week_number("d", "monday"),
                                           week_number("d", "iso")).collect()]
    assert got == [(1, 1), (0, 1), (0, 1), (24, 25), (25, 25), (24, 25)]


def test_running_balance_same_day_and_carry_forward(spark):
    tx = spark.createDataFrame(
        [(1, D("2020-01-05"), "deposit", 100), (1, D("2020-01-05"), "purchase", 30),
         (1, D("2020-01-20"), "deposit", 10), (1, D("2020-03-02"), "withdrawal", 500)],
        "customer_id int, txn_date date, txn_type string, txn_amount int")
    tx = tx.withColumn("signed", B.signed_amount("txn_type", "txn_amount"))
    rb = B.running_balance(tx, "customer_id", "txn_date", "signed")
    assert rows(rb, "txn_date", "balance") == [(D("2020-01-05"), 70), (D("2020-01-20"), 80),
                                               (D("2020-03-02"), -420)]
    closes = B.period_close(rb, "customer_id", "txn_date", "month")
    assert rows(closes, "period_start", "closing_balance") == [
        (D("2020-01-01"), 80), (D("2020-03-01"), -420)]
    cls = B.balance_change_classes(tx, "customer_id", "txn_date", "signed", "month").first()
    # February has no transactions: its closing balance is January's (80 -> 80)
    assert cls["n_positive_first"] == 1 and cls["share_increase"] == 0.0
    assert cls["share_decrease"] == 0.0 and cls["share_to_negative"] == 0.0


def test_before_after_one_sided_and_zero_before(spark):
    df = spark.createDataFrame(
        [(D("2020-06-08"), "a", 5), (D("2020-06-15"), "a", 7), (D("2020-06-22"), "b", 3),
         (D("2020-01-06"), "c", 99)],
        "week_date date, region string, sales int")
    r = before_after(df, "week_date", "2020-06-15", "sales", 4, ["region"])
    assert rows(r, "region", "before_value", "after_value", "pct_change") == [
        ("a", 5.0, 7.0, 0.4), ("b", 0.0, 3.0, None)]


def test_missing_periods(spark):
    df = spark.createDataFrame([(2020, 1), (2020, 3), (2021, 2)], "y int, w int")
    m = missing_periods(df, "w", 1, 3, by="y")
    assert rows(m, "y", "w") == [(2020, 2), (2021, 1), (2021, 3)]


def test_weeks_around_new_year(spark):
    from quarry.functions.dates import iso_week_monday, iso_weeks_in, week_year
    days = spark.createDataFrame([(D("1997-12-29"),), (D("2020-12-31"),), (D("2021-01-03"),), (D("2021-01-04"),)], "d date")
    got = rows(days.select("d", week_number("d").alias("w"), week_year("d").alias("y"),
                           week_number("d", "monday").alias("m"), week_year("d", "monday").alias("c")),
               "d", "w", "y", "m", "c")
    assert got == [(D("1997-12-29"), 1, 1998, 52, 1997), (D("2020-12-31"), 53, 2020, 52, 2020),
                   (D("2021-01-03"), 53, 2020, 0, 2021), (D("2021-01-04"), 1, 2021, 1, 2021)]
    y = spark.createDataFrame([(2020,), (2021,)], "y int")
    assert rows(y.select("y", iso_weeks_in("y").alias("n"), iso_week_monday("y", F.lit(1)).alias("m")), "y", "n", "m") == [
        (2020, 53, D("2019-12-30")), (2021, 52, D("2021-01-04"))]


def test_missing_week_53(spark):
    from quarry.functions.dates import iso_weeks_in
    df = spark.createDataFrame([(2020, w) for w in range(1, 53)] + [(2021, w) for w in range(1, 52)], "y int, w int")
    assert rows(missing_periods(df, "w", 1, iso_weeks_in("y"), by="y"), "y", "w") == [(2020, 53), (2021, 52)]


def test_change_rank_puts_losses_first(spark):
    from quarry.operators.impact import ranked_by_change
    df = spark.createDataFrame([("a", 0.1), ("b", -0.2), ("c", None), ("d", 0.1)], "g string, pct_change double")
    assert [tuple(r) for r in ranked_by_change(df).select("g", "change_rank").orderBy("change_rank", "g").collect()] == [
        ("b", 1), ("a", 2), ("d", 2), ("c", 4)]


def test_shares_sum_to_one(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 7)
    s = share_of_total(df, "g")
    assert abs(sum(r[0] for r in s.select("share").collect()) - 1.0) < 1e-12


def test_csv_source_and_sink(spark, tmp_path):
    from quarry.sources.io import read_csv, write_table
    p = tmp_path / "pages.csv"
    p.write_text("page_id,page_name,product_category,product_id\n"
                 "1,Home Page,,\n2,All Products,,\n3,Salmon,Fish,1\n")
    df = read_csv(spark, str(p), "page_id int, page_name string, "
                                 "product_category string, product_id int")
    assert [tuple(r) for r in df.orderBy("page_id").collect()] == [
        (1, "Home Page", None, None), (2, "All Products", None, None), (3, "Salmon", "Fish", 1)]
    out = str(tmp_path / "out")
    write_table(df, out)
    write_table(df.limit(1), out, mode="append")
    assert spark.read.parquet(out).count() == 4
