"""Node stays: a small hand-made table with answers worked out by hand, and
invariants on driver data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from quarry.operators import runs as RU

STAYS = [  # customer, region, node, first day, last day of January (None: open)
    (1, 1, 7, 1, 11), (1, 1, 7, 12, 17), (1, 1, 8, 18, 20), (1, 1, 7, 21, None),
    (2, 1, 8, 1, 4), (2, 1, 9, 5, 5),
    (3, 2, 7, 1, 31),
]


@pytest.fixture(scope="module")
def nodes(spark):
    day = lambda d: None if d is None else dt.date(2020, 1, d)
    return spark.createDataFrame([(c, r, n, day(a), day(b)) for c, r, n, a, b in STAYS],
                                 "customer_id int, region_id int, node_id int, start_date date, end_date date")


def test_mean_stay(nodes):
    """Closed runs last 15 (10 + 5), 2, 3, 0 and 30 days."""
    r = RU.run_durations(nodes, "customer_id", "start_date", "node_id", unit="DAY", end="end_date").first()
    assert (r["n_runs"], r["avg_length"]) == (5, 10.0)


def test_percentiles_by_region(nodes):
    r = RU.runs(nodes, "customer_id", "start_date", "node_id", unit="DAY", end="end_date", extra=["region_id"])
    got = [(g, *(round(x, 9) for x in p)) for g, *p in
           rows(RU.duration_percentiles(r, "region_id", "length"), "region_id", "p50", "p80", "p95")]
    assert got == [(1, 2.5, 7.8, 13.2), (2, 30.0, 30.0, 30.0)]


def test_percentiles_equal_the_builtin(spark):
    df = spark.range(5000).selectExpr("id % 3 as g", "(id * 7919) % 613 as v")
    ours = RU.duration_percentiles(df, "g", "v", ps=(0.1, 0.5, 0.99))
    theirs = df.groupBy("g").agg(F.percentile(F.col("v").cast("double"), [0.1, 0.5, 0.99]).alias("p"))
    want = {r["g"]: tuple(r["p"]) for r in theirs.collect()}
    for r in ours.collect():
        assert (r["p10"], r["p50"], r["p99"]) == pytest.approx(want[r["g"]])
    assert " percentile(" not in ours._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("parts", [1, 16])
def test_percentiles_of_one_group_with_very_many_values(spark, parts):
    """A group of 60,000 different values next to groups of one value and of NULLs;
    the large one spreads over the ranges."""
    df = spark.range(60000).selectExpr("case when id % 100 = 0 then 2 else 1 end as g", "(id * 7919) % 60013 / 7.0 as v") \
        .unionByName(spark.createDataFrame([(3, 5.0), (3, 5.0), (4, None), (None, 1.0), (None, 2.0)], "g int, v double"))
    ours = RU.duration_percentiles(df, "g", "v", ps=(0.0, 0.33, 0.8, 1.0), partitions=parts)
    theirs = df.groupBy("g").agg(F.percentile("v", [0.0, 0.33, 0.8, 1.0]).alias("p"))
    want = {r["g"]: tuple(r["p"]) for r in theirs.collect() if r["p"]}
    got = {r["g"]: (r["p0"], r["p33"], r["p80"], r["p100"]) for r in ours.collect()}
    assert set(got) == set(want) and all(got[g] == pytest.approx(want[g]) for g in want)
    plan = ours._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan


def test_percentiles_without_groups_or_rows(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "v double")
    assert RU.duration_percentiles(df, None, "v", ps=(0.5,)).collect() == [(2.0,)]
    assert RU.duration_percentiles(df.limit(0), None, "v", ps=(0.5,)).collect() == [(None,)]
    assert RU.duration_percentiles(df.limit(0).withColumn("g", F.lit(1)), "g", "v").collect() == []


def test_open_ends_come_from_the_next_row(spark):
    ts = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame([(1, "a", ts(0), 1), (1, "a", ts(2), 2), (1, "b", ts(3), 3), (1, "a", ts(7), 4)],
                               "k int, s string, t timestamp, id int")
    r = RU.runs(df, "k", "t", "s", ["id"])
    assert rows(r, "run_id", "s", "length") == [(1, "a", 180), (2, "b", 240)]


def test_islands_partition_rows(spark):
    from quarry.plans.standins import customer_nodes
    from quarry.sources.io import Tables
    n = customer_nodes(Tables(spark, "/root/testdata/sf0.001"))
    x = RU.run_ids(n, "customer_id", "start_ts", "node", ["event_id"])
    # every row belongs to exactly one run and a run never mixes states
    per = x.groupBy("customer_id", "run_id").agg(F.count_distinct("node").alias("k"),
                                                F.count(F.lit(1)).alias("n"))
    assert per.where(F.col("k") != 1).count() == 0
    assert per.agg(F.sum("n")).first()[0] == n.count()
