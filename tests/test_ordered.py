"""Skew-safe ordered helpers equal the plain single-window versions."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from fixtures import rows
from quarry.operators import ordered as O


def _data(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randrange(1, 40)          # key 0 holds a third
        ts = base + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))
        rows.append((k, ts, i, rnd.choice("abc"), rnd.randrange(-5, 9)))
    return spark.createDataFrame(rows, "k int, ts timestamp, id int, s string, v int")


def _eq(a, b, cols):
    ka = sorted(tuple(r[c] for c in cols) for r in a.collect())
    kb = sorted(tuple(r[c] for c in cols) for r in b.collect())
    assert ka == kb


def test_neighbors(spark):
    df = _data(spark)
    a = O.stitched(df, "k", ["ts", "id"], prev=["s", "ts"], nxt=["s", "ts"])
    b = O.stitched(df, "k", ["ts", "id"], prev=["s", "ts"], nxt=["s", "ts"], granularity=None)
    _eq(a, b, ["id", "prev_s", "next_s", "prev_ts", "next_ts"])


def test_row_number(spark):
    df = _data(spark)
    a = O.stitched(df, "k", ["ts", "id"], seq="rn")
    _eq(a, O.row_number(df, "k", ["ts", "id"], "rn", granularity=None), ["id", "rn"])
    assert a.where(F.col("k") == 0).agg(F.max("rn")).first()[0] == 1000


def test_dense_rank_of(spark):
    df = _data(spark).withColumn("d", F.to_date("ts"))
    from pyspark.sql import Window
    b = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("d")))
    _eq(O.dense_rank_of(df, "k", "d", "r"), b, ["id", "r"])


def test_stitched_all_outputs(spark):
    df = _data(spark)
    kw = dict(prev=["s", "ts"], nxt=["s"], seq="q", runs_of="s")
    b = O.stitched(df, "k", ["ts", "id"], granularity=None, **kw)
    for granularity in ("day", "hour", "month", "value"):
        a = O.stitched(df, "k", ["ts", "id"], granularity=granularity, **kw)
        _eq(a, b, ["id", "prev_s", "prev_ts", "next_s", "q", "run_id"])


def test_islands_with_null_states(spark):
    df = _data(spark).withColumn("s", F.when(F.col("id") % 11 == 0, None).otherwise(F.col("s")))
    _eq(O.stitched(df, "k", ["ts", "id"], runs_of="s"),
        O.islands(df, "k", ["ts", "id"], "s", granularity=None), ["id", "run_id"])


def test_hour_buckets(spark):
    df = _data(spark)
    kw = dict(prev=["s"], nxt=["ts"], seq="q", runs_of="s")
    _eq(O.stitched(df, "k", ["ts", "id"], granularity="hour", **kw),
        O.stitched(df, "k", ["ts", "id"], granularity=None, **kw),
        ["id", "prev_s", "next_ts", "q", "run_id"])


def _null_log(spark):
    """NULL keys, times and states, with every answer written down."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    rows = [  # key, time, id, state -> previous, next, number, run
        (1, None, 1, "a", None, "a", 1, 1),
        (1, day(1), 2, "a", "a", None, 2, 1),
        (1, day(1, 5), 3, None, "a", None, 3, 2),
        (1, day(2), 4, None, None, "b", 4, 2),
        (1, day(9), 5, "b", None, "a", 5, 3),
        (1, day(9, 1), 6, "a", "b", None, 6, 4),
        (None, day(1), 7, "x", None, "x", 1, 1),
        (None, day(3), 8, "x", "x", "y", 2, 1),
        (None, day(4), 9, "y", "x", None, 3, 2),
        (2, None, 10, None, None, None, 1, 1),
        (2, None, 11, None, None, None, 2, 1),
        (3, day(5), 12, None, None, "c", 1, 1),
        (3, day(6), 13, "c", None, None, 2, 2),
    ]
    df = spark.createDataFrame([r[:4] for r in rows], "k int, ts timestamp, id int, s string")
    return df, sorted((r[2], *r[4:]) for r in rows)


def test_nulls_by_hand(spark):
    df, want = _null_log(spark)
    for granularity in ("day", "month", "value", None):
        x = O.stitched(df, "k", ["ts", "id"], prev=["s"], nxt=["s"], seq="q", runs_of="s", granularity=granularity)
        key = lambda t: t[0]
        got = sorted((tuple(r) for r in x.select("id", "prev_s", "next_s", "q", "run_id").collect()), key=key)
        assert got == sorted(want, key=key), granularity


def test_dense_rank_with_nulls(spark):
    from pyspark.sql import Window
    df, _ = _null_log(spark)
    b = df.withColumn("r", F.dense_rank().over(Window.partitionBy("k").orderBy("s")))
    _eq(O.dense_rank_of(df, "k", "s", "r"), b, ["id", "r"])


def test_cells_come_from_one_exchange(spark):
    """A partitioning by key below does not keep a key whole, and the rows and
    their summary share the exchange by cell."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        names = spark.createDataFrame([(i, f"n{i}") for i in range(40)], "k int, name string")
        x = O.stitched(_data(spark).join(names, "k"), "k", ["ts", "id"], prev=["s"], nxt=["ts"], seq="q", runs_of="s")
        x.collect()
        plan = x._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("hashpartitioning(_cell") >= 2 and "REPARTITION_BY_COL" in final
    assert final.count("ReusedExchange") == 1


ROWS = "k int, t timestamp, a int, b string"


def _one_day(n):
    """All rows at one instant, with NULLs and repeats in the other order columns."""
    t = dt.datetime(2024, 1, 1)
    return [(i % 5 or None, t if i % 7 else None, (i * 7919) % n if i % 11 else None, f"b{i % 3}") for i in range(n)]


def test_total_row_number_equals_the_plain_window(spark):
    df = spark.createDataFrame(_one_day(4000), ROWS).repartition(5)
    order = ["t", "a", "k", "b"]
    got = O.total_row_number(df, order, "n", partitions=7)
    want = df.withColumn("n", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert got.schema["n"].dataType.simpleString() == "bigint"


def test_total_row_number_spreads_one_day_and_deals_the_rows_once(spark):
    df = spark.createDataFrame([r for r in _one_day(4000) if r[1]], ROWS).repartition(5)
    got = O.total_row_number(df, ["t", "a", "k", "b"], "n", partitions=8)
    per_task = [r["c"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("c")).collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * sum(per_task) / 8
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 1 and "hashpartitioning(t" not in plan
    assert plan.count("Exchange rangepartitioning") + plan.count("Exchange rang") >= 1
    assert "Window" not in "".join(line for line in plan.split("\n") if "partition by t" in line)


def test_total_row_number_of_few_or_no_rows(spark):
    empty = spark.createDataFrame([], ROWS)
    assert O.total_row_number(empty, ["t", "a"], "n").collect() == []
    same = spark.createDataFrame([(1, None, 1, "x")] * 3, ROWS)
    assert rows(O.total_row_number(same, ["t", "a"], "n", partitions=4), "n") == [(1,), (2,), (3,)]


def test_range_cells_equal_the_plain_window(spark):
    """A key with two thirds of the rows at one instant, NULL keys, times and states."""
    rnd = random.Random(3)
    t = dt.datetime(2024, 1, 1)
    data = [(0 if i % 3 else rnd.choice([None, 1, 2]), t if i % 5 else rnd.choice([None, t + dt.timedelta(hours=i)]), i,
             rnd.choice(["a", "b", None])) for i in range(4000)]
    df = spark.createDataFrame(data, "k int, ts timestamp, id int, s string").repartition(4)
    a = O.stitched(df, "k", ["ts", "id"], prev=["s"], nxt=["id"], seq="n", runs_of="s", granularity="range")
    b = O.stitched(df, "k", ["ts", "id"], prev=["s"], nxt=["id"], seq="n", runs_of="s", granularity=None)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_range_cells_spread_one_instant(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(7, t, i) for i in range(4000)], "k int, ts timestamp, id int").repartition(4)
    parts = df.repartitionByRange(4, "k", "ts", "id").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 4 and max(r["count"] for r in parts) < 2000
    out = O.stitched(df, "k", ["ts", "id"], seq="n", granularity="range")
    assert rows(out.where("n <> id + 1"), "id") == [] and out.count() == 4000
    assert O.stitched(df.limit(0), "k", ["ts", "id"], seq="n", granularity="range").collect() == []
