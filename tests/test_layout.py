"""Bucketed facts: joins and groupings on the key without an exchange."""

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from quarry.sources.layout import open_bucketed, write_bucketed


@pytest.fixture
def plain(spark):
    """Plans as for tables that are all large."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_join_and_grouping_move_nothing(spark, plain, tmp_path):
    a = spark.range(1000).selectExpr("id % 97 as k", "id as v").unionByName(spark.createDataFrame([(None, -1)], "k long, v long"))
    b = spark.range(97).selectExpr("id as k2", "id * 2 as w")
    wa = write_bucketed(a.repartition(5), f"file://{tmp_path}/a", "k", 4)
    wb = write_bucketed(b, f"file://{tmp_path}/b", "k2", 4)
    assert len([f for f in (tmp_path / "a").iterdir() if f.name.endswith(".parquet")]) <= 4
    got = wa.groupBy("k").agg(F.sum("v").alias("s")).join(wb, F.col("k") == F.col("k2"))
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = a.groupBy("k").agg(F.sum("v").alias("s")).join(b, F.col("k") == F.col("k2"))
    assert rows(got, "k", "s", "w") == rows(want, "k", "s", "w")
    again = open_bucketed(spark, f"file://{tmp_path}/a", "k long, v long", "k", 4)
    assert again.count() == 1001
    assert "Exchange" not in again.join(wb, F.col("k") == F.col("k2"))._jdf.queryExecution().executedPlan().toString()


def test_deliveries_by_bucket_have_no_exchange(spark, plain):
    from quarry.plans.registry import all_queries
    df = all_queries()["deliveries_by_order_bucket"](spark, "/root/testdata/sf0.001")
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() > 0


def _facts(spark, at):
    """Small tables for the joins of lines with their orders; some keys repeat or are null."""
    tables = {
        "region": spark.createDataFrame([(0, "R0"), (1, "R1")], "r_regionkey int, r_name string"),
        "nation": spark.range(4).selectExpr("cast(id as int) n_nationkey", "concat('N', id) n_name", "cast(id % 2 as int) n_regionkey"),
        "customer": spark.range(20).selectExpr("id c_custkey", "concat('C', id) c_name", "cast(id % 4 as int) c_nationkey", "0D c_acctbal",
                                               "element_at(array('BUILDING', 'HOUSEHOLD', 'MACHINERY'), cast(id % 3 as int) + 1) c_mktsegment"),
        "part": spark.range(10).selectExpr("id p_partkey", "concat('P', id) p_name", "'B' p_brand", "'SMALL' p_type",
                                           "cast(id as int) p_size", "1D p_retailprice"),
        "orders": spark.range(210).selectExpr("if(id = 209, null, id % 200) o_orderkey", "id % 20 o_custkey",
                                              "element_at(array('F', 'O', 'P'), cast(id % 3 as int) + 1) o_orderstatus", "1D o_totalprice",
                                              "timestamp_ntz'1998-01-01 00:00:00' o_orderdate", "'1-URGENT' o_orderpriority"),
        "lineitem": spark.range(900).selectExpr("if(id % 300 = 7, null, id % 200) l_orderkey", "id % 10 l_partkey", "id % 5 l_suppkey",
                                                "cast(id % 7 as int) l_linenumber", "cast(id % 50 as double) l_quantity",
                                                "cast(id as double) l_extendedprice", "0.1D l_discount", "0D l_tax", "'N' l_returnflag",
                                                "if(id % 2 = 0, 'F', 'O') l_linestatus",
                                                "cast(date_add(date'1998-01-01', cast(id % 40 as int)) as timestamp_ntz) l_shipdate"),
    }
    for name, df in tables.items():
        df.write.parquet(f"file://{at}/{name}.parquet")
    return f"file://{at}"


@pytest.mark.parametrize("name", ["clean_weekly", "totals_by_year", "totals_by_platform", "totals_by_region_month",
                                  "avg_transaction_by_year_platform", "avg_transaction_rounded", "ingredient_totals"])
def test_tasks_by_order_hold_a_bounded_number_of_lines(spark, plain, tmp_path, monkeypatch, name):
    """Partitions grow with the lines, and the results stay."""
    from quarry.plans.registry import all_queries
    from quarry.sources import layout
    at = _facts(spark, tmp_path)
    df = all_queries()[name](spark, at)
    want = rows(df, *df.columns)
    assert "REPARTITION_BY_NUM" not in df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(layout, "TASK_ROWS", 900 // 30)
    df = all_queries()[name](spark, at)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert [x for x in plan.splitlines() if "REPARTITION_BY_NUM" in x and "l_orderkey" in x and ", 30)" in x], plan
    assert want and rows(df, *df.columns) == want


@pytest.mark.parametrize("name", ["clean_weekly", "totals_by_platform", "totals_by_region_month", "avg_transaction_rounded"])
def test_lines_move_once_by_order(spark, plain, tmp_path, monkeypatch, name):
    """Also where customers are too many to broadcast, lines stay dealt by order up to the per-order grouping."""
    from quarry.plans.registry import all_queries
    from quarry.sources import layout
    at = _facts(spark, tmp_path)
    monkeypatch.setattr(layout, "TASK_ROWS", 5)
    plan = all_queries()[name](spark, at)._jdf.queryExecution().executedPlan().toString()
    moves = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in moves if "l_orderkey" in x]) == 1, plan
    assert [x for x in moves if "o_custkey" in x and "REPARTITION_BY_NUM" in x], plan
