"""Driver contract: every query has an oracle, entry() has a stable schema,
and a sample of queries agrees with its DuckDB oracle on the smoke data."""

import math
import os
import shutil
import subprocess
import sys

import pytest

import __spark_entry__ as E

SMOKE = "/root/testdata/sf0.001"
SAMPLE = ["before_after_12w_by_region", "payment_schedule", "merged_ingredient_list",
          "running_balance", "state_as_of", "top_item_per_customer", "visit_conversion",
          "platform_share_by_month", "before_after_by_year_4w", "qualified_customers_by_week",
          "opening_sign_share", "revenue_growth_by_month", "balance_change_classes",
          "avg_visits_per_user", "order_line_label", "run_duration_percentiles",
          "delivery_report", "masked_dense_rank", "transition_counts", "missing_weeks"]


def test_every_query_has_oracle():
    q, o = E.all_queries(), E.all_oracles()
    assert len(q) >= 90
    assert set(q) == set(o)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_schema(spark):
    if not os.path.exists(SMOKE):
        pytest.skip("no smoke data")
    df = E.entry(spark)
    assert df.columns == ["region", "before_value", "after_value", "change", "pct_change",
                          "change_rank"]
    assert df.count() == 5


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) if not math.isnan(v) else "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19]
    return v


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(SMOKE):
        pytest.skip("no smoke data")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    sdf = E.queries()[name](spark, SMOKE)
    res = con.execute(E.oracle_sql()[name])
    ocols = [c[0] for c in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    srows = sorted(tuple(_norm(r[c]) for c in sorted(ocols)) for r in sdf.collect())
    idx = [ocols.index(c) for c in sorted(ocols)]
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in res.fetchall())
    assert srows == orows


@pytest.mark.parametrize("gone", [["quarry/llm"], ["quarry/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_analyses_register_without_the_corpus_parts(tmp_path, gone):
    """A copy without them still registers every analysis."""
    top = os.path.dirname(os.path.abspath(E.__file__))
    skip = {os.path.join(top, *g.split("/")) for g in gone}
    copy = tmp_path / "copy"
    copy.mkdir()
    shutil.copytree(os.path.join(top, "quarry"), copy / "quarry",
                    ignore=lambda at, names: [n for n in names if os.path.join(at, n) in skip or n == "__pycache__"])
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.join(top, name) not in skip and os.path.exists(os.path.join(top, name)):
            shutil.copy(os.path.join(top, name), copy / name)
    code = ("import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); "
            "print(len([n for n in q if n in E.all_queries()]), 'pipeline' in q)")
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(E.all_queries())), "False"]
