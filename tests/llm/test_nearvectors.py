import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import nearvectors as N

SCHEMA = "vec_id long, embedding array<double>, label string, cid string, cell string, n string, vec string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "z", "y", "x", "w") for i, v, label in rows], SCHEMA)


def brute(rows, similar=0.93):
    """{vec_id: (n_links, component_id)} by all pairs."""
    fine = {i: (v, label) for i, v, label in rows
            if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    ids = [i for i, *_ in rows]
    links, comp = dict.fromkeys(ids, 0), {i: i for i in ids}
    groups = {}
    for i, (v, label) in fine.items():
        v = np.array(v) / np.abs(v).max()
        groups.setdefault((label, len(v)), []).append((i, v / np.linalg.norm(v)))
    for members in groups.values():
        x = np.stack([v for _, v in members])
        near = x @ x.T >= similar
        for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            a, b = members[a][0], members[b][0]
            links[a] += 1
            links[b] += 1
            x_, y_ = sorted((comp[a], comp[b]))
            if x_ != y_:
                comp = {k: x_ if c == y_ else c for k, c in comp.items()}
    return {i: (links[i], comp[i]) for i in ids}


def result(df):
    got = df.collect()
    assert len({r["vec_id"] for r in got}) == len(got)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    return {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got}


def cloud(rng, n, size=24):
    return rng.standard_normal((n, size))


def data(seed=0):
    """Scattered vectors, groups of near copies, chains and exact copies in three labels."""
    rng = np.random.default_rng(seed)
    base = cloud(rng, 300)
    x = np.vstack([base, np.repeat(base[:40], 4, 0) + 0.2 * cloud(rng, 160),
                   np.repeat(base[:1], 60, 0) + 0.25 * cloud(rng, 60), np.repeat(base[50:51], 80, 0)])
    x *= rng.uniform(0.1, 9, (len(x), 1))
    x[-80:] = base[50]
    order = rng.permutation(len(x))
    return [(int(i), x[k].tolist(), "abc"[k % 3] if k < 520 else "a") for i, k in enumerate(order)]


@pytest.mark.parametrize("shard", [2048, 60])
def test_equals_brute_force(spark, monkeypatch, shard):
    """In one cell a label, and in many overlapping ones (some of them dense)."""
    monkeypatch.setattr(N, "SHARD", shard)
    rows = data()
    assert result(N.near_duplicates(table(spark, rows))) == brute(rows)


def test_overlapping_cells_part_no_pair_at_full_reach(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 50)
    monkeypatch.setattr(N, "REPLICAS", 50)
    rows = data(1)
    nodes = N.usable(table(spark, rows), "vec_id", "embedding", "label").where("vec is not null") \
        .select(F.col("vec_id").alias("cid"), F.lit(1).cast("long").alias("n"), "label", "vec")
    dealt = N.cells(nodes, 0.5 * (2 - 2 * N.SIMILAR) ** 0.5, N.shared_dir(spark), "t").select("cid", "cell", "label").collect()
    where = {}
    for r in dealt:
        where.setdefault(r["cid"], set()).add((r["label"], r["cell"]))
    assert len({c for cells in where.values() for c in cells}) > 12
    x = {i: (np.array(v) / np.linalg.norm(v), label) for i, v, label in rows}
    for a in x:
        for b in x:
            if a < b and x[a][1] == x[b][1] and x[a][0] @ x[b][0] >= N.SIMILAR:
                assert where[a] & where[b]


def test_a_poor_index_is_found_out_and_made_again(spark, monkeypatch):
    """With no reach at first, the audit measures lost links and the rounds mend it."""
    monkeypatch.setattr(N, "SHARD", 10)
    monkeypatch.setattr(N, "SPREAD", 0.0)
    monkeypatch.setattr(N, "REPLICAS", 50)
    rng = np.random.default_rng(5)
    x = np.repeat(cloud(rng, 50, 8), 6, 0) + 0.2 * cloud(rng, 300, 8)
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)]
    want = brute(rows)
    nodes = table(spark, rows).select(F.col("vec_id").alias("cid"), F.lit(1).cast("long").alias("n"), "label",
                                      F.col("embedding").alias("vec"))
    first = N.link(nodes, N.shared_dir(spark), "first", 0.0, 4)
    assert N.audit(nodes, first) < N.TARGET
    got = result(N.near_duplicates(table(spark, rows)))
    assert sum(n for n, _ in got.values()) >= 0.98 * sum(n for n, _ in want.values())
    assert all(n <= want[i][0] for i, (n, _) in got.items())


def test_rows_that_take_no_part(spark):
    rows = [(0, None, "a"), (1, [], "a"), (2, [0.0, 0.0], "a"), (3, [1.0, None], "a"), (4, [1.0, math.nan], "a"),
            (5, [math.inf, 1.0], "a"), (6, [1.0, 1.0], None), (7, [1.0, 1.0], None), (10, [1.0, 1.0], "a"), (8, [2.0, 2.0], "a"),
            (9, [1.0, 1.0], "b"), (11, [1.0, 1.0, 0.0], "a"), (12, [1e200, 1e200], "a"), (13, [1e-200, 1e-200], "a")]
    got = result(N.near_duplicates(table(spark, [*rows, (None, [1.0, 1.0], "a"), rows[8]])))
    assert got == brute(rows)
    assert got[8] == (3, 8) and got[13] == (3, 8) and got[7] == (0, 7)


def test_equal_ids_count_once(spark):
    rows = [(1, [0.0, 1.0], "a"), (1, [1.0, 0.0], "a"), (2, [0.0, 1.0], "a"), (2, [0.0, 1.0], "a")]
    assert result(N.near_duplicates(table(spark, rows))) == {1: (1, 1), 2: (1, 1)}


def test_empty_table_and_labels_of_numbers(spark):
    assert N.near_duplicates(table(spark, [])).collect() == []
    df = spark.createDataFrame([(3, [1.0, 0.0], 7), (2, [1.0, 0.1], 7), (1, [1.0, 0.1], 8)], "vec_id long, embedding array<float>, label int")
    assert result(N.near_duplicates(df)) == {3: (1, 2), 2: (1, 2), 1: (0, 1)}


def test_robust_pruning_keeps_what_is_not_behind_a_neighbour():
    angle = np.array([0.0, 0.1, 0.2, 0.3, -0.4, 3.0])
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1)
    kept = N.robust_prune(x, np.array([0]), np.array([[1, 2, 3, 4, 5, 0, -1, 1]]), 4)[0]
    assert kept.tolist() == [1, 4, 5, -1]           # 2 and 3 are behind 1; 4 and 5 in other directions
