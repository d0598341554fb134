import math

import numpy as np
import pytest

from quarry.llm import vectors


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "z") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, vec string")


def brute(rows, query, k):
    q = np.array(query[1], np.float32).astype(float)
    seen = {(i, tuple(v)) for i, v in rows}
    scored = sorted((-float(np.dot(q, np.array(v, np.float32).astype(float))), i) for i, v in seen if i != query[0])
    return scored[:k]


def recall(got, rows, every, k):
    hit = total = 0
    for query in rows:
        if query[0] % every:
            continue
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query[0])
        want = brute(rows, query, k)
        assert [r for r, _, _ in mine] == list(range(1, len(want) + 1))
        by_id = dict(rows)
        q = np.array(query[1], np.float32).astype(float)
        assert all(abs(s - float(np.dot(q, np.array(by_id[i], np.float32).astype(float)))) < 1e-9 for _, i, s in mine)
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        hit += len({i for _, i, _ in mine} & {i for _, i in want})
        total += len(want)
    return hit / total


@pytest.mark.parametrize("tile", [4096, 60])
def test_recall_on_clusters_of_any_norm(spark, monkeypatch, tile):
    monkeypatch.setattr(vectors, "LIST", 50)
    monkeypatch.setattr(vectors, "TILE", tile)
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((8, 40)) * 2
    rows = [(i, ((centres[i % 8] + rng.standard_normal(40)) * rng.uniform(0.2, 3)).tolist()) for i in range(900)]
    rows += [(1000 + i, rows[0][1]) for i in range(300)]           # a third more of one vector
    got = vectors.search(table(spark, rows), every=20, k=20).collect()
    assert recall(got, rows, 20, 20) >= 0.9


def test_rows_that_take_no_part(spark):
    rows = [(20 * i, [float(i), 1.0, 0.0]) for i in range(1, 6)]
    odd = [(0, [0.0, 0.0, 0.0]), (1, None), (2, [1.0, None, 0.0]), (3, [1.0, math.nan, 0.0]), (4, [1.0, math.inf, 0.0]),
           (5, [1.0, 2.0]), (6, []), (None, [1.0, 1.0, 1.0]), (40, [2.0, 1.0, 0.0])]
    got = vectors.search(table(spark, rows + odd), every=20, k=20).collect()
    assert recall(got, rows, 20, 20) == 1.0
    assert {r["query_id"] for r in got} == {20, 40, 60, 80, 100} and len(got) == 20


def test_ties_and_few_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)]
    got = vectors.search(table(spark, rows), every=20, k=20).collect()
    for q in (0, 20, 40):
        ids = [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])]
        assert ids == [i for i in range(22) if i != q][:20]
    assert vectors.search(table(spark, rows[:1]), every=20, k=20).count() == 0
    assert vectors.search(table(spark, []), every=20, k=20).count() == 0
    assert vectors.search(table(spark, [(3, [1.0, 2.0])]), every=20, k=20).count() == 0


def test_scan_keeps_the_best():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((2000, 64))
    scanner = vectors.Scanner(x, float(np.sqrt((x ** 2).sum(axis=1)).max()))
    found = total = 0
    for q in x[:50]:
        exact = np.sort(x @ q)[-20:]
        places, scores = scanner.scan(q, 20, -np.inf)
        found += (np.sort(scores)[-20:] >= exact[0] - 1e-9).sum()
        total += 20
        assert len(places) < len(x)             # some are abandoned early
    assert found / total > 0.99


def test_rotation_keeps_lengths():
    r = vectors.rotation(33)
    assert np.allclose(r @ r.T, np.eye(33))
