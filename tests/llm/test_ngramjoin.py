import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import ngramjoin
from corpus_texts import edited, prose


def brute(rows):
    """(set size, component) of each row, from all pairs that share a shingle."""
    sets = []
    for _, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            least[top(i)] = min(least.get(top(i), row[0]), row[0])
    return [(row[0], len(sets[i]), least.get(top(i))) for i, row in enumerate(rows)]


def mixed_rows():
    rows = []
    for g in range(12):
        base = prose(g, 60 + 40 * g)
        rows += [(1000 - 3 * (7 * g + k), edited(base, 100 * g + k, k * (1 + g // 3))) for k in range(7)]
    passage = prose(999, 30)                        # stands in many unlike documents
    rows += [(2000 + k, prose(500 + k, 80) + " " + passage) for k in range(30)]
    hub = prose(77, 300)                            # a large group whose members differ from each other
    rows += [(3000 + k, edited(hub, 900 + k, 1 + k % 9)) for k in range(60)]
    return rows + [(5, None), (6, ""), (7, " \n "), (8, "one two"), (9, "ONE two"), (10, "two one"),
                   (11, "x " * 3000), (12, "x " * 3000), (12, "x " * 3000), (13, prose(5, 4000)), (None, "no id here")]


@pytest.mark.parametrize("tile", [1000, 4])
def test_components_match_brute_force(docs, monkeypatch, tile):
    monkeypatch.setattr(ngramjoin, "TILE", tile)
    monkeypatch.setattr(ngramjoin, "FREQUENT_DF", 5)
    rows = mixed_rows()
    got = sorted((tuple(r) for r in ngramjoin.similarity_join(docs(rows)).collect()), key=str)
    assert got == sorted(brute(rows), key=str)


def test_keep_one(docs):
    rows = mixed_rows()
    table = docs(rows)
    kept = ngramjoin.keep_one(table)
    assert kept.columns == table.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    want = brute(rows)
    expected = [i for i, n, c in want if not n] + sorted({c for i, n, c in want if n and c is not None}) + [None]
    assert ids == sorted(expected, key=str)


def test_empty_table(docs):
    assert ngramjoin.similarity_join(docs([])).count() == 0
    assert ngramjoin.keep_one(docs([])).count() == 0


def test_bounds_are_never_below_the_overlap():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 400))
        base = np.unique(rng.integers(-2**62, 2**62, n))
        other = np.unique(np.concatenate([base[:int(rng.integers(0, n + 1))], rng.integers(-2**62, 2**62, n)]))
        bound = ngramjoin.overlap_bounds([len(base)], [ngramjoin._bitmap(base)], [len(other)], [ngramjoin._bitmap(other)])
        assert bound[0] >= len(np.intersect1d(base, other))


def test_prefixes_of_linked_sets_meet():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a = np.unique(rng.integers(0, 10**9, int(rng.integers(1, 60))))
        keep = a[rng.random(len(a)) < 0.9]
        b = np.unique(np.concatenate([keep, rng.integers(0, 10**9, int(rng.integers(0, 8)))]))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 75 * (len(a) + len(b) - both):
            pa, pb = a[:ngramjoin.prefix_length(len(a))], b[:ngramjoin.prefix_length(len(b))]
            assert len(np.intersect1d(pa, pb))


def test_a_tile_gives_no_more_pairs_than_rows():
    """A group of near copies that are not joined yet: a pair a class, not all pairs."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    base = rng.integers(-2**62, 2**62, 100)
    sets = [np.sort(np.append(base[:95], rng.integers(-2**62, 2**62, 5))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7] * 60, pa.int64()), pa.array([0] * 60, pa.int32()), pa.array(range(60), pa.int64()),
         pa.array(range(60), pa.int64()), pa.array([100] * 60, pa.int64()),
         pa.array([ngramjoin._bitmap(s) for s in sets], pa.binary())], ["tile", "side", "sig", "comp", "n", "bits"])
    best = [r for b in ngramjoin._tile_pairs(75, 100, True)([batch]) for r in b.to_pylist()]
    assert sorted(r["a"] for r in best) == list(range(60)) and all(r["more"] for r in best)
    every = [r for b in ngramjoin._tile_pairs(75, 100, False)([batch]) for r in b.to_pylist()]
    assert len(every) == 60 * 59 // 2


def test_a_pair_comes_from_its_first_tile_only():
    """Sets that meet in many tiles: a pair once, not once a tile; none without a common earlier token goes."""
    import pyarrow as pa

    rng = np.random.default_rng(4)
    base = rng.integers(-2**62, 2**62, 100)
    bits = [ngramjoin._bitmap(np.sort(np.append(base[:95], rng.integers(-2**62, 2**62, 5)))) for _ in range(20)]
    tiles = {sig: [t for t in range(12) if (sig + t) % 5] for sig in range(20)}     # each lacks some tiles
    rows = []
    for sig, own in tiles.items():
        for k, tile in enumerate(own):
            rows.append((tile, 0, sig, sig, 100, bits[sig], own[k - 1] if k else None, own[k - 2] if k > 1 else None))
    rows.sort(key=lambda r: r[0])
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                       ["tile", "side", "sig", "comp", "n", "bits", "before1", "before2"])
    every = [tuple(sorted((r["a"], r["b"]))) for b in ngramjoin._tile_pairs(75, 100, False)([batch]) for r in b.to_pylist()]
    assert set(every) == {(a, b) for a in range(20) for b in range(a + 1, 20)}
    assert len(every) < 1.5 * len(set(every))


def test_edges_that_are_stars_need_no_round(spark, tmp_path):
    """Stars are their own components; others are joined until they are stars."""
    from quarry.llm.graphs import components

    def run(edges, name):
        out = components(spark.createDataFrame(edges, "a long, b long"), f"file://{tmp_path}", name)
        return sorted(map(tuple, out.collect())), sorted(p.name for p in tmp_path.glob(f"{name}-*"))
    found, tables = run([(1, 5), (7, 1), (5, 1), (2, 9), (4, 4), (None, 3)], "stars")
    assert found == [(1, 1), (2, 2), (5, 1), (7, 1), (9, 2)] and tables == ["stars-0"]
    found, tables = run([(8, 9), (9, 3), (3, 6), (6, 1), (20, 21), (22, 21), (22, 30)], "chains")
    assert found == [*((n, 1) for n in (1, 3, 6, 8, 9)), *((n, 20) for n in (20, 21, 22, 30))]
    assert len(tables) > 1
    found, tables = run([(5, 1), (5, 2)], "two")            # one larger end, two smaller ones
    assert found == [(1, 1), (2, 1), (5, 1)] and len(tables) > 1
