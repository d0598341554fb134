import re

import numpy as np
import pytest

from quarry.llm import mixing
from corpus_texts import prose


def shares(sizes):
    """Targets by hand: sources in code-point order, null last, weights 5, 2, 1."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[t] for t in rest) for s in rest}
        above = {s: 3 * sizes[s] for s in rest if share[s] > 3 * sizes[s]}
        if not above:
            return fixed | share
        fixed |= above


def rows_of(n=400):
    sources = ["b", "a", "Z", "é", None, "b"]
    rows = [(i, prose(i, 1 + (i * 37) % 90), None, sources[i % 6]) for i in range(n)]
    return rows + [(7, None, None, "a"), (7, "", None, "tiny"), (None, "a b c", None, "tiny"), (1, "same same", None, "q"),
                   (1, "same same", None, "q"), (1, "same same", None, "q"), (9, "w " * 5000, None, "a")]


@pytest.mark.parametrize("block", [8192, 16])
def test_targets_and_totals(docs, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK", block)
    rows = rows_of()
    got = mixing.mix_sources(docs(rows)).collect()
    assert len(got) == len(rows)
    sizes: dict = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = shares(sizes)
    taken: dict = {}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["size"] * r["copies"] and 0 <= r["copies"] <= 3
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for source in ("b", "Z", "é", None):
        assert abs(taken[source] - want[source]) <= 100
    again = mixing.mix_sources(docs(rows).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_take_repeats_rows(docs):
    rows = rows_of(60)
    table = docs(rows)
    mixed = mixing.mix_sources(table)
    out = mixing.take(table, mixed)
    assert out.columns == table.columns
    assert out.count() == mixed.agg({"copies": "sum"}).first()[0]


def test_empty_and_wordless(docs):
    assert mixing.mix_sources(docs([])).count() == 0
    got = mixing.mix_sources(docs([(1, "", None, "a"), (2, None, None, "b")])).collect()
    assert [r["taken"] for r in got] == [0, 0] and {r["target"] for r in got} == {0.0}


def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 500, 300)
    odds = np.full(300, 0.3)
    mean = np.zeros(300)
    for seed in range(200):
        out = mixing.flight(odds, sizes, np.random.Generator(np.random.PCG64(seed)))
        assert ((out > 0) & (out < 1)).sum() <= 2
        assert out.sum() == pytest.approx(odds.sum()) and (out * sizes).sum() == pytest.approx((odds * sizes).sum())
        mean += out / 200
    assert abs(mean - 0.3).max() < 0.15
