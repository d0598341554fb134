import random
import re
import zlib
from collections import Counter

import pytest

from quarry.llm import spelling


def is_near(a, b):
    """Exactly one edit, by trying every one."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = {w: [v for v in n if is_near(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def result(df):
    return sorted([tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect()], key=str)


def corpus(seed, letters, stems, n_docs):
    rng = random.Random(seed)
    words = []
    for _ in range(stems):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        words += [w] * rng.choice([1, 1, 6, 40])
        for _ in range(3):                      # variants, also of variants
            i = rng.randrange(len(w) + 1)
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            words += [w] * rng.choice([1, 1, 6])
    return [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(n_docs)]


@pytest.mark.parametrize("block", [512, 7])
def test_equals_brute_force(spark, docs, monkeypatch, block):
    """Also where groups of one affix are dealt into many block pairs."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rows = corpus(1, "abéÿ", 60, 60)
    got = result(spelling.group_variants(docs(rows)))
    assert got == brute(rows) and sum(r[1] is not None for r in got) > 5
    assert max(len(r[0]) for r in got) >= 9


def test_hot_prefix_and_chains(spark, docs, monkeypatch):
    monkeypatch.setattr(spelling, "BLOCK", 16)
    chain = ["prefixa"] * 3 + ["prefixab"] * 30 + ["prefixabc"] * 200
    tail = [f"prefix{a}{b}" for a in "defghi" for b in "klmnopq"] * 6
    rows = [(i, " ".join(chain + tail)) for i in range(1)] + [(7, "PREFIXA Prefixa")]
    got = result(spelling.group_variants(docs(rows)))
    assert got == brute(rows)
    assert {r[0]: r[2] for r in got}["prefixa"] == "prefixabc"


def test_nulls_empty_texts_and_ties(spark, docs):
    word = "Àbc×def" * 40                    # a very long word; upper-case À stays
    rows = [(1, None), (2, ""), (3, "12 _ -"), (None, "nullid " * 6), (4, (word + " ") * 6),
            (5, "wordone " * 25 + "wordona " * 5 + "wordonb " * 25 + "wordoné " * 5), (5, "wordone " * 3)]
    got = result(spelling.group_variants(docs(rows)))
    assert got == brute(rows)
    assert {r[0]: r[1] for r in got}["wordona"] == "wordone"          # of largest count


def test_empty_table(spark, docs):
    assert spelling.group_variants(docs([])).collect() == []


def test_no_pairs_leave_a_tile(spark, docs):
    """A tile gives one row a word, not one a pair."""
    rows = [(0, " ".join(f"same{a}{b}{c}" for a in "abcd" for b in "abcd" for c in "abcd") + " ")] * 5
    words = spelling.vocabulary(spelling.damaged_runs(docs(rows)))
    n = words.count()
    found = spelling.tiles(words).repartition("tile").sortWithinPartitions("tile", "m", "side", "affix") \
        .mapInArrow(spelling._compare_sorted, spelling.FOUND)
    assert found.groupBy("word").count().agg({"count": "max"}).first()[0] <= 4
    assert found.agg({"n_near": "sum"}).first()[0] == sum(r[4] for r in brute(rows)) > 4 * n
