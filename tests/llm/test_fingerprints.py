import hashlib
import re

import pytest
from pyspark.sql import functions as F

from corpus_texts import edited, prose
from quarry.llm import fingerprints as fp


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))


@pytest.mark.parametrize("size", [4096, 3])
def test_edits_by_hand(docs, monkeypatch, size):
    monkeypatch.setattr(fp, "RANGE", size)
    rows = [(i * 7 - 20, prose(i, 10 + 5 * i)) for i in range(20)]
    rows += [(None, "no id é one"), (None, "another"), (500, ""), (501, None), (502, "日本語 text"), (503, "x"), (3, "same"), (3, "same"),
             (600, prose(1, 6000))]
    got = [tuple(r) for r in fp.fingerprint_edits(docs(rows)).select(
        "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()]
    seq = ordered(rows)
    want = []
    for i, (doc_id, text) in enumerate(seq):
        text, after = text or "", seq[(i + 1) % len(seq)][1] or ""
        half = len(text) // 2
        new = text[:len(text) - half] + after[:half]
        a, b, c = shingles(text), shingles(new), shingles(after)
        want.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), likeness(a, b), likeness(a, c),
                     len(a | b) <= fp.K, len(a | c) <= fp.K))
    def key(r):
        return (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:3] == w[:3]
        for k in (3, 4):                            # exact up to K shingles
            assert abs(g[k] - w[k]) <= (1e-9 if w[k + 2] else 0.2)


def test_single_row_and_empty_table(docs):
    one = fp.fingerprint_edits(docs([(1, "a b c d e f")])).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 11
    none = fp.fingerprint_edits(docs([(None, "a b"), (None, "c d")])).collect()
    assert len(none) == 2
    assert fp.fingerprint_edits(docs([])).count() == 0


def test_equal_texts_have_equal_fingerprints(docs):
    rows = [(i, prose(i % 3, 400)) for i in range(9)]
    got = fp.fingerprint_edits(docs(rows)).select("doc_id", "fingerprint").collect()
    assert len({r["fingerprint"] for r in got}) == 3
    assert all(len({r["fingerprint"] for r in got if r["doc_id"] % 3 == m}) == 1 for m in range(3))


def test_estimates_and_merging(spark):
    base = [prose(k, 120) for k in range(30)]
    long_text, other = "\n".join(base), edited("\n".join(base), 3, 200)
    df = spark.createDataFrame([(long_text, other)], "a string, b string") \
        .select("a", "b", fp.sketch(F.col("a")).alias("sa"), fp.sketch(F.col("b")).alias("sb"))
    row = df.select(fp.resemblance(F.col("sa"), F.col("sb")).alias("r"), fp.containment(F.col("sa"), F.col("sb")).alias("c"),
                    fp.distinct_count(F.col("sa")).alias("n"), F.size("sa").alias("k")).first()
    sa, sb = shingles(long_text), shingles(other)
    assert row["k"] == fp.K
    assert abs(row["r"] - likeness(sa, sb)) < 0.15 and abs(row["c"] - len(sa & sb) / len(sa)) < 0.2
    assert abs(row["n"] / len(sa) - 1) < 0.35
    # parts sketched apart, in any grouping, merge to the sketch of all
    parts = spark.createDataFrame([(k % 2, t) for k, t in enumerate(base)] + [(None, "a b c d e"), (7, "")], "g int, t string")
    parts = parts.select("g", fp.sketch(F.col("t"), 16).alias("s"))
    merged = {x["g"]: x["s"] for x in fp.merge_groups(parts, ["g"], "s", 16).collect()}
    whole = {g: set() for g in (0, 1, None, 7)}
    for x in parts.collect():
        whole[x["g"]] |= set(x["s"])
    assert merged == {g: sorted(s)[:16] for g, s in whole.items()}
    both = spark.createDataFrame([(merged[0], merged[1])], "x array<bigint>, y array<bigint>") \
        .select(fp.merged(F.col("x"), F.col("y"), 16).alias("m")).first()["m"]
    assert both == sorted(set(merged[0]) | set(merged[1]))[:16]


def test_plan_has_no_python(docs):
    plan = fp.fingerprint_edits(docs([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
