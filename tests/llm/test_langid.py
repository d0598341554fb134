import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import langid

SYLLABLES = {"aa": "ka lo mi tu re so".split(), "bb": "sch ein ung pfe ber tz".split(), "cc": "eau oir ille que ent ch".split()}


def text_in(lang, seed, n=60):
    r = random.Random(seed)
    return " ".join("".join(r.choices(SYLLABLES[lang], k=r.randint(1, 4))) for _ in range(n))


def longest_matches(sample, text):
    """Phrases of greedy longest matches, by substring search."""
    phrases, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) + 1 and text[at:at + size] in sample:
            size += 1
        phrases += 1
        at += max(1, size - 1)
    return phrases


@pytest.mark.parametrize("piece", [1024, 40])
def test_phrases_match_substring_search(monkeypatch, piece):
    monkeypatch.setattr(langid, "PIECE", piece)
    r = random.Random(4)
    samples = tuple((lang, "".join(r.choice("abc ") for _ in range(300))) for lang in ("x", "y"))
    own = langid.Parser(samples)
    texts = ["".join(r.choice("abcdé ") for _ in range(n)) for n in (1, 5, 39, 40, 41, 200)]
    flat, at = own.symbols(texts)
    counts = own.phrases(flat, at)
    for row, (a, b) in enumerate(zip(at[:-1], at[1:], strict=True)):
        for col, (_, sample) in enumerate(samples):
            known = own.symbols([sample])[0].tolist()
            letters = {s: chr(97 + s) for s in range(own.width)}
            text = "".join("#" if s == 1 else letters[s] for s in flat[a:b].tolist())
            source = "".join(letters[s] for s in known)
            want = sum(longest_matches(source, text[i:i + piece]) for i in range(0, len(text), piece))
            assert counts[row, col] == want


def test_automaton_accepts_substrings_only():
    text = [2, 3, 2, 2, 3, 4, 2, 3]
    table = langid.suffix_automaton(text, 6)

    def accepted(word):
        state = 0
        for s in word:
            state = table[state, s]
            if not state:
                return False
        return True
    words = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    assert all(map(accepted, words)) and not accepted((4, 4)) and not accepted((3, 3)) and not accepted((5,))


def test_held_out_accuracy_and_edges(docs):
    rows = [(i, text_in(lang, i, 8 + i % 40), lang, "s") for i, lang in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "12 !! ?? 3", "cc"), (None, text_in("bb", 5), "bb"),
             (903, text_in("cc", 7, 30_000), None), (904, text_in("aa", 7), "aa"), (904, text_in("aa", 7), "aa")]
    table = docs(rows)
    samples = langid.sample_texts(table.where(~langid.kept_out() & F.col("doc_id").isNotNull()), F.col("text"), F.col("lang"))
    out = langid.identify(table.select("doc_id", langid.kept_out().alias("held_out"), "text", "lang"), samples).collect()
    assert len(out) == len(rows)
    for r in out:
        assert 0 <= r["score"] <= 1 and r["held_out"] is not None
        if r["doc_id"] in (900, 901, 902):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] == 903:
            assert r["lang_pred"] == "cc"
    held = [r for r in out if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(held) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95


def test_nothing_to_learn_from(docs):
    table = docs([(1, "some text", None), (2, None, "en")])
    samples = langid.sample_texts(table, F.col("text"), F.col("lang"))
    assert {r["lang_pred"] for r in langid.identify(table.select("doc_id", "text"), samples).collect()} == {"und"}
    assert langid.identify(docs([]).select("doc_id", "text"), ()).count() == 0


def test_fold_is_crc32_of_the_id(spark):
    import zlib
    got = spark.range(50).select("id", langid.kept_out("id").alias("x"), langid.kept_out("id", 5, 0).alias("y")).collect()
    assert all(r["x"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)
    assert all(r["y"] == (zlib.crc32(str(r["id"]).encode()) % 5 == 0) for r in got)


def test_worker_holds_one_parser():
    import gc

    one, two = (("a", "some text of one"),), (("a", "and of another"),)
    langid.parser(one)
    assert langid.parser(two) is langid.parser(two)
    gc.collect()
    held = [x for x in gc.get_objects() if isinstance(x, langid.Parser)]
    assert len(held) == 1 and held[0] is langid.parser(two)


def test_working_memory_is_of_a_slice_not_of_a_batch():
    """Twelve times the text in one batch takes hardly more memory."""
    import tracemalloc

    import pyarrow as pa

    line = "the quick brown fox jumps over the lazy dog and runs along the river bank " * 14
    samples = (("en", line), ("xx", "lorem ipsum dolor sit amet"))
    langid.parser(samples)

    def peak(rows: int) -> int:
        batch = pa.RecordBatch.from_arrays([pa.array([f"{i} {line}" for i in range(rows)])], ["text"])
        tracemalloc.start()
        n = sum(b.num_rows for b in langid._identified(samples, 0, ("lang", "score"))([batch]))
        top = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == rows
        return top
    peak(10)
    assert peak(24_000) < 2 * peak(2_000)


def test_other_operators_let_the_parser_go():
    """A worker that goes on to another operator does not hold the parser any more."""
    import pyarrow as pa

    from quarry.llm import _shared, lines

    samples = (("aa", "one two three four"), ("bb", "uno dos tres cuatro"))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["one two", "uno dos"])], ["doc_id", "text"])
    own = langid.parser(samples)
    found = list(langid._identified(samples, 1, ("lang", "score"))([batch]))
    assert found[0].column(2).to_pylist() == ["aa", "bb"] and langid.parser(samples) is own
    list(lines._sketched([batch]))
    assert not _shared._kept
