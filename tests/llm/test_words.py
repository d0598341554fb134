import random
import re

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import _words


@pytest.mark.parametrize("segment", [16, 64, 1 << 20])
def test_words_match_the_pattern_whatever_the_segment(monkeypatch, segment):
    monkeypatch.setattr(_words, "SEGMENT", segment)
    r = random.Random(3)
    pieces = ["a", "bb", "C", "é\n", "1", "\n\n", "日本", "\x0b", "x@y", "k" * 40]
    texts = [None, "", " ", "\n"] + [" ".join(r.choices(pieces, k=r.randint(0, 30))) for _ in range(200)]
    words, at, line = _words.word_hashes(pa.array(texts, pa.string()), True)
    found = [list(re.finditer(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
    assert np.diff(at).tolist() == [len(f) for f in found]
    assert line.tolist() == [t[:m.start()].count("\n") for t, f in zip(texts, found, strict=True) for m in f]
    plain, _ = _words.word_hashes(pa.array(texts, pa.string()))
    names: dict = {}
    for m, h in zip([m for f in found for m in f], plain.tolist(), strict=True):
        low = re.sub("[A-Z]", lambda c: c.group().lower(), m.group())
        assert names.setdefault(low, h) == h
    assert len(set(names.values())) == len(names)


def test_shingle_sets():
    values, at = _words.shingle_sets(pa.array(["a b c d e f", "A B c d e f", "a b", "b a", "", None, "a b c d e a b c d e"]))
    assert np.diff(at).tolist() == [2, 2, 1, 1, 0, 0, 5]
    assert (values[:2] == values[2:4]).all() and values[4] != values[5]
