from corpus_texts import edited, prose
from quarry.llm import lines


def run(docs, rows):
    return {(r["doc_id"], r["text"], r["n_lines_"], r["n_dropped_"]) for r in
            lines.drop_recurring_lines(docs(rows), names=("n_lines_", "n_dropped_")).collect()}


def test_recurring_templates_go(docs):
    boiler = "All rights reserved by the green garden company"
    rows = []
    for i in range(6):
        body = [prose(10 * i + k, 30) for k in range(3)]
        rows.append((i, "\n".join([body[0], f"Posted on 2024-0{i + 1}-11 by user{i} in the news", body[1], boiler,
                                   f"The green letter of the {prose(i, 2)} stands in the garden of the house", body[2], "the end"])))
    got = run(docs, rows)
    for i, text in rows:  # dated line, boilerplate and the line with one varying run are gone
        parts = text.split("\n")
        assert (i, "\n".join([parts[0], parts[2], parts[5], parts[6]]), 7, 3) in got


def test_copies_of_documents_are_left_alone(docs):
    base = "\n".join(prose(k, 40) for k in range(4))
    rows = [(i, base) for i in range(8)] + [(100 + i, edited(base, i, 1)) for i in range(8)] \
        + [(200 + i, "\n".join(prose(1000 + 10 * i + k, 20) for k in range(3))) for i in range(10)]
    assert {(i, t) for i, t, _, gone in run(docs, rows) if gone == 0} == set(rows)


def test_edges(docs):
    rows = [(1, None), (2, ""), (3, "\n\n"), (None, "one line here"), (4, "one two\n" * 4), (5, "w " * 60_000), (6, "a"), (6, "a")]
    got = run(docs, rows)
    assert {(i, t) for i, t, _, _ in got} == set(rows)
    assert {n for i, _, n, _ in got if i in (1, 2)} == {0}
    table = docs([])
    assert lines.drop_recurring_lines(table, names=("p", "q")).columns == [*table.columns, "p", "q"]
    assert lines.drop_recurring_lines(table, names=("p", "q")).count() == 0


def test_templates_by_hand():
    import pyarrow as pa
    texts = ["a b c d e f g h i\nx y z", "a b c d e f G H 7\nx y 5", "a b c d X Y g h i"]
    row, line, keys, usable, _ = lines.line_templates(pa.array(texts))
    assert row.tolist() == [0, 0, 1, 1, 2] and line.tolist() == [0, 1, 0, 1, 0]
    assert usable[1].tolist() == [True] + [False] * 5
    assert set(keys[0]) & set(keys[2])          # last third differs
    assert not set(keys[0][:1]) & set(keys[2]) and not set(keys[1]) & set(keys[3])


def test_a_copied_document_does_not_shield_its_lines(docs):
    passage = prose(7, 30)
    rows = [(i, f"{prose(2000 + i, 60)}\n{passage}") for i in range(6)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]
    assert {(n, gone) for _, _, n, gone in run(docs, rows)} == {(2, 1)}


def test_a_line_does_not_count_as_its_own_context(docs):
    """Short documents made up mostly of one line: whichever shingles the line has."""
    lost = 0
    for seed in range(4):
        passage = prose(40_000 + seed, 60)
        rows = [(i, f"{prose(3000 + 10 * seed + i, 25)}\n{passage}") for i in range(3)]
        lost += sum(gone != 1 for _, _, _, gone in run(docs, rows))
    assert lost == 0


def test_bits_of_a_line():
    import numpy as np
    import pyarrow as pa
    text = "\n".join(prose(k, 12) for k in range(3))
    words, at, _ = lines.word_hashes(pa.array(["other words here", text]), fields=True)
    _, _, _, _, mask = lines.line_templates(pa.array(["other words here", text]))
    small = lines.small_run(words)
    sketch = lines.sketches(words, at, small)[1]
    for k, got in enumerate(mask.view(np.uint64)[1:].tolist()):
        own = small[3 + 12 * k:3 + 12 * k + 8].tolist()
        assert {v for i, v in enumerate(sketch.tolist()) if got >> i & 1} == set(own)


def test_two_contexts_do_for_long_lines(docs):
    long, short = prose(50_000, 55), prose(50_001, 12)
    rows = [(i, f"{short}\n{prose(6000 + i, 60)}\n{long}") for i in range(2)] + [(9, prose(6009, 60))]
    got = {i: (t, gone) for i, t, _, gone in run(docs, rows)}
    assert got == {**{i: (f"{short}\n{prose(6000 + i, 60)}", 1) for i in range(2)}, 9: (prose(6009, 60), 0)}


def test_passages_inside_lines_go(docs):
    passage = prose(70_000, 53).split(" ")
    rows = []
    for i in range(2):      # mid-line to mid-line, over a line feed, other spacing
        a, b = prose(7000 + i, 70 + 5 * i), prose(7100 + i, 64)
        inner = " ".join(passage) if i else " ".join(passage[:30]) + "\n" + "  ".join(passage[30:])
        rows.append((i, f"{a} {inner} {b}"))
    rows += [(5, f"{prose(7200, 80)} {' '.join(passage[:49])} {prose(7201, 60)}"), (6, prose(7300, 90))]
    assert run(docs, rows) == {(0, f"{prose(7000, 70)}\n{prose(7100, 64)}", 2, 2),
                               (1, f"{prose(7001, 75)} {prose(7101, 64)}", 1, 1), (*rows[2], 1, 0), (*rows[3], 1, 0)}


def test_chosen_keys_by_brute_force():
    import numpy as np
    import pyarrow as pa
    words, at = lines.word_hashes(pa.array([prose(k, n) for k, n in enumerate((49, 50, 140, 3, 260, 0, 51))]))
    grams = lines._grams(words, lines.GRAM)
    expected = set()
    for a, b in zip(at[:-1], at[1:]):
        for i in range(a, b - lines.PASSAGE + 1):
            expected.add(i + int(np.argmin(grams[i:i + lines.PASSAGE - lines.GRAM + 1])))
    place, keys = lines._chosen(words, at)
    assert set(place.tolist()) == expected and (keys == grams[place]).all()
    assert lines._chosen(words[:0], at[:1])[0].size == 0


def test_texts_apart_by_brute_force():
    """All keys of a pair of texts at once: sketches without the hashes inside the line."""
    import numpy as np
    import pyarrow as pa

    def under(a, b):
        least = min(len(a), len(b))
        low = sorted(a | b)[:least]
        return len([x for x in low if x in a and x in b]) < lines.ALIKE * least - 0.5 * least ** 0.5

    rng = np.random.default_rng(5)
    rows, expected = [], []
    for mark in range(60):
        pool = np.unique(rng.integers(-2**31, 2**31, 130))
        a, b = (np.sort(rng.choice(pool, int(rng.integers(0, 65)), replace=False)).tolist() for _ in range(2))
        b = sorted(set(a[:-3] + b[:2])) if mark % 3 == 0 else b
        keys = rng.integers(-2**63, 2**63 - 1, mark % 5).tolist()
        spare = [int(rng.integers(-2**63, 2**63 - 1)) | (-1 << int(rng.integers(0, 64))) for _ in keys]
        masks = spare if mark % 2 else [m & int(rng.integers(-2**63, 2**63 - 1)) for m in spare]
        leads = rng.integers(-2**63, 2**63 - 1, len(keys)).tolist()
        rows.append((mark, a, b, keys, masks, leads))
        for key, mask, lead in zip(keys, masks, leads):
            x = {v for i, v in enumerate(a) if not mask >> i & 1}
            y = {v for i, v in enumerate(b) if not lead >> i & 1}
            if under(set(a), set(b)) if min(len(x), len(y)) < lines.OUTSIDE else under(x, y):
                expected.append((key, mark, mask))
    kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list("abcdef"))
    got = [tuple(r.values()) for part in (batch.slice(0, 7), batch.slice(7)) for b in lines._apart([part]) for r in b.to_pylist()]
    assert got == expected and 10 < len(got) < sum(len(r[3]) for r in rows)


def test_only_texts_with_drops_are_parsed(monkeypatch):
    import numpy as np
    import pyarrow as pa
    texts = [None, "", "a b c\n", "x y z\na b c\nlast one here", "\n\n"] + ["q r s"] * 20
    key = lines.line_templates(pa.array(["a b c"]))[2][0][:1].tolist()
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([key, key, None, key, []] + [None] * 20, pa.list_(pa.int64()))],
                                       ["text", "drop"])
    parsed, real = [], lines.line_templates
    monkeypatch.setattr(lines, "line_templates", lambda column, **kw: parsed.append(len(column)) or real(column, **kw))
    got = [tuple(r.values()) for b in lines._dropped(0, 1, ("n", "gone"))([batch]) for r in b.to_pylist()]
    assert got == [(None, 0, 0), ("", 0, 0), ("a b c\n", 2, 0), ("x y z\nlast one here", 3, 1), ("\n\n", 3, 0)] + [("q r s", 1, 0)] * 20
    assert parsed == [3]


def test_keys_are_dealt_in_few_rows_and_none_of_two_texts_is_lost(monkeypatch):
    """One parse; whatever a task holds of a bucket."""
    import numpy as np
    import pyarrow as pa
    shared = [prose(90_000 + k, 15) for k in range(6)]
    texts = [None, "", "one two"] + ["\n".join([prose(91_000 + i, 70), shared[i % 6], shared[i % 4]]) for i in range(40)]
    texts += texts[5:9]
    marks = [texts.index(t) for t in texts]
    emitted = lambda: lines._sketched([pa.RecordBatch.from_arrays([pa.array(marks), pa.array(texts)], ["mark", "text"])])
    plain, words, at, line = lines.line_words(pa.array(texts))
    row, _, keys, usable, first, stop = lines._parsed(words, at, line)
    place, chosen = lines._chosen(plain, at)
    stand: dict = {}
    for r, own, use in zip(row.tolist(), keys.tolist(), usable.tolist()):
        for key, ok in zip(own, use):
            if ok:
                stand.setdefault(key, set()).add(marks[r])
    for p, key in zip(place.tolist(), chosen.view(np.int64).tolist()):
        stand.setdefault(key, set()).add(marks[int(np.searchsorted(at, p, "right")) - 1])
    expected = {(key, mark) for key, own in stand.items() if len(own) > 1 for mark in own}
    assert len(expected) > 40
    monkeypatch.setattr(lines, "_BUCKET", np.uint64(62))    # four buckets
    for deal, hold in ((1 << 19, 1 << 21), (50, 1 << 21), (50, 20)):
        monkeypatch.setattr(lines, "DEAL", deal)
        monkeypatch.setattr(lines, "HOLD", hold)
        dealt = pa.Table.from_batches(list(emitted())).sort_by("bucket")
        if deal > 50:
            assert dealt.num_rows <= len(texts) + 4
        found = [r for b in lines._several(dealt.to_batches(max_chunksize=3)) for r in b.to_pylist()]
        rows = [(r["key"], r["mark"]) for r in found if r["key"] is not None]
        assert set(rows) == expected and (hold == 20 or len(rows) == len(expected))
        sketch = [(r["mark"], r["sketch"]) for r in found if r["key"] is None]
        want = lines.sketches(words, at, lines.small_run(words))
        assert sorted(sketch) == sorted((m, want[m].tolist()) for m in set(marks))
    assert sum(x == [] for _, x in sketch) == 2


def test_sketches_by_brute_force():
    """Also of texts that repeat few shingles many times, and of very short ones."""
    import numpy as np
    import pyarrow as pa
    texts = ["a b " * 400, prose(95_000, 400), "a b", "", prose(95_001, 70), "x y z " * 30 + prose(95_002, 300), "u v w x y"]
    _, words, at, _ = lines.line_words(pa.array(texts))
    run = lines.small_run(words)
    got = lines.sketches(words, at, run)
    for r, (a, b) in enumerate(zip(at[:-1], at[1:])):
        if b - a >= 5:
            assert got[r].tolist() == np.unique(run[a:b - 4])[:lines.SKETCH].tolist()
    assert [len(got[r]) for r in (0, 2, 3, 6)] == [2, 1, 0, 1]
