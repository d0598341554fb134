"""Spelling variants: words one edit apart, found by dense prefix-suffix tiles.

*Words.*  The maximal runs of letters (``RUN``) of whole texts, A-Z in lower case,
counted over all documents; see ``damaged_runs`` for the planted misspellings.

*Tiles.*  Two words differ by exactly one inserted, deleted or replaced code point
if their common prefix and common suffix together reach the longer length minus
one.  Let ``m`` be the shorter length: then the prefix or the suffix alone reaches
``m // 2``.  So a word lies in four groups: for the bands ``m = length`` and ``m =
length - 1``, by its first and by its last ``m // 2`` code points.  Rows arrive
sorted by group; many groups at a time become one padded matrix of code points,
and the pairs inside groups are compared as blocks of that matrix: the first
unequal column from the left and, with the words flush right, from the right.  A
pair that both groups hold counts in the prefix group.  A group of more than
``BLOCK`` words is dealt into blocks by hash and its block pairs are tiles of their
own, so one hot affix is the work of many tasks and a task holds two blocks.

Tiles give out one row a word (how many near words, the most frequent of them),
never pairs; these rows are added up by word.

*Roots.*  A word's form has at least ``RATIO`` times its count, so forms can't go
round; they are followed by pointer doubling.

Nulls (text, id), empty texts and texts without letters give no words; a null id
is an empty text in the hash.  Very long texts are whole; repeated rows count
again; ties go to the smaller word in code-point order.  An empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import shared_dir, stored

# The letters of a run and the planted misspellings.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE = 199

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
BLOCK = 512
PAIRS = 1 << 18             # pairs compared at a time


def damaged_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word)``, one row an occurrence: the runs in lower case; where the crc32 of
    ``<id>:<run>`` is divisible by ``DAMAGE``, without the code point that it names."""
    runs = docs.where(F.col(text_col).isNotNull()) \
        .select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                F.explode(F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(RUN), 0)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select("run", h.alias("h")).select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame) -> DataFrame:
    """``(word, n)``: long enough and frequent enough."""
    return words.where(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") >= LEAST_COUNT)


def tiles(words: DataFrame) -> DataFrame:
    """``(tile, m, side, mine, other, word, n)``: each word in the tiles of its four
    groups; ``mine`` is its block, ``other`` the block that it is compared with."""
    size = F.length("word")
    band = F.explode(F.array(size, size - 1)).alias("m")
    x = words.select("word", "n", band).withColumn("side", F.explode(F.array(F.lit("p"), F.lit("s"))))
    half = F.floor(F.col("m") / 2).cast("int")
    affix = F.when(F.col("side") == "p", F.substring("word", F.lit(1), half)) \
        .otherwise(F.substring("word", F.length("word") - half + 1, half))
    x = x.select("word", "n", "m", "side", affix.alias("affix"))
    group = ["m", "side", "affix"]
    sizes = x.groupBy(*group).agg(F.count(F.lit(1)).alias("size"), F.min(F.length("word")).alias("least"))
    # a group of words that all have the longer length has no pair in this band
    sizes = sizes.where((F.col("size") > 1) & (F.col("least") == F.col("m"))) \
        .select(*group, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    x = x.join(sizes, group).withColumn("mine", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return x.select(F.xxhash64(*group, F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
                    *group, "mine", "other", "word", "n")


FOUND = "word string, n_near long, best_n long, best string"


def _matrix(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Words as rows of code points, flush left or right, padded with zeros."""
    out = np.zeros((len(sizes), width), np.uint16)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(points)) - np.repeat(starts, sizes)
    out[row, at + np.repeat(width - sizes, sizes) if right else at] = points
    return out


def single_edit(left: np.ndarray, flush: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray,
                half: np.ndarray, suffix_side: np.ndarray) -> np.ndarray:
    """Which pairs ``(a, b)`` of matrix rows differ by one edit; pairs of a suffix
    group whose prefix reaches ``half`` too belong to the prefix group."""
    longer = np.maximum(sizes[a], sizes[b])
    unlike = left[a] != left[b]
    prefix = np.where(unlike.any(axis=1), unlike.argmax(axis=1), longer)
    prefix = np.minimum(prefix, np.minimum(sizes[a], sizes[b]))
    unlike = flush[a] != flush[b]
    suffix = np.where(unlike.any(axis=1), unlike[:, ::-1].argmax(axis=1), longer)
    near = prefix + np.minimum(suffix, np.minimum(sizes[a], sizes[b])) >= longer - 1
    return near & ~(suffix_side & (prefix >= half))


def _pairs(start: np.ndarray, end: np.ndarray):
    """Pairs i < j inside runs ``[start[i], end[i])`` of equal groups, in slices of
    about ``PAIRS``; ``end`` is given for every row."""
    n = end - np.arange(len(end)) - 1
    total = np.concatenate([[0], np.cumsum(n)])
    row = 0
    while row < len(n):
        last = max(row + 1, int(np.searchsorted(total, total[row] + PAIRS, "right")) - 1)
        k = n[row:last]
        a = np.repeat(np.arange(row, last), k)
        yield a, a + 1 + np.arange(len(a)) - np.repeat(total[row:last] - total[row], k)
        row = last


def _compare(table: pa.Table) -> pa.RecordBatch | None:
    """Near words of whole groups: ``(word, n_near, best_n, best)``."""
    words = table.column("word").to_pylist()
    encoded = "".join(words).encode("utf-16-le")
    points = np.frombuffer(encoded, np.uint16)          # letters of a run are below U+0100
    sizes = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    width = int(sizes.max())
    left, flush = (_matrix(points, starts, sizes, width, right) for right in (False, True))
    m, mine, other = (table.column(c).to_numpy() for c in ("m", "mine", "other"))
    counts = table.column("n").to_numpy()
    suffix = np.array(table.column("side").to_pylist()) == "s"
    tile = table.column("tile").to_numpy()
    affix = np.array(table.column("affix").to_pylist(), object)
    fresh = np.ones(len(words), bool)
    fresh[1:] = (tile[1:] != tile[:-1]) | (m[1:] != m[:-1]) | (suffix[1:] != suffix[:-1]) | (affix[1:] != affix[:-1])
    first = np.flatnonzero(fresh)
    ends = np.repeat(np.append(first[1:], len(words)), np.diff(np.append(first, len(words))))
    out_a, out_b = [], []
    for a, b in _pairs(first, ends):
        # a block pair is compared across its blocks only; two words of the longer length belong to the next band
        fine = (mine[a] == other[b]) & ((sizes[a] == m[a]) | (sizes[b] == m[a]))
        a, b = a[fine], b[fine]
        near = single_edit(left, flush, sizes, a, b, m[a] // 2, suffix[a])
        out_a += [a[near], b[near]]
        out_b += [b[near], a[near]]
    of, to = (np.concatenate(x) if x else np.zeros(0, int) for x in (out_a, out_b))
    if not len(of):
        return None
    order = sorted(range(len(of)), key=lambda i: (of[i], -counts[to[i]], words[to[i]]))
    of, to = of[order], to[order]
    head = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
    return pa.RecordBatch.from_arrays(
        [pa.array([words[i] for i in of[head]]), pa.array(np.diff(np.append(head, len(of))).astype(np.int64)),
         pa.array(counts[to[head]]), pa.array([words[i] for i in to[head]])], ["word", "n_near", "best_n", "best"])


def _compare_sorted(batches):
    """Whole groups of each sorted partition; the last group waits for the next batch."""
    held: list = []
    for batch in batches:
        if not batch.num_rows:
            continue
        tile = batch.column("tile").to_numpy()
        if held and tile[0] != held[-1].column("tile")[-1].as_py():
            yield from filter(None, [_compare(pa.Table.from_batches(held))])
            held = []
        others = np.flatnonzero(tile != tile[-1])
        cut = int(others[-1]) + 1 if len(others) else 0
        if cut:
            yield from filter(None, [_compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield from filter(None, [_compare(pa.Table.from_batches(held))])


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, form, form_n)`` of the words that have a near word; the form
    is the most frequent one."""
    dealt = tiles(words)
    dealt = dealt.repartition("tile").sortWithinPartitions("tile", "m", "side", "affix")
    found = dealt.mapInArrow(_compare_sorted, FOUND)
    best = F.min_by(F.struct("best", "best_n"), F.struct(-F.col("best_n"), F.col("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")) \
        .select("word", "n_near", F.col("b.best").alias("form"), F.col("b.best_n").alias("form_n"))


def roots(forms: DataFrame, folder: str) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``: each step doubles the distance
    that a pointer goes, so there are as many as the logarithm of the longest chain."""
    now = stored(forms.select("word", F.col("form").alias("root")), folder, "roots-0")
    step = 0
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(onward, "root", "left_semi").isEmpty():
            return now
        step += 1
        now = stored(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                     folder, f"roots-{step}")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word."""
    folder = shared_dir(docs.sparkSession)
    words = stored(vocabulary(damaged_runs(docs, id_col, text_col)), folder, "words")
    x = words.join(near_words(words), "word", "left")
    is_form = F.col("form_n") >= RATIO * F.col("n")
    x = x.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                 F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"))
    x = stored(x, folder, "forms")
    x = x.join(roots(x.where("form is not null"), folder), "word", "left")
    return x.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
