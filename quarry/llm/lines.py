"""Line deduplication by a log-template tree.

Every line is parsed down a tree of fixed depth: its number of tokens, then its
first ``DEPTH`` tokens, then its template.  Variable fields are generalised in
two ways: a token with a digit or an @ is a field wherever it stands; and a line
of ``LONG`` tokens or more also belongs to the five templates in which one third
of the tokens after the leading ones, from each sixth on, is a field.  Lines that
differ only inside a run of up to a sixth of their tokens so have a template in
common wherever the run is.  All templates of a line are read off prefix sums
of its token hashes.

A template recurs when it stands in documents of at least ``MIN_DOCS`` different
contexts, or of two if it has ``SURE`` tokens or more, too many to recur by chance,
however many documents each context has.  Two texts have one context
unless their resemblance outside the line is surely under ``ALIKE``, by those of
the ``SKETCH`` smallest hashes of their five-word shingles that don't stand in
the line (by all of them where a text has under ``OUTSIDE`` others): the lines of
copies and near copies of one document are left for the operators that handle
whole copies.  Contexts are told
apart in rounds: the first text of a template, the first that differs from it,
the first that differs from both.  Lines of recurring templates are dropped
everywhere; lines under ``MIN_TOKENS`` tokens never are.

Passages need not be whole lines.  Every run of ``PASSAGE`` words or more that
two documents of different contexts have in common (the same words, letter case
and spacing aside) is cut out of its lines.  Of each run of ``PASSAGE`` words the
smallest hash of ``GRAM`` words is a key like a template's, so two such runs share
one.  Where a key recurs, all runs of ``PASSAGE`` words around it are counted the
same way, and the words of recurring ones go.  Writing without spaces has no words
to count.

Texts are parsed once: all their keys are dealt to buckets of keys, many to a row,
and those in two different texts are listed by text; a task holds one bucket, of a
full one a row a key.  Each round is a minimum per
template and a join, so the most common line is one row per task.  What to drop
depends on the text alone and is joined to the documents by a hash of the text.

Null text stays null, empty text empty.  Repeated rows are documents of one
context.  Other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm._shared import SLICE, list_array, shared_dir, slices, stored
from quarry.llm._words import _powers, line_words, mix, shingle_run, word_hashes

DEPTH = 3
LONG = 8
MIN_TOKENS = 3
MIN_DOCS = 3                # contexts, told apart in as many rounds less one
SURE = 20                   # tokens of a line for which two contexts do; its keys are odd
_FREE = ~np.uint64(3)       # bits of keys but the lowest: two contexts do; a passage's
SKETCH = 64                 # shingle hashes kept of a text, one bit of a mask each
OUTSIDE = 6
PASSAGE = 50
GRAM = 25
_BUCKET = np.uint64(53)     # of 2,048 buckets of keys a key's: the bits above
DEAL = 1 << 19              # rows that a task deals at a time
HOLD = 1 << 21              # rows of a bucket that a task holds
_PACKED, _FOUND = ["bucket", "keys", "marks", "masks", "sketch"], ["key", "mark", "mask", "sketch"]
FILTER = 1 << 24            # bits of the bitmap of texts (2 MB, broadcast)
ALIKE = 0.4
WAYS = 6                    # templates of a line
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPOT = np.uint64(0xD6E8FEB86659FD93)


def line_templates(column: pa.Array, masks: bool = True):
    """Templates of all lines: (row, line, keys (lines x WAYS), usable (lines x
    WAYS)) and which hashes of the row's sketch stand in the line (bits;
    none without ``masks``)."""
    words, at, line = word_hashes(column, fields=True)
    row, number, keys, usable, first, stop = _parsed(words, at, line)
    if not masks:
        return row, number, keys, usable, np.zeros(len(first), np.int64)
    return row, number, keys, usable, inside(*_sketch(words, at, small_run(words))[2:], first, stop)


def _parsed(words: np.ndarray, at: np.ndarray, line: np.ndarray):
    """Row, line, keys and usable as above, and the words from and to of each line."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    new = np.ones(len(words), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(words)))
    place = np.arange(len(words)) - np.repeat(first, count)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words + place.astype(np.uint64) * _SPOT), out=sums[1:])
    rest = count - np.minimum(DEPTH, count)
    cuts = [first + np.minimum(DEPTH, count) + rest * k // 6 for k in range(7)]
    third = [sums[cuts[k + 2]] - sums[cuts[k]] for k in range(5)]
    whole = sums[first + count] - sums[first]
    base = count.astype(np.uint64) * _SPOT
    keys = np.stack([mix(whole + base), *(mix(whole - t + base + np.uint64(k + 1)) for k, t in enumerate(third))], axis=1)
    keys = keys & _FREE | (count >= SURE).astype(np.uint64)[:, None]
    usable = np.repeat((count >= LONG)[:, None], WAYS, axis=1)
    usable[:, 0] = count >= MIN_TOKENS
    return owner[first], line[first], keys.view(np.int64), usable, first, first + count


def _sketch(words: np.ndarray, at: np.ndarray, run: np.ndarray):
    """(hashes, pointers, places, bits): the ``SKETCH`` smallest distinct hashes of each
    row's shingles ``run``, of under five words the one of all; where shingles of these
    hashes begin, and their bits."""
    size = np.maximum(np.diff(at) - 4, 0)
    some = np.minimum(2**31 / np.maximum(size, 1) * 2 * SKETCH, 2**31 - 1).astype(np.int32)    # about twice as many are below
    found = _smallest(run, at, some)
    few = np.bincount(found[0], minlength=len(size)) < SKETCH
    few &= (size > 0) & (some < 2**31 - 1)
    if few.any():                       # many shingles alike
        more = _smallest(run, at, np.where(few, 2**31 - 1, -1).astype(np.int32))
        keep = ~few[found[2]], ~few[found[0]]
        found = (found[0][keep[1]], found[1][keep[1]], found[2][keep[0]], found[3][keep[0]], found[4][keep[0]])
        found = [np.concatenate(x) for x in zip(found, more, strict=True)]
    short = np.flatnonzero((np.diff(at) > 0) & (size == 0))
    whole = [mix(words[at[r]:at[r + 1]].sum(dtype=np.uint64, keepdims=True))[0] >> np.uint64(33) for r in short.tolist()]
    row, value = np.append(found[0], short), np.append(found[1], np.array(whole, np.int32))
    order = np.lexsort((value, row))
    by_place = np.argsort(found[3])
    return value[order], np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]), found[3][by_place], found[4][by_place]


def _smallest(run: np.ndarray, at: np.ndarray, below: np.ndarray):
    """Of the hashes up to ``below`` of each row the ``SKETCH`` smallest distinct ones
    (row, hash), and all places of these (row, place, bit)."""
    place = np.flatnonzero(run <= np.repeat(below, np.diff(at))[:len(run)])
    row = np.searchsorted(at, place, "right") - 1
    own = place + 5 <= at[row + 1]      # not over the end of the row
    place, row = place[own], row[own]
    code = row << 31 | run[place]
    order = np.argsort(code, kind="stable")
    code, place, row = code[order], place[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = code[1:] != code[:-1]
    number = np.cumsum(new) - 1
    one = row[new]
    rank = number - np.searchsorted(one, one)[number]
    low = rank < SKETCH
    return row[new & low], run[place[new & low]], row[low], place[low], np.uint64(1) << rank[low].astype(np.uint64)


def sketches(words: np.ndarray, at: np.ndarray, run: np.ndarray) -> list[np.ndarray]:
    """The sketch of each row."""
    values, ends, _, _ = _sketch(words, at, run)
    return [values[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def small_run(words: np.ndarray) -> np.ndarray:
    """Shingle hashes of 31 bits."""
    return (shingle_run(words) >> np.uint64(33)).astype(np.int32)


def inside(place: np.ndarray, bit: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each run of words from ``start`` to before ``stop`` the bits (of ``bit``) of
    the hashes in its row's sketch that are of shingles inside, which begin at ``place``."""
    bit = np.append(bit, np.uint64(0))
    lo, hi = np.searchsorted(place, start), np.searchsorted(place, np.maximum(stop - 4, start))
    bits = np.bitwise_or.reduceat(bit, np.stack([lo, hi], axis=1).ravel())[::2] if len(lo) else np.zeros(0, np.uint64)
    return np.where(hi > lo, bits, np.uint64(0)).view(np.int64)


def _grams(words: np.ndarray, width: int) -> np.ndarray:
    """Key of the ``width`` words from each place on (regardless of rows)."""
    n = len(words)
    power, inverse = _powers(max(SLICE, n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words * power[:n], out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * inverse[:max(n - width + 1, 0)]) | ~_FREE


def _slide(x: np.ndarray, width: int, op) -> np.ndarray:
    """``op`` (minimum, maximum) over each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x, size = op(x[:-size], x[size:]), 2 * size
    return op(x[:len(x) - (width - size)], x[width - size:])


def _runs(at: np.ndarray) -> np.ndarray:
    """Of each place whether ``PASSAGE`` words of one row begin there."""
    size = np.diff(at)
    left = np.repeat(size, size) - (np.arange(at[-1]) - np.repeat(at[:-1], size))
    return (left >= PASSAGE)[:max(int(at[-1]) - PASSAGE + 1, 0)]


def _chosen(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys): of each ``PASSAGE`` words the smallest key of ``GRAM`` words."""
    if len(words) < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams, wide = _grams(words, GRAM), PASSAGE - GRAM + 1
    least = np.where(_runs(at), _slide(grams, wide, np.minimum), np.uint64(0))
    edge = np.zeros(wide - 1, np.uint64)
    place = np.flatnonzero(_slide(np.concatenate([edge, least, edge]), wide, np.maximum) == grams)
    return place, grams[place]


def _among(values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which values are among the keys (few, at least one)."""
    keys = np.sort(keys)
    return keys[np.minimum(np.searchsorted(keys, values), len(keys) - 1)] == values


def _once(rows, keys, mask) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, mask): each key once a row, with all its bits."""
    order = np.lexsort((keys, rows))
    keys, rows, mask = keys[order], rows[order], mask[order]
    one = np.ones(len(keys), bool)
    one[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return rows[one], keys[one], np.bitwise_or.reduceat(mask, np.flatnonzero(one)) if len(mask) else mask


def _binary(column: np.ndarray, at: np.ndarray) -> pa.Array:
    """The numbers between the pointers ``at`` as one binary value each."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(column)])


def _numbers(column: pa.Array) -> np.ndarray:
    """The numbers of all binary values, one after the other."""
    if not len(column):
        return np.zeros(0, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int32)
    lo, hi = int(at[column.offset]), int(at[column.offset + len(column)])
    return np.frombuffer(column.buffers()[2], np.int64, (hi - lo) // 8, lo) if hi > lo else np.zeros(0, np.int64)


def _dealt(parts):
    """(bucket, keys, marks, masks, sketches) of arrays (mark, key, mask) and sketches:
    the rows of each bucket of keys together, so few rows are shuffled."""
    def packed(held):
        mark, key, mask = (np.concatenate(x) for x in zip(*held, strict=True))
        bucket = key.view(np.uint64) >> _BUCKET
        order = np.argsort(bucket.astype(np.uint16), kind="stable")
        some, at = np.unique(bucket[order], return_index=True)
        at = np.append(at, len(key))
        return pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), *(_binary(x[order], at) for x in (key, mark, mask)), pa.nulls(len(some), pa.list_(pa.int32()))], _PACKED)

    held, size = [], 0
    for rows, marks, found in parts:
        if found is not None:
            none = pa.nulls(len(marks), pa.binary())
            bucket = (marks.view(np.uint64) >> _BUCKET).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bucket), none, _binary(marks, np.arange(len(marks) + 1)), none,
                                              list_array(*found, pa.int32())], _PACKED)
        held.append(rows)
        size += len(rows[0])
        if size >= DEAL:
            yield packed(held)
            held, size = [], 0
    if size:
        yield packed(held)


def _sketched(batches):
    """Templates, chosen keys of passages and sketches of (mark, text)."""
    def parts():
        for batch in slices(batches, 1):
            plain, words, at, line = line_words(batch.column(1))
            row, _, keys, usable, first, stop = _parsed(words, at, line)
            place, chosen = _chosen(plain, at)
            values, ends, spots, bits = _sketch(words, at, small_run(words))
            mask = inside(spots, bits, np.append(first, place), np.append(stop, place + GRAM))
            mask, own = mask[:len(first)], mask[len(first):]
            row, key, mask = _once(np.append(np.repeat(row, WAYS)[usable.ravel()], np.searchsorted(at, place, "right") - 1),
                                   np.append(keys[usable], chosen.view(np.int64)), np.append(np.repeat(mask, WAYS)[usable.ravel()], own))
            marks = batch.column(0).to_numpy()
            yield (marks[row], key, mask), marks, (values, ends)
    return _dealt(parts())


def _passages(batches):
    """All ``PASSAGE`` words around the places of the keys of (mark, text, keys)."""
    def parts():
        for batch in slices(batches, 1):
            plain, words, at, _ = line_words(batch.column(1))
            if len(words) < PASSAGE:
                continue
            grams, runs = _grams(plain, GRAM).view(np.int64), _runs(at)
            hit = np.zeros(len(grams), bool)
            for r, keys in enumerate(batch.column(2)):
                a, b = int(at[r]), max(int(at[r + 1]) - GRAM + 1, int(at[r]))
                hit[a:b] = _among(grams[a:b], keys.values.to_numpy())
            place = np.flatnonzero(_slide(hit, PASSAGE - GRAM + 1, np.logical_or) & runs)
            _, _, spots, bits = _sketch(words, at, small_run(words))
            row, key, mask = _once(np.searchsorted(at, place, "right") - 1, _grams(plain, PASSAGE)[place].view(np.int64),
                                   inside(spots, bits, place, place + PASSAGE))
            yield (batch.column(0).to_numpy()[row], key, mask), None, None
    return _dealt(parts())


def _settled(key, mark, mask, out, last: bool):
    """Of rows, some of which are ``out`` already: those to give out, of keys in two
    texts, and unless these are the ``last`` of their keys what is to be held of them,
    a row a key."""
    if last:                            # most keys stand in one row
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        order = order[np.append(same, False) | np.append(False, same)] if len(key) else order
        key, mark, mask, out = key[order], mark[order], mask[order], out[order]
    order = np.lexsort((~out, mark, key))
    key, mark, mask, out = key[order], mark[order], mask[order], out[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    one = new.copy()
    one[1:] |= mark[1:] != mark[:-1]
    key, mark, mask, out, new = key[one], mark[one], mask[one], out[one], new[one]
    size = np.diff(np.append(np.flatnonzero(new), len(key)))
    many = np.repeat(size > 1, size)
    give = many & ~out
    given = key[give], mark[give], mask[give]
    return given, None if last else (key[new], mark[new], mask[new], size > 1)


def _several(batches):
    """(key, mark, mask) of dealt rows, sorted by bucket, whose key stands in two texts,
    and (mark, sketch).  Holds one bucket between batches, of that a row a key once it
    has ``HOLD`` rows; a row may then come twice."""
    held = [np.zeros(0, np.int64) for _ in range(3)] + [np.zeros(0, bool)]
    seen, of = set(), None

    def rows(key, mark, mask):
        return pa.RecordBatch.from_arrays([*map(pa.array, (key, mark, mask)), pa.nulls(len(key), pa.list_(pa.int32()))], _FOUND)

    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.filter(pc.is_valid(batch.column(4)))
        if texts.num_rows:
            keep = []
            for bucket, mark in zip(texts.column(0).to_pylist(), _numbers(texts.column(2)).tolist()):
                if bucket != of:
                    seen, of = set(), bucket
                keep.append(mark not in seen)
                seen.add(mark)
            none = pa.nulls(sum(keep), pa.int64())
            yield pa.RecordBatch.from_arrays([none, pa.array(_numbers(texts.column(2))[keep]), none,
                                              texts.column(4).filter(pa.array(keep))], _FOUND)
        packed = batch.filter(pc.is_valid(batch.column(1)))
        now = [_numbers(packed.column(k)) for k in (1, 2, 3)]
        held = [np.concatenate(x) for x in zip(held, [*now, np.zeros(len(now[0]), bool)], strict=True)]
        done = held[0].view(np.uint64) >> _BUCKET != batch.column(0)[-1].as_py()
        if done.any():
            yield rows(*_settled(*(x[done] for x in held), last=True)[0])
            held = [x[~done] for x in held]
        if len(held[0]) > HOLD:
            given, held = _settled(*held, last=False)
            yield rows(*given)
    yield rows(*_settled(*held, last=True)[0])


def _padded(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of ``SKETCH`` hashes, the missing ones larger than all."""
    size = np.diff(at)
    out = np.full((len(size), SKETCH), 1 << 40, np.int64)
    out[np.arange(SKETCH) < size[:, None]] = values[at[0]:at[-1]]
    return out


def _under(values: np.ndarray, same: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of two sketches sorted together (``same``: as the one before, of
    the other sketch): whether the resemblance of the hashes that ``keep`` tells is
    surely under ``ALIKE``, and the smaller number kept.  ``values`` tells whose a hash is."""
    both = keep & same
    both[:, 1:] &= keep[:, :-1]
    low = np.cumsum(keep & ~both, axis=1, dtype=np.int16)
    least = np.minimum((keep & values).sum(axis=1), (keep & ~values).sum(axis=1))
    return (both & (low <= least[:, None])).sum(axis=1) < ALIKE * least - 0.5 * np.sqrt(least), least


def _outside(mask: np.ndarray) -> np.ndarray:
    """Which hashes of a sketch don't have their bit in each mask."""
    bits = np.unpackbits(np.ascontiguousarray(mask).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits == 0


def _apart(batches):
    """(key, mark, mask) of (mark, sketch, lead sketch, keys, masks, masks of the
    lead) where the two texts differ outside the line."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            mark, *lists = batch.slice(start, 512).columns
            (a, a_at), (b, b_at), (key, at), (mask, _), (lead, _) = (
                (c.flatten().to_numpy(), c.offsets.to_numpy() - c.offsets[0].as_py()) for c in lists)
            values = np.concatenate([_padded(a, a_at), _padded(b, b_at)], axis=1)
            order = np.argsort(values, axis=1, kind="stable")
            values = np.take_along_axis(values, order, axis=1)
            same = np.zeros(values.shape, bool)
            same[:, 1:] = values[:, 1:] == values[:, :-1]
            real = values < 1 << 40
            pair = np.repeat(np.arange(len(mark)), np.diff(at))
            keep = []
            for lo in range(0, len(key), 4096):
                own = pair[lo:lo + 4096]
                left = np.concatenate([_outside(mask[lo:lo + 4096]), _outside(lead[lo:lo + 4096])], axis=1)
                left = np.take_along_axis(left, order[own], axis=1) & real[own]
                under, least = _under(order[own] < SKETCH, same[own], left)
                few = np.flatnonzero(least < OUTSIDE)
                under[few] = _under(order[own[few]] < SKETCH, same[own[few]], real[own[few]])[0]
                keep.append(under)
            keep = np.concatenate([np.zeros(0, bool), *keep])
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(mark.to_numpy()[pair[keep]]), pa.array(mask[keep])],
                                             ["key", "mark", "mask"])


def _differing(rows: DataFrame, sketch: DataFrame) -> DataFrame:
    """The rows of (key, mark, mask) whose text has another context than the first
    text of the key.  Sketches are joined once a pair of texts."""
    first = rows.groupBy("key").agg(F.min("mark").alias("lead"), F.min_by("mask", "mark").alias("lead_mask"))
    one = F.col("keys")
    return rows.join(first, "key").where("mark <> lead") \
        .groupBy("lead", "mark").agg(F.collect_list(F.struct("key", "mask", "lead_mask")).alias("keys")) \
        .join(sketch, "mark").join(sketch.select(F.col("mark").alias("lead"), F.col("sketch").alias("lead_sketch")), "lead") \
        .select("mark", "sketch", "lead_sketch", one["key"].alias("key"), one["mask"].alias("mask"), one["lead_mask"].alias("lead_mask")) \
        .mapInArrow(_apart, "key long, mark long, mask long")


def _in_contexts(where: DataFrame, sketch: DataFrame, folder: str, name: str) -> DataFrame:
    """The keys of (key, mark, mask) that stand in ``MIN_DOCS`` contexts, odd ones
    in two."""
    odd, sure = F.col("key").bitwiseAND(F.lit(1)) == 1, None
    for n in range(1, MIN_DOCS):
        where = _differing(where, sketch)
        if n == 1:
            where = stored(where, folder, f"{name}_contexts")
            sure, where = where.where(odd).select("key"), where.where(~odd)
    return sure.union(where.select("key")).distinct()


def _covered(words: np.ndarray, drops: np.ndarray) -> np.ndarray:
    """Which words of one text stand in a passage of ``drops``."""
    step = np.zeros(len(words) + 1, np.int64)
    if len(words) >= PASSAGE:
        place = np.flatnonzero(_among(_grams(words, PASSAGE).view(np.int64), drops))
        step[place] += 1
        step[place + PASSAGE] -= 1
    return np.cumsum(step[:-1]) > 0


def _left(line: str, cover: list[bool], spans: list[tuple[int, int]]) -> str:
    """The line without its covered words and the white space after them (before
    them at the end of the line)."""
    out, done = [], 0
    for k, (start, _) in enumerate(spans):
        if cover[k] and not (k and cover[k - 1]):
            out.append(line[done:start])
        if not cover[k] and k and cover[k - 1]:
            done = start
    if cover[-1]:
        out[-1], done = out[-1].rstrip(" \t\v\f\r"), spans[-1][1]
    return "".join(out) + line[done:]


def _kept(lines: list[str], bad: set[int], cover: np.ndarray, at: np.ndarray) -> tuple[list[str], int]:
    """The lines without the bad ones and the covered words (the words of line ``i``
    from ``at[i]`` on), and how many are dropped or shortened."""
    if not cover.any():
        return [one for i, one in enumerate(lines) if i not in bad], len(bad)
    sums = np.concatenate([[0], np.cumsum(cover)])
    out, gone = [], 0
    for i, (one, n, some) in enumerate(zip(lines, np.diff(at).tolist(), np.diff(sums[at]).tolist(), strict=True)):
        gone += i in bad or some > 0
        if i in bad or some and some == n:
            continue
        out.append(_left(one, cover[at[i]:at[i + 1]].tolist(), [x.span() for x in _WORD.finditer(one)]) if some else one)
    return out, gone


def _in_row(row: np.ndarray, keys: np.ndarray, owner: np.ndarray, drops: np.ndarray) -> np.ndarray:
    """Which keys of rows are among the drops of the same row."""
    names = np.unique(drops)
    if not len(names):
        return np.zeros(keys.shape, bool)
    spot = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return (names[spot] == keys) & np.isin(row[:, None] * len(names) + spot, owner * len(names) + np.searchsorted(names, drops))


def _dropped(text_at: int, drop_at: int, names: tuple[str, str]):
    """Texts without the lines of the templates, and the words of the passages, in
    the list column ``drop_at``."""
    def run(batches):
        for batch in slices(batches, text_at):
            text, drops = batch.column(text_at), batch.column(drop_at)
            size = pc.fill_null(pc.list_value_length(drops), 0).to_numpy()
            some = np.flatnonzero(size)         # only these need parsing
            part, drops = text.take(pa.array(some)), drops.flatten().to_numpy()
            owner = np.repeat(np.arange(len(some)), size[some])
            row, line, keys, usable, _ = line_templates(part, masks=False)
            hit = (_in_row(row, keys, owner, drops) & usable).any(axis=1)
            row, line = row[hit], line[hit]
            ends = np.searchsorted(row, np.arange(len(some) + 1))
            long = drops & 2 == 2               # passages
            which = np.unique(owner[long])
            words, _, at, number = line_words(part.take(pa.array(which)))
            pieces = dict(zip(which.tolist(), zip(at[:-1].tolist(), at[1:].tolist())))
            starts = np.concatenate([[0], np.cumsum(size[some])])
            total = np.where(pc.fill_null(pc.binary_length(text), 0).to_numpy() > 0,
                             pc.fill_null(pc.count_substring(text, "\n"), 0).to_numpy() + 1, 0)
            out, gone = part.to_pylist(), np.zeros(len(text), np.int64)
            for k, r in enumerate(some.tolist()):
                bad = set(line[ends[k]:ends[k + 1]].tolist())
                cover, first = np.zeros(0, bool), None
                if k in pieces:
                    a, b = pieces[k]
                    cover = _covered(words[a:b], drops[starts[k]:starts[k + 1]])
                    first = np.searchsorted(number[a:b], np.arange(total[r] + 1))
                if not out[k] or not bad and not cover.any():
                    continue
                left, gone[r] = _kept(out[k].split("\n"), bad, cover, first)
                out[k] = "\n".join(left)
            columns = [batch.column(i) for i in range(batch.num_columns) if i != drop_at]
            if len(some):
                mask = np.zeros(len(text), bool)
                mask[some] = True
                columns[text_at] = pc.replace_with_mask(text, pa.array(mask), pa.array(out, text.type))
            labels = [n for i, n in enumerate(batch.schema.names) if i != drop_at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
                                             [*labels, *names])
    return run


def _found(dealt: DataFrame, folder: str, name: str) -> DataFrame:
    """(key, mark, mask) and (mark, sketch) of dealt rows (``_several``)."""
    return stored(dealt.repartition("bucket").sortWithinPartitions("bucket")
                  .mapInArrow(_several, "key long, mark long, mask long, sketch array<int>"), folder, name)


def _recurring(found: DataFrame, sketch: DataFrame, folder: str, name: str) -> DataFrame:
    """(mark, key) of the keys of (key, mark, mask) in enough contexts."""
    where = found.where("key is not null").select("key", "mark", "mask")
    keys = stored(_in_contexts(where, sketch, folder, name), folder, f"{name}_keys")
    return where.select("mark", "key").join(keys, "key")


def _bit(mark):
    return F.pmod(mark, F.lit(FILTER)) + 1


def _filtered(rows: DataFrame, mark, hits: DataFrame) -> DataFrame:
    """``rows`` and whether the bit of their mark is set in the bitmap of the marks
    of ``hits`` (``_maybe``): most others then need no shuffle."""
    bitmap = hits.select(_bit(F.col("mark")).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("_bits"))
    place = F.bitmap_bit_position(_bit(mark))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.pow(F.lit(2), place % 8).cast("int")) > 0
    return rows.withColumn("_place", F.bitmap_bucket_number(_bit(mark))) \
        .join(F.broadcast(bitmap), F.col("_place") == F.col("_bucket"), "left") \
        .withColumn("_maybe", F.coalesce(is_set, F.lit(False))).drop("_place", "_bucket", "_bits")


def drop_recurring_lines(docs: DataFrame, text_col: str = "text",
                         names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the lines of recurring templates and recurring passages dropped
    from the text, and two more columns: lines before and lines dropped or shortened."""
    folder = shared_dir(docs.sparkSession)
    mark = F.xxhash64(F.col(text_col))
    texts = docs.select(mark.alias("mark"), F.col(text_col).alias("text"))
    kind = "bucket int, keys binary, marks binary, masks binary, sketch array<int>"
    both = _found(texts.mapInArrow(_sketched, kind), folder, "found")
    sketch = both.where("sketch is not null").select("mark", "sketch")
    found = stored(_recurring(both, sketch, folder, "found"), folder, "hits")
    passage = F.col("key").bitwiseAND(F.lit(2)) == 2
    around = found.where(passage).groupBy("mark").agg(F.collect_set("key").alias("keys"))
    near = _filtered(texts, F.col("mark"), found.where(passage)).where("_maybe").drop("_maybe")
    around = _found(near.join(around, "mark").mapInArrow(_passages, kind), folder, "around")
    passages = stored(_recurring(around, sketch, folder, "passages"), folder, "passage_hits")
    drop = "_drop"
    while drop in docs.columns:
        drop += "_"
    hits = found.where(~passage).select("mark", "key").union(passages.select("mark", "key"))
    rows = _filtered(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), mark.alias("mark")), F.col("mark"), hits)
    hits = hits.groupBy("mark").agg(F.collect_set("key").alias(drop))
    rows = rows.where("_maybe").join(hits, "mark", "left").select("doc.*", drop) \
        .union(rows.where("not _maybe").select("doc.*", F.lit(None).cast("array<long>").alias(drop)))
    kinds = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType())])
    return rows.mapInArrow(_dropped(docs.columns.index(text_col), len(docs.columns), names), kinds)
