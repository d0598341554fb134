"""Vectorised word and shingle hashes over Arrow text columns.

Words are maximal runs of bytes other than space and 0x09-0x0D (the pattern
``[^\\x20\\x09-\\x0D]+``, which is the same on UTF-8 bytes and on characters);
A-Z are lowered, nothing else changes.  A word's hash is a polynomial in
2**64 of its bytes (each byte first mapped to a random 64-bit value), read off
prefix sums, so no Python code runs per word.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from quarry.llm._shared import text_bytes

SEGMENT = 1 << 18          # bytes hashed at a time: the working arrays stay in the cache
SHINGLE = 5                # words per shingle
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = int(_RNG.integers(1, 2**62)) * 4 + 1
_STEP = np.uint64(int(_RNG.integers(1, 2**62)) * 4 + 1)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_BYTE[SPACE] = 0           # so a word may be summed with the white space after it


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    def run(base: int) -> np.ndarray:
        out = np.full(n + 1, np.uint64(base % 2**64))
        out[0] = 1
        return np.multiply.accumulate(out)
    return run(_BASE), run(pow(_BASE, -1, 2**64))


VARIES = np.zeros(256, bool)    # bytes that mark a word as a variable field
VARIES[48:58] = True
VARIES[64] = True
FIELD = np.uint64(0x9E3779B97F4A7C15)


def _segment_hashes(data: np.ndarray, heads: np.ndarray, fields: bool):
    """Start positions and hashes of the words of ``data``; ``heads`` are the
    positions where a new text begins (a word never runs over one).  With
    ``fields``, also how many line feeds stand before each word, and the words
    with a digit or an @."""
    none = np.zeros(0, np.int64)
    solid = ~SPACE[data]
    after = np.ones(len(data), bool)    # a word can begin here
    np.logical_not(solid[:-1], out=after[1:])
    after[heads[heads < len(data)]] = True
    starts = np.flatnonzero(solid & after)
    if not len(starts):
        return none, np.zeros(0, np.uint64), none, none
    power, inverse = _powers(max(SEGMENT, len(data)))
    values = _BYTE[data]
    values *= power[:len(data)]
    hashes = mix(np.add.reduceat(values, starts) * inverse[starts])
    if not fields:
        return starts, hashes, none, none
    feeds = np.searchsorted(starts, np.flatnonzero(data == 10))
    feeds = np.cumsum(np.bincount(feeds, minlength=len(starts) + 1))[:len(starts)]
    return starts, hashes, feeds, np.unique(np.searchsorted(starts, np.flatnonzero(VARIES[data]), "right") - 1)


def word_hashes(column: pa.Array, fields: bool = False):
    """(hashes of all words in row order, row pointers) of a text column; with
    ``fields`` words with a digit or an @ all get one hash, and the line number
    of each word in its row is added."""
    if not fields:
        return _hashed(column, False)[:2]
    _, *found = line_words(column)
    return tuple(found)


def line_words(column: pa.Array):
    """(hashes of all words, the same with those of words with a digit or an @ made
    one, row pointers, line numbers), parsed once."""
    plain, pointers, lines, varies = _hashed(column, True)
    words = plain.copy()
    words[varies] = FIELD
    return plain, words, pointers, lines


def _hashed(column: pa.Array, fields: bool):
    """(hashes, row pointers, line numbers, places of the words with a digit or an @)
    of all words; the last two only with ``fields``."""
    data, offsets = text_bytes(column)
    rows = len(column)
    parts, lines, counts = [], [], np.zeros(rows, np.int64)
    varied, done, row = [np.zeros(0, np.int64)], 0, 0
    while row < rows:
        last = int(np.searchsorted(offsets, offsets[row] + SEGMENT, "right")) - 1
        if last > row:                  # several whole texts
            lo, hi = offsets[row], offsets[last]
            piece = data[lo:hi]
            heads = offsets[row:last + 1] - lo
            starts, hashes, feeds, varies = _segment_hashes(piece, heads[:-1], fields)
            own = np.diff(np.searchsorted(starts, heads))
            counts[row:last] = own
            parts.append(hashes)
            varied.append(varies + done)
            done += len(hashes)
            if fields:
                lines.append(feeds - np.repeat(np.searchsorted(np.flatnonzero(piece == 10), heads[:-1]), own))
            row = last
            continue
        at, end = int(offsets[row]), int(offsets[row + 1])   # one long text, in pieces
        before = 0
        while at < end:
            cut = min(at + SEGMENT, end)
            while cut < end and not SPACE[data[cut]]:        # only between words
                gap = np.flatnonzero(SPACE[data[cut:min(cut + SEGMENT, end)]])
                cut = cut + int(gap[0]) if len(gap) else min(cut + SEGMENT, end)
            _, hashes, feeds, varies = _segment_hashes(data[at:cut], np.zeros(0, np.int64), fields)
            counts[row] += len(hashes)
            parts.append(hashes)
            varied.append(varies + done)
            done += len(hashes)
            if fields:
                lines.append(feeds + before)
                before += int((data[at:cut] == 10).sum())
            at = cut
        row += 1
    pointers = np.concatenate([[0], np.cumsum(counts)])
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return words, pointers, np.concatenate(lines) if lines else np.zeros(0, np.int64), np.concatenate(varied)


def shingle_run(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hash of the ``width`` words from each place on (regardless of rows)."""
    run = np.zeros(max(len(words) - width + 1, 0), np.uint64)
    for k in range(width):
        run = run * _STEP + words[k:k + len(run)]
    return mix(run)


def shingle_sets(column: pa.Array, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row as (values int64, pointers).
    With fewer than ``width`` words the whole sequence is the one shingle; with
    no words the set is empty."""
    words, pointers = word_hashes(column)
    rows = len(column)
    run = shingle_run(words, width).view(np.int64)
    sets = []
    for r in range(rows):
        a, b = int(pointers[r]), int(pointers[r + 1])
        if b - a >= width:
            sets.append(np.unique(run[a:b - width + 1]))
        elif b > a:
            acc = np.zeros(1, np.uint64)
            for w in words[a:b]:
                acc = acc * _STEP + w
            sets.append((mix(acc) ^ np.uint64(b - a)).view(np.int64))
        else:
            sets.append(np.zeros(0, np.int64))
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.zeros(0, np.int64)), \
        np.concatenate([[0], np.cumsum(sizes)])
