"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text knows every substring of
it.  A text is parsed against it greedily: each phrase is the longest match
that goes on from where the last one ended (a letter the language never showed
is a phrase of its own).  The language whose automaton needs the fewest
phrases per letter wins; ties go to the smaller name.

*Learning.*  The automata hold a bounded sample: of the labelled rows, by a
hash of the text, ``ROWS`` a language, cut off at ``SYMBOLS`` letters a language
(``TOTAL`` for all together).  Only this sample passes the driver; each worker
builds the automata from it once.

*Parsing.*  Texts are lowered; runs of what is no letter are one space.  Every
whole text is parsed in pieces of ``PIECE`` symbols, all pieces of a batch and
all languages in step, as array operations.  A cut between pieces ends a
phrase.

Null text, empty text and text without letters: ``und``, score 0.  The score is
``1 - phrases of the winner / phrases of the next`` (with one language:
``1 - phrases / letters``).  With nothing to learn from, everything is ``und``.
Repeated rows get equal answers; other columns pass through.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm._shared import kept, slices

SYMBOLS = 40_000
TOTAL = 400_000
ROWS = 400
PIECE = 1024
GROUP = 1_000_000           # characters parsed together
UNKNOWN = "und"


def sample_texts(docs: DataFrame, text: Column, lang: Column) -> tuple[tuple[str, str], ...]:
    """The bounded sample: (language, text), short texts first so that many
    documents have a part in it."""
    short = SYMBOLS // 16
    rows = docs.select(text.alias("text"), lang.cast("string").alias("lang"),
                       (F.length(text) > short).alias("long"), F.xxhash64(text).alias("turn")) \
        .where("lang is not null and text is not null")
    # which rows: ranked without their texts, ROWS a language
    place = Window.partitionBy("lang").orderBy("long", "turn")
    chosen = rows.select("lang", "long", "turn").distinct() \
        .withColumn("place", F.row_number().over(place)).where(F.col("place") <= ROWS).select("lang", "turn", "place")
    texts = rows.select("lang", "turn", F.substring("text", 1, SYMBOLS).alias("text")) \
        .join(F.broadcast(chosen), ["lang", "turn"]).dropDuplicates(["lang", "place"])
    # what goes to the driver is cut to the sample's size first
    before = Window.partitionBy("lang").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    texts = texts.withColumn("before", F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))) \
        .where(F.col("before") < SYMBOLS)
    found = sorted((r["lang"], r["place"], r["text"]) for r in texts.select("lang", "place", "text").collect())
    langs = sorted({f[0] for f in found})
    room = min(SYMBOLS, TOTAL // max(1, len(langs)))
    return tuple((lang, " ".join(t for one, _, t in found if one == lang)[:room]) for lang in langs)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions (states x ``width``, 0: none; state 0 is the start) of the
    smallest automaton that accepts all suffixes of ``symbols``."""
    length, link, step = [0], [-1], [{}]
    last = 0
    for s in symbols:
        now = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        at = last
        while at >= 0 and s not in step[at]:
            step[at][s] = now
            at = link[at]
        if at >= 0:
            to = step[at][s]
            if length[to] == length[at] + 1:
                link[now] = to
            else:                       # a state that ends shorter substrings splits off
                part = len(length)
                length.append(length[at] + 1)
                link.append(link[to])
                step.append(dict(step[to]))
                link[to] = link[now] = part
                while at >= 0 and step[at].get(s) == to:
                    step[at][s] = part
                    at = link[at]
        last = now
    table = np.zeros((len(step), width), np.int32)
    for state, ways in enumerate(step):
        for s, to in ways.items():
            table[state, s] = to
    return table


class Parser:
    """The automata of all languages in one table, and the symbols they share:
    0 what is no letter, 1 a letter that no sample has, 2 and up the letters."""

    def __init__(self, samples: tuple[tuple[str, str], ...]):
        self.langs = [lang for lang, _ in samples]
        letters = _letters()
        known = sorted({c for _, text in samples for c in text.lower() if letters[ord(c)]})
        self.symbol = letters.astype(np.int16)
        self.symbol[[ord(c) for c in known]] = np.arange(2, 2 + len(known))
        self.width = len(known) + 2
        tables, self.roots, base = [], [], 0
        for _, text in samples:
            flat, _ = self.symbols([text])
            table = suffix_automaton(flat.tolist(), self.width)
            table[table > 0] += base
            tables.append(table)
            self.roots.append(base)
            base += len(table)
        # row 0 of the first language is never a target, so 0 stays "none"
        self.table = np.empty(base * self.width, np.int32)
        at = 0
        while tables:                   # each goes once it is copied
            table = tables.pop(0).ravel()
            self.table[at:at + len(table)] = table
            at += len(table)

    def symbols(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(symbols of all texts, pointers)."""
        low = [t.lower() for t in texts]
        ends = np.cumsum([len(t) for t in low])
        flat = self.symbol[np.frombuffer("".join(low).encode("utf-32-le"), np.uint32)]
        heads = np.concatenate([[0], ends[:-1]])
        blank = flat == 0
        again = np.zeros(len(flat), bool)
        again[1:] = blank[1:] & blank[:-1]
        again[heads[heads < len(flat)]] = False
        kept = np.concatenate([[0], np.cumsum(~again)])
        return flat[~again], kept[np.concatenate([[0], ends])]

    def phrases(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        starts, owner, sizes = [], [], []
        for r in range(len(at) - 1):
            s = np.arange(at[r], at[r + 1], PIECE)
            starts.append(s)
            owner.append(np.full(len(s), r))
            sizes.append(np.minimum(PIECE, at[r + 1] - s))
        starts, owner, sizes = map(np.concatenate, (starts, owner, sizes))
        order = np.argsort(-sizes, kind="stable")
        starts, owner, sizes = starts[order], owner[order], sizes[order]
        roots = np.array(self.roots, np.int64)[:, None]
        state = np.repeat(roots, len(starts), axis=1)
        count = np.zeros(state.shape, np.int32)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes.max(initial=0))), "left")
        for t, n in enumerate(alive):
            s = flat[starts[:n] + t].astype(np.int64)
            now = state[:, :n]
            to = self.table[now * self.width + s]
            fresh = self.table[roots * self.width + s]
            miss = to == 0
            count[:, :n] += miss & (now != roots)       # the phrase ends before this symbol
            count[:, :n] += miss & (fresh == 0)         # and this symbol is one by itself
            state[:, :n] = np.where(miss, np.where(fresh == 0, roots, fresh), to)
        count += state != roots
        out = np.zeros((len(at) - 1, len(self.roots)), np.int64)
        np.add.at(out, owner, count.T)
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        flat, at = self.symbols(texts)
        has = np.concatenate([[0], np.cumsum(flat > 0)])
        letters = has[at[1:]] - has[at[:-1]]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.langs:
            return names, scores
        counts = self.phrases(flat, at)
        best = counts.argmin(axis=1)
        ranked = np.sort(counts, axis=1)
        other = ranked[:, 1] if len(self.langs) > 1 else at[1:] - at[:-1]
        for r in np.flatnonzero(letters):
            names[r] = self.langs[best[r]]
            scores[r] = float(min(1.0, max(0.0, 1 - ranked[r, 0] / max(1, other[r]))))
        return names, scores


def parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    """The parser of this worker process.  That of other samples goes before a new
    one is built, so a worker never holds two, and the tasks of other operators let it go."""
    return kept(("parser", samples), lambda: Parser(samples))


def _identified(samples, text_at: int, names: tuple[str, str]):
    def run(batches):
        own = parser(samples)
        for batch in slices(batches, text_at, keeps=True):
            texts = [t or "" for t in batch.column(text_at).to_pylist()]
            langs, scores, at, size = [], [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= GROUP or i == len(texts) - 1:
                    found = own.predict(texts[at:i + 1])
                    langs += found[0]
                    scores += found[1]
                    at, size = i + 1, 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             [*batch.schema.names, *names])
    return run


def identify(docs: DataFrame, samples: tuple[tuple[str, str], ...], text_col: str = "text",
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score."""
    kinds = T.StructType([*docs.schema.fields, T.StructField(names[0], T.StringType()),
                          T.StructField(names[1], T.DoubleType())])
    return docs.mapInArrow(_identified(samples, docs.columns.index(text_col), names), kinds)


def kept_out(doc_id: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text, modulo ``folds``."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))
