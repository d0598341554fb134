"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause: *insult*, *threat*, *target*
(who is spoken to or about), *negation* and *reported speech*.  Each has a few
states and, for every word class, a next state and a factor; their product is
composed once, state by state, into one table (``compose``), so that a clause is
scored in a single run.  An insult or threat counts by its weight, more with a
target before it (and the target again when it follows), less under a negation
in the last three words, less after a reporting verb or inside a quotation that
follows one.  Words alone do not count: the sum goes over matched clauses.

*Learning.*  From a bounded sample of labelled rows (``LABELLED``, by a hash of
the id): words and word beginnings that stand in more toxic than other
documents become the insult transducer's weighted entries (log odds; a short
beginning replaces its longer forms where it is surer), and a logistic curve
turns a document's clause sums into a score.  Fixed word lists (below) feed the
other classes and, with a small weight, the insult class.  A beginning whose
evidence is mostly that of one longer form gives way to it.

Null and empty text: the score of a document without matches.  Repeated rows get
equal scores.  Without labels of both kinds the fixed lists and curve serve.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELLED = 20_000           # labelled rows to learn from, at most
ENTRIES = 4_000             # learnt entries at most
STEMS = (4, 5, 6, 7)        # lengths of word beginnings
MIN_DOCS, MIN_ODDS, MIN_Z = 4, 3.0, 4.0
SEED_WEIGHT, THREAT_WEIGHT = 1.0, 2.0

# Function words and verbs of the grammar's classes.
TARGETS = frozenset("""you your yours yourself u he him she her they them these those people
du dich dir dein deine ihr euch euer sie ihn tu te toi ton ta vous votre vos il elle ils elles
tú ti tus usted ustedes su sus él ella ellos ellas""".split())
NEGATIONS = frozenset("""not no never neither nor without isn't aren't wasn't don't doesn't didn't
nicht kein keine keinen nie niemals ohne ne pas jamais sans aucun aucune ni nunca jamás sin""".split())
REPORTS = frozenset("""said says say called calls wrote writes claimed claims quoted reported alleged
sagte sagt nannte schrieb behauptete dit disait appelle écrit prétend dijo dice llamó escribió""".split())
THREATS = ("kill", "hurt", "shoot", "stab", "strangle", "töten", "umbringen", "erschießen",
           "tuer", "frapper", "matar", "golpear")
INSULTS = ("idiot", "moron", "stupid", "imbecile", "scum", "dummkopf", "trottel", "abschaum",
           "imbécile", "crétin", "estúpido", "imbécil")

_WORD = re.compile(r"[\w'’]+|[\"“”„«»]|[,(]", re.UNICODE)
_END = re.compile(r"[.!?;\n]")
QUOTES = frozenset("\"“”„«»")
CLASSES = ("insult", "threat", "target", "negation", "report", "quote", "comma", "other")


def _insult(state, kind):
    """Counts every insult once."""
    return 0, (1.0 if kind == "insult" else 0.0)


def _threat(state, kind):
    """A threat counts when a target follows (in full) and by itself a little."""
    if kind == "threat":
        return 1, 0.25
    if kind == "target" and state:
        return 0, 1.0
    return state, 0.0


def _target(state, kind):
    """0: no target yet, 1: target, 2: an insult waits for its target."""
    if kind == "target":
        return 1, (1.25 if state == 2 else 1.0)
    if kind in ("insult", "threat"):
        return (1, 1.5) if state == 1 else (2, 1.0)
    return state, 1.0


def _negation(state, kind):
    """Covers the three words after a negation, not past a comma."""
    if kind == "negation":
        return 3, 1.0
    factor = 0.4 if state else 1.0
    return (0 if kind == "comma" else max(0, state - (kind != "quote"))), factor


def _report(state, kind):
    """1 after a reporting verb, 2 inside the quotation that follows."""
    if kind == "report":
        return 1, 1.0
    if kind == "quote":
        return (2 if state == 1 else 0), 1.0
    return state, (0.6 if state else 1.0)


def compose(*machines):
    """The product of transducers as {(state, class): (state, factors)} over the
    states that can be reached from all zeros."""
    table, todo = {}, [(0,) * len(machines)]
    seen = set(todo)
    while todo:
        state = todo.pop()
        for kind in CLASSES:
            moved = [m(s, kind) for m, s in zip(machines, state, strict=True)]
            after = tuple(s for s, _ in moved)
            table[state, kind] = (after, tuple(f for _, f in moved))
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return table


def _weights(table):
    """The composed table with one factor a step: (matches) x target x negation x report."""
    return {key: (after, (f[0], f[1], f[2] * f[3] * f[4])) for key, (after, f) in table.items()}


class Grammar:
    """The composed grammar with its entries: {beginning or word: (weight, whole word?)}."""

    def __init__(self, entries: tuple[tuple[str, float, bool], ...]):
        self.step = _weights(compose(_insult, _threat, _target, _negation, _report))
        self.find = ahocorasick.Automaton()
        kept: dict[str, list] = {}
        for text, weight, whole in entries:
            kept.setdefault(text, []).append(("insult", weight, whole))
        for text in INSULTS:
            kept.setdefault(text, []).append(("insult", SEED_WEIGHT, True))
        for text in THREATS:
            kept.setdefault(text, []).append(("threat", THREAT_WEIGHT, True))
        for text, ways in kept.items():
            self.find.add_word(text, (len(text), ways))
        self.find.make_automaton()

    def hits(self, text: str) -> dict[int, tuple[str, float]]:
        """Start of a word -> class and weight of its heaviest entry."""
        out: dict[int, tuple[str, float]] = {}
        for end, (size, ways) in self.find.iter(text):
            at = end - size + 1
            if at and (text[at - 1].isalnum() or text[at - 1] == "_"):
                continue
            closed = end + 1 == len(text) or not (text[end + 1].isalnum() or text[end + 1] == "_")
            for kind, weight, whole in ways:
                if (closed or not whole) and (at not in out or weight > out[at][1]):
                    out[at] = (kind, weight)
        return out

    def clause(self, text: str, hits: dict[int, tuple[str, float]], offset: int) -> float:
        """The weight of one clause that starts at ``offset`` of the document."""
        state, total, held = (0, 0, 0, 0, 0), 0.0, 0.0
        for m in _WORD.finditer(text):
            word = m.group()
            hit = hits.get(offset + m.start())
            if hit:
                kind = hit[0]
            elif word in TARGETS:
                kind = "target"
            elif word in NEGATIONS:
                kind = "negation"
            elif word in REPORTS:
                kind = "report"
            elif word in QUOTES:
                kind = "quote"
            else:
                kind = "comma" if word in ",(" else "other"
            state, (insult, threat, factor) = self.step[state, kind]
            if kind == "insult":
                total += insult * hit[1] * factor
            elif kind == "threat":
                held = hit[1]
                total += threat * held * factor
            elif kind == "target" and threat:
                total += threat * held * factor
        return total

    def features(self, text: str) -> tuple[float, float, float]:
        """Sum and largest of the clause weights, and matched clauses."""
        text = text.lower()
        hits = self.hits(text)
        if not hits:
            return 0.0, 0.0, 0.0
        sums, done = [], -1
        for at in sorted(hits):
            if at < done:
                continue
            head = max(text.rfind(c, 0, at) for c in ".!?;\n") + 1
            m = _END.search(text, at)
            done = m.start() if m else len(text)
            sums.append(self.clause(text[head:done], hits, head))
        sums = [s for s in sums if s > 0]
        return (sum(sums), max(sums), float(len(sums))) if sums else (0.0, 0.0, 0.0)


@lru_cache(maxsize=2)
def grammar(entries: tuple[tuple[str, float, bool], ...]) -> Grammar:
    """The grammar of this worker process."""
    return Grammar(entries)


def _shape(features: np.ndarray) -> np.ndarray:
    """What the curve reads: growth slows with the sums."""
    return np.log1p(features)


def _scored(entries, curve, text_at: int):
    def run(batches):
        own = grammar(entries)
        for batch in batches:
            found = np.array([own.features(t or "") for t in batch.column(text_at).to_pylist()], float).reshape(-1, 3)
            odds = curve[0] + _shape(found) @ np.array(curve[1:])
            score = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns) if i != text_at), pa.array(score)],
                [*(n for i, n in enumerate(batch.schema.names) if i != text_at), "score"])
    return run


def _counted(batches):
    """Per batch of (toxic, text): documents with each word or beginning, by label."""
    for batch in batches:
        counts: dict[tuple[str, bool], list[int]] = {}
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for w in re.findall(r"\w+", (text or "").lower()) if len(w) >= 3 and not w.isdigit()}
            for item in {(w, True) for w in words} | {(w[:k], False) for w in words for k in STEMS if len(w) >= k}:
                counts.setdefault(item, [0, 0])[label] += 1
        items = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([i[0] for i in items], pa.string()), pa.array([i[1] for i in items], pa.bool_()),
             pa.array([counts[i][0] for i in items], pa.int64()), pa.array([counts[i][1] for i in items], pa.int64())],
            ["item", "whole", "other", "toxic"])


def learn_entries(rows: DataFrame) -> tuple[tuple[str, float, bool], ...]:
    """Insult entries from ``rows(toxic, text)``, the bounded sample."""
    kinds = dict(rows.groupBy("toxic").count().collect())
    bad, good = kinds.get(1, 0), kinds.get(0, 0)
    if not bad or not good:
        return ()
    a, b = F.col("toxic"), F.col("other")
    odds = F.log((a + 0.5) / (bad - a + 0.5)) - F.log((b + 0.5) / (good - b + 0.5))
    table = rows.mapInArrow(_counted, "item string, whole boolean, other long, toxic long") \
        .groupBy("item", "whole").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic")) \
        .where(a >= MIN_DOCS).withColumn("odds", odds) \
        .where((F.col("odds") >= MIN_ODDS) & (F.col("odds") / F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= MIN_Z))
    best = table.orderBy(F.desc(F.col("odds") * F.sqrt("toxic")), "item", "whole").limit(ENTRIES).collect()
    stems = {r["item"]: r for r in best if not r["whole"]}
    longer: dict[str, list] = {}
    for r in best:
        for k in STEMS:
            if k < len(r["item"]) + r["whole"]:
                longer.setdefault(r["item"][:k], []).append(r)
    kept = []
    for r in best:
        shorter = [stems[r["item"][:k]] for k in STEMS if k < len(r["item"]) + r["whole"] and r["item"][:k] in stems]
        borrowed = not r["whole"] and any(
            e["odds"] >= r["odds"] - 1e-9 and e["toxic"] >= 0.7 * r["toxic"] for e in longer.get(r["item"], ()))
        if not borrowed and not any(s["odds"] > r["odds"] + 1e-9 for s in shorter):
            kept.append((r["item"], round(float(r["odds"]), 6), bool(r["whole"])))
    return tuple(sorted(kept))


def learn_curve(rows: DataFrame, entries) -> tuple[float, ...]:
    """Logistic curve over the clause sums of the bounded sample (Newton steps
    with a small ridge)."""
    def features(batches):
        own = grammar(entries)
        for batch in batches:
            found = np.array([own.features(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *(pa.array(found[:, k]) for k in range(3))],
                                             ["toxic", "f0", "f1", "f2"])
    seen = rows.mapInArrow(features, "toxic int, f0 double, f1 double, f2 double") \
        .orderBy("toxic", "f0", "f1", "f2").collect()
    y = np.array([r[0] for r in seen], float)
    if not 0 < y.sum() < len(y):
        return (-3.0, 2.0, 0.0, 0.0)
    x = np.hstack([np.ones((len(y), 1)), _shape(np.array([r[1:] for r in seen], float))])
    w = np.zeros(4)
    ridge = np.diag([1e-6, 0.05, 0.05, 0.05])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def learn(docs: DataFrame, labels: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> tuple[tuple, tuple[float, ...]]:
    """(entries, curve) from at most ``LABELLED`` labelled rows with ``train``."""
    marks = labels.where(train & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("int").alias("toxic")) \
        .orderBy(F.xxhash64("_id"), "_id", "toxic").limit(LABELLED)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text")) \
        .join(F.broadcast(marks), "_id").select("toxic", "text")
    entries = learn_entries(rows)
    return entries, learn_curve(rows, entries)


def score(docs: DataFrame, model: tuple[tuple, tuple[float, ...]], text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the ``score`` of every whole text."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != text_col)
    return docs.mapInArrow(_scored(*model, docs.columns.index(text_col)), f"{kinds}, score double")
