import random

from pyspark.sql import functions as F

from corpus_texts import prose
from quarry.llm import toxicity
from quarry.llm.langid import kept_out

PLAIN = toxicity.Grammar(())


def weight(text, grammar=PLAIN):
    return grammar.features(text)[0]


def test_clauses_are_scored_by_their_pattern():
    assert weight("The weather is fine.") == 0
    assert weight("You are an idiot.") > weight("What an idiot.") > 0
    assert weight("You are not an idiot.") < weight("You are an idiot.")
    assert weight("She said you are an idiot.") < weight("You are an idiot.")
    assert weight("Not far from here, in the end, they saw an idiot.") == weight("Far from here, in the end, they saw an idiot.")
    assert weight("I will kill you.") > weight("I will kill time.") > 0
    assert weight("idiotic") == weight("xidiot") == 0           # whole words
    assert weight("You idiot. You idiot.") == 2 * weight("You idiot.")


def test_composition_covers_every_state():
    table = toxicity.compose(toxicity._insult, toxicity._threat, toxicity._target, toxicity._negation, toxicity._report)
    states = {s for s, _ in table}
    assert all((s, kind) in table for s in states for kind in toxicity.CLASSES)
    assert {after for after, _ in table.values()} <= states


def test_beginnings_and_words():
    own = toxicity.Grammar((("grump", 2.0, False), ("zonk", 3.0, True)))
    assert weight("a grumpface here", own) == 2.0 and weight("a zonk here", own) == 3.0
    assert weight("a zonked one, agrump", own) == 0


def labelled():
    r = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        bad = i % 6 == 0
        words = prose(i, 60).split(" ")
        for _ in range(3 if bad else 0):
            words[r.randrange(60)] = r.choice(["blorto" + r.choice("abcdefgh"), "snark"])
        docs.append((i, " ".join(words), "en", "s"))
        if i % 5:
            labels.append((i, 1, int(bad)))
    return docs, labels


def test_learns_words_and_beginnings(spark, docs):
    rows, labels = labelled()
    rows += [(9000, None), (9001, ""), (9002, "word " * 50_000 + "snark snark"), (None, "snark you snark"), (9003, "snark"), (9003, "snark")]
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    table = docs(rows)
    model = toxicity.learn(table, marks, ~kept_out(folds=5, fold=0))
    found = {e[0] for e in model[0]}
    assert "snark" in found and any(e.startswith("blorto"[:len(e)]) for e in found)
    out = toxicity.score(table.select("doc_id", kept_out(folds=5, fold=0).alias("held_out"), "text"), model).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    right = [(r["score"] >= 0.5) == (r["doc_id"] % 6 == 0) for r in out if r["held_out"] and r["doc_id"] < 600]
    assert len(right) > 60 and sum(right) / len(right) > 0.97
    assert all(r["score"] < 0.5 for r in out if r["doc_id"] in (9000, 9001))
    assert len({r["score"] for r in out if r["doc_id"] == 9003}) == 1


def test_without_labels(spark, docs):
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs([(1, "You are an idiot and scum, you moron")]), marks, F.lit(True))
    assert model[0] == ()
    out = toxicity.score(docs([(1, "You are an idiot and scum, you moron"), (2, "fine")]).select("doc_id", "text"), model)
    scores = {r["doc_id"]: r["score"] for r in out.collect()}
    assert scores[1] > 0.5 > scores[2]
    assert toxicity.score(docs([]).select("doc_id", "text"), model).count() == 0
