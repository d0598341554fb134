import re

import pytest

import corpus_pipeline
import __spark_entry__
from corpus_texts import edited, prose
from quarry.llm import langid, queries


def corpus():
    rows = [(i, prose(i, 60 + i % 50), "en", f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, edited(rows[0][1], i, 1), "en", "s1") for i in range(5)] + [(110, rows[1][1], "en", "s2")]
    rows += [(120, None, "en", "s0"), (121, "", None, "s0"), (122, "123 !!", "en", None), (None, prose(77, 50), "en", None),
             (3, rows[3][1], "en", "s3"), (130, "The boiler line of it all is here\n" + prose(5000, 160), "en", "s0"),
             (131, "The boiler line of it all is here\n" + prose(5001, 160), "en", "s0"),
             (132, "The boiler line of it all is here\n" + prose(5002, 160), "en", "s0"),
             (133, "The boiler line of it all is here", "en", "s0")]
    return rows


def test_stages(spark, docs):
    table = docs(corpus())
    columns = table.columns
    kept = corpus_pipeline.identify_language(spark, table, "")
    assert kept.columns == columns
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None)
    assert ids == sorted(r[0] for r in corpus() if r[0] is not None and r[0] not in (120, 121, 122))
    lines = corpus_pipeline.dedup_lines(spark, kept, "")
    assert lines.columns == columns and lines.dtypes == table.dtypes
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    assert 133 not in texts and texts[130] == (prose(5000, 160), len(prose(5000, 160)))
    assert texts[10] == (corpus()[10][1], len(corpus()[10][1]))
    one = corpus_pipeline.drop_near_copies(spark, lines, "")
    left = sorted(r["doc_id"] for r in one.select("doc_id").collect() if r["doc_id"] is not None)
    assert one.columns == columns and left == sorted([*range(60), 130, 131, 132])
    mixed = corpus_pipeline.mix(spark, one, "")
    assert mixed.columns == columns
    times = {}
    for r in mixed.select("doc_id").collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= {*left, None} and max(times.values()) <= 3
    last = corpus_pipeline.tokenize(spark, mixed, "")
    assert last.columns == ["doc_id", "n_tokens", "ids"]
    assert all(r["n_tokens"] == len(r["ids"]) for r in last.collect())


def test_run_and_empty_table(spark, sf_dir, docs, tmp_path):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    docs([]).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"file://{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


def test_registration():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "line_dedup", "ngram_join", "mixing", "sentencepiece"]
    found = __spark_entry__.queries()
    ops = [q for q in found if re.fullmatch(r"op\d+_\w+", q)]
    assert sorted(int(q[2:].split("_")[0]) for q in ops) == list(range(1, 14)) and "pipeline" in found
    assert set(queries.ORACLE) <= set(queries.QUERIES)
    assert langid.UNKNOWN == "und"


@pytest.mark.parametrize("name, columns", [
    ("op1_fingerprints", "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next"),
    ("op3_toxicity", "doc_id held_out score predicted"), ("op4_language", "doc_id held_out lang_pred score"),
    ("op5_main_text", "page_id url text n_chars"), ("op6_nearest", "query_id rank vec_id score"),
    ("op7_line_dedup", "doc_id text n_lines n_dropped"),
    ("op8_mix_sources", "doc_id size source_size target taken"),
    ("op9_sentencepiece", "doc_id n_tokens ids_sha256 decoded_sha256"), ("op10_ngram_join", "doc_id n_shingles component_id"),
    ("op11_near_vectors", "vec_id n_links component_id kept"),
    ("op12_whitening", "vec_id component n deviation whitened explained identity_error"),
    ("op13_spelling_variants", "word form root n n_near form_n")])
def test_queries_return_their_columns(spark, sf_dir, name, columns):
    df = queries.QUERIES[name](spark, sf_dir)
    assert df.columns[:len(columns.split())] == columns.split()
    assert df.count() > 0
