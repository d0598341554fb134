"""One registered query per corpus operator, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm._shared import known_to_workers
from quarry.llm import fingerprints, htmltext, langid, lines, mixing, nearvectors, ngramjoin, pieces, spelling, toxicity, vectors, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    @wraps(fn)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        known_to_workers(spark)
        return fn(spark, sf_dir)
    QUERIES[fn.__name__] = query
    return query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"))


@register
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_pages(spark, warc.write_pages(table(spark, sf_dir, "pages")))


# five bytes of the digest are one number, written as eight digits to the base 32
ORACLE["op2_warc"] = """
with pages0 as (
    select page_id, encode(coalesce(html, '')) as payload from pages),
hashed as (
    select page_id, octet_length(payload) as payload_bytes, sha1(payload) as hex from pages0),
coded as (
    select page_id, payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      1 + ((('0x' || substr(hex, 1 + 10 * (i // 8)::int, 10))::bigint
                            >> (35 - 5 * (i % 8))::int) & 31)::int, 1)), '') as payload_digest
    from hashed),
firsts as (select *, min(page_id) over (partition by payload_digest) as first from coded)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
       case when page_id > first then 'revisit' else 'response' end as record_type,
       case when page_id > first then first end as refers_to
from firsts
"""


@register
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = langid.kept_out(folds=5, fold=0)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@register
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    samples = langid.sample_texts(docs.where(~langid.kept_out() & F.col("doc_id").isNotNull()),
                                  F.col("text"), F.col("lang"))
    return langid.identify(docs.select("doc_id", langid.kept_out().alias("held_out"), "text"), samples).drop("text")


@register
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


@register
def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.search(table(spark, sf_dir, "embeddings"))


@register
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_recurring_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@register
def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@register
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similarity_join(table(spark, sf_dir, "documents"))


@register
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"))


# crc32 byte by byte over its table (letters up to U+00FF take two bytes from U+0080 on); two words of
# one length differ at one place if they agree without it, others if one is the other without a place
ORACLE["op13_spelling_variants"] = f"""
with recursive crc_table as (
    select list(c order by i) as tab from (
        select i, list_reduce(list_prepend(i, range(8)), lambda c, k:
            case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))),
runs as (
    select coalesce(doc_id::varchar, '') as id,
           unnest(regexp_extract_all(translate(text, '{spelling.UPPER}', '{spelling.LOWER}'), '{spelling.RUN}')) as run
    from documents where text is not null),
seen as (select id, run, count(*) as k from runs group by all),
hashed as (
    select run, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
               string_split(id || ':' || run, ''), lambda c:
               case when unicode(c) < 128 then [unicode(c)::bigint] else [195, unicode(c)::bigint - 64] end))),
               lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)]))) as h
    from seen, crc_table),
occurrences as (
    select case when h % {spelling.DAMAGE} = 0
                then run[1:h % length(run)] || run[h % length(run) + 2:] else run end as word, k from hashed),
words as (
    select word, sum(k)::bigint as n from occurrences where length(word) >= {spelling.LEAST_LETTERS}
    group by word having sum(k) >= {spelling.LEAST_COUNT}),
shorter as (
    select word, n, i, word[1:i] || word[i + 2:] as rest from words, unnest(range(length(word))) t(i)),
near as (
    select a.word, b.word as other, b.n as other_n from shorter a join shorter b on a.rest = b.rest and a.i = b.i and a.word <> b.word
    union
    select a.word, b.word, b.n from shorter a join words b on a.rest = b.word
    union
    select b.word, a.word, a.n from shorter a join words b on a.rest = b.word),
best as (
    select word, count(*) as n_near, first(other order by other_n desc, other) as best,
           max(other_n) as best_n from near group by word),
forms as (
    select w.word, w.n, coalesce(n_near, 0) as n_near, case when best_n >= {spelling.RATIO} * w.n then best end as form,
           case when best_n >= {spelling.RATIO} * w.n then best_n end as form_n
    from words w left join best using (word)),
chain as (
    select word, word as here, 0 as step from forms
    union all
    select c.word, f.form, c.step + 1 from chain c join forms f on f.word = c.here where f.form is not null),
roots as (select word, arg_max(here, step) as root from chain group by word)
select word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n from forms join roots using (word)
"""


@register
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register
def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearvectors.near_duplicates(table(spark, sf_dir, "embeddings"))
