"""The corpus pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it back for the next stage.

1. language identification: documents without a language (``und``) go;
2. line dedup: lines of recurring templates are dropped from the texts, and with
   them documents that had nothing else;
3. n-gram Jaccard join: one document of each group of near copies stays;
4. mixing: each document is there as often as the mix takes it;
5. SentencePiece: the ids of each whole text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import langid, lines, mixing, ngramjoin, pieces
from quarry.llm._shared import known_to_workers, shared_dir, stored

ORACLE_SQL = None           # SQL expresses none of the stages; tests/llm compares with brute force


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    samples = langid.sample_texts(docs.where(~langid.kept_out() & F.col("doc_id").isNotNull()),
                                  F.col("text"), F.col("lang"))
    found, sure = _free(docs, "_found"), _free(docs, "_sure")
    return langid.identify(docs, samples, names=(found, sure)) \
        .where(F.col(found) != langid.UNKNOWN).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    before, gone = _free(docs, "_lines"), _free(docs, "_gone")
    left = lines.drop_recurring_lines(docs, names=(before, gone))
    emptied = (F.col(gone) > 0) & ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    size = F.when(F.col(gone) > 0, F.length("text")).otherwise(F.col("n_chars"))
    return left.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", size.cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    return ngramjoin.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    return mixing.take(docs, mixing.mix_sources(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known_to_workers(spark)
    return pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix),
    ("sentencepiece", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = shared_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), folder, name)
    return STAGES[-1][1](spark, docs, sf_dir)
