"""Mixing sources to target weights by balanced sampling (cube method).

*Targets.*  Sources in code-point order, null last, weigh ``weights`` in turn
and share all words of the corpus by weight; a target stops at ``cap`` times
its source's size and the excess goes to the others by weight until none is
above.  *Copies.*  Every document of a source is to be taken ``r = target /
size of the source`` times on average: ``floor(r)`` times surely and once more
with probability ``r - floor(r)``.

*Cube method.*  These probabilities are moved along the null space of the two
balancing constraints, number of documents and number of words, until each is 0
or 1: of three open documents with sizes s1, s2, s3 the direction is
(s3-s2, s1-s3, s2-s1), which changes neither total; a random one of the two ways
is followed to the first bound, with odds that keep all expectations.  A block
of ``BLOCK`` documents of one source is one task's work and leaves two open
documents at most; these are pooled over the blocks, level by level, until one
block per source is left, whose last two are landed on the nearest word total.
Large documents go first, so the landing is between small ones.

Results depend only on the rows: order and random numbers come from hashes.

Null or empty text: size 0 (taken 0 words, whatever its copies).  Null source:
a source of its own, last.  Null ``doc_id`` and repeated rows are documents
like others.  A corpus without words has targets 0.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import shared_dir, slices, stored
from quarry.llm._words import word_hashes

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 8192                # documents one task moves at a time
SPARE = 12                  # documents kept for the landing


def _sizes(batches):
    for batch in slices(batches, 3):
        _, at = word_hashes(batch.column(3))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(np.diff(at), pa.int64())],
            ["doc_id", "source", "mark", "size"])


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source, mark, size): words per row; ``mark`` is a hash of the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                       F.xxhash64(text_col).alias("mark"), F.col(text_col).alias("text")) \
        .mapInArrow(_sizes, "doc_id long, source string, mark long, size long")


def source_targets(sizes: DataFrame, folder: str, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) of every source.

    The position of a source is its rank within a range partition plus the
    number of sources in the partitions before; only these counts and the sums
    of the sharing rounds come to the driver.
    """
    spark = sizes.sparkSession
    totals = stored(sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")),
                    folder, "sources")
    parted = stored(totals.repartitionByRange(F.col("source").asc_nulls_last())
                    .withColumn("part", F.spark_partition_id()), folder, "ranged")
    counts = sorted((r["part"], r["count"]) for r in parted.groupBy("part").count().collect())
    before, seen = [], 0
    for part, n in counts:
        before.append((part, seen))
        seen += n
    offsets = spark.createDataFrame(before, "part int, before long")
    place = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    ranked = parted.join(F.broadcast(offsets), "part") \
        .withColumn("place", F.col("before") + F.row_number().over(place) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    ranked = stored(ranked.select("source", "source_size", "docs", weight.cast("long").alias("weight")),
                    folder, "weighted")
    most = cap * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    left, share = total, ranked.agg(F.sum("weight")).first()[0] or 1
    while True:
        over = most * F.lit(share) < F.col("weight") * F.lit(float(left))
        fixed, open_weight = ranked.agg(F.coalesce(F.sum(F.when(over, most)), F.lit(0)),
                                        F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        if (total - fixed, open_weight) == (left, share) or not open_weight:
            break
        left, share = total - fixed, open_weight
    target = F.when(over, most.cast("double")).otherwise(F.lit(float(left)) * F.col("weight") / F.lit(float(share)))
    return ranked.select("source", "source_size", "docs", F.least(target, most.cast("double")).alias("target"))


def flight(odds: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the odds of one block until two at most are neither 0 nor 1; the
    sums of the odds and of odds times sizes stay as they are."""
    odds = odds.astype(float).tolist()
    size = sizes.astype(float).tolist()
    draws = rng.random(len(odds) + 8).tolist()
    open_rows: list[int] = []
    upcoming = iter(range(len(odds)))
    tiny = 1e-9
    draw = 0
    while True:
        while len(open_rows) < 3:
            i = next(upcoming, None)
            if i is None:
                break
            if tiny < odds[i] < 1 - tiny:
                open_rows.append(i)
            else:
                odds[i] = float(odds[i] > 0.5)
        if len(open_rows) < 3:
            break
        i, j, k = open_rows
        ways = [size[k] - size[j], size[i] - size[k], size[j] - size[i]]
        if not any(ways):
            ways = [1.0, -1.0, 0.0]
        ahead = back = math.inf
        for r, w in zip(open_rows, ways, strict=True):
            if w > 0:
                ahead, back = min(ahead, (1 - odds[r]) / w), min(back, odds[r] / w)
            elif w < 0:
                ahead, back = min(ahead, odds[r] / -w), min(back, (1 - odds[r]) / -w)
        step = ahead if draws[draw % len(draws)] * (ahead + back) < back else -back
        draw += 1
        for r, w in zip(open_rows, ways, strict=True):
            odds[r] += step * w
            if odds[r] <= tiny or odds[r] >= 1 - tiny:
                odds[r] = float(odds[r] > 0.5)
        open_rows = [r for r in open_rows if 0.0 < odds[r] < 1.0]
    return np.array(odds)


def _land(odds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Round the last open odds (few) so that the word total, then the number
    of documents, is nearest to what is expected: all ways are tried."""
    rows = np.flatnonzero((odds > 0) & (odds < 1))
    ways = (np.arange(1 << len(rows))[:, None] >> np.arange(len(rows))) & 1
    words = ways @ sizes[rows].astype(float) - (odds[rows] * sizes[rows]).sum()
    docs = ways.sum(axis=1) - odds[rows].sum()
    odds[rows] = ways[int(np.argmin(np.abs(words) + np.abs(docs)))]
    return odds


def _last(odds: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A source's only block: ``SPARE`` documents spread over all sizes wait
    until the others have moved, and are landed together with what is open."""
    open_rows = np.flatnonzero((odds > 0) & (odds < 1))
    spare = np.zeros(len(odds), bool)
    if len(open_rows):
        spare[open_rows[np.linspace(0, len(open_rows) - 1, min(SPARE, len(open_rows))).astype(int)]] = True
    odds = odds.copy()
    odds[~spare] = flight(odds[~spare], sizes[~spare], rng)
    return _land(odds, sizes)


def _block(level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "turn", "doc_id", "mark"], ascending=[False, True, True, True],
                                kind="stable", ignore_index=True)
        seed = [level, int(rows["block"].iat[0]), int(rows["turn"].iat[0]) & 0xFFFFFFFF]
        sizes = rows["size"].to_numpy()
        move = _last if rows["blocks"].iat[0] == 1 else flight
        odds = move(rows["odds"].to_numpy(), sizes, np.random.Generator(np.random.PCG64(seed)))
        return rows.assign(odds=odds)
    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``mark`` (text
    hash), ``size``, ``source_size``, ``target``, ``copies``, ``taken``."""
    folder = shared_dir(docs.sparkSession)
    sizes = stored(word_counts(docs, id_col, text_col, source_col), folder, "sizes")
    targets = source_targets(sizes, folder, weights, cap).withColumnRenamed("source", "_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(cap)))) \
        .otherwise(F.lit(0.0))
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["_source"])).drop("_source") \
        .withColumn("base", F.floor(rate)).withColumn("odds", rate - F.floor(rate)) \
        .withColumn("turn", F.xxhash64("doc_id", "mark", F.lit("turn")))
    keep = ["doc_id", "source", "mark", "size", "source_size", "target", "base", "odds", "turn"]
    current = rows.withColumn("blocks", F.ceil(F.col("docs") / BLOCK)).select(*keep, "blocks")
    done, level = None, 0
    schema = None
    while True:
        dealt = current.withColumn("block", F.pmod(F.xxhash64("turn", F.lit(level)), F.col("blocks")))
        schema = schema or dealt.schema
        moved = stored(dealt.groupBy("source", "block").applyInPandas(_block(level), schema), folder, f"level{level}")
        settled = moved.where("odds <= 0 or odds >= 1").select(*keep)
        done = settled if done is None else done.unionByName(settled)
        rest = moved.where("odds > 0 and odds < 1").select(*keep)
        per_source = rest.groupBy(F.col("source").alias("_source")).agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        if per_source.first() is None:
            break
        current = rest.join(per_source, rest["source"].eqNullSafe(per_source["_source"])).select(*keep, "blocks")
        level += 1
    copies = (F.col("base") + F.col("odds")).cast("long")
    return done.select("doc_id", "source", "mark", "size", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its ``copies``.
    Rows equal in id, source and text are told apart by their place."""
    a, b = "_mix", "_place"
    while a in docs.columns or b in docs.columns:
        a, b = a + "_", b + "_"
    mark = F.xxhash64(F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.xxhash64(text_col))
    rows = docs.withColumn(a, mark)
    rows = rows.withColumn(b, F.row_number().over(Window.partitionBy(a).orderBy(a)))
    chosen = mixed.where("copies > 0").select(F.xxhash64("doc_id", "source", "mark").alias(a), "copies")
    chosen = chosen.withColumn(b, F.row_number().over(Window.partitionBy(a).orderBy(F.desc("copies")))) \
        .withColumnRenamed("copies", f"{a}n")
    return rows.join(chosen, [a, b]).withColumn(f"{a}r", F.explode(F.expr(f"sequence(1L, `{a}n`)"))) \
        .select(*docs.columns)
