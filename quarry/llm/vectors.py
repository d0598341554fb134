"""Nearest neighbours by inner product: adaptive dimension scan inside an
inverted file.

*Index.*  Equal vectors are one candidate with the ``k + 1`` smallest of their
ids (no answer can need more).  Centres come from k-means over a bounded sample
(``SAMPLE`` vectors by hash); every candidate belongs to the list of its nearest
centre.  One list has about ``LIST`` candidates, up to ``MOST_LISTS`` lists.

*Scan.*  An extra coordinate ``sqrt(M^2 - |x|^2)`` makes the largest inner product
the smallest Euclidean distance.  Vectors are rotated at random and kept in
blocks of columns.  A query adds up the squared distance block by block; after
``d`` of ``D`` dimensions a candidate is abandoned when its distance so far, scaled
by ``D / d``, is above the k-th best by more than the factor
``(1 + EPSILON / sqrt(d))^2``: under a random rotation a nearer candidate looks so
far with negligible probability.  Survivors are scored exactly, in double
precision, on the original vectors.

*Probing.*  The nearest list is scanned first; the k-th best found there is the
bound with which the other probed lists are scanned.  How many lists are probed
is measured: for ``PROBE_QUERIES`` queries the true neighbours are found by brute
force, and enough lists are taken that ``COVER`` of these neighbours lie in them.

Lists and their queries meet in tiles of at most ``TILE`` candidates and ``TILE``
queries, so a list that holds a large part of all vectors, or that very many
queries probe, is the work of many tasks.

No part take: null ids; vectors that are null, zero, or hold null or non-finite
components; vectors whose length isn't that of most.  Equal rows count once.  An
empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm._shared import shared_dir, stored

LIST = 800
MOST_LISTS = 4096
SAMPLE = 65_536
TILE = 4096
BLOCK = 16                  # columns per block
EPSILON = 2.5
PROBE_QUERIES = 128
COVER = 0.97


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part, equal rows once."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).where("id is not null and vec is not null")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(fine & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if sizes is None:
        return rows
    return rows.where(F.size("vec") == sizes["size"]).dropDuplicates(["id", "vec"])


def rotation(size: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(size)).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def k_means(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centres of a sample (rows in a fixed order)."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=k)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres ** 2).sum(axis=1) / 2
    out = np.empty(len(points), np.int64)
    for at in range(0, len(points), 8192):
        out[at:at + 8192] = np.argmax(points[at:at + 8192] @ centres.T - half, axis=1)
    return out


class Scanner:
    """Candidates of one tile, rotated and in column blocks."""

    def __init__(self, vectors: np.ndarray, top_norm: float):
        self.plain = vectors
        self.top = top_norm
        extra = np.sqrt(np.maximum(0.0, top_norm ** 2 - (vectors ** 2).sum(axis=1)))
        self.turn = rotation(vectors.shape[1] + 1)
        turned = np.hstack([vectors, extra[:, None]]) @ self.turn
        self.size = turned.shape[1]
        self.blocks = [np.ascontiguousarray(turned[:, at:at + BLOCK]) for at in range(0, self.size, BLOCK)]

    def scan(self, query: np.ndarray, k: int, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of candidates that may be among the k best with a
        score of at least ``floor``."""
        if floor == -np.inf and len(self.plain) > 4 * k:
            floor = float(np.partition(self.plain[:4 * k] @ query, -k)[-k])
        limit = np.inf if floor == -np.inf else \
            (query @ query + self.top ** 2 - 2 * floor) * (1 + 1e-9) + 1e-12
        turned = query @ self.turn[:-1]
        alive, far, seen = None, None, 0
        for n, block in enumerate(self.blocks):
            part = turned[n * BLOCK:n * BLOCK + block.shape[1]]
            step = (block if alive is None else block[alive]) - part
            step = np.einsum("ij,ij->i", step, step)
            far = step if far is None else far + step
            seen += block.shape[1]
            slack = (1 + EPSILON / np.sqrt(seen)) ** 2 if seen < self.size else 1.0
            keep = np.flatnonzero(far * (self.size / seen) <= slack * limit)
            if len(keep) < len(far):
                alive, far = (keep if alive is None else alive[keep]), far[keep]
            if not len(far):
                break
        alive = np.arange(len(self.plain)) if alive is None else alive
        return alive, self.plain[alive] @ query


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _scan_tile(k: int, top_norm: float):
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(candidates) and len(queries):
            scanner = Scanner(np.stack(candidates["vec"].to_numpy()), top_norm)
            members = candidates["ids"].to_numpy()
            for own, key, vec, floor in zip(queries["query_id"], queries["query_key"], queries["vec"], queries["floor"],
                                            strict=True):
                places, scores = scanner.scan(np.asarray(vec), k + 1, floor)
                if len(places) > k + 1:             # ties at the cut stay
                    cut = np.partition(scores, -(k + 1))[-(k + 1)]
                    places, scores = places[scores >= cut], scores[scores >= cut]
                if not len(places):
                    continue
                ids = [np.asarray(members[p]) for p in places]
                scores = np.repeat(scores, [len(i) for i in ids])
                ids = np.concatenate(ids)
                other = ids != own
                ids, scores = best_of(ids[other], scores[other], k)
                out.append(pd.DataFrame({"query_id": own, "query_key": key, "vec_id": ids, "score": scores}))
        if not out:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "query_key": pd.Series(dtype="int64"),
                                 "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return pd.concat(out, ignore_index=True)
    return run


FOUND = "query_id long, query_key long, vec_id long, score double"


class Index:
    """The lists of one set of vectors."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20):
        spark = vectors.sparkSession
        self.k, self.folder = k, shared_dir(spark)
        self.rows = stored(usable(vectors, id_col, vector_col), self.folder, "vectors")
        place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
        classes = self.rows.withColumn("place", place).where(F.col("place") <= k + 1) \
            .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        classes = stored(classes, self.folder, "classes")
        self.number = classes.count()
        if not self.number:
            return
        norm = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x)
        self.top_norm = float(np.sqrt(classes.agg(F.max(norm)).first()[0]))
        sample = classes.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).select("vec").toPandas()["vec"]
        sample = np.stack(sample.to_numpy())
        lists = max(1, min(MOST_LISTS, self.number // LIST, len(sample)))
        self.centres = k_means(sample, lists)
        self.shared = spark.sparkContext.broadcast(self.centres)
        self.lists = stored(classes.mapInArrow(_assigned(self.shared), "ids array<long>, vec array<double>, list long"),
                            self.folder, "lists")
        self.sizes = stored(self.lists.groupBy("list").agg(F.ceil(F.count("*") / TILE).alias("chunks")),
                            self.folder, "sizes")

    def true_neighbours(self, queries: np.ndarray, own: list[int]) -> list[tuple[int, int]]:
        """Brute force for a few queries: (query place, list) of each true neighbour."""
        shared = self.rows.sparkSession.sparkContext.broadcast((queries, own))
        best = self.lists.mapInArrow(_brute(shared, self.k), "place long, list long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("place").orderBy(F.desc("score"), "vec_id"))
        return [(r["place"], r["list"]) for r in best.withColumn("rank", rank).where(F.col("rank") <= self.k).collect()]

    def probes(self, queries: DataFrame) -> int:
        """Lists to probe so that ``COVER`` of the true neighbours of a bounded
        sample of queries are in reach."""
        few = queries.orderBy(F.xxhash64("query_key"), "query_key").limit(PROBE_QUERIES).select("query_id", "vec").collect()
        points = np.array([r["vec"] for r in few])
        found = self.true_neighbours(points, [r["query_id"] for r in few])
        order = list_order(points, self.centres)
        rank = np.argsort(order, axis=1)
        ranks = np.sort([rank[p, one] for p, one in found])
        return int(ranks[min(len(ranks) - 1, int(COVER * len(ranks)))]) + 1 if len(ranks) else 1

    def scan(self, probed: DataFrame) -> DataFrame:
        """Best k of each (query, list) tile; ``probed(query_id, query_key, vec, floor, list)``."""
        per_list = probed.groupBy("list").agg(F.ceil(F.count("*") / TILE).alias("parts"))
        dealt = self.sizes.join(per_list, "list")
        candidates = self.lists.join(dealt, "list") \
            .withColumn("chunk", F.pmod(F.xxhash64("ids"), F.col("chunks"))) \
            .withColumn("part", F.explode(F.expr("sequence(0L, parts - 1L)"))).select("list", "chunk", "part", "ids", "vec")
        asked = probed.join(dealt, "list") \
            .withColumn("part", F.pmod(F.xxhash64("query_key"), F.col("parts"))) \
            .withColumn("chunk", F.explode(F.expr("sequence(0L, chunks - 1L)"))) \
            .select("list", "chunk", "part", "query_id", "query_key", "vec", "floor")
        keys = ["list", "chunk", "part"]
        return candidates.groupBy(*keys).cogroup(asked.groupBy(*keys)) \
            .applyInPandas(_scan_tile(self.k, self.top_norm), FOUND)

    def best(self, found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_key", "query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= self.k)

    def search(self, queries: DataFrame) -> DataFrame:
        """(query_id, rank, vec_id, score) for ``queries(id, vec)``."""
        asked = queries.select(F.col("id").alias("query_id"), F.xxhash64("id", "vec").alias("query_key"), "vec")
        if not self.number or asked.first() is None:
            return self.rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        probes = self.probes(asked)
        ranked = asked.mapInArrow(_probed(self.shared, probes),
                                  "query_id long, query_key long, vec array<double>, list long, turn int")
        ranked = stored(ranked, self.folder, "probes")
        first = stored(self.best(self.scan(ranked.where("turn = 0").withColumn("floor", F.lit(float("-inf"))))),
                       self.folder, "first")
        floors = first.where(F.col("rank") == self.k).select("query_key", F.col("score").alias("floor"))
        others = ranked.where("turn > 0").join(floors, "query_key", "left") \
            .withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
        found = first.drop("rank").unionByName(self.scan(others))
        return self.best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def list_order(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Lists of each point, nearest centre first."""
    return np.argsort((centres ** 2).sum(axis=1) / 2 - points @ centres.T, axis=1, kind="stable")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _assigned(shared):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                vec, ids = batch.column(batch.schema.get_field_index("vec")), batch.column(batch.schema.get_field_index("ids"))
                yield pa.RecordBatch.from_arrays([ids, vec, pa.array(nearest(_matrix(vec), shared.value))],
                                                 ["ids", "vec", "list"])
    return run


def _probed(shared, probes: int):
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                order = list_order(_matrix(part.column(2)), shared.value)[:, :probes]
                rows = pa.array(np.repeat(np.arange(part.num_rows), order.shape[1]))
                turn = np.tile(np.arange(order.shape[1], dtype=np.int32), part.num_rows)
                yield pa.RecordBatch.from_arrays([*(part.column(i).take(rows) for i in range(3)),
                                                  pa.array(order.ravel()), pa.array(turn)],
                                                 ["query_id", "query_key", "vec", "list", "turn"])
    return run


def _brute(shared, k: int):
    def run(batches):
        queries, own = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            members, lists = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            scores = _matrix(batch.column(1)) @ queries.T
            for q in range(len(queries)):
                places = np.argsort(-scores[:, q], kind="stable")[:k + 1]
                rows = [(i, p) for p in places for i in members[p] if i != own[q]]
                ids, place = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
                order = np.lexsort((ids, -scores[place, q]))[:k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(order), q)), pa.array(lists[place[order]]), pa.array(ids[order]),
                     pa.array(scores[place[order], q])], ["place", "list", "vec_id", "score"])
    return run


def search(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``."""
    index = Index(vectors, id_col, vector_col, k)
    return index.search(index.rows.where(F.col("id") % every == 0))
