"""Near-duplicate vectors: a robust-pruned flat graph, searched by range.

*Classes.*  Equal vectors of one label are one node with a count, so copies are
neither indexed nor compared with each other.

*Shards.*  The nodes of a label are split by k-means (centres from a bounded sample
of each cell, rows assigned by many tasks), level by level, until a cell has at most
``SHARD`` members.  Cells overlap: a node also joins every cell whose bisecting plane
with its own is nearer than ``reach``.  Two vectors of cosine ``SIMILAR`` are at most
``sqrt(2 - 2 SIMILAR)`` apart, so one of them is within half of that of any plane
between them: with ``reach`` of half that length every pair shares a cell.  In d
dimensions the part of the way that crosses a given plane is seldom above
``SPREAD / sqrt(d)`` of it, which is the reach of the first round.

*Graph.*  Each cell builds a flat graph: nodes come in batches of growing size, a
greedy search from the nearest of the cell's medoids collects candidates, and robust pruning keeps a
neighbour unless a kept one is nearer to it by a factor of ``ALPHA``; backward edges
are pruned alike.  A node's adjacency lists of all its cells are then united.

*Search.*  Every node is a query: greedy search from the medoids of each of its cells
over the united lists, then the range is expanded: neighbours, along edges and against
them, of all nodes within the wider cosine ``EXPAND`` are visited until none is new.  Pairs are verified in double
precision on the original vectors.  A pair that shares several cells counts in the
first of them in name order.

*Audit.*  The links of ``AUDIT`` nodes, picked by hash, are counted by brute force
over all nodes.  If fewer than ``TARGET`` of them were found, the index is made again
with twice the reach and breadth, at last with the reach that parts no pair.

*Dense cells.*  Where overlap leaves nothing to split (a large group of near copies),
all pairs of a cell are compared exactly, in tiles of two blocks.

Cells and tiles give out one row a node (its number of links and one edge of a
spanning forest), never pairs.  No part take: vectors that are null, empty, zero or
hold null or non-finite entries, and rows whose label is null; they have no links and
are their own component.  Vectors of different lengths never link.  Rows without an
id are left out; of rows with equal ids one counts, the first by label and entries.
An empty table gives an empty result.  Extra columns are not read.
"""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import list_array, shared_dir, stored
from quarry.llm.graphs import components
from quarry.llm.vectors import k_means

SIMILAR = 0.93

SHARD = 8192                # members of a cell
BRANCH = 32                 # cells that one cell is split into, at most
SAMPLE = 4096               # nodes of a cell from which its centres come
PART = 8192                 # nodes assigned by one task
REPLICAS = 4                # cells per node above which a cell counts as dense
SPREAD = 3.0
DEGREE = 16
BEAM = 32
GROUP = 64                  # nodes per medoid
STARTS = 8                  # medoids a search starts from
ALPHA = 1.2
EXPAND = 0.85
AT_ONCE = 256               # queries searched in step
AUDIT = 2048
TARGET = 0.99
ROUNDS = 3


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, vec)``, one row an id; ``vec`` is null where it takes no part."""
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), v.alias("vec")) \
        .where("vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("label", "vec")).alias("row"))
    fine = F.col("row.label").isNotNull() & F.col("row.vec").isNotNull() \
        & F.forall("row.vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists("row.vec", lambda x: x != 0)
    return rows.select("vec_id", F.col("row.label").alias("label"), F.when(fine, F.col("row.vec")).alias("vec"))


def unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


# ---------------------------------------------------------------- the graph

def greedy(x: np.ndarray, lists: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int) -> np.ndarray:
    """Best-first search for all rows of ``queries`` in step, from the nearest of the
    ``starts``: the ``beam`` nearest nodes met by each, -1 where there are fewer."""
    ids = np.full((len(queries), beam), -1)
    near = np.full((len(queries), beam), -np.inf, x.dtype)
    done = np.zeros((len(queries), beam), bool)
    seen = np.zeros((len(queries), len(x)), bool)
    lift = queries @ x[starts].T
    first = np.argsort(-lift, axis=1, kind="stable")[:, :min(STARTS, beam)]
    width = first.shape[1]
    ids[:, :width], near[:, :width] = starts[first], np.take_along_axis(lift, first, 1)
    np.put_along_axis(seen, starts[first], True, 1)
    while True:
        open_ = np.where(done | (ids < 0), -np.inf, near)
        at = open_.argmax(axis=1)
        rows = np.flatnonzero(open_[np.arange(len(at)), at] > -np.inf)
        if not len(rows):
            return ids
        done[rows, at[rows]] = True
        onward = lists[ids[rows, at[rows]]]
        fresh = (onward >= 0) & ~seen[rows[:, None], onward]
        r, c = np.nonzero(fresh)
        seen[rows[r], onward[r, c]] = True
        found = np.full(onward.shape, -np.inf, x.dtype)
        found[r, c] = np.einsum("ij,ij->i", x[onward[r, c]], queries[rows[r]])
        all_near = np.hstack([near[rows], found])
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[rows] = np.take_along_axis(all_near, order, 1)
        ids[rows] = np.take_along_axis(np.hstack([ids[rows], np.where(fresh, onward, -1)]), order, 1)
        done[rows] = np.take_along_axis(np.hstack([done[rows], np.zeros_like(fresh)]), order, 1)


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int) -> np.ndarray:
    """Neighbour lists of ``nodes`` out of their ``candidates`` (-1: none): the nearest
    one stays, and what is nearer to it by ``ALPHA`` than to the node goes; and so on."""
    out = np.full((len(nodes), degree), -1)
    ok = (candidates >= 0) & (candidates != nodes[:, None])
    order = np.argsort(np.where(ok, candidates, len(x)), axis=1, kind="stable")
    candidates, ok = np.take_along_axis(candidates, order, 1), np.take_along_axis(ok, order, 1)
    ok[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    points = x[np.where(ok, candidates, 0)]
    apart = np.where(ok, 2 - 2 * np.einsum("icd,id->ic", points, x[nodes]), np.inf)
    rows = np.arange(len(nodes))
    for k in range(degree):
        best = apart.argmin(axis=1)
        left = apart[rows, best] < np.inf
        if not left.any():
            break
        out[left, k] = candidates[left, best[left]]
        between = 2 - 2 * np.einsum("icd,id->ic", points, points[rows, best])
        apart[between * ALPHA ** 2 <= apart] = np.inf
        apart[rows, best] = np.inf
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """Nodes from which searches start: the one nearest to the centre of each
    group of about ``GROUP`` nodes.  From a single one a search would never leave a dense
    group around it that is larger than the beam."""
    centres = k_means(x, max(1, len(x) // GROUP), 4)
    return np.unique(np.concatenate([np.argmax(x @ centres[i:i + 64].T - (centres[i:i + 64] ** 2).sum(axis=1) / 2
                                               - (x ** 2).sum(axis=1)[:, None] / 2, axis=0) for i in range(0, len(centres), 64)]))


def build(x: np.ndarray, degree: int, beam: int) -> np.ndarray:
    """Adjacency lists of a cell (rows of node numbers, -1: none)."""
    lists = np.full((len(x), degree), -1)
    starts = medoids(x)
    for i in range(0, len(starts), AT_ONCE):
        part = starts[i:i + AT_ONCE]
        lists[part] = robust_prune(x, part, np.tile(starts, (len(part), 1)), degree)
    others = np.random.Generator(np.random.PCG64(len(x))).permutation(np.setdiff1d(np.arange(len(x)), starts))
    for turn in (others, np.concatenate([starts, others])):     # the second time all nodes are there to be found
        at, size = 0, 1
        while at < len(turn):
            nodes = turn[at:at + size]
            found = greedy(x, lists, starts, x[nodes], beam)
            lists[nodes] = robust_prune(x, nodes, np.hstack([found, lists[nodes]]), degree)
            _link_back(x, lists, nodes)
            at, size = at + size, min(2 * size, AT_ONCE)
    return lists


def _link_back(x: np.ndarray, lists: np.ndarray, nodes: np.ndarray) -> None:
    """Adds the edges from the neighbours of ``nodes`` back to them."""
    degree = lists.shape[1]
    to, of = lists[nodes].ravel(), np.repeat(nodes, degree)
    to, of = to[to >= 0], of[to >= 0]
    if not len(to):
        return
    order = np.argsort(to, kind="stable")
    to, of = to[order], of[order]
    heads = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
    counts = np.diff(np.append(heads, len(to)))
    owners = to[heads]
    for low in range(0, len(owners), AT_ONCE):
        part = slice(low, low + AT_ONCE)
        width = int(counts[part].max())
        more = np.full((len(owners[part]), width), -1)
        row = np.repeat(np.arange(len(owners[part])), counts[part])
        first = heads[part][0]
        size = int(counts[part].sum())
        more[row, np.arange(size) - np.repeat(heads[part] - first, counts[part])] = of[first:first + size]
        lists[owners[part]] = robust_prune(x, owners[part], np.hstack([lists[owners[part]], more]), degree)


def both_ways(lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pointers, nodes) of the edges in either direction: a node on the rim of a
    dense group is in nobody's pruned list, though it has one itself."""
    a, b = np.repeat(np.arange(len(lists)), lists.shape[1])[lists.ravel() >= 0], lists[lists >= 0]
    code = np.unique(np.concatenate([a * len(lists) + b, b * len(lists) + a]))
    return np.searchsorted(code, np.arange(len(lists) + 1) * len(lists)), code % len(lists)


def in_range(x: np.ndarray, lists: np.ndarray, starts: np.ndarray, queries: np.ndarray, beam: int, expand: float):
    """Range-expanding search: slices of (query, node) pairs of cosine ``expand`` at
    least, reached from the greedy beam and from the query itself."""
    pointers, ends = both_ways(lists)
    for low in range(0, len(queries), AT_ONCE):
        part = queries[low:low + AT_ONCE]
        beams = greedy(x, lists, starts, x[part], beam)
        seen = np.zeros((len(part), len(x)), bool)
        row, col = np.nonzero(beams >= 0)
        row, node = np.concatenate([row, np.arange(len(part))]), np.concatenate([beams[row, col], part])
        while len(row):
            code = np.unique(row * len(x) + node)
            row, node = code // len(x), code % len(x)
            fresh = ~seen[row, node]
            row, node = row[fresh], node[fresh]
            seen[row, node] = True
            near = np.concatenate([np.einsum("ij,ij->i", x[node[i:i + 65536]], x[part[row[i:i + 65536]]]) >= expand
                                   for i in range(0, len(row), 65536)]) if len(row) else np.zeros(0, bool)
            row, node = row[near], node[near]
            yield part[row], node
            counts = pointers[node + 1] - pointers[node]
            at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(pointers[node], counts)
            row, node = np.repeat(row, counts), ends[at]


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest number that edges ``(a, b)`` join each of ``size`` numbers with."""
    root = np.arange(size)
    while True:
        before = root.copy()
        least = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        if (root == before).all():
            return root


# ---------------------------------------------------------------- Spark

NODE = "cid long, n long, label {label}, cell string, vec array<double>"


def _label(df: DataFrame) -> str:
    return df.schema["label"].dataType.simpleString()


def _centres(shard: int):
    def run(table: pa.Table) -> pa.Table:
        x = unit(table.column("vec"))
        members = table.column("members")[0].as_py()
        order = np.argsort(table.column("cid").to_numpy(), kind="stable")
        k = int(min(BRANCH, max(2, -(-2 * members // shard)), len(x)))
        centres = k_means(x[order], k)
        return pa.table({"label": table.column("label").slice(0, 1), "cell": table.column("cell").slice(0, 1),
                         "members": table.column("members").slice(0, 1), "centres": pa.array([centres.ravel().tolist()])})
    return run


def _assigned(reach: float):
    def run(rows: pa.Table, centres: pa.Table) -> pa.Table:
        if not rows.num_rows or not centres.num_rows:
            return pa.table({c: rows.column(c).slice(0, 0) for c in ("cid", "n", "label", "cell", "vec")}
                            | {"parent": rows.column("cell").slice(0, 0)})
        x = unit(rows.column("vec"))
        c = centres.column("centres")[0].values.to_numpy().reshape(-1, x.shape[1])
        lift = x @ c.T - (c ** 2).sum(axis=1) / 2
        own = lift.argmax(axis=1)
        apart = np.linalg.norm(c[own][:, None] - c[None], axis=2) if len(x) * c.size < 1 << 24 else \
            np.linalg.norm(c[:, None] - c[None], axis=2)[own]
        joins = (lift.max(axis=1)[:, None] - lift) <= reach * apart
        row, child = np.nonzero(joins)
        parent = rows.column("cell").take(pa.array(row))
        cell = pa.array([f"{p}/{k}" for p, k in zip(parent.to_pylist(), child, strict=True)], pa.string())
        return pa.table({**{n: rows.column(n).take(pa.array(row)) for n in ("cid", "n", "label")}, "cell": cell,
                         "vec": rows.column("vec").take(pa.array(row)), "parent": parent})
    return run


def cells(nodes: DataFrame, reach: float, folder: str, name: str) -> DataFrame:
    """``nodes(cid, n, label, vec)`` dealt to overlapping cells, one row a node and
    cell; ``dense`` marks the cells that can't be split."""
    kind = _label(nodes)
    now = nodes.select("cid", "n", "label", F.size("vec").cast("string").alias("cell"), "vec")
    out, level = None, 0
    while True:
        sizes = now.groupBy("label", "cell").agg(F.count(F.lit(1)).alias("members"))
        sizes = stored(sizes, folder, f"{name}-sizes-{level}")
        sized = now.join(sizes, ["label", "cell"])
        small = sized.where(F.col("members") <= SHARD).drop("members").withColumn("dense", F.lit(False))
        out = small if out is None else out.unionByName(small)
        if sizes.where(F.col("members") > SHARD).isEmpty():
            return out
        large = sized.where(F.col("members") > SHARD)
        share = F.ceil(F.col("members") / SAMPLE)
        sample = large.where(F.pmod(F.xxhash64("cid", F.lit(level)), share) == 0)
        centres = sample.select("cid", "label", "cell", "members", "vec").groupBy("label", "cell") \
            .applyInArrow(_centres(SHARD), f"label {kind}, cell string, members long, centres array<double>")
        parts = F.ceil(F.col("members") / PART)
        centres = centres.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        dealt = large.withColumn("part", F.pmod(F.xxhash64("cid"), parts)).drop("members")
        keys = ["label", "cell", "part"]
        children = dealt.groupBy(*keys).cogroup(centres.groupBy(*keys)) \
            .applyInArrow(_assigned(reach), NODE.format(label=kind) + ", parent string")
        children = stored(children, folder, f"{name}-{level}")
        each = children.groupBy("label", "parent", "cell").agg(F.count(F.lit(1)).alias("k")) \
            .groupBy("label", "parent").agg(F.sum("k").alias("all"), F.max("k").alias("most"))
        split = each.join(sizes.withColumnRenamed("cell", "parent"), ["label", "parent"]) \
            .where((F.col("all") <= REPLICAS * F.col("members")) & (F.col("most") * 10 <= F.col("members") * 9)) \
            .select("label", "parent")
        split = stored(split, folder, f"{name}-split-{level}")
        whole = large.drop("members").join(split.withColumnRenamed("parent", "cell"), ["label", "cell"], "left_anti")
        out = out.unionByName(whole.withColumn("dense", F.lit(True)))
        now = children.join(split, ["label", "parent"], "left_semi").drop("parent")
        level += 1


def _built(degree: int, beam: int):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        order = np.argsort(ids, kind="stable")
        table, ids = table.take(pa.array(order)), ids[order]
        lists = build(unit(table.column("vec")).astype(np.float32), degree, beam)
        there = lists >= 0
        near = list_array(ids[lists[there]], np.concatenate([[0], np.cumsum(there.sum(axis=1))]), pa.int64())
        return table.select(["cid", "n", "label", "cell", "vec"]).append_column("near", near)
    return run


def _tally(ids: np.ndarray, weight: np.ndarray, lower: np.ndarray, a: np.ndarray, b: np.ndarray):
    """Links that the verified pairs ``a < b`` add to each node, and the root of each."""
    links = np.zeros(len(ids), np.int64)
    mine = ~(lower[a] & lower[b]).any(axis=1)
    np.add.at(links, a[mine], weight[b[mine]])
    np.add.at(links, b[mine], weight[a[mine]])
    return links


FOUND = "cid long, links long, root long"


def _result(ids, links, root) -> pa.Table:
    some = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
    return pa.table({"cid": pa.array(ids[some]), "links": pa.array(links[some]), "root": pa.array(ids[root[some]])})


def _lower_cells(column: list, cell: str) -> np.ndarray:
    """Which of the cells before ``cell`` in name order each node is in."""
    names = {c: i for i, c in enumerate(sorted({c for one in column for c in one if c < cell}))}
    out = np.zeros((len(column), len(names) or 1), bool)
    for i, one in enumerate(column):
        for c in one:
            if c in names:
                out[i, names[c]] = True
    return out


def _searched(beam: int, expand: float, similar: float):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        order = np.argsort(ids, kind="stable")
        table, ids = table.take(pa.array(order)), ids[order]
        exact = unit(table.column("vec"))
        x = exact.astype(np.float32)
        near = table.column("near").combine_chunks()
        place = np.searchsorted(ids, near.flatten().to_numpy())
        owner = np.repeat(np.arange(len(ids)), np.diff(near.offsets.to_numpy()))
        there = (place < len(ids)) & (ids[np.minimum(place, len(ids) - 1)] == near.flatten().to_numpy())
        place, owner = place[there], owner[there]            # neighbours in other cells are met there
        counts = np.bincount(owner, minlength=len(ids))
        lists = np.full((len(ids), max(1, int(counts.max()))), -1)
        lists[owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)] = place
        codes = [np.zeros(0, np.int64)]
        for a, b in in_range(x, lists, medoids(x), np.arange(len(ids)), beam, expand):
            a, b = np.minimum(a, b), np.maximum(a, b)
            fits = (a < b) & (np.einsum("ij,ij->i", x[a], x[b]) >= similar - 1e-4)
            a, b = a[fits], b[fits]
            fits = _verified(exact, a, b, similar)
            codes.append(a[fits] * len(ids) + b[fits])
        pairs = np.unique(np.concatenate(codes))
        a, b = pairs // len(ids), pairs % len(ids)
        lower = _lower_cells(table.column("cells").to_pylist(), table.column("cell")[0].as_py())
        links = np.zeros(len(ids), np.int64)
        for at in range(0, len(a), 1 << 18):
            part = slice(at, at + (1 << 18))
            links += _tally(ids, table.column("n").to_numpy(), lower, a[part], b[part])
        return _result(ids, links, forest(len(ids), a, b))
    return run


def _verified(exact: np.ndarray, a: np.ndarray, b: np.ndarray, similar: float) -> np.ndarray:
    return np.concatenate([np.einsum("ij,ij->i", exact[a[i:i + 65536]], exact[b[i:i + 65536]]) >= similar
                           for i in range(0, len(a), 65536)]) if len(a) else np.zeros(0, bool)


def _tiled(similar: float):
    def run(table: pa.Table) -> pa.Table:
        ids = table.column("cid").to_numpy()
        order = np.argsort(ids, kind="stable")
        table, ids = table.take(pa.array(order)), ids[order]
        x, weight = unit(table.column("vec")), table.column("n").to_numpy()
        chunk, low, high = (table.column(c).to_numpy() for c in ("chunk", "low", "high"))
        lower = _lower_cells(table.column("cells").to_pylist(), table.column("cell")[0].as_py())
        mine, others = np.flatnonzero(chunk == low[0]), np.flatnonzero(chunk == high[0])
        links, root = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at in range(0, len(mine), 128):
            part = mine[at:at + 128]
            i, j = np.nonzero(x[part] @ x[others].T >= similar - 1e-9)
            a, b = part[i], others[j]
            fits = (a != b) if low[0] != high[0] else (a < b)
            a, b = a[fits], b[fits]
            fits = _verified(x, a, b, similar)
            a, b = a[fits], b[fits]
            links += _tally(ids, weight, lower, a, b)
            root = forest(len(ids), np.concatenate([a, np.arange(len(ids))]), np.concatenate([b, root]))
        return _result(ids, links, root)
    return run


def link(nodes: DataFrame, folder: str, name: str, reach: float, beam: int, similar: float = SIMILAR) -> DataFrame:
    """``(cid, links, root)``: per node and cell what it adds to its links, and a node
    that it is joined with."""
    kind = _label(nodes)
    dealt = cells(nodes, reach, folder, f"{name}-cells")
    dealt = stored(dealt, folder, f"{name}-members")
    graph = dealt.where("not dense").drop("dense").groupBy("label", "cell") \
        .applyInArrow(_built(DEGREE, beam), NODE.format(label=kind) + ", near array<long>")
    graph = stored(graph.withColumn("dense", F.lit(False)).unionByName(
        dealt.where("dense").withColumn("near", F.array().cast("array<long>"))), folder, f"{name}-graph")
    union = graph.groupBy("label", "cid").agg(
        F.first("n").alias("n"), F.first("vec").alias("vec"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
        F.collect_list(F.struct("cell", "dense")).alias("at"))
    every = union.withColumn("cells", F.col("at.cell")).withColumn("here", F.explode("at")) \
        .select("cid", "n", "label", "vec", "near", "cells", "here.cell", "here.dense")
    every = stored(every, folder, f"{name}-union")
    found = every.where("not dense").groupBy("label", "cell").applyInArrow(_searched(beam, EXPAND, similar), FOUND)
    dense = every.where("dense").drop("near", "dense")
    blocks = dense.groupBy("label", "cell").agg(F.ceil(F.count(F.lit(1)) / SHARD).alias("chunks"))
    tiles = dense.join(blocks, ["label", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks"))) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))) \
        .withColumn("low", F.least("chunk", "other")).withColumn("high", F.greatest("chunk", "other")).drop("chunks", "other")
    tiled = tiles.groupBy("label", "cell", "low", "high").applyInArrow(_tiled(similar), FOUND)
    return stored(found.unionByName(tiled), folder, f"{name}-found")


def audit(nodes: DataFrame, found: DataFrame, similar: float = SIMILAR) -> float:
    """Share of the true links of ``AUDIT`` nodes, by hash, that were found."""
    few = nodes.orderBy(F.xxhash64("cid", F.lit(7)), "cid").limit(AUDIT).select("cid", "label", F.size("vec").alias("size"), "vec").collect()
    if not few:
        return 1.0
    sizes = np.array([r["size"] for r in few])
    sample = {s: (np.flatnonzero(sizes == s), unit(pa.array([r["vec"] for r in few if r["size"] == s], pa.list_(pa.float64()))))
              for s in set(sizes.tolist())}
    shared = nodes.sparkSession.sparkContext.broadcast(([r["cid"] for r in few], [r["label"] for r in few], sample))

    def count(batches):
        own, labels, groups = shared.value
        own, labels = np.array(own), np.array(labels, object)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                of, total = [], []
                length = np.diff(part.column(3).offsets.to_numpy())
                for size, (places, points) in groups.items():
                    rows = part.take(pa.array(np.flatnonzero(length == size)))
                    if not rows.num_rows:
                        continue
                    near = unit(rows.column(3)) @ points.T >= similar
                    near &= np.array(rows.column(2).to_pylist(), object)[:, None] == labels[places][None]
                    near &= rows.column(0).to_numpy()[:, None] != own[places][None]
                    links = (near * rows.column(1).to_numpy()[:, None]).sum(axis=0)
                    of.append(own[places][links > 0])
                    total.append(links[links > 0])
                if of:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(of)), pa.array(np.concatenate(total))], ["cid", "true"])

    true = nodes.select("cid", "n", "label", "vec").mapInArrow(count, "cid long, true long") \
        .groupBy("cid").agg(F.sum("true").alias("true"))
    mine = found.groupBy("cid").agg(F.sum("links").alias("links"))
    both = true.join(mine, "cid", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return 1.0 if not both[0] else both[1] / both[0]


def near_duplicates(vectors: DataFrame, similar: float = SIMILAR, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every vector."""
    spark = vectors.sparkSession
    folder = shared_dir(spark)
    rows = stored(usable(vectors, id_col, vector_col, label_col), folder, "vectors")
    part = rows.where("vec is not null")
    key = [F.xxhash64("label", "vec").alias("k1"), F.xxhash64(F.lit(1), "vec", "label").alias("k2")]
    classes = stored(part.groupBy("label", "vec").agg(F.min("vec_id").alias("cid"), F.count(F.lit(1)).alias("n")), folder, "classes")
    length = (2 - 2 * similar) ** 0.5
    widest = classes.agg(F.max(F.size("vec"))).first()[0] or 1
    reach, beam = length / 2 * min(1.0, SPREAD / widest ** 0.5), BEAM
    for turn in range(ROUNDS + 1):
        found = link(classes, folder, f"round-{turn}", reach, beam, similar)
        recall = audit(classes, found, similar)
        if recall >= TARGET or turn == ROUNDS:
            break
        reach, beam = length / 2 * min(1.0, 2 * reach / (length / 2)) if turn < ROUNDS - 1 else length / 2, 2 * beam
    if recall < TARGET:
        warnings.warn(f"near_duplicates: the audit found {recall:.3f} of the links", stacklevel=2)
    joined = components(found.where("cid <> root").select(F.col("cid").alias("a"), F.col("root").alias("b")), folder, "components")
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    each = classes.select("cid", "n", *key).join(links, "cid", "left").join(joined.withColumnRenamed("node", "cid"), "cid", "left") \
        .select("k1", "k2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("comp", "cid").alias("comp"))
    taken = part.select("vec_id", *key).join(each, ["k1", "k2"]).select("vec_id", "links", "comp")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("links"), F.col("vec_id").alias("comp"))
    return taken.unionByName(alone).select("vec_id", F.col("links").alias("n_links"), F.col("comp").alias("component_id"),
                                           (F.col("vec_id") == F.col("comp")).alias("kept"))
