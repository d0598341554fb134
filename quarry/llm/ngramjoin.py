"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

A document's set holds its distinct five-word shingles (64-bit hashes).  Two
documents link when ``den * |A & B| >= num * |A | B|`` (75/100 by default).

1. Equal sets form one *class*; all further work is on classes.
2. *Tiles.*  In one order of all shingles, linked classes share a shingle among
   their first ``n - ceil(n * num / den) + 1``; so classes that share one of
   these meet in that shingle's tile.  Very frequent shingles come last in the
   order (``frequent``), then hash order decides; any order finds all links, so
   the bounded list of frequent ones affects cost only.  Inside a tile classes
   are sorted by size and only those in the same size band (``|A| * den >=
   |B| * num``) are compared.  A tile of over ``TILE`` rows is dealt out as
   pairs of blocks, so no task holds more than two blocks.
3. *Bitmaps.*  Each class has a parity bitmap of its hashes, two to four bits a
   shingle (wider ones fold to narrower by exclusive or).  The bits in which
   two bitmaps differ are at most the shingles in which the sets differ, which
   bounds the overlap from above; pairs whose bound is too low go.
4. *Exact.*  The rest is decided on the sorted arrays themselves.

Classes already connected need no comparison.  A first round compares each
class only with one centre per min-hash key, the class whose own keys are shared
most; this joins large groups of near copies without comparing all their pairs.
Tiles whose classes all lie in one component are then left out.  In the others
each class tests the foreign class of its best bound only, so a tile gives no more
pairs than it has rows; where a class had more candidates, its tiles are gone
through again with the components joined so far, ``ROUNDS`` times at most and as
long as links are found.  Then every pair left is tested.  No link between
components is lost: every pair of different components in a tile is linked,
refused by its bound or refused exactly.

Null or empty text: empty set, linked with nothing, its own component (null
``doc_id``: null).  Repeated rows and equal texts share a class.  Extra columns
are ignored.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm._shared import dropped, list_array, shared_dir, slices, stored
from quarry.llm._words import mix, shingle_sets
from quarry.llm.graphs import components

NUM, DEN = 75, 100
KEYS = 8                    # min-hash keys of the first round
FREQUENT = 1 << 18          # shingles at most that come last in the order (2 MB)
FREQUENT_DF = 64            # and in how many documents at least
ROUNDS = 2                  # times that classes test their best bound before all pairs left are tested
EARLIER = 4                 # tokens before a tile's by which a pair is known to meet in an earlier tile
TILE = 1000                 # rows of a block of a large tile
MIN_BITS, MAX_BITS = 64, 1 << 17
_KEY = np.random.Generator(np.random.PCG64(7)).integers(1, 2**62, KEYS, dtype=np.uint64) \
    * np.uint64(2) + np.uint64(1)


def prefix_length(n, num: int = NUM, den: int = DEN):
    """How many first shingles of a set of ``n`` any linked set must meet."""
    return n - -(-n * num // den) + 1


def _signature(s: np.ndarray) -> int:
    """A set's 64-bit name: an order-free sum of mixed hashes and its size."""
    total = mix(s.view(np.uint64) ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(s))]))[0].view(np.int64))


def _bitmap(s: np.ndarray) -> bytes:
    width = min(max(MIN_BITS, 1 << int(2 * len(s) - 1).bit_length()), MAX_BITS)
    place = (s.view(np.uint64) >> np.uint64(7)) & np.uint64(width - 1)
    return np.packbits((np.bincount(place.astype(np.int64), minlength=width) & 1).astype(np.uint8)).tobytes()


def _fold(block: np.ndarray, width: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) folded to ``width`` words."""
    while block.shape[1] > width:
        half = block.shape[1] // 2
        block = block[:, :half] ^ block[:, half:]
    return block


def _packed(maps: list[bytes]):
    """Bitmaps by width: words of each one, its row in the array of its width, the arrays."""
    wide = np.array([len(m) // 8 for m in maps], np.int64)
    place, arrays = np.zeros(len(maps), np.int64), {}
    for w in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == w)
        place[rows] = np.arange(len(rows))
        arrays[w] = np.frombuffer(b"".join([maps[r] for r in rows.tolist()]), np.uint64).reshape(len(rows), w)
    return wide, place, arrays


def _bounds(sizes_a, packed_a, i, sizes_b, packed_b, j) -> np.ndarray:
    """Upper bounds of the overlaps of the sets ``i`` with the sets ``j``."""
    (wide_a, place_a, arrays_a), (wide_b, place_b, arrays_b) = packed_a, packed_b
    sizes_a, sizes_b = sizes_a[i], sizes_b[j]
    out = np.minimum(sizes_a, sizes_b)
    both = wide_a[i] << 32 | wide_b[j]
    for code in np.unique(both).tolist():
        wa, wb = code >> 32, code & 0xFFFFFFFF
        rows, w = np.flatnonzero(both == code), min(wa, wb)
        step = max(1, (1 << 20) // max(wa, wb))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            x, y = arrays_a[wa][place_a[i[part]]], arrays_b[wb][place_b[j[part]]]
            differ = np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum(axis=1, dtype=np.int64)
            out[part] = np.minimum(out[part], (sizes_a[part] + sizes_b[part] - differ) // 2)
    return out


def overlap_bounds(sizes_a, maps_a, sizes_b, maps_b) -> np.ndarray:
    """Upper bounds of the overlaps of pairs of sets, from sizes and bitmaps."""
    each = np.arange(len(maps_a))
    return _bounds(np.asarray(sizes_a, np.int64), _packed(maps_a), each, np.asarray(sizes_b, np.int64), _packed(maps_b), each)


def _possible(sizes_a, sizes_b, overlap, num, den) -> np.ndarray:
    """Whether an overlap makes (or, as a bound, may make) a link."""
    small, large = np.minimum(sizes_a, sizes_b), np.maximum(sizes_a, sizes_b)
    return (small * den >= large * num) & ((den + num) * overlap >= num * (sizes_a + sizes_b))


def _sketches(batches):
    for batch in slices(batches, 1):
        values, at = shingle_sets(batch.column(1))
        n = np.diff(at)
        full = np.flatnonzero(n > 0)
        signs = [None] * len(n)
        maps = [None] * len(n)
        for r in full:
            s = values[at[r]:at[r + 1]]
            signs[r], maps[r] = _signature(s), _bitmap(s)
        keys = np.zeros((len(n), KEYS), np.int64)
        if len(full):
            for j in range(KEYS):
                keys[full, j] = np.minimum.reduceat(mix(values.view(np.uint64) * _KEY[j]), at[full]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(signs, pa.int64()),
             list_array(keys.ravel(), np.arange(len(n) + 1) * KEYS, pa.int64()), pa.array(maps, pa.binary())],
            ["doc_id", "n", "sig", "keys", "bits"])


def _prefixes(num, den, frequent=None):
    """Batches of (token, sig) of the first shingles of each set; a set that the
    task has seen is not repeated.  ``frequent``: broadcast sorted array."""
    def run(batches):
        last = frequent.value if frequent is not None else np.zeros(0, np.int64)
        seen: set[int] = set()
        for batch in slices(batches, 1):
            values, at = shingle_sets(batch.column(1))
            late = np.zeros(len(values), bool)
            if len(last) and len(values):
                spot = np.minimum(np.searchsorted(last, values), len(last) - 1)
                late = last[spot] == values
            tokens, signs = [], []
            for r in range(len(at) - 1):
                s = values[at[r]:at[r + 1]]
                if not len(s):
                    continue
                sign = _signature(s)
                if sign in seen:
                    continue
                seen.add(sign)
                p = prefix_length(len(s), num, den)
                tail = late[at[r]:at[r + 1]]
                if tail[:p].any():
                    s = np.concatenate([s[~tail], s[tail]])
                tokens.append(s[:p])
                signs.append(np.full(p, sign, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(np.concatenate(signs))],
                                                 ["token", "sig"])
    return run


def _meetings(batches):
    """Of (token, sig) sorted by both: the distinct rows whose token has two
    signatures at least.  Holds one row between batches, whatever a token's size."""
    held_t = held_s = None              # the last distinct row, not yet given out
    held_out = False                    # whether it has met another
    for batch in batches:
        t, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(t):
            continue
        if held_t is not None:
            t, s = np.concatenate([[held_t], t]), np.concatenate([[held_s], s])
        keep = np.ones(len(t), bool)
        keep[1:] = (t[1:] != t[:-1]) | (s[1:] != s[:-1])
        t, s = t[keep], s[keep]
        same = t[1:] == t[:-1]
        meets = np.zeros(len(t), bool)
        meets[1:] |= same
        meets[:-1] |= same
        meets[0] |= held_out
        held_t, held_s, held_out = t[-1], s[-1], bool(meets[-1])
        out = meets.copy()
        out[-1] = False
        if out.any():
            yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(s[out])], ["token", "sig"])
    if held_t is not None and held_out:
        yield pa.RecordBatch.from_arrays([pa.array([held_t], pa.int64()), pa.array([held_s], pa.int64())],
                                         ["token", "sig"])


def _best(rows: list[np.ndarray]) -> list[np.ndarray]:
    """Of (row, partner, bound, candidates): the highest bound of each row, and
    the sum of the candidates."""
    row, partner, bound, number = rows
    order = np.lexsort((partner, -bound, row))
    row, partner, bound, number = row[order], partner[order], bound[order], number[order]
    first = np.ones(len(row), bool)
    first[1:] = row[1:] != row[:-1]
    places = np.flatnonzero(first)
    return [row[first], partner[first], bound[first], np.add.reduceat(number, places)]


def _tile_pairs(num, den, only_best: bool):
    """Pairs with a high enough bound in tiles: rows (tile, side, sig, comp, n,
    bits) sorted by tile and n.  ``side`` 0: compared with all others of the
    tile; 1 and 2: with the other side only.  Compares at growing distance in
    the sorted rows, all tiles of a batch at once.  ``only_best``: of each class in
    a tile just the pair of the highest bound with a foreign component; ``more``
    says whether the class ``a`` had other candidates there.  Columns after these
    hold earlier tokens whose tiles the class stands in: a pair that has one in
    common is left to that tile."""
    def batch_of(sig, i, j, more):
        return pa.RecordBatch.from_arrays([pa.array(sig[i]), pa.array(sig[j]), pa.array(more)], ["a", "b", "more"])

    def compare(rows: pa.Table):
        tile, side, sig, comp, n = (rows.column(i).to_numpy() for i in range(5))
        bits = _packed(rows.column(5).to_pylist())
        earlier = [rows.column(k) for k in range(6, rows.num_columns)]
        earlier = [(x.fill_null(0).to_numpy(), x.is_valid().to_numpy()) for x in earlier]
        alive = np.arange(len(tile))
        held = [np.zeros(0, np.int64) for _ in range(4)]
        gap = 0
        while len(alive):
            gap += 1
            alive = alive[alive + gap < len(tile)]
            alive = alive[(tile[alive] == tile[alive + gap]) & (n[alive] * den >= n[alive + gap] * num)]
            i, j = alive, alive + gap
            ok = (comp[i] != comp[j]) & ((side[i] == 0) | (side[i] != side[j]))
            i, j = i[ok], j[ok]
            if not len(i):
                continue
            bound = _bounds(n, bits, i, n, bits, j)
            ok = _possible(n[i], n[j], bound, num, den)
            i, j, bound = i[ok], j[ok], bound[ok]
            ok = np.ones(len(i), bool)
            for x, is_x in earlier:
                for y, is_y in earlier:
                    ok &= ~((x[i] == y[j]) & is_x[i] & is_y[j])
            i, j, bound = i[ok], j[ok], bound[ok]
            if not len(i):
                continue
            if not only_best:
                yield batch_of(sig, i, j, np.zeros(len(i), bool))
                continue
            more = (np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([bound, bound]),
                    np.ones(2 * len(i), np.int64))
            held = [np.concatenate(x) for x in zip(held, more, strict=True)]
            if len(held[0]) > 1 << 18:
                held = _best(held)
        if len(held[0]):
            held = _best(held)
            yield batch_of(sig, held[0], held[1], held[3] > 1)

    def run(batches):
        held = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, now]) if held is not None else now
            tile = held.column(0).to_numpy()
            cut = int(np.searchsorted(tile, tile[-1])) if len(tile) else 0   # the last tile may go on
            if cut:
                yield from compare(held.slice(0, cut).combine_chunks())
                held = held.slice(cut)
        if held is not None and held.num_rows:
            yield from compare(held.combine_chunks())
    return run


def _bounded(num, den):
    """Pairs (a, b, na, bits_a, nb, bits_b) whose bound is high enough."""
    def run(batches):
        for batch in batches:
            a, b, na, ma, nb, mb = (batch.column(i) for i in range(6))
            na, nb = na.to_numpy(), nb.to_numpy()
            bound = overlap_bounds(na, ma.to_pylist(), nb, mb.to_pylist())
            ok = pa.array(_possible(na, nb, bound, num, den))
            yield pa.RecordBatch.from_arrays([a.filter(ok), b.filter(ok)], ["a", "b"])
    return run


def _sets(batches):
    seen: set[int] = set()
    for batch in slices(batches, 1):
        values, at = shingle_sets(batch.column(1))
        signs, sets = [], []
        for r in range(len(at) - 1):
            s = values[at[r]:at[r + 1]]
            if len(s) and (sign := _signature(s)) not in seen:
                seen.add(sign)
                signs.append(sign)
                sets.append(s)
        if signs:
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signs, pa.int64()), list_array(np.concatenate(sets), ends, pa.int64())], ["sig", "items"])


def _either_way(pairs: DataFrame) -> DataFrame:
    """The distinct pairs, each once whatever its direction."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


class _Join:
    """One run of the join: its stored tables and rounds."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, num: int, den: int):
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        self.num, self.den = num, den
        self.spark = docs.sparkSession
        self.folder = shared_dir(self.spark)
        self.tab = stored(self.docs.mapInArrow(
            _sketches, "doc_id long, n long, sig long, keys array<long>, bits binary"), self.folder, "sketches")
        full = self.tab.where("n > 0")
        each = stored(full.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")),
                      self.folder, "classes")         # every round joins it
        self.features, self.reps = each.select("sig", "n", "bits"), each.select("sig", "rep")
        self.label = None               # (sig, comp) of the classes with a link

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that link, by exact intersection of their sets."""
        pairs = stored(pairs, self.folder, f"{name}-pairs")
        needed = pairs.select(F.col("a").alias("sig")).union(pairs.select("b")).distinct()
        ids = needed.join(self.reps, "sig").select("rep").distinct()
        texts = self.docs.join(ids, self.docs["doc_id"].eqNullSafe(ids["rep"]), "left_semi")
        sets = texts.mapInArrow(_sets, "sig long, items array<long>") \
            .join(needed, "sig", "left_semi").dropDuplicates(["sig"])
        left = sets.select(F.col("sig").alias("a"), F.col("items").alias("x"))
        right = sets.select(F.col("sig").alias("b"), F.col("items").alias("y"))
        enough = F.size(F.array_intersect("x", "y")).cast("long") * (self.den + self.num) >= (F.size("x") + F.size("y")).cast("long") * self.num
        links = stored(pairs.select("a", "b").join(left, "a").join(right, "b").where(enough).select("a", "b"),
                       self.folder, f"{name}-links")
        self.done()
        return links

    def relabel(self, links: DataFrame, name: str) -> DataFrame:
        """(sig, comp) of every class that has a link so far: components of the
        new links between the components before."""
        old = self.label
        if old is not None:
            la = old.select(F.col("sig").alias("a"), F.col("comp").alias("ca"))
            lb = old.select(F.col("sig").alias("b"), F.col("comp").alias("cb"))
            links = links.join(la, "a", "left").join(lb, "b", "left") \
                .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
        new = stored(components(links, self.folder, name), self.folder, f"{name}-components")
        if old is None:
            label = new.select(F.col("node").alias("sig"), "comp")
        else:
            moved = new.select("node", F.col("comp").alias("to"))
            label = old.join(moved, old["comp"] == moved["node"], "left") \
                .select("sig", F.coalesce("to", "comp").alias("comp")) \
                .unionByName(new.join(old, new["node"] == old["sig"], "left_anti")
                             .select(F.col("node").alias("sig"), "comp"))
        self.label = stored(label, self.folder, f"{name}-labels")
        return self.label

    def centre_pairs(self) -> DataFrame:
        """Round 1: each class with the centre of each of its min-hash keys, the
        class whose keys together have the most holders."""
        rows = stored(self.tab.where("n > 0").select("sig", "keys").dropDuplicates(["sig"])
                      .select("sig", F.posexplode("keys").alias("j", "key")), self.folder, "keys")
        shared = rows.groupBy("j", "key").agg(F.count("*").alias("holders")).where("holders > 1")
        rows = rows.join(shared, ["j", "key"])
        typical = rows.groupBy("sig").agg(F.sum("holders").alias("weight"))
        rows = stored(rows.select("sig", "j", "key").join(typical, "sig"), self.folder, "shared-keys")
        top = rows.groupBy("j", "key").agg(F.max("weight").alias("weight"))
        centres = rows.join(top, ["j", "key", "weight"]).groupBy("j", "key").agg(F.min("sig").alias("centre"))
        pairs = rows.join(centres, ["j", "key"]).where("sig <> centre") \
            .select(F.least("sig", "centre").alias("a"), F.greatest("sig", "centre").alias("b")).distinct()
        fa = self.features.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("bits").alias("ma"))
        fb = self.features.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("mb"))
        return pairs.join(fa, "a").join(fb, "b").select("a", "b", "na", "ma", "nb", "mb") \
            .mapInArrow(_bounded(self.num, self.den), "a long, b long")

    def frequent_tokens(self):
        """The most frequent first shingles, at most ``FREQUENT``, sorted."""
        tokens = self.docs.select("doc_id", "text").mapInArrow(_prefixes(self.num, self.den), "token long, sig long")
        top = tokens.groupBy("token").count().where(F.col("count") >= FREQUENT_DF) \
            .orderBy(F.desc("count"), "token").limit(FREQUENT).select("token")
        return np.sort(np.array([r[0] for r in top.collect()], np.int64))

    def meetings(self) -> DataFrame:
        last = self.spark.sparkContext.broadcast(self.frequent_tokens())
        rows = self.docs.mapInArrow(_prefixes(self.num, self.den, last), "token long, sig long")
        return stored(rows.repartition("token").sortWithinPartitions("token", "sig")
                      .mapInArrow(_meetings, "token long, sig long"), self.folder, "meetings")

    def tile_pairs(self, meetings: DataFrame, labels: DataFrame, only_best: bool) -> DataFrame:
        """(a, b, more): pairs of different components in the tiles, bounded by
        their bitmaps."""
        name = "best" if only_best else "rest"
        rows = meetings.join(labels, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
        rows = stored(rows, self.folder, f"{name}-rows")
        open_tiles = rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                               F.count("*").alias("rows")).where("lo <> hi")
        open_tiles = open_tiles.select("token", F.ceil(F.col("rows") / TILE).cast("int").alias("blocks"))
        before = Window.partitionBy("sig").orderBy("token")
        earlier = [f"before{k}" for k in range(1, EARLIER + 1)]
        rows = rows.join(open_tiles, "token") \
            .select("*", *[F.lag("token", k).over(before).alias(name) for k, name in enumerate(earlier, 1)]) \
            .join(self.features, "sig")
        mine = F.pmod(F.xxhash64("sig"), F.col("blocks"))
        tiles = rows.withColumn("mine", mine) \
            .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))) \
            .select(F.xxhash64("token", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
                    F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1)
                    .otherwise(2).alias("side"), "sig", "comp", "n", "bits", *earlier)
        return tiles.repartition("tile").sortWithinPartitions("tile", "n") \
            .mapInArrow(_tile_pairs(self.num, self.den, only_best), "a long, b long, more boolean")

    def run(self) -> DataFrame:
        """(sig, comp): components of all classes with a link."""
        labels = self.relabel(self.verified(self.centre_pairs(), "centres"), "one")
        self.done("keys", "shared-keys", "centres-pairs", "centres-links")
        meetings = self.meetings()
        self.done()
        last = "meetings"
        for turn in range(ROUNDS):
            name = f"best{turn}"
            best = stored(self.tile_pairs(meetings, labels, True), self.folder, f"{name}-tiles")
            self.done("best-rows")
            links = self.verified(_either_way(best), name)
            labels = self.relabel(links, name)
            again = best.where("more").select(F.col("a").alias("sig")).distinct()
            tokens = meetings.join(again, "sig", "left_semi").select("token").distinct()
            meetings = stored(meetings.join(tokens, "token", "left_semi"), self.folder, f"{name}-meetings")
            found, left = not links.isEmpty(), not meetings.isEmpty()
            self.done(last, f"{name}-tiles", f"{name}-pairs", f"{name}-links", f"best{turn - 1}-labels" if turn else "one-labels")
            last = f"{name}-meetings"
            if not (found and left):
                break
        label = labels
        if left:
            rest = self.tile_pairs(meetings, labels, False)
            label = self.relabel(self.verified(_either_way(rest), "rest"), "three")
            self.done("rest-rows", "rest-pairs", "rest-links", f"{name}-labels")
        self.done(last)
        return label

    def done(self, *names: str) -> None:
        """Tables that the next steps don't read go, with the shuffles of the last ones."""
        dropped(self.spark, self.folder, *names)

    def classes(self) -> DataFrame:
        """(sig, comp, component_id): every class, its component and that
        component's smallest ``doc_id``."""
        labelled = self.reps.join(self.run(), "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
        least = labelled.groupBy("comp").agg(F.min("rep").alias("component_id"))
        return labelled.join(least, "comp").select("sig", "comp", "rep", "component_id")


def similarity_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    num: int = NUM, den: int = DEN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` (size of its
    set), ``component_id`` (smallest ``doc_id`` reachable by links)."""
    join = _Join(docs, id_col, text_col, num, den)
    classes = join.classes().select("sig", "component_id")
    return join.tab.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(classes, "sig", "left") \
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id"))
                .otherwise(F.col("doc_id")).alias("component_id"))


def _signed(text_at: int, name: str):
    """Rows as they are, with the signature of their set (null: empty set)."""
    def run(batches):
        for batch in slices(batches, text_at):
            values, at = shingle_sets(batch.column(text_at))
            signs = [_signature(values[at[r]:at[r + 1]]) if at[r + 1] > at[r] else None for r in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.int64())],
                                             [*batch.schema.names, name])
    return run


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             num: int = NUM, den: int = DEN) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest ``doc_id``
    (among repeated rows, one).  Rows with an empty set all stay."""
    classes = _Join(docs, id_col, text_col, num, den).classes()
    chosen = classes.groupBy("comp").agg(F.min_by("sig", F.struct(F.col("rep").isNull(), "rep", "sig")).alias("_s")) \
        .select("_s")
    sign = "_sig"
    while sign in docs.columns:
        sign += "_"
    kinds = T.StructType([*docs.schema.fields, T.StructField(sign, T.LongType())])
    rows = docs.mapInArrow(_signed(docs.columns.index(text_col), sign), kinds)
    first = Window.partitionBy(sign).orderBy(F.col(id_col).asc_nulls_last(), F.xxhash64(text_col))
    place = f"{sign}_place"
    kept = rows.join(chosen, rows[sign] == chosen["_s"], "left_semi") \
        .withColumn(place, F.row_number().over(first)).where(F.col(place) == 1)
    return kept.select(*docs.columns).unionByName(rows.where(F.col(sign).isNull()).select(*docs.columns))
