"""Document fingerprints: bottom-k sketches of shingle hashes, in SQL functions only.

A text's words (lower case, split at white space) give five-word shingles; with
fewer words the whole sequence is the one shingle.  Its sketch is the sorted
array of the ``K`` smallest distinct 64-bit shingle hashes.  Sketches merge
(``merged``, ``merge_groups``): the sketch of a union is the K smallest of both,
so parts of a text or of a corpus can be sketched apart, provided no shingle
runs over the cut.  Two sketches estimate

* ``resemblance``: of the K smallest hashes of the union, the share in both;
* ``containment`` of the first in the second: from the same share and the sizes;
* ``distinct_count``: exact below K hashes, else ``(K - 1) / `` the K-th
  smallest hash as a part of the hash range.

All are exact as long as neither set has more than K shingles.

``fingerprint_edits`` compares every document with an edited copy of itself and
with the next document.  Its rows are cut at quantiles of the id into ranges
of about ``RANGE`` rows; the first row of each range is also dealt to the range
that ends before it, so a single exchange of the texts brings every row
together with its successor and no range depends on another.

Null text is empty; an empty text has the empty sketch (resemblance 1 with
another empty one, else 0).  Null ids come last in the order; rows of equal id
are ordered by their text.  A single row is its own successor.  Columns with
other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
WIDTH = 5
RANGE = 4096
MOST_RANGES = 1 << 16
DIGITS = 12                 # hex digits of a hash in the printed form


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Array of the distinct shingle hashes (bigint) of a text."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")

    def of_words(w: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(w) - width),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
        few = F.array(F.xxhash64(F.array_join(w, " ")))
        return F.when(F.size(w) >= width, many).when(F.size(w) > 0, few) \
            .otherwise(F.array().cast("array<bigint>"))
    # the words are bound once, whatever the engine makes of the expression
    return F.array_distinct(F.flatten(F.transform(F.array(words), of_words)))


def sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Bottom-k sketch of a text: sorted array<bigint> of at most ``k`` hashes."""
    return F.slice(F.sort_array(shingle_hashes(text, width)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(df: DataFrame, keys: list[str], sketch_col: str, k: int = K) -> DataFrame:
    """One merged sketch per group.  Hashes are made distinct and cut to the k
    smallest of a group within each task first, so a large group sends k hashes a
    task.  Groups without any hash get the empty sketch."""
    hashes = df.select(*keys, F.explode(sketch_col).alias("_hash")).distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    least = hashes.withColumn("_place", place).where(F.col("_place") <= k) \
        .groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col))
    groups = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)]).distinct()
    same = [F.col(f"_k{i}").eqNullSafe(F.col(c)) for i, c in enumerate(keys)]
    joined = groups.join(least, same, "left")
    return joined.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keys)],
                         F.coalesce(sketch_col, F.array().cast("array<bigint>")).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B| of the sketched sets, 0 to 1."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles of the sketched set."""
    last = F.element_at(a, -1).cast("double") + F.lit(2.0**63)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit((k - 1) * 2.0**64) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A|: how much of the first set lies in the second."""
    share = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share / distinct_count(a, k)))


def printed(a: Column) -> Column:
    """A sketch as text: its number of hashes and their leading hex digits."""
    head = F.transform(a, lambda h: F.lpad(F.hex(F.shiftrightunsigned(h, 64 - 4 * DIGITS)), DIGITS, "0"))
    return F.concat(F.size(a).cast("string"), F.lit(":"), F.array_join(head, ""))


def _cuts(docs: DataFrame) -> list[int]:
    """Ids at which ranges end (their largest ids), at most ``MOST_RANGES``;
    the largest id of all is the last."""
    rows = docs.agg(F.count("doc_id")).first()[0]
    if not rows:
        return []
    n = max(1, min(MOST_RANGES, rows // RANGE))
    parts = ", ".join(repr(i / n) for i in range(1, n + 1))
    found, top = docs.agg(F.expr(f"percentile_approx(doc_id, array({parts}), 100000)"), F.max("doc_id")).first()
    return sorted(set(found) | {top})


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """Per row: its fingerprint, that of the text whose last half is replaced by
    the head of the next row's text (ids descending, the last followed by the
    first), and the resemblance to the edited and to the next text."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cuts = _cuts(rows)
    low = F.lit(-1)                                  # the range of null ids, behind all others
    if cuts:
        ends = F.expr(f"transform(split('{','.join(map(str, cuts))}', ','), x -> cast(x as bigint))")
        # binary search: how many range ends lie below the id
        steps = max(1, len(cuts).bit_length())
        below = F.aggregate(
            F.array(*[F.lit(1 << s) for s in reversed(range(steps))]), F.lit(0),
            lambda at, step: F.when((at + step <= len(cuts)) & (F.get(ends, at + step - 1) < F.col("doc_id")), at + step)
            .otherwise(at))
        spot = F.when(F.col("doc_id").isNull(), low).otherwise(below)
        is_end = F.col("doc_id").eqNullSafe(F.get(ends, F.greatest(spot, F.lit(0))))
        top = len(cuts) - 1
    else:
        spot, is_end, top = low, F.lit(False), -1
    has_null = rows.where("doc_id is null").limit(1).count() > 0
    bottom = -1 if has_null or not cuts else 0
    # the rows of a range's largest id (and all without id) also end the range
    # before (above) it; those of the first range end the last one
    above = F.when(F.col("range") == top, F.lit(bottom)).otherwise(F.col("range") + 1)
    leads = F.col("is_end") | F.col("doc_id").isNull()
    dealt = rows.withColumn("range", spot).withColumn("is_end", is_end) \
        .withColumn("to", F.explode(F.when(leads, F.array(
            F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")),
            F.struct(above.alias("range"), F.lit(True).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("guest")))))) \
        .select("doc_id", "text", F.col("to.range").alias("range"), F.col("to.guest").alias("guest"))
    order = Window.partitionBy("range").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    known = dealt.repartition("range").withColumn("sketch", sketch(F.col("text"), k))
    paired = known.select("doc_id", "text", "guest", "sketch",
                          F.lead("text").over(order).alias("next_text"),
                          F.lead("sketch").over(order).alias("next_sketch")).where(~F.col("guest"))
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - half),
                      F.substring(F.col("next_text"), F.lit(1), half))
    out = paired.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), k))
    return out.select("doc_id", size.cast("long").alias("n_chars"),
                      F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      printed(F.col("sketch")).alias("fingerprint"),
                      printed(F.col("edited_sketch")).alias("edited_fingerprint"),
                      resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
                      resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
                      distinct_count(F.col("sketch"), k).alias("shingles"),
                      containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained"))
