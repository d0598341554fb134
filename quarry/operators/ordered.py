"""Ordered per-key computations that survive a hot key.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; a
key holding a third of the data would then be processed by a single task.
These helpers deal the rows to *cells*, one per key and time bucket (default:
a day of the leading order column), compute within the cells, and stitch the
cells of a key together through a summary:

* the rows are repartitioned by cell explicitly, so a partitioning that the
  input brings along (say from a join on the key) does not keep a key whole;
* the summary has one row per cell and comes from that same exchange;
* a window over the summary carries boundary values and offsets across the
  cells of a key, and a join on the cell brings them back; the rows already
  lie by cell, so only the summary moves.

Keys and buckets are compared as one struct, in which NULL equals NULL, so
NULL keys, times and states give what a plain window gives (NULL times come
first).  ``granularity`` may be "minute", "hour" (timestamps), "day", "week",
"month", ... or "value" (every value of the leading column is a bucket);
``None`` is the plain window, for keys known to be small.  ``"range"`` cuts keys at
quantiles of the whole order, measured by Spark from a sample of the rows: also a
key with all its rows on one day, or at one instant, spreads over many tasks, at the
price of one more exchange of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.dates import period_start
from quarry.operators._util import cols

CELL = "_cell"


def _order(order) -> list:
    return [F.col(o).asc() for o in cols(order)]


def _bucket(df: DataFrame, lead: str, granularity: str) -> Column:
    if granularity == "value":
        return F.col(lead)
    if not isinstance(df.schema[lead].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise ValueError(f"bucketing needs a date/timestamp leading order column, got {lead!r}; "
                         "pass granularity=None for a plain window")
    return period_start(lead, granularity)


def _changed(before: Column, now: Column) -> Column:
    return F.when(before.eqNullSafe(now), 0).otherwise(1)


def _plain(df: DataFrame, keys, order, prev, nxt, seq, runs_of, run_name, prefix) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    x = df.select("*", *[F.lag(c).over(w).alias(prefix[0] + c) for c in prev],
                  *[F.lead(c).over(w).alias(prefix[1] + c) for c in nxt])
    if seq:
        x = x.withColumn(seq, F.row_number().over(w).cast("bigint"))
    if runs_of:
        first = F.row_number().over(w) == 1
        x = x.withColumn("_chg", F.when(first, 1).otherwise(_changed(F.lag(runs_of).over(w), F.col(runs_of))))
        x = x.withColumn(run_name, F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_chg")
    return x


def stitched(df: DataFrame, key, order, prev=(), nxt=(), seq: str | None = None,
             runs_of: str | None = None, run_name: str = "run_id",
             granularity: str | None = "day", prefix=("prev_", "next_")) -> DataFrame:
    """One pass giving, within ``key`` in ``order``: LAG of ``prev`` columns,
    LEAD of ``nxt`` columns, the row number (``seq``) and the number of the
    run of equal consecutive ``runs_of`` values (``run_name``).  ``order`` has
    to be total for runs and neighbours to be determined."""
    keys, order, prev, nxt = cols(key), cols(order), cols(prev), cols(nxt)
    if granularity is None:
        return _plain(df, keys, order, prev, nxt, seq, runs_of, run_name, prefix)
    columns = df.columns
    if granularity == "range":
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartitionByRange(n, *_order(keys), *_order(order)).withColumn("_range", F.spark_partition_id())
        bucket = F.col("_range").alias("bucket")
    else:
        bucket = _bucket(df, order[0], granularity).alias("bucket")
    key_struct = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("key")
    rest = [c for c in df.columns if c not in keys]
    dealt = df.select(F.struct(key_struct, bucket).alias(CELL), *rest).repartition(CELL)

    # within the cells
    w = Window.partitionBy(CELL).orderBy(*_order(order))
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    x = dealt.withColumn("_rn", F.row_number().over(w))
    x = x.select("*", *[F.lag(c).over(w).alias("_p_" + c) for c in prev],
                 *[F.lead(c).over(w).alias("_n_" + c) for c in nxt])
    if runs_of:
        x = x.withColumn("_ch", F.when(F.col("_rn") == 1, 0)
                         .otherwise(_changed(F.lag(runs_of).over(w), F.col(runs_of))))
        x = x.withColumn("_in", F.sum("_ch").over(upto))

    # one row per cell.  The checksum reads every column beside the cell: with the
    # same columns on both branches the planner reuses the one exchange.
    at = F.struct(*order)
    lasts = list(dict.fromkeys([*prev, *([runs_of] if runs_of else [])]))
    firsts = list(dict.fromkeys([*nxt, *([runs_of] if runs_of else [])]))
    source = x if runs_of else dealt
    aggs = [F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(CELL, *rest)).alias("_sum")]
    if lasts:
        aggs.append(F.max_by(F.struct(*lasts), at).alias("_last"))
    if firsts:
        aggs.append(F.min_by(F.struct(*firsts), at).alias("_first"))
    if runs_of:
        aggs.append(F.sum("_ch").alias("_inside"))
    summary = source.groupBy(CELL).agg(*aggs)

    # across the cells of a key
    ws = Window.partitionBy(f"{CELL}.key").orderBy(F.col(f"{CELL}.bucket").asc())
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.col("_n").alias("_size"), "_sum", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    if lasts:
        carried.append(F.lag("_last").over(ws).alias("_pl"))
    if firsts:
        carried.append(F.lead("_first").over(ws).alias("_nf"))
    if runs_of:
        opens = F.when(F.row_number().over(ws) == 1, 1) \
            .otherwise(_changed(F.lag("_last").over(ws)[runs_of], F.col("_first")[runs_of]))
        summary = summary.withColumn("_opens", opens)
        carried += ["_opens", F.coalesce(F.sum(F.col("_opens") + F.col("_inside")).over(before), F.lit(0))
                    .alias("_roff")]
    x = x.join(summary.select(CELL, *carried), CELL, "left" if granularity == "range" else "inner")
    if granularity == "range":
        # bounds that were taken twice would give other cells than were summed up
        whole = F.count(F.lit(1)).over(Window.partitionBy(CELL)) == F.col("_size")
        x = x.withColumn("_rn", F.when(whole & F.col("_sum").isNotNull(), F.col("_rn")).otherwise(
            F.raise_error(F.lit("stitched: rows were dealt twice with different bounds")).cast("int")))
    else:
        x = x.where(F.col("_sum").isNotNull())

    out = [F.when(F.col("_rn") == 1, F.col("_pl")[c]).otherwise(F.col("_p_" + c)).alias(prefix[0] + c) for c in prev]
    out += [F.when(F.col("_rn") == F.col("_size"), F.col("_nf")[c]).otherwise(F.col("_n_" + c))
            .alias(prefix[1] + c) for c in nxt]
    if seq:
        out.append((F.col("_off") + F.col("_rn")).cast("bigint").alias(seq))
    if runs_of:
        out.append((F.col("_roff") + F.col("_opens") + F.col("_in")).alias(run_name))
    kept = [F.col(f"{CELL}.key.k{keys.index(c)}").alias(c) if c in keys else F.col(c) for c in columns]
    return x.select(*kept, *out)


def row_number(df: DataFrame, key, order, name: str, granularity: str | None = "day") -> DataFrame:
    """Position of each row within its key (ROW_NUMBER), skew-safe."""
    return stitched(df, key, order, seq=name, granularity=granularity)


def islands(df: DataFrame, key, order, state: str, name: str = "run_id", nxt=(),
            granularity: str | None = "day") -> DataFrame:
    """Run number of equal consecutive ``state`` values (plus optional LEAD
    columns), in one stitched pass."""
    return stitched(df, key, order, nxt=nxt, runs_of=state, run_name=name, granularity=granularity)


def dense_rank_of(df: DataFrame, key, value: str, name: str) -> DataFrame:
    """DENSE_RANK of ``value`` within ``key``: in order of the value, the number
    of its run of equal values.  Every value is a cell of its own."""
    return stitched(df, key, value, runs_of=value, run_name=name, granularity="value") \
        .withColumn(name, F.col(name).cast("bigint"))


def total_row_number(df: DataFrame, order, name: str, partitions: int | None = None) -> DataFrame:
    """Number all rows from 1 in ``order`` (ROW_NUMBER without PARTITION BY, E4).

    Range-partitioned prefix counts: the rows are dealt to ranges of the whole
    order, whose bounds Spark takes from a sample, so that rows of one day, or of
    one value of any but the last order column, spread over all tasks.  Each range is sorted
    where it lies; a row's number is its place in its range plus the sizes of the
    ranges before.  One exchange of the rows; beside them only one row a range
    moves.  Numbers are determined where ``order`` is total; rows that are equal in
    all of it share a task and are numbered in any order.  NULLs come first.

    Sizes and rows have to come from the same exchange.  It is reused because both
    read the same columns (``_sum``); should a plan deal the rows twice, bounds may
    differ, and a row outside the bounds that were counted for its range fails the
    query instead of getting a wrong number.  ``partitions`` is the number of
    ranges (default: ``spark.sql.shuffle.partitions``)."""
    order = cols(order)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*order)
    dealt = df.repartitionByRange(n, *_order(order))
    sizes = dealt.groupBy(F.spark_partition_id().alias("_part")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(key).alias("_first"), F.max(key).alias("_last"),
        F.bit_xor(F.xxhash64(*df.columns)).alias("_sum"))
    # n rows at most: small enough for one task and for a broadcast
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", "_first", "_last", "_sum", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = dealt.sortWithinPartitions(*_order(order)).withColumn("_at", F.monotonically_increasing_id())
    # the upper bits of _at are the partition, the lower 33 the place in it
    x = placed.withColumn("_part", F.shiftright("_at", 33).cast("int")).join(F.broadcast(sizes), "_part", "left")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    counted = (key >= F.col("_first")) & (key <= F.col("_last")) & F.col("_sum").isNotNull()
    number = F.when(counted, F.col("_before") + place) \
        .otherwise(F.raise_error(F.lit("total_row_number: rows were dealt twice with different bounds")).cast("bigint"))
    return x.select(*df.columns, number.cast("bigint").alias(name))
