"""Runs of consecutive equal states ("islands") and their lengths (analyses
4.1-4.4; survey ids E9, K1, D11, D16).

One stitched pass (``quarry.operators.ordered``) numbers the runs; they are
then grouped by (key, run id), which is one more exchange of the stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators import ordered as O
from quarry.operators._util import as_col, cols, ratio


def run_ids(df: DataFrame, key, ts: str, state: str, tie=None,
            name: str = "run_id") -> DataFrame:
    """Number the runs of equal consecutive ``state`` within each key: a
    change flag from LAG and its running sum, in one skew-safe pass (see
    ``quarry.operators.ordered``)."""
    return O.islands(df, key, [ts] + cols(tie), state, name)


def runs(df: DataFrame, key, ts: str, state: str, tie=None, unit: str = "MINUTE",
         include_open: bool = False, extra=None, end: str | None = None) -> DataFrame:
    """One row per run: key, state, run start/end and whole-unit length.

    Rows without an end (open stays) are dropped first unless
    ``include_open`` (ruling X5); consecutive rows with the same state are
    then merged, a run spanning from its first start to its last end."""
    if end is None:
        # the end is the next row's start; dropping a key's last (open) row
        # afterwards leaves every other row's predecessor unchanged, so run ids
        # and ends come from the same pass
        x = O.islands(df, key, [ts] + cols(tie), state, nxt=[ts])
        x = x.withColumnRenamed(f"next_{ts}", "end_ts")
        if not include_open:
            x = x.where(F.col("end_ts").isNotNull())
    else:
        x = df.withColumn("end_ts", F.col(end))
        if not include_open:
            x = x.where(F.col("end_ts").isNotNull())
        x = run_ids(x, key, ts, state, tie)
    if unit.upper() == "DAY":
        row_len = F.datediff(F.col("end_ts").cast("date"), F.col(ts).cast("date"))
    else:
        row_len = F.timestamp_diff(unit, F.col(ts), F.col("end_ts"))
    x = x.withColumn("_len", row_len)
    # a run's length is the time spent in its rows (gaps between rows excluded)
    return x.groupBy(*cols(key), "run_id").agg(
        F.first(state).alias(state),
        *[F.first(e).alias(e) for e in cols(extra)],
        F.min(ts).alias("run_start"),
        F.max("end_ts").alias("run_end"),
        F.sum("_len").alias("length"))


def run_durations(df: DataFrame, key, ts: str, state: str, tie=None, unit: str = "MINUTE",
                  by=None, end: str | None = None) -> DataFrame:
    """Mean closed-run length (4.3): exact sum / count."""
    r = runs(df, key, ts, state, tie, unit, extra=by, end=end)
    g = r.groupBy(*cols(by)) if cols(by) else r.groupBy()
    return g.agg(ratio(F.sum("length"), F.count(F.lit(1))).alias("avg_length"),
                 F.count(F.lit(1)).alias("n_runs"))


def duration_percentiles(df: DataFrame, by, value: str, ps=(0.5, 0.8, 0.95), partitions: int | None = None) -> DataFrame:
    """Interpolated percentiles of ``value`` per group (4.4, D16), exact, by
    distributed selection.

    Rows are counted per distinct value first (partial sums in every task).  The counts
    are dealt to ranges of (group, value), whose bounds Spark takes from a sample:
    a group with very many values spreads over many tasks.  One row per range and
    group has its number of rows; running sums over a group's ranges (at most
    ``partitions``, default ``spark.sql.shuffle.partitions``) say which ranges hold
    the two ranks around each percentile.  Only the counts of those ranges are
    summed value by value; no window covers a whole group.

    Sizes and counts have to come from one exchange (both read the same columns, so
    it is reused); a range whose counts don't add up to its size fails the query."""
    by = cols(by)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    v = as_col(value).cast("double")
    counts = df.where(v.isNotNull()).groupBy(*by, v.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    dealt = counts.repartitionByRange(n, *by, "_v").select(F.struct(F.lit(0).alias("_one"), *by).alias("_g"), "_v", "_c") \
        .withColumn("_part", F.spark_partition_id())
    cells = dealt.groupBy("_g", "_part").agg(F.sum("_c").alias("_n"), F.bit_xor(F.xxhash64("_v", "_c")).alias("_sum"))
    w = Window.partitionBy("_g").orderBy("_part")
    cells = cells.select("_g", "_part", "_n", "_sum", F.sum("_n").over(Window.partitionBy("_g")).alias("_all"),
                         (F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))

    def at(p):
        return (F.col("_all") - 1).cast("double") * F.lit(float(p))

    ranks = [rank(at(p)) for p in ps for rank in (F.floor, F.ceil)]         # counted from 0
    here = F.lit(False)
    for r in ranks:
        here = here | ((r >= F.col("_before")) & (r < F.col("_before") + F.col("_n")))
    x = dealt.join(cells.where(here), ["_g", "_part"])
    inside = Window.partitionBy("_g", "_part")
    upto = F.sum("_c").over(inside.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    whole = (F.sum("_c").over(inside) == F.col("_n")) & F.col("_sum").isNotNull()
    end = F.when(whole, F.col("_before") + upto) \
        .otherwise(F.raise_error(F.lit("duration_percentiles: counts were dealt twice with different bounds")).cast("bigint"))
    x = x.select("_g", "_v", "_c", "_all", end.alias("_end"))
    picked = [F.max(F.when((r < F.col("_end")) & (r >= F.col("_end") - F.col("_c")), F.col("_v"))).alias(f"_x{i}")
              for i, r in enumerate(ranks)]
    g = (x.groupBy("_g") if by else x.groupBy()).agg(F.max("_all").alias("_all"), *picked)
    out = []
    for i, p in enumerate(ps):
        lo, hi = F.col(f"_x{2 * i}"), F.col(f"_x{2 * i + 1}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at(p)) - at(p)) * lo + (at(p) - F.floor(at(p))) * hi)
                   .alias(f"p{int(round(p * 100))}"))
    return g.select(*[F.col(f"_g.{b}").alias(b) for b in by], *out)
