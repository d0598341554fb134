"""Facts stored by key, so that joins and groupings on that key move nothing.

A bucketed table keeps the rows of a key in one of a fixed number of files, sorted
by key.  Two tables with as many buckets of the same key join bucket by bucket,
and a grouping by that key, or by it and more, stays inside a bucket: the facts are
shuffled once when they are stored instead of in every analysis.

``buckets`` is the unit of work: choose it so that a bucket fits a task (say one per 200 MB
of the larger table), the same for all tables that are joined.  A key that fills a
bucket by itself is not split by this layout; keep such facts in the plain one, where
adaptive execution splits skewed joins.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` by ``key`` and return it as a table of this session.

    The rows are dealt by the bucket hash before they are written, so each bucket is
    one file, however many tasks there were."""
    name = f"quarry_{uuid.uuid4().hex}"
    (df.repartition(buckets, F.col(key)).write.format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` stored, in another session; ``key`` and
    ``buckets`` as it was written."""
    name = f"quarry_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    return spark.table(name)


# Fixed value: rows of a fact that one task joins and groups by their key.
TASK_ROWS = 250_000


def dealt_by_key(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` over as many tasks as its rows need, so that the sorts and
    hash tables of the joins and groupings on ``key`` after it stay the same size
    whatever the input's.  Adaptive execution sizes tasks by compressed bytes, of
    which a few columns hold millions of rows.  Counting reads the files' footers
    only.  A table with no more than two such portions a core stays as it is; no fewer
    partitions than the session's are made, or the other side of a join would set
    their number."""
    spark = df.sparkSession
    n = -(-df.count() // TASK_ROWS)
    if n <= 2 * spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(max(n, int(spark.conf.get("spark.sql.shuffle.partitions"))), key)
