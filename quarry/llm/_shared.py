"""Helpers shared by the corpus operators: tables written to the shared folder,
stable row ids inside a group, and Arrow column access."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def known_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package also where it is not installed
    and the driver was started elsewhere (local runs; harmless otherwise)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    now = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in now.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, now]))


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below the one the cluster shares.

    ``spark.checkpoint.dir`` is read from the session.  Where it is unset a
    scratch folder is made, in local mode only (as in tests); a cluster without
    a shared folder is an error, because a machine-local one would be lost with
    its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="quarry-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quarry-{uuid.uuid4().hex}"


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write ``df`` as Parquet to ``folder``/``name`` and read it back: cuts the
    lineage, survives lost executors and is compressed, unlike a checkpoint.  The
    write's shuffle files go with its end: nothing reads them again."""
    path, conf = f"{folder}/{name}", df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, folder: str, *names: str) -> None:
    """Delete stored tables that nothing reads any more, and have the shuffle files of
    finished jobs removed: Spark's cleaner removes them once the JVM has collected
    the plans that made them, which without much allocation on the driver can take long."""
    jvm = spark.sparkContext._jvm
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column without copying; nulls are
    empty.  ``offsets`` has one entry more than the column."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1] \
        if offsets is not None else np.zeros(len(column) + 1, kind)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


_kept: dict = {}            # what this worker keeps between its tasks


def kept(key, build):
    """What ``build`` made for ``key`` in this worker process.  One thing is kept at a
    time: that of another key goes before a new one is built."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = build()
    return _kept[key]


SLICE = 1 << 20             # bytes of text that array work handles at a time


def slices(batches, at: int, keeps: bool = False):
    """The batches in runs of rows with about ``SLICE`` bytes of the text column
    ``at``: arrays over words are several times as large as the text.  Workers serve
    one operator after the other: unless the task itself ``keeps`` something in its
    worker, what an earlier operator kept there goes."""
    if not keeps:
        _kept.clear()
    for batch in batches:
        _, offsets = text_bytes(batch.column(at))
        row = 0
        while row < batch.num_rows:
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1)
            yield batch.slice(row, last - row)
            row = last


def list_array(values: np.ndarray, pointers: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from flat values and row pointers."""
    return pa.ListArray.from_arrays(pa.array(pointers, pa.int32()), pa.array(values, kind))
