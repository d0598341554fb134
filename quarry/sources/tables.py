"""Tables in a shared store that appends and replaces leave whole.

A table is a folder.  ``_commits/<number>`` holds the name of the version folder
that became current with that number, and its schema; the highest one that is whole
counts.

* ``replace`` writes a new version folder and commits it afterwards: readers see
  the old version or the new one, never a part, and the new content may be computed
  from the table itself.  A commit file is created only if its number is free, so of
  two writers that started from the same version the second fails instead of undoing
  the first.
* ``append`` writes one batch of the current version as a partition of its own, with
  dynamic partition overwrite: tasks write to a staging folder, which Spark moves into place when the
  job commits.  Running the same batch again puts the same partition there, so a
  job that is run again after a failure adds nothing twice.
* Tasks that are repeated after a lost executor write new files; only committed
  task attempts are moved into place.

A version folder without a commit is what a failed job left; ``vacuum`` deletes
those and the versions before the current one.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch"
COMMITS = "_commits"


class _Store:
    """The few file operations needed, on any store that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, text: str):
        return self.jvm.org.apache.hadoop.fs.Path(text)

    def names(self, path: str) -> list[str]:
        at = self.path(path)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def text(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> None:
        stream = self.fs.create(self.path(path), False)         # fails where the file exists
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class Table:
    """One table; every call looks up the current version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.store = _Store(spark, self.path)

    def commits(self) -> list[tuple[int, str, str]]:
        """(number, version folder, schema) of all commits, oldest first."""
        found = []
        for name in self.store.names(f"{self.path}/{COMMITS}"):
            if re.fullmatch(r"\d{12}", name):
                folder, _, schema = self.store.text(f"{self.path}/{COMMITS}/{name}").partition("\n")
                if schema:
                    found.append((int(name), folder, schema))
        return found

    def exists(self) -> bool:
        return bool(self.commits())

    def _current(self) -> tuple[str, T.StructType]:
        commits = self.commits()
        if not commits:
            raise FileNotFoundError(f"no committed version of {self.path}")
        return f"{self.path}/{commits[-1][1]}", T.StructType.fromJson(json.loads(commits[-1][2]))

    def read(self) -> DataFrame:
        """The rows of the current version, columns in the order of its first batch."""
        folder, schema = self._current()
        whole = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
        return self.spark.read.schema(whole).parquet(folder).select(*[F.col(f"`{c}`") for c in schema.names])

    def replace(self, df: DataFrame, partition_by: list[str] | None = None, batch: str = "0") -> None:
        """Make ``df`` the whole content (also the first one).  It may read this table."""
        taken = [int(n) for n in self.store.names(f"{self.path}/{COMMITS}") if n.isdigit()]
        number = max(taken, default=0) + 1
        folder = f"v{number:012d}-{uuid.uuid4().hex}"
        self._write(df, f"{self.path}/{folder}", batch, partition_by)
        self.store.create(f"{self.path}/{COMMITS}/{number:012d}", f"{folder}\n{df.schema.json()}")

    def append(self, df: DataFrame, batch: str, partition_by: list[str] | None = None) -> None:
        """Add ``df`` as ``batch``.  A batch that is there already is put there anew
        (without rows, or in partitions without rows, it stays as it was)."""
        folder, schema = self._current()
        if set(df.columns) != set(schema.names):
            raise ValueError(f"columns {df.columns} are not those of the table, {schema.names}")
        # a value that its column can't hold fails the job
        same = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        self._write(same, folder, batch, partition_by)

    def _write(self, df: DataFrame, folder: str, batch: str, partition_by: list[str] | None) -> None:
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch name is letters, digits, '.', '_' and '-', not {batch!r}")
        if BATCH in df.columns:
            raise ValueError(f"{BATCH} is the table's own column")
        (df.withColumn(BATCH, F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(BATCH, *(partition_by or [])).parquet(folder))

    def vacuum(self) -> list[str]:
        """Delete version folders other than the current one; their names."""
        keep = self.commits()[-1][1]
        gone = [n for n in self.store.names(self.path) if re.fullmatch(r"v\d{12}-[0-9a-f]{32}", n) and n != keep]
        for name in gone:
            self.store.delete(f"{self.path}/{name}")
        return gone

    def drop(self) -> None:
        """Remove the table; nothing happens where there is none."""
        self.store.delete(self.path)
