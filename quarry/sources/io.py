"""Sources and sinks.

Tables are read lazily from parquet so column pruning and filter pushdown reach
the scan.  CSV inputs are read with a declared schema, never inferred.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Declared schemas of the driver tables: reading with a schema skips footer
# inference at plan time (and pins the types the operators expect).
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table by name (A4), with its declared schema when
    known."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(path)


class Tables:
    """Lazy attribute access to the tables of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            df = load(self.spark, self.sf_dir, name)
            setattr(self, name, df)
            return df
        raise AttributeError(name)

    @cached_property
    def names(self) -> tuple[str, ...]:
        return DRIVER_TABLES


# Times in CSV files keep their microseconds.
CSV_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str,
             header: bool = True, null_value: str = "") -> DataFrame:
    """Header CSV with blank cells as NULL and a declared schema (A3).  A cell that
    isn't of its column's type fails the query."""
    return (spark.read.schema(schema)
            .options(header=header, nullValue=null_value, mode="FAILFAST", escape='"', **CSV_TIMES)
            .csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True, null_value: str = "") -> None:
    """CSV files that ``read_csv`` reads back; texts must hold no line feed."""
    df.write.mode("errorifexists").options(header=header, nullValue=null_value, escape='"', **CSV_TIMES).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """Materialise a derived table as plain files; ``quarry.sources.tables`` has the
    appends and replaces that can be run again."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
