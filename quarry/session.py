"""Session construction.

Configuration favours large clusters: AQE re-plans joins and partition counts
from runtime statistics, skew-join splitting is on, and the session time zone
is pinned to UTC so date/hour extraction is the same on every executor.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # post-shuffle partitions are sized from runtime statistics towards this
    # target, so a cluster-wide spark.sql.shuffle.partitions can stay high
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's baseline configuration."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(k, conf[k])
    return spark
