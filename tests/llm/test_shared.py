from pyspark.sql import functions as F

from quarry.llm import _shared


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_shuffles_of_a_stored_table_go_with_its_write(spark):
    """Without waiting for the driver to collect its garbage; later reads are whole."""
    import time
    before, setting = shuffle_files(spark), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    rows = spark.range(5000).withColumn("k", F.col("id") % 700).groupBy("k").agg(F.sum("id").alias("s")).repartition(3, "s")
    kept = [_shared.stored(rows, _shared.shared_dir(spark), "a") for _ in range(2)]     # the plan can be run again
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert [t.agg(F.sum("s")).first()[0] for t in (*kept, rows)] == [5000 * 4999 // 2] * 3
