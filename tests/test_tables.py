"""The table protocol: replaces and appends that can be run again."""

import os

import pytest
from pyspark.sql import functions as F

from fixtures import rows
from quarry.sources.tables import BATCH, COMMITS, Table


@pytest.fixture
def table(spark, tmp_path):
    return Table(spark, f"file://{tmp_path}/shop")


def numbers(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id int, name string")


def test_append_twice_adds_once(spark, table):
    table.replace(numbers(spark, 1, 2))
    for _ in range(2):
        table.append(numbers(spark, 3, 4), "monday")
    table.append(numbers(spark, 4), "tuesday")
    assert rows(table.read(), "id", "name") == [(1, "n1"), (2, "n2"), (3, "n3"), (4, "n4"), (4, "n4")]
    table.append(numbers(spark, 5), "monday")                    # other content under the same name
    assert rows(table.read(), "id") == [(1,), (2,), (4,), (5,)]


def test_replace_reads_its_own_target(spark, table):
    table.replace(numbers(spark, 1, 2, 3))
    before = table.read()
    table.replace(before.where("id > 1").withColumn("id", F.col("id") * 10))
    assert rows(table.read(), "id", "name") == [(20, "n2"), (30, "n3")]
    assert rows(before, "id") == [(1,), (2,), (3,)]              # a reader of the old version goes on
    assert len(table.vacuum()) == 1 and rows(table.read(), "id") == [(20,), (30,)]


def test_a_failed_replace_changes_nothing(spark, table):
    table.replace(numbers(spark, 1))
    broken = numbers(spark, 1, 2).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert rows(table.read(), "id") == [(1,)] and len(table.commits()) == 1
    with pytest.raises(Exception, match="lost"):
        table.append(broken, "b")
    assert rows(table.read(), "id") == [(1,)]
    assert len(table.vacuum()) == 1


def test_the_second_of_two_writers_fails(spark, table, tmp_path):
    table.replace(numbers(spark, 1))
    taken = tmp_path / "shop" / COMMITS / f"{2:012d}"
    real = table.store.names
    table.store.names = lambda path: [n for n in real(path) if n != taken.name]      # has looked before the other's commit
    Table(spark, table.path).replace(numbers(spark, 2))
    with pytest.raises(Exception, match="(?i)exist"):
        table.replace(numbers(spark, 3))
    assert rows(Table(spark, table.path).read(), "id") == [(2,)]


def test_a_commit_without_content_does_not_count(spark, table, tmp_path):
    table.replace(numbers(spark, 1))
    (tmp_path / "shop" / COMMITS / f"{2:012d}").write_text("")
    assert rows(table.read(), "id") == [(1,)]
    table.replace(numbers(spark, 2))
    assert [n for n, *_ in table.commits()] == [1, 3] and rows(table.read(), "id") == [(2,)]


def test_partitions_empty_batches_and_types(spark, table, tmp_path):
    table.replace(numbers(spark).limit(0))
    assert table.read().collect() == [] and table.read().dtypes == [("id", "int"), ("name", "string")]
    table.append(spark.createDataFrame([("n7", 7), ("07", 8), (None, 9)], "name string, id long"), "b1", ["name"])
    assert sorted(rows(table.read(), "id", "name"), key=str) == [(7, "n7"), (8, "07"), (9, None)]
    assert os.path.isdir(tmp_path / "shop" / table.commits()[-1][1] / f"{BATCH}=b1" / "name=n7")
    with pytest.raises(ValueError):
        table.append(numbers(spark, 1).withColumn("more", F.lit(1)), "b2")
    with pytest.raises(ValueError):
        table.append(numbers(spark, 1), "../b2")
    table.drop()
    assert not table.exists()
    table.drop()
    with pytest.raises(FileNotFoundError):
        table.read()
