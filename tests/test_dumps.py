"""Dumps of INSERT statements: round trips and hand-made files."""

import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from quarry.sources import dumps

D = dt.date.fromisoformat
TOUGH = ["plain", "it's", "''", "'", "a;\nb", "x');\nINSERT INTO t(id) VALUES (9);", "--no comment", "line\n-- it's\nend",
         "(1, 2)", "NULL", "", None, "  padded  ", "\r\n;", "über, ß", "5::int", "long'" * 3000]
SCHEMA = "id int, name string, day date, price decimal(10,2), ok boolean, at timestamp_ntz"


@pytest.fixture
def table(spark):
    rows = [(i, s, D("2020-01-31"), decimal.Decimal("9.90"), i % 2 == 0, dt.datetime(2024, 1, 2, 3, 4, 5, i)) for i, s in enumerate(TOUGH)]
    return spark.createDataFrame([*rows, (None,) * 6], SCHEMA)


def written(tmp_path, text, name="dump.sql"):
    (tmp_path / name).write_bytes(text.encode())
    return f"file://{tmp_path / name}"


@pytest.mark.parametrize("split", [None, 64])
def test_round_trip_of_tough_texts(spark, table, tmp_path, split):
    """Also where a file is cut into many splits, in the midst of texts."""
    path = f"file://{tmp_path}/dump"
    dumps.write_dump(table.repartition(2), path, "shop.t")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = dumps.read_dump(spark, path, SCHEMA, "shop.t")
        if split:
            assert got.rdd.getNumPartitions() > 1
        assert got.where(F.col(dumps.BAD).isNotNull()).count() == 0
        assert sorted(map(tuple, got.drop(dumps.BAD).collect()), key=str) == sorted(map(tuple, table.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_hand_made_dump(spark, tmp_path):
    path = written(tmp_path, """--schema init; it's
DROP SCHEMA IF EXISTS shop CASCADE;

CREATE TABLE shop.t (
   id INT, name TEXT);

INSERT INTO shop.t(id, name)
VALUES
(0, 'trial'),
-- don't read this
(1, 'basic; or
-- not'),
  (2,null);
insert into "shop"."t" values (3, 'all', DATE);
INSERT INTO shop.t(name) VALUES ('by name');
INSERT INTO shop.t VALUES (4,'cast'::text),(5, 'two');
INSERT INTO shop.t(id,name) VALUES ('x1', 'wrong type');
INSERT INTO shop.t(id,nope) VALUES (6, 'unknown column');
INSERT INTO shop.t(id,name) VALUES (7);
INSERT INTO shop.t(id,name) VALUES (8, lower('NESTED'));
INSERT INTO other VALUES (1, 'z');
INSERT INTO shop.t(id,name) VALUES (10, ''), (11, ,'gap');
INSERT INTO shop.t(id,name) VALUES (9, 'no end')
""")
    got = dumps.read_dump(spark, path, "id int, name string", "shop.t").collect()
    good = sorted(((r["id"], r["name"]) for r in got if r[dumps.BAD] is None), key=str)
    assert good == sorted([(0, "trial"), (1, "basic; or\n-- not"), (2, None), (None, "by name"), (4, "cast"), (5, "two"), (10, "")], key=str)
    bad = [r for r in got if r[dumps.BAD] is not None]
    assert all(r["id"] is None and r["name"] is None for r in bad)
    assert sorted(r[dumps.BAD].split("(")[-1][:6] for r in bad) == sorted(["3, 'al", "'x1', ", "6, 'un", "7);", "'NESTE", "11, ,'", "9, 'no"])


def test_empty_dump(spark, tmp_path):
    got = dumps.read_dump(spark, written(tmp_path, "\n-- nothing\n"), "id int, name string", "t")
    assert got.collect() == [] and got.columns == ["id", "name", dumps.BAD]


def test_several_files_keep_their_own_quotes(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(6):
        tail = "INSERT INTO t(id) VALUES ('open" if i == 3 else ""
        (folder / f"{i}.sql").write_text(f"INSERT INTO t(id) VALUES ({i});\n" * 50 + tail)
    got = dumps.read_dump(spark, f"file://{folder}", "id int", "t")
    assert {(r["id"], r["count"]) for r in got.groupBy("id").count().collect()} == {*((i, 50) for i in range(6)), (None, 1)}
