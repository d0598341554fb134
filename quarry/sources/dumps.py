"""Dumps of INSERT statements (A2): writer and distributed, quote-aware reader.

*Statements.*  A dump is text; a statement ends where a line ends with ``;`` outside
of quotes, and texts may hold ``;``, line feeds and doubled quotes.  Whether a line
starts inside a quote depends on all lines before it, which is an associative scan:
an odd number of quotes turns the state around, and a comment line (``--``) with an
odd number always ends outside (outside it is a comment, inside it closes the
text).  The scan runs inside each split of a file; one summary row a split carries
state and statement numbers across, so a file of any size is read by as many tasks
as it has splits.  A statement of one line is parsed where it lies; only those of
several lines are gathered (one group a statement).

*Values.*  ``INSERT INTO t [(columns)] VALUES (..), (..);`` with quoted texts, plain
numbers, booleans and NULL, each with an optional ``::type``.  A list of columns maps
values by name; columns that it leaves out are NULL.  What can't be read -- another
number of values, an unknown column, nested calls, a value that isn't of its type, a
statement without an end -- gives one row with the statement in ``bad`` and NULL
elsewhere.  Statements that aren't INSERTs, or go into other tables, are passed over;
comments take whole lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAD = "_bad"

# Texts in quotes (quotes inside are doubled), or anything else up to a comma.
_QUOTED = r"'[^']*+(?:''[^']*+)*+'"
_VALUE = rf"(?:{_QUOTED}|[^'(),]++)++"
_TUPLE = rf"\(((?:{_QUOTED}|[^'()]++)*+)\)"
_INSERT = r"(?is)^\s*INSERT\s+INTO\s+([\w.\"]+)\s*(?:\(([^)']*)\)\s*)?VALUES\s*(\(.*\))\s*;\s*$"
_INTO = r"(?is)^\s*INSERT\s+INTO\s+([\w.\"]+)"


def _literal(df: DataFrame, name: str) -> Column:
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        text = c.cast("string")
    elif isinstance(kind, T.BooleanType):
        text = F.upper(c.cast("string"))
    elif isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = F.concat(F.lit("'"), F.replace(c.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    else:
        raise TypeError(f"no literal for {name}: {kind.simpleString()}")
    return F.coalesce(text, F.lit("NULL"))


def write_dump(df: DataFrame, path: str, table: str) -> None:
    """One INSERT statement per row, in text files below ``path``; each task writes
    its own rows."""
    values = F.concat_ws(",", *[_literal(df, c) for c in df.columns])
    head = f"INSERT INTO {table}({','.join(df.columns)}) VALUES ("
    df.select(F.concat(F.lit(head), values, F.lit(");")).alias("value")) \
        .write.mode("errorifexists").option("lineSep", "\n").text(path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, at, line)``: every line with its split and its place in it."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("at"), F.col("value").alias("line")))


def statements(spark: SparkSession, path: str) -> DataFrame:
    """``(statement)``: every statement of the dump, with its final ``;`` (only one
    without an end lacks it); blank and comment lines between statements are left out."""
    x = _lines(spark, path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit("'"), F.lit("")))
    comment = F.col("line").rlike(r"^\s*--")
    x = x.select("*", quotes.alias("q"), comment.alias("comment"),
                 (comment & (quotes % 2 == 1)).alias("reset"), F.col("line").rlike(r";\s*$").alias("semi"))

    # inside a split: quotes since the last reset, counted before each line
    w = Window.partitionBy("file", "start").orderBy("at")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    x = x.withColumn("_sum", F.coalesce(F.sum("q").over(before), F.lit(0)))
    x = x.withColumn("_from", F.last(F.when(F.col("reset"), F.col("_sum") + F.col("q")), ignorenulls=True).over(before))
    x = x.withColumn("_turned", (F.col("_sum") - F.coalesce("_from", F.lit(0))) % 2 == 1)

    # one row a split: what it does to a state, as from outside (0) and from inside (1)
    end = F.struct("at")
    splits = x.groupBy("file", "start").agg(
        F.max_by(F.struct((F.col("_sum") + F.col("q")).alias("sum"),
                          F.when(F.col("reset"), F.col("_sum") + F.col("q")).otherwise(F.col("_from")).alias("from")), end).alias("e"))
    splits = splits.select("file", "start", F.col("e.from").isNotNull().alias("fixed"),
                           ((F.col("e.sum") - F.coalesce("e.from", F.lit(0))) % 2).cast("int").alias("turn"))
    ws = Window.partitionBy("file").orderBy("start")
    wb = ws.rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_t", F.coalesce(F.sum("turn").over(wb), F.lit(0)))
    splits = splits.withColumn("_f", F.last(F.when(F.col("fixed"), F.col("_t")), ignorenulls=True).over(wb))
    splits = splits.select("file", "start", ((F.col("_t") - F.coalesce("_f", F.lit(0))) % 2 == 1).alias("opens_inside"))
    x = x.join(splits, ["file", "start"])
    # after a reset inside the split, what was before the split no longer matters
    inside = F.when(F.col("_from").isNotNull(), F.col("_turned")).otherwise(F.col("_turned") != F.col("opens_inside"))
    x = x.withColumn("inside", inside)
    out = (F.col("inside").cast("int") + F.col("q")) % 2 == 0
    x = x.withColumn("ends", F.col("semi") & out & ~(F.col("comment") & ~F.col("inside")))

    x = x.where(F.col("inside") | ~(F.col("comment") | (F.trim("line") == "")))

    # statement numbers: ends before the line, in the split and in the splits before
    w = Window.partitionBy("file", "start").orderBy("at")
    x = x.withColumn("_n", F.coalesce(F.sum(F.col("ends").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    x = x.withColumn("_prev", F.lag("ends").over(w))
    carried = x.groupBy("file", "start").agg(F.sum(F.col("ends").cast("long")).alias("k"), F.max_by("ends", "at").alias("tail"))
    carried = carried.select("file", "start", F.coalesce(F.sum("k").over(wb), F.lit(0)).alias("_off"),
                             F.coalesce(F.lag("tail").over(ws), F.lit(True)).alias("_closed"))
    x = x.join(carried, ["file", "start"]).withColumn("number", F.col("_n") + F.col("_off"))

    # a line that is a statement of its own stays where it is
    x = x.withColumn("alone", F.col("ends") & F.coalesce("_prev", "_closed"))
    whole = x.where("alone").select(F.col("line").alias("statement"))
    parts = x.where("not alone").groupBy("file", "number") \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "at", "line"))), lambda r: r["line"]), "\n")
             .alias("statement")).select("statement")
    return whole.unionByName(parts)


def _value(token: Column) -> Column:
    """The text of one value; NULL for the word NULL."""
    bare = F.regexp_replace(F.trim(token), r"::[\w ]+$", "")
    quoted = bare.startswith("'")
    inner = F.replace(F.substring(bare, F.lit(2), F.length(bare) - 2), F.lit("''"), F.lit("'"))
    return F.when(quoted, inner).when(F.upper(bare) != "NULL", bare)


def read_dump(spark: SparkSession, path: str, schema: T.StructType | str, table: str) -> DataFrame:
    """The rows that a dump inserts into ``table``, with ``schema``, and ``_bad``: NULL,
    or the statement that could not be read."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = [f.name for f in schema.fields]
    x = statements(spark, path).where(F.col("statement").rlike(_INTO))
    into = F.replace(F.regexp_extract("statement", _INTO, 1), F.lit('"'), F.lit(""))
    x = x.where(F.lower(into) == table.lower())
    listed = F.regexp_extract("statement", _INSERT, 2)
    given = F.transform(F.split(listed, ","), lambda c: F.lower(F.replace(F.trim(c), F.lit('"'), F.lit(""))))
    values = F.regexp_extract("statement", _INSERT, 3)
    all_names = F.array(*[F.lit(n.lower()) for n in names])
    x = x.select("statement", F.when(F.trim(listed) == "", all_names).otherwise(given).alias("given"), values.alias("values"))
    x = x.withColumn("tuples", F.regexp_extract_all("values", F.lit(_TUPLE), 1))
    rest = F.regexp_replace("values", _TUPLE, "")
    known = F.size(F.array_except("given", all_names)) == 0
    fine = (F.col("values") != "") & (F.size("tuples") > 0) & known & rest.rlike(r"^[\s,]*$") \
        & (F.size(F.array_distinct("given")) == F.size("given"))
    x = x.withColumn("fine", fine)
    rows = x.where("fine").select("statement", "given", F.explode("tuples").alias("tuple"))
    rows = rows.select("statement", "given", F.transform(F.regexp_extract_all("tuple", F.lit(_VALUE), 0), _value).alias("v"),
                       F.size(F.regexp_extract_all(F.regexp_replace("tuple", _QUOTED, ""), F.lit(","), 0)).alias("commas"))
    typed, right = [], (F.size("v") == F.size("given")) & (F.col("commas") + 1 == F.size("v"))
    for field in schema.fields:
        at = F.array_position("given", field.name.lower())
        raw = F.when(at > 0, F.try_element_at("v", at.cast("int")))
        cast = raw if isinstance(field.dataType, T.StringType) else F.trim(raw).try_cast(field.dataType)
        right = right & (raw.isNull() | cast.isNotNull())
        typed.append(cast.alias(field.name))
    rows = rows.select(*typed, F.coalesce(right, F.lit(False)).alias("_right"), "statement")
    # of a statement with several rows, a bad row is reported with the statement; the others stay
    good = rows.select(*[F.when(F.col("_right"), F.col(f"`{n}`")).alias(n) for n in names],
                       F.when(~F.col("_right"), F.col("statement")).alias(BAD))
    bad = x.where("not fine").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], F.col("statement").alias(BAD))
    return good.unionByName(bad)
