"""Comma-list columns: counting, lookups, labels and multiset merges
(analyses 2.17-2.21, 2.26; survey ids H9-H12, D14, D15, D19, J5).

Counting and merging the ids of one row stays inside array expressions.  Names
are looked up by position in small, dense dimensions and through a dictionary of
the distinct lists otherwise (``Names``); either way the fact is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import split_ids
from quarry.operators._util import as_col, cols


def with_id_lists(df: DataFrame, columns: dict, sep: str = ",") -> DataFrame:
    """Parse text lists ('1, 4', '', 'null') into array<int> columns."""
    out = df
    for src, dst in columns.items():
        out = out.withColumn(dst, split_ids(src, sep))
    return out


class Names:
    """Names of the ids of a dimension, looked up in list columns.

    *Small, dense dimensions.*  Where there are at most ``MOST_IDS`` ids, as near to
    each other as that and each with one name -- a limited read of the dimension
    finds out -- the names are one constant array by id, and rows look their ids up by
    position: the fact is read once and nothing of it moves.

    *Any other dimension.*  Each distinct list is looked up once: the dictionary of lists
    is made from the rows' own exchange (dealt by a hash of the whole row, so no
    list is a hot key), its ids are joined with the dimension and gathered again
    (a list's own ids, so a bounded group), and the texts are joined back by a
    hash of the list and the list itself.  Both branches read the one exchange, so
    what the rows were made from is still computed once."""

    MOST_IDS = 4096

    def __init__(self, dim: DataFrame, key: str, value: str):
        self.dim = dim.select(F.col(key).alias("_id"), F.col(value).alias("_name")) \
            .where(F.col("_id").isNotNull() & F.col("_name").isNotNull())
        # one row more than is allowed tells a larger dimension
        some = self.dim.limit(self.MOST_IDS + 1).collect()
        ids = [r["_id"] for r in some]
        self.empty = not some
        self.small = len(some) <= self.MOST_IDS and len(set(ids)) == len(ids) and all(isinstance(i, int) for i in ids) \
            and max(ids, default=0) - min(ids, default=0) < self.MOST_IDS
        if self.small and some:
            self.low, self.high = min(ids), max(ids)
            named = {r["_id"]: r["_name"] for r in some}
            self.names = F.lit([named.get(i) for i in range(self.low, self.high + 1)])

    def add(self, df: DataFrame, lists: dict, text) -> DataFrame:
        """``df`` with one text column per entry of ``lists`` (output name -> list
        column): ``text`` of the array of names of the list's known ids, NULL where
        there is none."""
        if self.empty:
            return df.select("*", *[F.lit(None).cast("string").alias(out) for out in lists])
        if self.small:
            return self._add_by_position(df, lists, text)
        return self._add_by_dictionary(df, lists, text)

    def _add_by_position(self, df, lists, text):
        # an id beyond the ends has no name, like one between that is missing
        df = df.select("*", *[F.when(F.size(c) > 0, F.transform(c, lambda i: F.get(self.names, (i - self.low).cast("int"))))
                              .alias(f"_names_{out}") for out, c in lists.items()])
        found = {out: text(F.col(f"_names_{out}")) for out in lists}
        return df.select("*", *[F.when(t != "", t).alias(out) for out, t in found.items()]).drop(*[f"_names_{out}" for out in lists])

    def _add_by_dictionary(self, df, lists, text):
        columns = df.columns
        coded = df.select("*", *[F.when(F.size(c) > 0, F.xxhash64(c)).alias(f"_code_{out}") for out, c in lists.items()])
        dealt = coded.withColumn("_row", F.xxhash64(*[F.col(f"`{c}`") for c in columns])).repartition("_row")
        # every column is read in both branches, so the planner reuses the one exchange
        entries = dealt.select(F.explode(F.array(*[F.struct(F.col(f"_code_{out}").alias("code"), F.col(c).alias("ids"))
                                                   for out, c in lists.items()])).alias("e"),
                               F.xxhash64(*dealt.columns).alias("_sum"))
        words = entries.where("e.code is not null").groupBy("e.code", "e.ids").agg(F.bit_xor("_sum").alias("_sum"))
        texts = words.select("code", "ids", F.explode("ids").alias("_id")).join(self.dim, "_id") \
            .groupBy("code", "ids").agg(text(F.collect_list("_name")).alias("_text"))
        out = dealt
        for name, c in lists.items():
            found = texts.select(F.col("code").alias(f"_code2_{name}"), F.col("ids").alias(f"_list_{name}"), F.col("_text").alias(name))
            same = (F.col(f"_code_{name}") == F.col(f"_code2_{name}")) & (F.col(f"`{c}`") == F.col(f"_list_{name}"))
            out = out.join(found, same, "left")
        return out.select(*[F.col(f"`{c}`") for c in columns], *lists)


def _joined(sep: str):
    return lambda names: F.array_join(F.sort_array(names), sep)


def _counted(names: Column) -> Column:
    """'2xA, B': each name once, with its count in front of it when above 1, by name."""
    def item(one):
        n = F.size(F.filter(names, lambda other: other == one))
        return F.concat(F.when(n > 1, F.concat(n.cast("string"), F.lit("x"))).otherwise(F.lit("")), one)
    once = F.array_distinct(names)
    return F.when(F.size(once) == F.size(names), F.array_join(F.sort_array(names), ", ")) \
        .otherwise(F.array_join(F.transform(F.sort_array(once), item), ", "))


def with_names(df: DataFrame, list_col: str, dim: DataFrame, key: str, value: str, out: str,
               sep: str = ", ") -> DataFrame:
    """Add the sorted, joined names of an id list (2.17, D14, D15); NULL when
    the list is NULL or empty or holds no known id."""
    return Names(dim, key, value).add(df, {out: list_col}, _joined(sep))


def list_item_counts(df: DataFrame, list_col: str, dim: DataFrame, key: str, value: str,
                     name: str = "n") -> DataFrame:
    """How often each id occurs in a list column, with its name (2.18).

    explode + groupBy(id) aggregates map-side, so the shuffle carries one
    partial row per id per task; the dimension is joined after aggregation."""
    ids = df.select(F.explode(F.col(list_col)).alias(key)).where(F.col(key).isNotNull())
    c = ids.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    # joined after aggregation (one row per id); AQE picks the join strategy
    return c.join(dim.select(key, value), key, "left")


def order_line_label(df: DataFrame, base: str, minus: str, plus: str, dim: DataFrame, key: str,
                     value: str, out: str = "label") -> DataFrame:
    """'<base> - Exclude a, b - Extra c' per line (2.19, ruling X18: per line)."""
    x = Names(dim, key, value).add(df, {"_minus": minus, "_plus": plus}, _joined(", "))
    label = F.concat_ws("", F.col(base), F.concat(F.lit(" - Exclude "), F.col("_minus")),
                        F.concat(F.lit(" - Extra "), F.col("_plus")))
    return x.withColumn(out, label).drop("_minus", "_plus")


def merged_ids(recipe: str, minus: str, plus: str) -> Column:
    """Recipe and extras together, without what is excluded, as an id array
    (2.20, 2.21).  An excluded id goes from the extras too; repeats stay."""
    empty = F.array().cast("array<int>")
    excluded = F.coalesce(F.col(minus), empty)
    both = F.concat(F.coalesce(F.col(recipe), empty), F.coalesce(F.col(plus), empty))
    return F.when(F.size(excluded) > 0, F.filter(both, lambda i: ~F.coalesce(F.array_contains(excluded, i), F.lit(False)))) \
        .otherwise(both)


def merged_ingredient_list(df: DataFrame, base: str, recipe: str, minus: str, plus: str,
                           dim: DataFrame, key: str, value: str, out: str = "ingredients") -> DataFrame:
    """'<base>: 2xA, B, C' per line: recipe plus extras minus exclusions,
    each name once with its count as a prefix when above 1, sorted by name
    (2.20, ruling X19: keyed by line)."""
    x = df.withColumn("_ids", merged_ids(recipe, minus, plus))
    x = Names(dim, key, value).add(x, {"_text": "_ids"}, _counted)
    return (x.withColumn(out, F.concat(F.col(base), F.lit(": "), F.coalesce("_text", F.lit(""))))
             .drop("_ids", "_text"))


def ingredient_totals(df: DataFrame, recipe: str, minus: str, plus: str, dim: DataFrame,
                      key: str, value: str, name: str = "n_used") -> DataFrame:
    """Total use of each ingredient over all lines (2.21): partial counts per
    id, then the name."""
    ids = df.select(F.explode(merged_ids(recipe, minus, plus)).alias(key))
    c = ids.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return c.join(dim.select(key, value), key, "left")


def append_all_items_row(recipes: DataFrame, dim: DataFrame, id_col: str, list_col: str,
                         key: str, new_id_offset: int = 1) -> DataFrame:
    """Add one recipe made of every ingredient (2.26): id = max id + offset,
    list = all dimension ids in ascending order, as comma text.  The new row is
    one text, so the dimension has to be one that a text can list."""
    new = (dim.agg(F.array_join(F.array_sort(F.collect_list(F.col(key))), ", ").alias(list_col))
           .withColumn(id_col, recipes.select(F.max(id_col) + new_id_offset).scalar()))
    return recipes.unionByName(new.select(id_col, list_col))


def revenue(df: DataFrame, price: Column, extras: str | None = None,
            surcharge: float = 0.0, special: dict | None = None, by=None,
            name: str = "revenue", unpriced: str = "n_unpriced") -> DataFrame:
    """sum(price + surcharge per extra) (2.22, 2.23); ``special`` maps an
    extra id to its own surcharge.  Lines without a price count as
    ``unpriced``; their extras are charged all the same."""
    add = F.lit(0)
    if extras:
        sp = special or {}
        per = F.aggregate(F.coalesce(F.col(extras), F.array().cast("array<int>")),
                          F.lit(0).cast("decimal(10,2)"),
                          lambda acc, i: (acc + _charge(i, surcharge, sp))
                          .cast("decimal(10,2)"))
        add = per
    g = df.groupBy(*cols(by)) if cols(by) else df.groupBy()
    p = as_col(price)
    return g.agg(F.sum(F.coalesce(p, F.lit(0)) + add).cast("double").alias(name),
                 F.count_if(p.isNull()).alias(unpriced))


def _charge(i: Column, default: float, special: dict) -> Column:
    c = None
    for k, v in special.items():
        c = F.when(i == k, F.lit(v)) if c is None else c.when(i == k, F.lit(v))
    d = F.lit(default)
    return (d if c is None else c.otherwise(d)).cast("decimal(10,2)")
