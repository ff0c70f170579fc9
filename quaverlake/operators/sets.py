"""Set operations with the assertions of catalog merges."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def union_disjoint(parts: list[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """(the union by name, keys that more than one row has)."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out, out.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def append_new(old: DataFrame, new: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(old and new rows, keys that the new rows repeat or that are there already); with such keys nothing should be appended."""
    repeats = new.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    clash = new.join(old.select(key), key, "left_semi").select(key).union(repeats).distinct()
    return old.unionByName(new.select(*old.columns)), clash


def same_set(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether two sets of keys are equal, and how many each has alone."""
    x = a.select(key, F.lit(1).alias("_a")).distinct()
    both = x.join(b.select(key, F.lit(1).alias("_b")).distinct(), key, "full")
    out = both.agg(F.count_if(F.col("_b").isNull()).alias("left_only"), F.count_if(F.col("_a").isNull()).alias("right_only"))
    return out.select(((F.col("left_only") == 0) & (F.col("right_only") == 0)).alias("equal"), "left_only", "right_only")


def first_seen(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each key with the place where it came first; an aggregate, so a frequent key leaves each task once."""
    return df.groupBy(key).agg(F.min(F.struct(*order)).alias("first")).select(key, "first.*")


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def same_multiset(a: Column, b: Column) -> Column:
    return F.sort_array(a) == F.sort_array(b)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.exceptAll(b)


def fold_supplements(base: DataFrame, supplements: DataFrame, key: str, value: str) -> DataFrame:
    """Applies supplements (key, seq, expected, value) in order of seq, each only if the value is then as expected.

    The writes of one key are folded in its array; keys don't depend on each other.
    """
    s = supplements.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "expected", F.col(value).alias("to")))).alias("_s"))
    folded = F.aggregate("_s", F.col(value), lambda acc, w: F.when(acc.eqNullSafe(w["expected"]), w["to"]).otherwise(acc))
    return base.join(s, key, "left").withColumn(value, F.when(F.col("_s").isNull(), F.col(value)).otherwise(folded)).drop("_s")


def shard_report(shards: DataFrame, total: int | None = None) -> DataFrame:
    """One row on shards (start, stop): their number, extent, and whether they are disjoint, without gaps and complete.

    Each shard is compared with the farthest stop before it, so an overlap doesn't make
    up for a gap. Complete shards cover [0, total); without a total their own extent.
    """
    before = F.max("stop").over(W.orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1))
    placed = shards.select("start", "stop", F.coalesce(before, F.col("start")).alias("reach"))
    complete = F.bool_and(F.col("start") <= F.col("reach"))
    if total is not None:
        complete = complete & (F.min("start") <= 0) & (F.max("stop") >= total)
    return placed.agg(
        F.count(F.lit(1)).alias("shards"),
        F.min("start").alias("first"),
        F.max("stop").alias("last"),
        F.bool_and(F.col("start") >= F.col("reach")).alias("disjoint"),
        F.bool_and(F.col("start") == F.col("reach")).alias("contiguous"),
        complete.alias("complete"),
    )


def edge_changes(old: DataFrame, new: DataFrame, added: DataFrame) -> DataFrame:
    """Edges (a, b, type) that break an extension: ``lost`` old ones, and ``foreign`` new ones that touch none of ``added`` (id)."""
    keys = ["a", "b", "type"]
    lost = old.join(new, keys, "left_anti").select(*keys, F.lit("lost").alias("fault"))
    fresh = new.join(old, keys, "left_anti")
    foreign = fresh.join(added.select(F.col("id").alias("a")), "a", "left_anti").join(added.select(F.col("id").alias("b")), "b", "left_anti")
    return lost.union(foreign.select(*keys, F.lit("foreign").alias("fault")))


def is_subset(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether every key of ``a`` is in ``b``, and how many aren't."""
    missing = a.select(key).distinct().join(b.select(key), key, "left_anti")
    return missing.agg((F.count(F.lit(1)) == 0).alias("subset"), F.count(F.lit(1)).alias("missing"))
