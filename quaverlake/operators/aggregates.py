"""Grouped summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key by some columns: an aggregate, so it is combined before the shuffle."""
    rest = [c for c in df.columns if c != key and c not in order]
    return df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("_m")).select(key, "_m.*")


def collapse(df: DataFrame, key: list[str], members: str, identity: list[str]) -> DataFrame:
    """One row a key with its distinct members in order; ``drift`` tells that its identity columns differ."""
    whole = F.struct(*identity)
    return df.groupBy(*key).agg(
        F.array_sort(F.collect_set(members)).alias(members), *(F.min(c).alias(c) for c in identity), (F.count_distinct(whole) > 1).alias("drift")
    )


def conflicts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("variants"), F.array_sort(F.collect_set(value)).alias("seen")).where("variants > 1")


def duplicates(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def histogram(df: DataFrame, value: str) -> DataFrame:
    """Counts by value, keys as strings."""
    return df.groupBy(F.col(value).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def multiset_overlap(a: DataFrame, b: DataFrame, key: list[str], value: str) -> DataFrame:
    """Per key the size of the multiset intersection of two sides' values, and both sizes."""
    count = lambda df, n: df.groupBy(*key, value).agg(F.count(F.lit(1)).alias(n))
    both = count(a, "_a").join(count(b, "_b"), [*key, value], "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.groupBy(*key).agg(
        F.sum(F.least(zero("_a"), zero("_b"))).alias("shared"), F.sum(zero("_a")).alias("left_size"), F.sum(zero("_b")).alias("right_size")
    )


def worst(status: Column, order: list[str]) -> Column:
    """The status that is worst by ``order`` (worst first)."""
    return F.min_by(status, F.array_position(F.array(*map(F.lit, order)), status))


def reclaimable(files: DataFrame, group: list[str], size: str, path: str) -> DataFrame:
    """Bytes that hard links would free: all copies of a content but one."""
    return files.groupBy(*group).agg(((F.count_distinct(path) - 1) * F.max(size)).alias("reclaimable"))
