"""Data-quality rules as tables of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rule(df: DataFrame, name: str, key: str, broken: Column) -> DataFrame:
    return df.where(broken).select(F.lit(name).alias("rule"), F.col(key).cast("string").alias("key"))


def unique(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.lit(name).alias("rule"), F.col(key).cast("string").alias("key"))


def references(df: DataFrame, name: str, key: str, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows whose reference isn't in the target; null references are broken too."""
    t = target.select(F.col(target_column).alias(column)).distinct()
    return df.join(t, column, "left_anti").select(F.lit(name).alias("rule"), F.col(key).cast("string").alias("key"))


def violations(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, parts)


def findings(df: DataFrame, key: str, fields: list[str], rules: dict[str, tuple[str, str]]) -> DataFrame:
    """(key, field, rule, severity) of text fields that match a rule's pattern."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields))).alias("t")
    rows = df.select(F.col(key), pairs)
    hits = F.array_compact(
        F.array(*(F.when(F.col("t.text").rlike(p), F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"))) for n, (s, p) in rules.items()))
    )
    return rows.select(key, "t.field", F.explode(hits).alias("h")).select(key, "field", "h.rule", "h.severity")


def readiness(found: DataFrame) -> DataFrame:
    """Counts by severity and rule, and whether no error is left."""
    counts = found.groupBy("severity", "rule").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("blocks", F.col("severity") == "error")


def fingerprints(df: DataFrame, group: str, key: str, digest: Column, chunk: int = 1000) -> DataFrame:
    """(group, rows, fingerprint): digests of rows in order of an integer key, chunk by chunk, so that no group is one array."""

    def joined(order: str, text: str) -> Column:
        return F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda r: r[text]), ""))

    rows = df.select(group, F.col(key).alias("_k"), digest.alias("_d"), F.expr(f"{key} div {chunk}").alias("_chunk"))
    chunks = rows.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"), joined("_k", "_d").alias("_f"))
    return chunks.groupBy(group).agg(F.sum("_n").alias("rows"), joined("_chunk", "_f").alias("fingerprint"))


def compared_fingerprints(now: DataFrame, stored: DataFrame, group: str) -> DataFrame:
    """(group, state): unchanged, changed, new or gone since the fingerprints were stored."""
    old = stored.select(group, F.struct("rows", "fingerprint").alias("_old"))
    both = now.select(group, F.struct("rows", "fingerprint").alias("_new")).join(old, group, "full")
    state = F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone").when(F.col("_old") == F.col("_new"), "unchanged").otherwise("changed")
    return both.select(group, state.alias("state"))
