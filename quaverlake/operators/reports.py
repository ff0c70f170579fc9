"""Composite plans: editions, reviews, staged expansions and reports, as tables of what would be done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage(df: DataFrame, by: list[str], script: Column, attributed: str, pending: Column) -> DataFrame:
    """Per group the records, those in a script, the distinct attributions and the pending ones."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(script).alias("with_script"), F.count_distinct(attributed).alias("attributed"), F.count_if(pending).alias("pending")
    )


def offline_edition(works: DataFrame, files: DataFrame, exclusions: DataFrame, key: str, guard: list[str]) -> DataFrame:
    """Works with their files by format: array of struct(format, verified, files), and the number of files.

    files: key, format, verified and the guard's columns; a file that an exclusion names
    by the whole guard is left out. Counts are made before anything is collected, so a
    work's array has one element a format.
    """
    kept = files.join(exclusions.select(*guard).distinct(), guard, "left_anti")
    counts = kept.groupBy(key, "format").agg(F.count_if("verified").alias("verified"), F.count(F.lit(1)).alias("files"))
    own = counts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("format", "verified", "files"))).alias("files"), F.sum("files").alias("n"))
    none = F.array().cast("array<struct<format:string,verified:bigint,files:bigint>>")
    return works.join(own, key, "left").withColumns({"files": F.coalesce("files", none), "n": F.coalesce("n", F.lit(0))})


def expansion_steps(recalled: DataFrame, extracted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Each recalled record's step: not_extracted, rejected, known (in the library already) or commit."""
    out = recalled.select(key).join(extracted.select(key, "accepted"), key, "left").join(known.select(key, F.lit(True).alias("_known")).distinct(), key, "left")
    step = F.when(F.col("accepted").isNull(), "not_extracted").when(~F.col("accepted"), "rejected").when(F.col("_known"), "known").otherwise("commit")
    return out.select(key, step.alias("step"))


def reviewed_titles(works: DataFrame, reviews: DataFrame, key: str, title: str) -> DataFrame:
    """Titles with their reviews (key, expected, title) applied, and the outcome of each.

    A review of a title that is another one now is stale and has no effect; one of a work
    that isn't there is unknown.
    """
    r = reviews.select(key, "expected", F.col(title).alias("_new"), F.lit(True).alias("_reviewed"))
    out = works.select(key, title, F.lit(True).alias("_there")).join(r, key, "full")
    fits = F.col(title).eqNullSafe(F.col("expected"))
    outcome = F.when(F.col("_there").isNull(), "unknown").when(F.col("_reviewed").isNull(), "unreviewed").when(fits, "applied").otherwise("stale")
    return out.select(key, outcome.alias("outcome"), F.when(outcome == "applied", F.col("_new")).otherwise(F.col(title)).alias(title))


def dedup_plan(files: DataFrame, content: list[str], key: str, verified: str) -> DataFrame:
    """What a run over equal files would do, without doing it: the smallest key of a content stays, others become links if verified."""
    groups = files.groupBy(*content).agg(F.min(key).alias("keep"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    action = F.when(F.col(key) == F.col("keep"), "keep").when(F.col(verified), "link").otherwise("skip_unverified")
    return files.join(groups, content).select(key, "keep", action.alias("action"))


def integration_report(records: DataFrame, files: DataFrame, key: str, source: str, published: str) -> DataFrame:
    """Per source the records, the published ones, those without files, and the files; files are counted before the join."""
    own = files.groupBy(key).agg(F.count(F.lit(1)).alias("_files"))
    return records.join(own, key, "left").groupBy(source).agg(
        F.count(F.lit(1)).alias("records"), F.count_if(published).alias("published"), F.count_if(F.col("_files").isNull()).alias("without_files"),
        F.coalesce(F.sum("_files"), F.lit(0)).alias("files"),
    )


def resume_plan(frozen: DataFrame, live: DataFrame, group: str, member: str) -> DataFrame:
    """Per frozen group what a resumed run does: resume (members as they were), refetch or removed.

    Members are compared by number, sum of hashes and largest one, so no group is collected.
    """
    digest = lambda df: df.groupBy(group).agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(member).cast("decimal(20,0)")).alias("h"), F.max(member).alias("m")).alias("d")
    )
    out = digest(frozen).withColumnRenamed("d", "a").join(digest(live).withColumnRenamed("d", "b"), group, "left")
    action = F.when(F.col("b").isNull(), "removed").when(F.col("a") == F.col("b"), "resume").otherwise("refetch")
    return out.select(group, action.alias("action"))


def compiled_review(records: DataFrame, votes: DataFrame, key: str, value: str) -> DataFrame:
    """Per record the value that all its votes agree on: decided, conflict (several values) or pending (none)."""
    own = votes.groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    state = F.when(F.col("_low").isNull(), "pending").when(F.col("_low") == F.col("_high"), "decided").otherwise("conflict")
    return records.select(key).join(own, key, "left").select(key, state.alias("state"), F.when(state == "decided", F.col("_low")).alias(value))
