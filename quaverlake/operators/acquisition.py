"""Plans of acquisitions from their logs: what to try next, in which batches, and what came of it. Nothing is fetched here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered

#: Statuses after which a file isn't tried again, those that may be, and the one that ends a batch.
TERMINAL = ("verified", "deleted", "copyright_restricted", "region_restricted", "commercial_only", "membership_required")
RETRYABLE = ("network_error", "membership_wait_pending", "rate_limited")
STOPS = "human_verification_required"


def next_actions(wanted: DataFrame, log: DataFrame, key: str, now: Column, most: int = 3) -> DataFrame:
    """(key, attempts, action): done, wait, retry, give_up, review, stop or start.

    log: key, number, status, retry_after. The latest attempt decides; a retryable status
    is tried ``most`` times in all, when its time has come. One attempt that a human has
    to confirm stops whatever isn't done.
    """
    last = log.groupBy(key).agg(F.count(F.lit(1)).alias("attempts"), F.max(F.struct("number", "status", "retry_after")).alias("_l"))
    stop = log.where(F.col("status") == STOPS).limit(1).agg((F.count(F.lit(1)) > 0).alias("_stop"))  # one row
    status = F.col("_l.status")
    tries = F.when(F.col("attempts") >= most, "give_up").when(F.coalesce(F.col("_l.retry_after") > now, F.lit(False)), "wait").otherwise("retry")
    action = (
        F.when(status.isin(*TERMINAL), "done").when(F.col("_stop"), "stop").when(status.isNull(), "start").when(status.isin(*RETRYABLE), tries).otherwise("review")
    )
    out = wanted.select(key).distinct().join(last, key, "left").crossJoin(F.broadcast(stop))
    return out.select(key, F.coalesce("attempts", F.lit(0)).alias("attempts"), action.alias("action"))


def batches(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Adds ``batch``: rows in order, ``size`` a batch."""
    out = ordered.dense_ids(df, order, "_n")
    return out.withColumn("batch", F.expr(f"_n div {size}")).drop("_n")


def receipts(log: DataFrame, key: str, formats: str) -> DataFrame:
    """Per format the files, the verified ones, their distinct contents and bytes, from each file's last attempt."""
    last = log.groupBy(key, formats).agg(F.max(F.struct("number", "status", "sha256", "size")).alias("l")).select(key, formats, "l.*")
    fine = F.col("status") == "verified"
    return last.groupBy(formats).agg(
        F.count(F.lit(1)).alias("files"), F.count_if(fine).alias("verified"), F.count_distinct(F.when(fine, F.col("sha256"))).alias("contents"),
        F.coalesce(F.sum(F.when(fine, F.col("size"))), F.lit(0)).alias("bytes"),
    )


def extraction_plan(wanted: DataFrame, members: DataFrame, member: str, digest: str) -> DataFrame:
    """Wanted members (member, digest, ...) with how they stand in an archive: extract, missing or differs."""
    there = members.groupBy(member).agg(F.min(digest).alias("_d"))
    out = wanted.join(there, member, "left")
    step = F.when(F.col("_d").isNull(), "missing").when(F.col("_d") == F.col(digest), "extract").otherwise("differs")
    return out.select(*wanted.columns, step.alias("step"))
