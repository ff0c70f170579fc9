"""Ordered and stateful operators, as windows where state allows, else per group in pandas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import staging


def dense_ids(df: DataFrame, order: list[Column], name: str = "id") -> DataFrame:
    """Numbers distinct rows from 0 in a total order.

    Range partitions are numbered each on its own and shifted by the counts before them,
    so no task sees all rows. They are written once, in the shared folder: the counts
    and the numbers are of the same partitions, also if a lost task runs again.
    """
    parts = F.spark_partition_id().alias("_part")
    ranged = staging.checkpointed(df.repartitionByRange(*order).select("*", parts))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    own = W.partitionBy("_part").orderBy(*order)
    out = ranged.withColumn("_k", F.row_number().over(own)).join(F.broadcast(before.select("_part", "_before")), "_part")  # a row a partition
    return out.withColumn(name, (F.col("_before") + F.col("_k") - 1).cast("long")).drop("_part", "_k", "_before")


def carry_forward(df: DataFrame, partition: list[str], order: list[str], value: Column, name: str, reset: Column | None = None) -> DataFrame:
    """The last non-null value so far; a reset forgets it."""
    w = W.partitionBy(*partition).orderBy(*order)
    if reset is not None:
        df = df.withColumn("_epoch", F.sum(reset.cast("int")).over(w))
        w = W.partitionBy(*partition, "_epoch").orderBy(*order)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_epoch")


def merge_intervals(df: DataFrame, partition: list[str], start: str, stop: str, tolerance) -> DataFrame:
    """Unions of intervals whose gaps are at most ``tolerance``."""
    w = W.partitionBy(*partition).orderBy(start, stop)
    reach = F.max(stop).over(w.rowsBetween(W.unboundedPreceding, -1))
    out = df.withColumn("_new", F.when(F.col(start) <= reach + F.lit(tolerance), 0).otherwise(1))
    out = out.withColumn("_island", F.sum("_new").over(w))
    return out.groupBy(*partition, "_island").agg(
        F.min(start).alias(start), F.max(stop).alias(stop), F.count(F.lit(1)).alias("parts")
    ).drop("_island")


def covered_share(intervals: DataFrame, partition: list[str], start: str, stop: str, tolerance, width: str) -> DataFrame:
    """Per group the share of its width that merged intervals cover."""
    merged = merge_intervals(intervals.select(*partition, start, stop), partition, start, stop, tolerance)
    own = merged.groupBy(*partition).agg(F.sum(F.col(stop) - F.col(start)).alias("_covered"))
    return intervals.groupBy(*partition).agg(F.max(width).alias("_width")).join(own, partition).select(*partition, (F.col("_covered") / F.col("_width")).alias("share"))


def numbered_attempts(df: DataFrame, key: str, order: list[str], phase: str, started: str = "started") -> DataFrame:
    """Adds ``attempt``: the number of starts so far, 0 before the first, and whether the row is its key's latest."""
    w = W.partitionBy(key).orderBy(*order)
    number = F.sum((F.col(phase) == started).cast("int")).over(w)
    return df.withColumns({"attempt": number.cast("int"), "latest": F.lead(phase).over(w).isNull()})


def unsorted_rows(df: DataFrame, partition: list[str], order: list[str], key: str) -> DataFrame:
    """Rows whose key is smaller than the one before."""
    w = W.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_last", F.lag(key).over(w)).where(F.col(key) < F.col("_last")).drop("_last")


def suffix_collisions(df: DataFrame, name: str, ident: str, most: int = 10) -> DataFrame:
    """``unique_name``: names that collide regardless of case get the id as a suffix, until none collide.

    A suffixed name may be another row's own name; both then get one more. Ids differ, so
    two rounds settle all but contrived names; ``most`` rounds without success fail.
    """
    out = df.withColumn("unique_name", F.col(name))
    for _ in range(most):
        n = out.groupBy(F.lower("unique_name").alias("_name")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        if n.isEmpty():
            return out
        out = out.join(n, F.lower("unique_name") == F.col("_name"), "left")
        suffixed = F.concat_ws("-", F.col("unique_name"), F.col(ident).cast("string"))
        out = out.withColumn("unique_name", F.when(F.col("_n").isNull(), F.col("unique_name")).otherwise(suffixed)).drop("_name", "_n")
    raise ValueError(f"names still collide after {most} rounds")


def top_k(df: DataFrame, partition: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*partition).orderBy(*order))).where(F.col("rank") <= k)


def unfinished(df: DataFrame, key: str, order: list[str], phase: str, started: str = "started") -> DataFrame:
    """Attempts that started and were followed by another start or nothing."""
    w = W.partitionBy(key).orderBy(*order)
    following = F.lead(phase).over(w)
    return df.withColumn("_next", following).where((F.col(phase) == started) & (F.col("_next").isNull() | (F.col("_next") == started))).drop("_next")


def planned_ranges(files: DataFrame, done: DataFrame, key: str, step: int) -> DataFrame:
    """(key, start, stop): byte ranges of ``step`` at most in the gaps that ``done`` (key, start, stop) leaves of files (key, total).

    Ranges may overlap and pass the total. Each file is planned on its own.
    """
    known = done.join(files, key, "left_semi").select(key, "start", "stop")
    edges = known.union(files.select(key, F.col("total").alias("start"), F.col("total").alias("stop")))
    edges = edges.join(files, key).where("start <= total")
    w = W.partitionBy(key).orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    gaps = edges.withColumn("reach", F.coalesce(F.max("stop").over(w), F.lit(0))).where("start > reach")
    cut = gaps.select(key, F.col("start").alias("_end"), F.explode(F.sequence("reach", F.col("start") - 1, F.lit(step))).alias("start"))
    return cut.select(key, "start", F.least("_end", F.col("start") + step).alias("stop"))


def pair_fifo(df: DataFrame, partition: list[str], order: list[str], kind: str, on: str, off: str) -> DataFrame:
    """Pairs each ``off`` with the earliest open ``on`` of its partition.

    Returns the partition, on_at, off_at (by the first order column); an unmatched event
    has a null on the other side. The n-th off that finds an open on closes the n-th on;
    an off finds none where the balance of ons and offs reaches a new low below zero. So
    running sums give the pairs, and they meet by their number, not in a queue.
    """
    at = order[0]
    w = W.partitionBy(*partition).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    is_on = F.col(kind) == on
    rows = df.where(F.col(kind).isin(on, off)).withColumns({"_ons": F.sum(is_on.cast("int")).over(w), "_offs": F.sum((~is_on).cast("int")).over(w)})
    rows = rows.withColumn("_lost", F.greatest(F.max(F.col("_offs") - F.col("_ons")).over(w), F.lit(0)))
    before = F.coalesce(F.lag("_lost").over(W.partitionBy(*partition).orderBy(*order)), F.lit(0))
    rows = rows.withColumn("_alone", ~is_on & (F.col("_lost") > before))
    number = F.when(is_on, F.col("_ons")).when(F.col("_alone"), -F.col("_lost")).otherwise(F.col("_offs") - F.col("_lost"))
    pairs = rows.withColumn("_number", number).groupBy(*partition, "_number")
    return pairs.agg(F.max(F.when(is_on, F.col(at))).alias("on_at"), F.max(F.when(~is_on, F.col(at))).alias("off_at")).drop("_number")


def spacing_runs(df: DataFrame, partition: list[str], at: str, size: int, tolerance: float) -> DataFrame:
    """Runs of ``size`` evenly spaced values (such as staff lines): (partition, run_start, run_stop, spacing)."""
    schema = df.select(*partition, F.col(at).cast("double").alias("run_start"), F.col(at).cast("double").alias("run_stop"), F.col(at).cast("double").alias("spacing")).schema

    def runs(pdf: pd.DataFrame) -> pd.DataFrame:
        key, values, out, run = tuple(pdf[c].iloc[0] for c in partition), sorted(set(pdf[at].astype(float))), [], []
        for v in values:
            if len(run) >= 2 and abs((v - run[-1]) - (run[1] - run[0])) > tolerance:
                run = run[-1:]
            run.append(v)
            if len(run) == size:
                out.append((*key, run[0], run[-1], (run[-1] - run[0]) / (size - 1)))
                run = []
        return pd.DataFrame(out, columns=schema.names)

    return df.groupBy(*partition).applyInPandas(runs, schema)
