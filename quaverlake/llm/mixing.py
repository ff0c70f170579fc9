"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by (source, exact length, hash bucket). A source whose target is
at least its size takes every document once; what remains of the target (or all of it)
is the budget for one further copy of some documents. The budget is fitted per source
from the counts by length: each length gives its share, rounded down, and a bounded
knapsack over the lengths left fills the rest, to the word if the lengths allow it.
Which documents of a length are taken follows from a seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: Documents of one (source, length) are ranked within so many hash buckets, so none is one task's.
BUCKETS = 256
#: Words that are left to the knapsack at least; twice the longest document, if that is more.
EXACT = 1 << 16
#: Cells of the knapsack at most; beyond them (documents of millions of words) a cell is several words.
CELLS = 1 << 24


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that their words come to ``budget`` or just below.

    Each length gives its share but for some room, which the knapsack fills. Where the
    documents left then don't fill it to the word, the room is widened, up to the whole
    budget: the choice is then the best one there is, as long as CELLS hold it.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total <= 0:
        return take
    fits = (lengths > 0) & (lengths <= budget) & (counts > 0)
    if not fits.any():
        return take
    unit = int(np.gcd.reduce(lengths[fits]))  # sums are multiples of it
    lengths, counts, budget = np.where(fits, lengths, 0) // unit, np.where(fits, counts, 0), budget // unit
    if budget >= int((lengths * counts).sum()):
        return counts
    room = max(EXACT, 2 * int(lengths.max()))
    while True:
        tried = _fit(lengths, counts, budget, room)
        if int((tried * lengths).sum()) > int((take * lengths).sum()):
            take = tried
        if room >= min(budget, CELLS) or int((take * lengths).sum()) == budget:
            return take
        room = min(room * 8, budget)


def _fit(lengths: np.ndarray, counts: np.ndarray, budget: int, room: int) -> np.ndarray:
    total = int((lengths * counts).sum())
    share = max(0, budget - room)
    take = np.array([int(c) * share // total for c in counts], np.int64)
    rest = budget - int((take * lengths).sum())
    left = counts - take
    longest_first = [int(k) for k in np.argsort(-lengths, kind="stable") if lengths[k]]
    for k in longest_first:  # until the rest is small
        if rest <= room:
            break
        n = min(int(left[k]), (rest - room // 2) // int(lengths[k]))
        take[k] += n
        left[k] -= n
        rest -= n * int(lengths[k])
    # Bounded knapsack: the first length (long to short) by which each sum is reached, and how often.
    grain = rest // CELLS + 1
    steps, rest = -(-lengths // grain), rest // grain
    first, used = np.full(rest + 1, -1, np.int32), np.zeros(rest + 1, np.int32)
    reached = np.zeros(rest + 1, bool)
    reached[0] = True
    for k in longest_first:
        step, most = int(steps[k]), int(left[k])
        if step > rest or not most:
            continue
        at = np.flatnonzero(reached)
        for n in range(1, min(most, rest // step) + 1):
            at = at[at + step <= rest] + step
            at = at[~reached[at]]
            if not len(at):
                break
            reached[at], first[at], used[at] = True, k, n
        if reached[rest]:
            break
    at = int(np.flatnonzero(reached).max())
    while at > 0:
        k, n = int(first[at]), int(used[at])
        take[k] += n
        at -= n * int(steps[k])
    return take


def targets(sizes: DataFrame, weights=WEIGHTS, share: int = 150) -> DataFrame:
    """Adds ``target`` to rows (source, source_size).

    Sources by code point, null last, weigh ``weights`` in turn and share ``share``
    percent of all sizes; none gets over twice its size, the excess is reshared.
    With the sources in order of 2 * size / weight, those that are cut off at twice
    their size are a prefix; the first prefix after which the level fits is taken.
    """
    every = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(every) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * 2)
    # cap / weight, compared as whole numbers: a common multiple of the weights
    common_multiple = int(np.lcm.reduce(np.array(weights)))
    ranked = ranked.withColumn("ratio", F.expr(f"cap * ({common_multiple} div weight)"))
    up = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    all_rows = W.partitionBy()
    ranked = (
        ranked.withColumn("cut", F.coalesce(F.sum("cap").over(up), F.lit(0)))
        .withColumn("w_left", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(up), F.lit(0)))
        .withColumn("words", F.sum("source_size").over(all_rows))
    )
    # 100 * level = (share * words - 100 * cut) / w_left
    ranked = ranked.withColumn("num", F.col("words") * share - F.col("cut") * 100)
    fits = F.col("num").cast("double") * common_multiple <= F.col("ratio").cast("double") * 100 * F.col("w_left")
    level = F.min_by(F.col("num").cast("double") / (F.col("w_left") * 100), F.when(fits, F.struct("ratio", "rank"))).over(all_rows)
    return ranked.withColumn("level", level).select(
        "source",
        "source_size",
        F.when(F.col("level").isNull(), F.col("cap").cast("double"))
        .otherwise(F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double")))
        .alias("target"),
    )


def sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source",
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("content"),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: int = 150, seed: int = 11) -> DataFrame:
    """``mix_rows`` without the source and the content's hash."""
    return mix_rows(docs, weights, share, seed).drop("source", "content")


def mix_rows(docs: DataFrame, weights=WEIGHTS, share: int = 150, seed: int = 11) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, content, source_size, target, taken.

    ``content`` is a hash of the text.
    ``taken`` is 0, 1 or 2 times the document's size. A null text has no words; a null
    source is one source, last in order. Rows that repeat a doc_id are chosen each on
    its own. Sources without words have the target 0. Reruns agree: ranks within a
    length follow the seeded hash of doc_id and text, then doc_id. An empty table gives an
    empty result; other columns are ignored.
    """
    rank_key = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("content"))
    rows = sized(docs).withColumn("bucket", F.pmod(rank_key, F.lit(BUCKETS)).cast("int"))
    rows = common.stage(rows, "mix-sizes")  # the texts are read once
    counts = common.stage(rows.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sizes = counts.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    goals = common.stage(targets(sizes, weights, share), "mix-targets")
    lengths = counts.groupBy("source", "size").agg(F.sum("n").alias("n"))

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        """The lengths of one source: as many rows as it has different lengths."""
        pdf = pdf.sort_values("size")
        size, goal = int(pdf.source_size.iloc[0]), pdf.target.iloc[0]
        whole = int(goal >= size)
        take = fit_budget(pdf["size"].to_numpy(), pdf.n.to_numpy(), int(round(goal)) - whole * size)
        return pd.DataFrame(
            {"source": pdf.source, "size": pdf["size"], "source_size": size, "target": goal, "base": whole, "extra": take}
        )

    g = goals.withColumnRenamed("source", "s")
    plan = lengths.join(g, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = plan.groupBy("source").applyInPandas(
        fitted, "source string, size long, source_size long, target double, base int, extra long"
    )
    plan = common.stage(plan, "mix-plan")
    # Of each length, whole buckets in order, then the first ranks of one more.
    below = W.partitionBy("source", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    quota = counts.withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
    p = plan.select(*(F.col(c).alias(f"p_{c}") for c in plan.columns))
    quota = quota.join(p, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))).select(
        "source", "size", "bucket", "p_source_size", "p_target", "p_base",
        F.greatest(F.lit(0), F.col("p_extra") - F.col("before")).alias("quota"),
    )
    in_bucket = W.partitionBy("source", "size", "bucket").orderBy(rank_key, "doc_id")
    rows = rows.withColumn("rank", F.row_number().over(in_bucket))
    q = quota.select(*(F.col(c).alias(f"q_{c}") for c in quota.columns))
    out = rows.join(
        q,
        F.col("source").eqNullSafe(F.col("q_source"))
        & (F.col("size") == F.col("q_size"))
        & (F.col("bucket") == F.col("q_bucket")),
    )
    times = F.col("q_p_base") + F.when(F.col("rank") <= F.col("q_quota"), 1).otherwise(0)
    return out.select(
        "doc_id",
        "source",
        "size",
        "content",
        F.col("q_p_source_size").alias("source_size"),
        F.col("q_p_target").alias("target"),
        (F.col("size") * times).cast("long").alias("taken"),
    )


def op7_mix(spark, sf_dir):
    return mix(common.read(spark, sf_dir, "documents"))


def mixed(spark, docs, sf_dir):
    """Pipeline stage, the last: the documents of the mix with size, source_size, target and taken.

    Rows of equal doc_id, source and text are interchangeable: as many of them are taken
    as the mix takes, once or twice. Columns of ``docs`` with a name of the result's are
    replaced. An empty table gives an empty result.
    """
    keys, added = ["doc_id", "source", "size", "content"], ["size", "source_size", "target", "taken"]
    chosen = mix_rows(docs).groupBy(*keys).agg(
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.count(F.lit(1)).alias("_n"),
        F.sum((F.col("taken") > F.col("size")).cast("int")).alias("_twice"),
        F.sum((F.col("taken") == F.col("size")).cast("int")).alias("_once"),
    )
    chosen = chosen.where("_twice + _once > 0 and size > 0")
    t = chosen.select(*(F.col(c).alias(f"_{c}") if c in keys else F.col(c) for c in chosen.columns))
    own = [c for c in docs.columns if c not in added]
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*own, F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("_key"))
    same = rows["doc_id"].cast("long").eqNullSafe(t["_doc_id"]) & rows["source"].eqNullSafe(t["_source"])
    rows = rows.join(t, same & (rows["size"] == t["_size"]) & (rows["_key"] == t["_content"]))
    alike = W.partitionBy("_doc_id", "_source", "_size", "_content").orderBy("_key")
    rows = rows.where("_n = 1").withColumn("_rank", F.lit(1)).unionByName(rows.where("_n > 1").withColumn("_rank", F.row_number().over(alike)))
    times = F.when(F.col("_rank") <= F.col("_twice"), 2).when(F.col("_rank") <= F.col("_twice") + F.col("_once"), 1)
    rows = rows.withColumn("taken", (F.col("size") * times).cast("long")).where("taken is not null")
    return rows.select(*own, *added)
