"""Joins with contracts: must-match, unique lookup, priorities, ranges, overlays, audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def remap(df: DataFrame, key: str, mapping: DataFrame, old: str, new: str) -> DataFrame:
    """Replaces ``key`` by the mapping's new value; rows whose key is missing get a null and count as ``unmapped``."""
    m = mapping.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    return df.join(m, df[key] == m["_old"], "left").withColumn("unmapped", F.col("_old").isNull()).withColumn(key, F.col("_new")).drop("_old", "_new")


def unique_lookup(reference: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) of keys that have exactly one distinct value."""
    return (
        reference.where(F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.min(value).alias(value), F.max(value).alias("_most"))
        .where(F.col(value) == F.col("_most"))
        .drop("_most")
    )


def prioritised(candidates: DataFrame, key: list[str], priority: Column, *ties: Column) -> DataFrame:
    """The best candidate of each key."""
    w = W.partitionBy(*key).orderBy(priority, *ties)
    return candidates.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def range_join(points: DataFrame, at: str, ranges: DataFrame, start: str, stop: str, keys: list[str], width: int) -> DataFrame:
    """Points within half-open ranges [start, stop) of equal keys.

    Both sides are cut into bins of ``width`` and joined on them, so the plan is an equi
    join; a range is copied once per bin that it touches.
    """
    p = points.withColumn("_bin", F.expr(f"cast(floor({at} / {width}) as bigint)"))
    r = ranges.withColumn(
        "_bin", F.explode(F.expr(f"sequence(cast(floor({start} / {width}) as bigint), cast(floor(greatest({start}, {stop} - 1) / {width}) as bigint))"))
    )
    return p.join(r, [*keys, "_bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("_bin")


def overlay(base: DataFrame, reviews: DataFrame, key: str, columns: list[str], guard: str | None = None) -> DataFrame:
    """Reviewed values over those of ``base``; with ``guard`` only where both sides' guards agree."""
    r = reviews.select(F.col(key), *(F.col(c).alias(f"_{c}") for c in columns), *([F.col(guard).alias("_guard")] if guard else []))
    out = base.join(r, key, "left")
    holds = F.col("_guard").eqNullSafe(F.col(guard)) if guard else F.lit(True)
    for c in columns:
        out = out.withColumn(c, F.coalesce(F.when(holds, F.col(f"_{c}")), F.col(c)))
    return out.drop(*(f"_{c}" for c in columns), "_guard")


def audit(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: matched keys and those of one side only."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").agg(
        F.count_if(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("matched"),
        F.count_if(F.col("_r").isNull()).alias("left_only"),
        F.count_if(F.col("_l").isNull()).alias("right_only"),
    )


def changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, change) of rows that were added, removed or changed."""
    a = before.select(key, F.struct(*columns).alias("_a"))
    b = after.select(key, F.struct(*columns).alias("_b"))
    change = (
        F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    )
    return a.join(b, key, "full").select(key, change.alias("change")).where("change is not null")


def two_phase(chunks: DataFrame, metadata: DataFrame, id_column: str, name_column: str) -> DataFrame:
    """Matches by id first; what is left by name, where exactly one candidate has it.

    Returns the chunk's columns with matched_id and outcome: id, conflict (the id is
    known under another name, so nothing is matched), name, ambiguous or missing.
    """
    m = metadata.select(F.col(id_column).alias("_id"), F.col(name_column).alias("_name"))
    ids = m.groupBy(F.col("_id").alias(id_column)).agg(F.collect_set("_name").alias("_named"))  # an id has few names
    by_id = chunks.join(ids, id_column, "left")
    names = m.groupBy("_name").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_only"))
    out = by_id.join(names, by_id[name_column] == names["_name"], "left")
    same = F.col(name_column).isNull() | F.array_contains("_named", F.col(name_column))
    conflict = F.col("_named").isNotNull() & ~same
    outcome = F.when(conflict, "conflict").when(F.col("_named").isNotNull(), "id").when(F.col("_n") == 1, "name").when(F.col("_n") > 1, "ambiguous").otherwise("missing")
    matched = F.when(outcome == "id", F.col(id_column)).when(outcome == "name", F.col("_only"))
    return out.select(*chunks.columns, matched.alias("matched_id"), outcome.alias("outcome"))


def matched_once(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Pairs whose left and right rows are in no other pair."""
    one = lambda c: pairs.groupBy(c).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select(c)
    return pairs.join(one(left), left, "left_semi").join(one(right), right, "left_semi")


def by_precedence(left: DataFrame, right: DataFrame, left_id: str, right_id: str, levels: list[list[str]]) -> DataFrame:
    """(left_id, right_id, level): rows that agree on the first list of columns on which exactly one right row agrees.

    Each level is an equi join with the right rows that its columns name alone; a level
    with null columns doesn't match.
    """
    out = left.select(left_id)
    for n, columns in enumerate(levels):
        one = right.groupBy(*columns).agg(F.count(F.lit(1)).alias("_k"), F.min(right_id).alias(f"_{n}")).where("_k = 1").drop("_k")
        out = out.join(left.join(one, columns).select(left_id, f"_{n}"), left_id, "left")
    found = F.coalesce(*(F.when(F.col(f"_{n}").isNotNull(), F.struct(F.col(f"_{n}").alias("id"), F.lit(n).alias("level"))) for n in range(len(levels))))
    return out.select(left_id, found["id"].alias(right_id), found["level"].alias("level"))


def _deletions(name: Column, most: int) -> Column:
    """All texts that are left of a name after ``most`` deletions or fewer, each once."""
    out = F.array(name)
    for _ in range(most):
        shorter = F.transform(out, lambda t: F.transform(F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1))), lambda i: F.concat(F.substring(t, 1, i - 1), F.substr(t, i + 1))))
        out = F.array_distinct(F.concat(out, F.flatten(shorter)))
    return out


def similar_names(left: DataFrame, right: DataFrame, name: str, most: int, block: Column) -> DataFrame:
    """Pairs of names within ``most`` edits among rows of one block.

    Two such names have a text in common that ``most`` deletions leave of each, so the
    join is on these texts, not on all pairs of a block; distinct names are compared once.
    """
    side = lambda df, n: df.select(F.col(name).alias(n), block.alias("_block")).distinct().withColumn("_left", F.explode(_deletions(F.col(n), most)))
    pairs = side(left, "old_name").join(side(right, "new_name"), ["_block", "_left"]).select("_block", "old_name", "new_name").distinct()
    return pairs.withColumn("distance", F.levenshtein("old_name", "new_name", most)).where(F.col("distance") >= 0).drop("_block")


def star_edges(df: DataFrame, key: str, node: str, kind: str) -> DataFrame:
    """Edges from the smallest node of each key to its others; (from_id, to_id, kind), distinct."""
    least = df.groupBy(key).agg(F.min(node).alias("from_id"), F.max(node).alias("_most")).where("from_id < _most")
    return (
        df.join(least, key)
        .where(F.col(node) != F.col("from_id"))
        .select("from_id", F.col(node).alias("to_id"), F.lit(kind).alias("kind"))
        .distinct()
    )


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges with the smaller end first, once each, without loops."""
    return edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("from_id"), F.greatest(a, b).alias("to_id"), "kind").distinct()


def neighbours(edges: DataFrame, nodes: DataFrame, node: str) -> DataFrame:
    """One hop from some nodes, in both directions."""
    both = edges.select(F.col("from_id").alias(node), F.col("to_id").alias("neighbour"), "kind").union(
        edges.select("to_id", "from_id", "kind")
    )
    return both.join(nodes.select(node).distinct(), node, "left_semi")


def all_or_nothing(df: DataFrame, guards: list[Column]) -> DataFrame:
    """All rows if every guard holds on every row, else none."""
    bad = df.agg(F.count_if(~F.coalesce(reduce(lambda a, b: a & b, guards), F.lit(False))).alias("_bad"))
    return df.join(F.broadcast(bad.where("_bad = 0")), F.lit(True), "left_semi")  # one row
