"""Merges of several sources, overlays in order of precedence, and drift reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import sets


def project_details(metadata: Column, allowed: list[str]) -> Column:
    """Whitelisted keys of a map with non-blank values, trimmed."""
    kept = F.map_filter(metadata, lambda k, v: k.isin(*allowed) & (F.trim(v) != ""))
    return F.transform_values(kept, lambda k, v: F.trim(v))


def merge_sources(sources: dict[str, tuple[DataFrame, DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """(works, memberships) of sources given as (works (id, ...), memberships (id, category)).

    Ids get the source as a prefix. A key that two rows share ends the merge; works
    without a membership are left out.
    """
    works, bridges = [], []
    for name, (w, m) in sources.items():
        ident = F.concat(F.lit(f"{name}:"), F.col("id").cast("string"))
        works.append(w.withColumn("id", ident).withColumn("source_id", F.lit(name)))
        bridges.append(m.select(ident.alias("id"), F.concat(F.lit(f"{name}:"), F.col("category").cast("string")).alias("category")))
    merged, twice = sets.union_disjoint(works, "id")
    broken = twice.limit(5).collect()
    if broken:
        raise ValueError(f"ids of two works: {[r.id for r in broken]}")
    bridge = reduce(DataFrame.unionByName, bridges).distinct()
    return merged.join(bridge, "id", "left_semi"), bridge


def topics(rules: list[tuple[str, Column]], review: Column | None = None, further: list[tuple[str, Column]] = ()) -> Column:
    """Topics of a row: a review replaces what the first rule that holds says; further ones are added to either."""
    first = F.array(F.coalesce(*(F.when(cond, F.lit(name)) for name, cond in rules)))
    base = first if review is None else F.when(review.isNotNull(), review).otherwise(first)
    added = F.array(*(F.when(cond, F.lit(name)) for name, cond in further)) if further else F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.concat(base, added)))


def translate(base: DataFrame, assets: list[tuple[DataFrame, list[str]]], field: str) -> tuple[DataFrame, list[DataFrame]]:
    """``field_zh`` from assets in order of precedence, each (keys..., zh); and the stale rows of each asset."""
    out, stale, names = base, [], []
    for n, (asset, keys) in enumerate(assets):
        name = f"_zh{n}"
        names.append(name)
        one = asset.groupBy(*keys).agg(F.min("zh").alias(name))
        out = out.join(one, keys, "left")
        stale.append(asset.join(base, keys, "left_anti"))
    return out.withColumn(f"{field}_zh", F.coalesce(*names)).drop(*names), stale


def drift(frozen: DataFrame, live: DataFrame, name: str, member: str, most: int, least_jaccard: float, block: Column) -> DataFrame:
    """Renamed groups: a name that went and one that came, near in edits and in members.

    frozen and live: (name, member). Candidates share the ``block`` of their names and at
    least one member, so the join runs over memberships.
    """
    gone = frozen.join(live.select(name), name, "left_anti")
    come = live.join(frozen.select(name), name, "left_anti")
    sized = lambda df, tag: df.groupBy(F.col(name).alias(tag)).agg(F.count_distinct(member).alias(f"n_{tag}"))
    a = gone.select(F.col(name).alias("old_name"), F.col(member), block.alias("_block")).distinct()
    b = come.select(F.col(name).alias("new_name"), F.col(member), block.alias("_block")).distinct()
    both = a.join(b, ["_block", member]).groupBy("old_name", "new_name").agg(F.count(F.lit(1)).alias("shared"))
    out = both.join(sized(gone, "old_name"), "old_name").join(sized(come, "new_name"), "new_name")
    out = out.withColumn("jaccard", F.col("shared") / (F.col("n_old_name") + F.col("n_new_name") - F.col("shared")))
    out = out.withColumn("distance", F.levenshtein("old_name", "new_name"))
    return out.where((F.col("distance") <= most) & (F.col("jaccard") >= least_jaccard)).select("old_name", "new_name", "distance", "jaccard")


def reconcile(declared: DataFrame, members: DataFrame, key: str, count: str) -> DataFrame:
    """Declared counts against members: keep, adjust, remove (no members) or unverified (not declared)."""
    seen = members.groupBy(key).agg(F.count(F.lit(1)).alias("_seen"))
    action = (
        F.when(F.col(count).isNull(), "unverified").when(F.col("_seen").isNull(), "remove").when(F.col(count) == F.col("_seen"), "keep").otherwise("adjust")
    )
    return declared.join(seen, key, "full").select(key, action.alias("action"), F.coalesce("_seen", F.lit(0)).alias("members"))


def carry_receipts(discovered: DataFrame, receipts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Receipts of earlier runs on re-discovered works; new values win over old ones."""
    old = receipts.select(key, *(F.col(c).alias(f"_{c}") for c in columns))
    out = discovered.join(old, key, "left")
    return out.withColumns({c: F.coalesce(c, f"_{c}") for c in columns}).drop(*(f"_{c}" for c in columns))


