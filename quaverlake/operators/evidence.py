"""Joins, windows and reductions over files, parts, events and pages as evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def unique_counterpart(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id) where a left row has exactly one right row with its keys; others have none.

    Counted by an aggregate before the join, so a popular key doesn't make pairs.
    """
    one = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min(right_id).alias(right_id)).where("_n = 1").drop("_n")
    return left.join(one, keys).select(left_id, right_id)


def first_verified(groups: DataFrame, manifest: DataFrame, keys: list[str], order: list[str], verified: str) -> DataFrame:
    """Of each content group the first manifest row, in order, that could be verified; groups without one have none."""
    best = manifest.where(F.col(verified)).groupBy(*keys).agg(F.min(F.struct(*order)).alias("_m"))
    return groups.join(best, keys).select(*groups.columns, *(F.col(f"_m.{c}").alias(c) for c in order))


def confirmed_pairs(actions: DataFrame, current: DataFrame, key: str, guards: list[str]) -> DataFrame:
    """Journal actions whose two files (a, b) are still what the journal saw: all, or none if one of them isn't.

    actions: a, b and for each guard ``a_<guard>``, ``b_<guard>``; current: key, guards.
    """
    rows = actions
    for side in ("a", "b"):
        now = current.select(F.col(key).alias(side), F.lit(True).alias(f"_{side}"), *(F.col(g).alias(f"_{side}_{g}") for g in guards))
        rows = rows.join(now, side, "left")
    fine = F.coalesce(F.col("_a") & F.col("_b"), F.lit(False))
    for g in guards:
        fine = fine & F.col(f"a_{g}").eqNullSafe(F.col(f"_a_{g}")) & F.col(f"b_{g}").eqNullSafe(F.col(f"_b_{g}")) & F.col(f"a_{g}").eqNullSafe(F.col(f"b_{g}"))
    bad = rows.where(~fine).limit(1).agg(F.count(F.lit(1)).alias("_bad"))  # one row
    return rows.join(F.broadcast(bad.where("_bad = 0")), F.lit(True), "left_semi").select(*actions.columns)


def reusable(wanted: DataFrame, library: DataFrame, key: str, digest: str) -> DataFrame:
    """Wanted files with ``reused``: the smallest library path of the same content, whatever its name; null without one."""
    there = library.groupBy(digest).agg(F.min("path").alias("reused"))
    return wanted.select(key, digest).join(there, digest, "left").select(key, "reused")


def connected_bands(df: DataFrame, partition: list[str], top: str, bottom: str, linked: Column) -> DataFrame:
    """Adds ``band_group``: neighbours in order from the top belong together while ``linked`` holds.

    linked: a condition on the row and ``_top``, ``_bottom`` of the band before it.
    """
    w = W.partitionBy(*partition).orderBy(top, bottom)
    out = df.withColumns({"_top": F.lag(top).over(w), "_bottom": F.lag(bottom).over(w)})
    out = out.withColumn("_new", F.when(F.coalesce(linked, F.lit(False)), 0).otherwise(1))
    return out.withColumn("band_group", F.sum("_new").over(w).cast("int")).drop("_top", "_bottom", "_new")


def alternates(df: DataFrame, partition: list[str], order: str, value: str) -> DataFrame:
    """Per group whether values alternate between the first two, which differ, at strictly later places."""
    w = W.partitionBy(*partition).orderBy(order, value)
    rows = df.withColumns({"_k": F.row_number().over(w), "_last": F.lag(order).over(w), "_two": F.lag(value, 2).over(w), "_one": F.lag(value).over(w)})
    fine = (F.col("_last").isNull() | (F.col(order) > F.col("_last"))) & (F.col("_two").isNull() | (F.col(value) == F.col("_two"))) & (F.col("_one").isNull() | (F.col(value) != F.col("_one")))
    return rows.groupBy(*partition).agg(F.bool_and(fine).alias("alternates"), F.count(F.lit(1)).alias("n"))


def numbered_spans(df: DataFrame, partition: list[str], number: str, order: list[str], kind: str, start: str, stop: str) -> DataFrame:
    """(partition, number, opened, closed) of spans that starts and stops of one number mark, such as groups of parts.

    A start is closed by the stop that follows it among its number's marks; one that
    another start follows, or nothing, has a null ``closed``. Stops without a start are left out.
    """
    at = order[0]
    own = W.partitionBy(*partition, number).orderBy(*order)
    rows = df.where(F.col(kind).isin(start, stop)).withColumns({"_next": F.lead(kind).over(own), "closed": F.lead(at).over(own)})
    closed = F.when(F.col("_next") == stop, F.col("closed")).alias("closed")
    return rows.where(F.col(kind) == start).select(*partition, number, F.col(at).alias("opened"), closed)


def first_few(items: Column, n: int) -> Column:
    """struct(shown, more): the first ``n`` elements, and how many are left out."""
    return F.struct(F.slice(items, 1, n).alias("shown"), F.greatest(F.size(items) - n, F.lit(0)).alias("more"))


def started_groups(df: DataFrame, group: str, order: list[str], started: Column, most: int) -> DataFrame:
    """Rows of the first ``most`` groups with a started row, by their first place in order."""
    first = df.where(started).groupBy(group).agg(F.min(F.struct(*order)).alias("_o")).orderBy("_o", group).limit(most)
    return df.join(F.broadcast(first.select(group)), group, "left_semi")


def numeric_id(ident: Column, mark: str = ":") -> Column:
    """The number after the mark of an id, for sorting; null if there is none."""
    return F.substring_index(ident, mark, -1).try_cast("bigint")


def by_rank(column: Column, order: list[str]) -> Column:
    """The place of a value in a fixed order; other values come last."""
    return F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, order)), column), F.lit(0)), F.lit(len(order) + 1))


def zipped(a: Column, b: Column) -> Column:
    """struct(pairs, fault): two parallel arrays as pairs, or why they don't go together."""
    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    fault = F.coalesce(
        F.when(F.size(a) != F.size(b), F.lit("lengths")), F.when(F.size(F.array_distinct(a)) < F.size(a), F.lit("repeated")), F.when(F.sort_array(a) != a, F.lit("unsorted"))
    )
    return F.struct(F.when(fault.isNull(), pairs).alias("pairs"), fault.alias("fault"))


def rotated_merge(preferred: Column, others: Column) -> Column:
    """The preferred elements first, then the others, each once, in order."""
    return F.array_distinct(F.concat(preferred, others))


def label_candidates(boxes: DataFrame, x: float, top: float, bottom: float, longest: int) -> DataFrame:
    """Text boxes (x0, y0, y1, text, width, height) in the left part and the middle band of their page, short and with letters."""
    return boxes.where(
        (F.col("x0") <= F.col("width") * x) & (F.col("y0") >= F.col("height") * top) & (F.col("y1") <= F.col("height") * bottom)
        & (F.length(F.trim("text")) <= longest) & F.col("text").rlike(r"\p{L}")
    )


def classified_parts(parts: DataFrame, work: str, kind: str, names: dict[str, str], topics: dict[int, str], lead: str, many: str, mixed: str) -> DataFrame:
    """Per work the instrumentation text, its topic and the number of players, from its parts.

    Kinds are counted and named in order of the names; a work of the lead alone has the
    topic of its number, any other one is mixed. Unknown kinds leave the topic open.
    """
    counts = parts.groupBy(work, kind).agg(F.count(F.lit(1)).alias("_n"))
    label = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[F.col(kind)]
    rank = by_rank(F.col(kind), list(names))
    item = F.struct(rank.alias("r"), F.col(kind).alias("k"), F.when(F.col("_n") > 1, F.concat(F.col("_n").cast("string"), F.lit(" "), label)).otherwise(label).alias("t"))
    out = counts.groupBy(work).agg(
        F.array_sort(F.collect_list(item)).alias("_i"), F.sum("_n").alias("players"), F.bool_and(F.col(kind) == lead).alias("_alone"), F.bool_or(label.isNull()).alias("_unknown")
    )
    by_count = F.coalesce(*(F.when(F.col("players") == n, F.lit(t)) for n, t in topics.items()), F.lit(many))
    topic = F.when(F.col("_unknown"), F.lit("unspecified")).when(F.col("_alone"), by_count).otherwise(F.lit(mixed))
    return out.select(work, F.array_join(F.transform("_i", lambda i: F.coalesce(i["t"], i["k"])), ", ").alias("instrumentation"), topic.alias("topic"), "players")


def crosscheck_status(pairs: DataFrame, key: str, outcome: str) -> DataFrame:
    """Per file the status of its matched groups: differs if one does, partial if one is missing, else agrees."""
    return pairs.groupBy(key).agg(
        F.when(F.bool_or(F.col(outcome) == "different"), "differs").when(F.bool_or(F.col(outcome) == "missing"), "partial").otherwise("agrees").alias("status"),
        F.count(F.lit(1)).alias("groups"),
    )


def reclaimable(files: DataFrame, inode: str, links: str, size: str) -> DataFrame:
    """Per content what replacing its files by links to one inode frees.

    An inode's bytes are freed if all its links are among the files; the inode that is
    kept, the smallest of a content, isn't.
    """
    nodes = files.groupBy("digest", inode).agg(F.count(F.lit(1)).alias("_paths"), F.max(links).alias("_links"), F.max(size).alias("_size"))
    kept = nodes.groupBy("digest").agg(F.min(inode).alias("_kept"))
    freed = F.when((F.col(inode) != F.col("_kept")) & (F.col("_paths") >= F.col("_links")), F.col("_size")).otherwise(0)
    return nodes.join(kept, "digest").groupBy("digest").agg(F.sum(freed).alias("bytes"), F.sum((freed > 0).cast("long")).alias("inodes"))


def flattened(raw: Column, fields: dict[str, str]) -> Column:
    """Fields of a JSON text by path; null where there is none."""
    v = F.try_parse_json(raw)
    return F.struct(*(F.try_variant_get(v, path, "string").alias(n) for n, path in fields.items()))
