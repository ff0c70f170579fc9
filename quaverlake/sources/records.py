"""Readers of replayed pages, exchange formats and review tables, from texts in a column or files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import readers


def page_faults(pages: DataFrame, feed: str) -> DataFrame:
    """(feed, fault) of replayed pages (feed, page, next, items array): a page that is missing or comes twice, or a chain that doesn't end."""
    own = pages.groupBy(feed).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("page").alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"),
        F.count_if(F.col("next").isNull()).alias("ends"), F.max_by("next", "page").alias("tail"), F.count_if(F.col("next") != F.col("page") + 1).alias("jumps"),
    )
    faults = F.array_compact(
        F.array(
            F.when(F.col("n") != F.col("pages"), F.lit("page_twice")),
            F.when(F.col("pages") != F.col("last") - F.col("first") + 1, F.lit("page_missing")),
            F.when((F.col("ends") != 1) | F.col("tail").isNotNull(), F.lit("no_end")),
            F.when(F.col("jumps") > 0, F.lit("wrong_continuation")),
        )
    )
    return own.select(feed, F.explode(faults).alias("fault"))


def paged_items(pages: DataFrame, feed: str, key: str) -> DataFrame:
    """Items of all pages (feed, page, items array<struct>), of one key the first page's only."""
    rows = pages.select(feed, "page", F.posexplode("items").alias("_at", "_item"))
    first = rows.groupBy(feed, F.col(f"_item.{key}").alias("_key")).agg(F.min_by("_item", F.struct("page", "_at")).alias("item"))
    return first.select(feed, "item.*")


def unanswered(requested: DataFrame, answered: DataFrame, key: str) -> DataFrame:
    """(key, fault): requested keys without an answer, and answers that nobody asked for."""
    lost = requested.select(key).distinct().join(answered.select(key), key, "left_anti").select(key, F.lit("missing").alias("fault"))
    odd = answered.select(key).distinct().join(requested.select(key), key, "left_anti").select(key, F.lit("unrequested").alias("fault"))
    return lost.union(odd)


def pager_faults(pages: DataFrame, feed: str) -> DataFrame:
    """Search pages (feed, start, size, total, ids array) whose pager contradicts itself, by feed."""
    own = pages.groupBy(feed).agg(
        F.count_distinct("total").alias("totals"), F.max("total").alias("total"), F.sum(F.size("ids")).alias("items"),
        F.size(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"), F.count_if(F.size("ids") > F.col("size")).alias("long"),
    )
    faults = F.array_compact(
        F.array(
            F.when(F.col("totals") > 1, F.lit("totals_differ")), F.when(F.col("items") != F.col("ids"), F.lit("record_twice")),
            F.when(F.col("ids") != F.col("total"), F.lit("incomplete")), F.when(F.col("long") > 0, F.lit("page_too_long")),
        )
    )
    return own.select(feed, F.explode(faults).alias("fault"))


def marc_fields(xml: Column, wanted: dict[str, tuple[str, str]]) -> Column:
    """struct of the wanted subfields (name: (tag, code)) of a MARC record in XML, each an array in order."""
    path = lambda tag, code: f"//*[local-name()='datafield'][@tag='{tag}']/*[local-name()='subfield'][@code='{code}']/text()"
    return F.struct(*(F.xpath(xml, F.lit(path(*spot))).alias(name) for name, spot in wanted.items()))


def marc_control(xml: Column, tag: str) -> Column:
    return F.xpath_string(xml, F.lit(f"//*[local-name()='controlfield'][@tag='{tag}']"))


def linked_data(raw: Column, fields: dict[str, str]) -> Column:
    """struct of fields of a JSON-LD document by key; a language map or a list of values gives its first text."""
    v = F.try_parse_json(raw)
    get = lambda path: F.try_variant_get(v, path, "string")
    one = lambda k: F.coalesce(get(f"$['{k}']['@value']"), get(f"$['{k}'][0]['@value']"), get(f"$['{k}'][0]"), get(f"$['{k}']"))
    return F.struct(*(one(k).alias(n) for n, k in fields.items()))


def header_fields(text: Column) -> Column:
    """map of ``name = "value"`` lines in the header block of a notation source; of a name that repeats the first."""
    block = F.regexp_extract(text, r"(?s)\\header\s*\{(.*?)\n?\}", 1)
    pairs = F.regexp_extract_all(block, F.lit(r'(?m)^\s*(\w+\s*=\s*"(?:[^"\\]|\\.)*")'), 1)
    entry = lambda p: F.struct(F.trim(F.substring_index(p, "=", 1)).alias("k"), F.regexp_extract(p, r'=\s*"(.*)"$', 1).alias("v"))
    entries = F.transform(pairs, entry)
    keys = F.transform(entries, lambda e: e["k"])
    first = F.filter(F.transform(entries, lambda e, i: F.struct(e["k"], e["v"], (F.array_position(keys, e["k"]) == i + 1).alias("first"))), lambda e: e["first"])
    return F.map_from_arrays(F.transform(first, lambda e: e["k"]), F.transform(first, lambda e: e["v"]))


def index_lines(text: Column, pattern: str) -> Column:
    """array of struct(label, target) of a README's links whose target fits the pattern."""
    found = F.regexp_extract_all(text, F.lit(r"(\[[^\]]*\]\([^)\s]+\))"), 1)
    rows = F.transform(found, lambda p: F.struct(F.regexp_extract(p, r"^\[([^\]]*)\]", 1).alias("label"), F.regexp_extract(p, r"\(([^)]+)\)$", 1).alias("target")))
    return F.filter(rows, lambda r: r["target"].rlike(pattern))


def tsv_review(spark: SparkSession, path: str, columns: list[str], key: str) -> DataFrame:
    """A review table of tab-separated texts with a header; a key that is blank or repeats fails."""
    rows = spark.read.schema(", ".join(f"{c} string" for c in columns)).option("sep", "\t").option("header", True).option("mode", "FAILFAST").option("quote", "").csv(path)
    broken = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 or {key} is null or trim({key}) = ''").limit(5).collect()  # a few for the message
    if broken:
        raise ValueError(f"keys of {path}: {[r[0] for r in broken]}")
    return rows


def member_map(rows: DataFrame, member: str, ident: str) -> DataFrame:
    """(member, ids): of each archive member the ids of the rows that name it, sorted."""
    return rows.where(F.col(member).isNotNull()).groupBy(member).agg(F.array_sort(F.collect_set(ident)).alias("ids"))


def config_union(parts: dict[str, DataFrame], name: str, order: list[Column]) -> DataFrame:
    """The configured rows of several lists with the list they are in, sorted; a name that two rows have fails."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (df.withColumn("list", F.lit(k)) for k, df in parts.items()))
    twice = out.groupBy(F.lower(name).alias("n")).agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(5).collect()  # a few for the message
    if twice:
        raise ValueError(f"names of two configured rows: {[r.n for r in twice]}")
    return out.orderBy(*order)


def source_catalog(spark: SparkSession, root: str, source: str, schema: str, overlays: list[tuple[DataFrame, str]] = ()) -> DataFrame:
    """The records of one source's catalog below ``root``, with overlays (rows, key) put over them in order.

    The file must say that it is this source's, every id must have its prefix, and no
    path of a record may leave the source's folder.
    """
    if source in ("", ".", "..") or "/" in source:
        raise ValueError(f"not a source: {source!r}")
    rows = readers.json_documents(spark, f"{root}/{source}/catalog.json", f"source_id string, works array<{schema}>")
    other = rows.where(~F.coalesce(F.col("source_id") == source, F.lit(False))).limit(1).collect()
    if other:
        raise ValueError(f"the catalog of {source} is of {other[0].source_id}")
    works = rows.select(F.explode("works").alias("w")).select("w.*")
    bad = ~F.coalesce(F.col("id").startswith(f"{source}:"), F.lit(False))
    if "path" in works.columns:
        bad = bad | F.coalesce(F.col("path").startswith("/") | F.arrays_overlap(F.split("path", "[/\\\\]"), F.array(F.lit(".."))), F.lit(False))
    broken = works.where(bad).limit(5).collect()  # a few for the message
    if broken:
        raise ValueError(f"records of {source} out of bounds: {[r.id for r in broken]}")
    for patch, key in overlays:
        new = [c for c in patch.columns if c != key]
        p = patch.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_{c}") for c in new))
        works = works.join(p, F.col(key) == F.col("_k"), "left")
        works = works.withColumns({c: F.coalesce(f"_{c}", c) if c in works.columns else F.col(f"_{c}") for c in new}).drop("_k", *(f"_{c}" for c in new))
    return works


def file_digests(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size, modified, sha256) of whole files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, fault) of files that a second scan finds gone, new or with another size, time or content."""
    a = before.select("path", F.struct("size", "modified", "sha256").alias("a"))
    b = after.select("path", F.struct("size", "modified", "sha256").alias("b"))
    fault = F.when(F.col("b").isNull(), "gone").when(F.col("a").isNull(), "new").when(F.col("a.sha256") != F.col("b.sha256"), "content").when(~F.col("a").eqNullSafe(F.col("b")), "touched")
    return a.join(b, "path", "full").select("path", fault.alias("fault")).where("fault is not null")


def object_path(digest: Column, extension: str) -> Column:
    """The place of a content in a store that is addressed by digests."""
    return F.concat(F.substring(digest, 1, 2), F.lit("/"), F.substring(digest, 3, 2), F.lit("/"), digest, F.lit(extension))


def rendered_table(df: DataFrame, columns: list[str]) -> Column:
    """A row as a line of a Markdown table: bars and line ends inside cells are escaped."""
    cell = lambda c: F.regexp_replace(F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", "<br>")
    return F.concat(F.lit("| "), F.concat_ws(" | ", *map(cell, columns)), F.lit(" |"))


def rendered_cells(line: Column) -> Column:
    """The cells of such a line, as they were."""
    inner = F.regexp_replace(line, r"^\|\s?|\s?\|$", "")
    cells = F.split(inner, r"(?<!\\)\s\|\s")
    return F.transform(cells, lambda c: F.replace(F.replace(c, F.lit("<br>"), F.lit("\n")), F.lit("\\|"), F.lit("|")))
