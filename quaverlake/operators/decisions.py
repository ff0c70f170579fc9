"""Rules on evidence, decisions, rankings, aliases, bindings and preservation, as tables of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks, facets

HAN = r"[\x{3400}-\x{9fff}]"


def invariants(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(rule, key) of every rule that a row breaks, in one pass; a rule whose condition is null is broken."""
    broken = facets.issues(*((name, ~F.coalesce(holds, F.lit(False))) for name, holds in rules.items()))
    return df.select(F.explode(broken).alias("rule"), F.col(key).cast("string").alias("key"))


def translation_fault(status: Column, basis: Column, reason: Column, original: Column, shown: Column) -> Column:
    """The first fault of a field's translation evidence, or null.

    Translated states need a basis and Han text; retained text needs something to show
    and a reason; an untranslated field is empty; one that doesn't apply has nothing.
    """
    blank = lambda c: F.trim(c) == ""
    return facets.first_reason(
        ("status", ~F.coalesce(status.isin("reviewed", "reference", "machine", "retained", "untranslated", "not_applicable"), F.lit(False))),
        ("evidence", basis.isNull() | reason.isNull()),
        ("basis", ~status.isin("untranslated", "not_applicable") & blank(basis)),
        ("han", status.isin("reviewed", "reference", "machine") & (blank(shown) | ~shown.rlike(HAN))),
        ("retained", (status == "retained") & (blank(F.concat(shown, original)) | blank(reason))),
        ("untranslated", (status == "untranslated") & (shown != "")),
        ("not_applicable", (status == "not_applicable") & ((original != "") | (shown != ""))),
    )


def decision_faults(decisions: DataFrame, records: DataFrame, evidence: DataFrame, exact: dict[str, int], file_basis: str, open_topics: list[str]) -> DataFrame:
    """(id, fault) of reviewed classifications.

    decisions: id, digest, topic, basis, players; records: id, digest; evidence: id,
    kind, value, actual. A decision needs its record as it was seen, evidence that all
    still holds, a file if files are its basis, and the players that its topic says.
    """
    states = evidence.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("value").eqNullSafe(F.col("actual")) & F.col("actual").isNotNull()).alias("holds"), F.bool_or(F.col("kind") == "file").alias("file")
    )
    rows = decisions.join(records.select("id", F.col("digest").alias("_now")), "id", "left").join(states, "id", "left")
    wanted = F.create_map(*(F.lit(x) for pair in exact.items() for x in pair))[F.col("topic")]
    faults = facets.issues(
        ("missing_record", F.col("_now").isNull()),
        ("stale", F.col("_now") != F.col("digest")),
        ("no_evidence", F.col("n").isNull()),
        ("evidence_differs", ~F.col("holds")),
        ("no_file", (F.col("basis") == file_basis) & ~F.coalesce("file", F.lit(False))),
        ("players", wanted.isNotNull() & ~F.col("players").eqNullSafe(wanted)),
        ("open_topic_with_players", F.col("topic").isin(*open_topics) & F.col("players").isNotNull()),
    )
    return rows.select("id", F.explode(faults).alias("fault"))


def ranking_faults(entries: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, key, fault) of ranking entries (kind, key, weight): unknown identities and weights that aren't whole numbers of 0 to 100."""
    rows = entries.join(known.select("kind", "key", F.lit(True).alias("_known")).distinct(), ["kind", "key"], "left")
    weight = F.col("weight").cast("double")
    bad = F.coalesce((weight < 0) | (weight > 100) | (weight != F.floor(weight)), F.lit(True))
    return rows.select("kind", "key", F.explode(facets.issues(("unknown", F.col("_known").isNull()), ("weight", bad))).alias("fault"))


def alias_faults(aliases: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, key, fault) of alias lists (kind, key, aliases array): unknown identities, empty lists, blanks and repeats."""
    rows = aliases.join(known.select("kind", "key", F.lit(True).alias("_known")).distinct(), ["kind", "key"], "left")
    a = F.coalesce("aliases", F.array().cast("array<string>"))
    faults = facets.issues(
        ("unknown", F.col("_known").isNull()),
        ("empty", F.size(a) == 0),
        ("blank", F.exists(a, lambda x: x.isNull() | (F.trim(x) == ""))),
        ("repeated", F.size(F.array_distinct(a)) < F.size(a)),
    )
    return rows.select("kind", "key", F.explode(faults).alias("fault"))


def binding_faults(pages: DataFrame, categories: DataFrame) -> DataFrame:
    """(rule, key) where pages (page, category) and categories (category, member) don't bind one to one."""
    p = pages.select("category", F.col("page").alias("member"))
    c = categories.select("category", "member")
    key = F.concat_ws("/", F.col("category").cast("string"), F.col("member").cast("string"))
    parts = [
        p.join(c, ["category", "member"], "left_anti").select(F.lit("page_without_member").alias("rule"), key.alias("key")),
        c.join(p, ["category", "member"], "left_anti").select(F.lit("member_without_page").alias("rule"), key.alias("key")),
        c.groupBy("category", "member").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("member_twice").alias("rule"), key.alias("key")),
    ]
    return checks.violations(*parts)


def preservation(before: DataFrame, after: DataFrame, key: str, kept: list[str], may_grow: list[str] = ()) -> DataFrame:
    """(key, fault) of a new edition: rows that went, kept columns that changed, and arrays that lost elements.

    New rows are fine. Columns that aren't named may change.
    """
    new = after.select(key, F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in [*kept, *may_grow]))
    rows = before.select(key, *kept, *may_grow).join(new, key, "left")
    faults = [("gone", F.col("_there").isNull())]
    faults += [(f"changed_{c}", F.col("_there") & ~F.col(c).eqNullSafe(F.col(f"_{c}"))) for c in kept]
    faults += [(f"lost_{c}", F.col("_there") & (F.size(F.array_except(F.col(c), F.col(f"_{c}"))) > 0)) for c in may_grow]
    return rows.select(key, F.explode(facets.issues(*faults)).alias("fault"))


def accepted(rows: DataFrame, faults: DataFrame, key: str) -> DataFrame:
    """Rows without a fault."""
    return rows.join(faults.select(key).distinct(), key, "left_anti")


def forbidden_paths(raw: Column, names: list[str]) -> Column:
    """Keys of a JSON text, at any depth, that are forbidden (case aside), each once, sorted."""
    keys = F.regexp_extract_all(F.to_json(F.try_parse_json(raw)), F.lit(r'"((?:[^"\\]|\\.)*)":'), 1)
    low = F.transform(keys, F.lower)
    return F.array_sort(F.array_distinct(F.filter(low, lambda k: k.isin(*names))))


def all_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a & b, conditions)
