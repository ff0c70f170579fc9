"""Ranked search over records with composer, title and metadata fields, and typo recovery.

The fields of a group are one text: a line each, with a space on either side. So a whole
field, a word, a prefix and a number phrase inside one field are all plain substring
tests, which stay in generated code and need no arrays of words.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Cost of a term by where it is found: as a whole field, a word, a prefix of a word, within a word.
COSTS = {"composer": (0, 1, 2, 6), "title": (2, 3, 4, 7), "metadata": (8, 9, 10, 11)}
#: What a query gains that is a whole composer field, or else a whole title field.
BONUS = {"composer": 0.75, "title": 0.5}
#: Words that make a number after them one phrase.
NUMBERING = ("op", "opus", "no", "nr")
#: Typo recovery takes so many terms and characters of a query at most.
MOST_TERMS, MOST_CHARACTERS = 12, 160


def lines(fields: Column) -> Column:
    """An array of normalised fields as one text; empty and null ones are left out."""
    fields = F.array_distinct(F.filter(fields, lambda f: f.isNotNull() & (f != "")))
    return F.concat(F.lit("\n "), F.array_join(fields, " \n "), F.lit(" \n"))


def _has(group: Column, text: str) -> Column:
    return F.contains(group, F.lit(text))


def found(group: Column, term: str) -> Column:
    """A number must be a word of its own; other terms may stand anywhere."""
    return _has(group, f" {term} " if term.isdigit() else term)


def strength(group: Column, term: str, costs: tuple[int, ...]) -> Column:
    """The cost of a term in a group of fields, null if it isn't there."""
    whole, word, prefix, inside = costs
    out = F.when(_has(group, f"\n {term} \n"), whole).when(_has(group, f" {term} "), word)
    if not term.isdigit():
        out = out.when(_has(group, f" {term}"), prefix).when(_has(group, term), inside)
    return out


def phrases(terms: list[str]) -> list[str]:
    """Numbers with the word before them that says what they number."""
    return [f" {a} {b} " for a, b in zip(terms, terms[1:]) if a in NUMBERING and b.isdigit()]


def relevance(query: str) -> Column:
    """The cost of a normalised query over the groups of COSTS (low is good), null if a term isn't found anywhere."""
    terms = query.split()
    cost = lambda t: F.least(*(strength(F.col(g), t, c) for g, c in COSTS.items()))
    total = reduce(lambda a, b: a + b, map(cost, terms), F.lit(0))
    bonus = F.coalesce(*(F.when(_has(F.col(g), f"\n {query} \n"), F.lit(b)) for g, b in BONUS.items()), F.lit(0.0))
    return total.cast("double") - (bonus if terms else 0.0)


def matches_all(groups: list[Column], terms: list[str]) -> Column:
    """Every term in some group, and every number phrase inside one field."""
    parts = [reduce(lambda a, b: a | b, (found(g, t) for g in groups)) for t in terms]
    parts += [reduce(lambda a, b: a | b, (_has(g, p) for g in groups)) for p in phrases(terms)]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def exact(index: DataFrame, query: str) -> DataFrame:
    """Records that have every term, with their relevance and whether their own fields suffice.

    index: id and the groups of COSTS as ``lines``, with aliases in composer and title;
    where there are ``own_composer`` and ``own_title`` (without aliases), match_type is
    exact if these and the metadata have all terms, else alias.
    """
    terms = query.split()
    groups = [F.col(g) for g in COSTS]
    out = index.where(matches_all(groups, terms)).withColumn("relevance", relevance(query))
    if {"own_composer", "own_title"} <= set(index.columns):
        own = matches_all([F.col("own_composer"), F.col("own_title"), F.col("metadata")], terms)
        out = out.withColumn("match_type", F.when(own, "exact").otherwise("alias"))
    return out


def first_page(hits: DataFrame, order: list[Column], size: int, pages: int = 1) -> DataFrame:
    """The first ``pages`` pages with their places; only these rows are numbered."""
    top = hits.orderBy(*order).limit(size * pages)
    return top.withColumn("place", F.row_number().over(W.orderBy(*order)))


def eligible(bridge: DataFrame, works: DataFrame, categories: DataFrame, facets: list[Column]) -> DataFrame:
    """Memberships (id, category, ...) that satisfy all facets; a category without a kind takes the record's own.

    works: (id, declared_kind); categories: (category, kind, ...). Facets may name
    ``kind``, and any column of bridge and categories.
    """
    rows = bridge.join(categories, "category").join(works.select("id", "declared_kind"), "id")
    kind = F.when((F.col("kind") == "unspecified") & (F.col("declared_kind") != "unspecified"), F.col("declared_kind")).otherwise(F.col("kind"))
    return rows.withColumn("kind", kind).where(reduce(lambda a, b: a & b, facets, F.lit(True)))


def scoped(works: DataFrame, members: DataFrame, fields: list[str]) -> DataFrame:
    """Works with a membership in ``members``, with ``metadata`` of their own (array) and of these memberships' fields."""
    own = members.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list(F.array(*fields)))).alias("_scope"))
    out = works.join(own, "id")
    return out.withColumn("metadata", lines(F.concat("metadata", "_scope"))).drop("_scope")


def with_aliases(works: DataFrame, composer_aliases: DataFrame, work_aliases: DataFrame) -> DataFrame:
    """Adds aliases: by composer (composer_key, alias) and by work (id, alias), both normalised.

    works: id, composer_key and arrays composer, title. Where ``attributed`` is false the
    name isn't the composer's, so neither it nor its aliases are searched as one.
    """
    by_name = composer_aliases.groupBy("composer_key").agg(F.collect_set("alias").alias("_names"))
    by_work = work_aliases.groupBy("id").agg(F.collect_set("alias").alias("_titles"))
    out = works.join(by_name, "composer_key", "left").join(by_work, "id", "left")
    none = F.array().cast("array<string>")
    own = F.when(F.col("attributed"), F.col("composer")).otherwise(none)
    names = F.when(F.col("attributed"), F.concat(F.col("composer"), F.coalesce("_names", none))).otherwise(none)
    return out.withColumns(
        {"own_composer": lines(own), "own_title": lines(F.col("title")), "composer": lines(names), "title": lines(F.concat("title", F.coalesce("_titles", none)))}
    ).drop("_names", "_titles")


def tolerance(term: str) -> int:
    """Edits that a term may have: none in numbers and short words; terms of Han characters are short earlier."""
    if all("\u3400" <= c <= "\u9fff" for c in term):
        return 0 if not 3 <= len(term) <= 24 else 1 if len(term) < 7 else 2
    return 0 if not term.isalpha() or not 4 <= len(term) <= 40 else 1 if len(term) < 8 else 2


def fuzzy(postings: DataFrame, query: str, distance, most: int = 2) -> DataFrame:
    """Records that have a near word for each term, with the sum of edits; nothing for longer queries than recovery takes.

    postings: (id, word). One pass compares the vocabulary with all terms, after cheap
    tests of the length and of letters that a word lacks; near words are joined back.
    """
    terms = list(dict.fromkeys(query.split()))
    if not terms or len(query.split()) > MOST_TERMS or len(query) > MOST_CHARACTERS:
        return postings.where("false").select("id", F.lit(0).cast("long").alias("cost"))
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("term"), F.lit(tolerance(t)).alias("k")) for t in terms))).alias("t")
    pairs = postings.select("word").distinct().select("word", each).select("word", "t.*")
    letters = lambda c: F.array_distinct(F.split(c, ""))
    lacks = F.size(F.array_except(letters(F.col("term")), letters(F.col("word"))))
    han = F.col("term").rlike(r"^[\x{3400}-\x{9fff}]+$")  # such a term may be any part of a longer word
    near_length = F.when(han, F.length("word") >= F.length("term") - F.col("k")).otherwise(F.abs(F.length("word") - F.length("term")) <= F.col("k"))
    pairs = pairs.where(near_length & (lacks <= F.col("k")))
    near = pairs.withColumn("cost", distance(F.col("word"), F.col("term"))).where("cost between 0 and k").select("word", "term", "cost")
    hits = postings.join(near, "word").groupBy("id", "term").agg(F.min("cost").alias("cost"))
    out = hits.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("cost").cast("long").alias("cost"))
    return out.where((F.col("n") == len(terms)) & (F.col("cost") <= most)).select("id", "cost")


def search(index: DataFrame, postings: DataFrame, query: str, distance) -> tuple[str, DataFrame]:
    """(mode, hits): exact and alias hits, or only where there is none at all those of typo recovery."""
    hits = exact(index, query)
    if not query.split() or not hits.isEmpty():
        return "exact", hits
    return "fuzzy", index.join(fuzzy(postings, query, distance), "id").withColumn("relevance", F.col("cost").cast("double"))


def all_postings(postings: DataFrame, terms: list[str]) -> DataFrame:
    """Ids (id) that have every term as a word, from stored postings (id, word): only the terms' rows are read."""
    hits = postings.where(F.col("word").isin(*terms)).distinct()
    return hits.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(set(terms))).select("id")


def suggest(hits: DataFrame, query: str, order: list[Column], composers: int = 3, total: int = 6) -> DataFrame:
    """(place, kind, label, query): up to ``composers`` composers that have every term, then works, ``total`` in all, each text once.

    hits: composer_key, composer_label, composer (lines), work_label, canonical (a work's
    title and composer, normalised) and metadata (lines). A work's query keeps the terms
    that only its metadata has.
    """
    terms = query.split()
    if len(query) < 2:
        return hits.select(F.lit(0).alias("place"), F.lit("").alias("kind"), F.lit("").alias("label"), F.lit("").alias("query")).where("false")
    rank = F.struct(*(c.alias(f"o{n}") for n, c in enumerate(order)))
    first = hits.where((F.col("composer_key") != "") & matches_all([F.col("composer")], terms)).groupBy("composer_key")
    first = first.agg(F.min(rank).alias("rank"), F.min_by("composer_label", rank).alias("label"))
    first = first.orderBy("rank").limit(composers).select(F.lit(0).alias("part"), "rank", F.lit("composer").alias("kind"), "label", F.col("composer_key").alias("query"))
    kept = F.array_compact(F.array(*(F.when(~found(lines(F.array("canonical")), t) & found(F.col("metadata"), t), F.lit(t)) for t in terms)))
    works = hits.withColumn("query", F.concat_ws(" ", "canonical", F.array_join(kept, " "))).withColumn("query", F.trim("query"))
    works = works.groupBy("query").agg(F.min(rank).alias("rank"), F.min_by("work_label", rank).alias("label")).orderBy("rank").limit(total)
    both = first.union(works.select(F.lit(1).alias("part"), "rank", F.lit("work").alias("kind"), "label", "query"))
    once = both.groupBy("query").agg(F.min(F.struct("part", "rank", "kind", "label")).alias("m"))  # a few rows
    top = once.orderBy("m.part", "m.rank").limit(total)
    return top.select(F.row_number().over(W.orderBy("m.part", "m.rank")).alias("place"), "m.kind", "m.label", "query")
