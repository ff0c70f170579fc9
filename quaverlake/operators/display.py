"""Projections of native records into what is shown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import facets


def fallback_fields(details: Column, native: Column, pairs: list[tuple[str, str]]) -> Column:
    """Details with missing fields taken from native ones: (native, shown) pairs, the first that has a value wins; links don't.

    details and native: map<string,string>.
    """

    def filled(details: Column, source: str, shown: str) -> Column:
        value = native[source]
        fits = details[shown].isNull() & value.isNotNull() & ~value.rlike("https?://")
        others = F.map_filter(details, lambda k, v: k != shown)
        return F.when(fits, F.map_concat(others, F.create_map(F.lit(shown), value))).otherwise(details)

    return reduce(lambda out, pair: filled(out, *pair), pairs, details)


def project_notes(details: Column, drop: list[str], note: str, facts: list[str], wording: str) -> Column:
    """struct(details, fault): editorial notes as readers see them.

    Keys in ``drop`` go. A note that states all ``facts`` is replaced by ``wording``; one
    that doesn't has not been reviewed: the fault says so and the note goes.
    """
    kept = F.map_filter(details, lambda k, v: ~k.isin(*drop, note))
    text = F.lower(F.coalesce(details[note], F.lit("")))
    stated = F.lit(True)
    for fact in facts:
        stated = stated & F.contains(text, F.lit(fact))
    told = F.when((text != "") & stated, F.map_concat(kept, F.create_map(F.lit(note), F.lit(wording)))).otherwise(kept)
    return F.struct(told.alias("details"), F.when((text != "") & ~stated, F.lit("unreviewed_note")).alias("fault"))


def repaired_placeholder(value: Column, placeholder: str, names: Column, mark: str = "；") -> Column:
    """A declaration, or instead of the placeholder the non-blank names joined; null without any."""
    known = F.filter(names, lambda n: n.isNotNull() & (F.trim(n) != ""))
    return F.when(value == placeholder, F.when(F.size(known) > 0, F.array_join(known, mark))).otherwise(value)


def material_type(form: Column, notes: Column, recordings: list[str], recording_pattern: str, types: dict[str, str]) -> Column:
    """recording by a form's name or pattern, else the type that the notes or the form name, else null."""
    return F.coalesce(
        F.when(form.isin(*recordings) | form.rlike(recording_pattern), F.lit("recording")),
        *(F.when((notes == name) | (form == name), F.lit(t)) for name, t in types.items()),
    )


def identity(df: DataFrame, required: list[str]) -> DataFrame:
    """Adds ``missing``: the required text columns that are null or blank, in order."""
    return df.withColumn("missing", facets.issues(*((c, F.coalesce(F.trim(F.col(c)), F.lit("")) == "") for c in required)))


def converted(raw: Column, fields: dict[str, str], allowed: dict[str, list[str]] | None = None) -> Column:
    """struct(record, reason) of a JSON text: the record with the fields' types, or why it is refused.

    A refused record is null: text that isn't an object, a field that is missing or of
    another type, or a value that isn't among its allowed ones.
    """
    v = F.try_parse_json(raw)
    got = {n: F.try_variant_get(v, f"$.{n}", t) for n, t in fields.items()}
    rules = [("not_an_object", v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))]
    rules += [(f"missing_{n}", F.try_variant_get(v, f"$.{n}", "variant").isNull() | F.is_variant_null(F.try_variant_get(v, f"$.{n}", "variant"))) for n in fields]
    rules += [(f"type_of_{n}", got[n].isNull()) for n in fields]
    rules += [(f"value_of_{n}", ~got[n].isin(*values)) for n, values in (allowed or {}).items()]
    reason = facets.first_reason(*rules)
    record = F.struct(*(c.alias(n) for n, c in got.items()))
    return F.struct(F.when(reason.isNull(), record).alias("record"), reason.alias("reason"))


def decision_details(basis: Column, note: Column, instrumentation: Column, players: Column, names: dict[str, str], file_basis: str) -> Column:
    """What is shown of a reviewed decision, as a map; the players are reviewed ones if files are the basis, else declared."""
    basis_name = F.create_map(*(F.lit(x) for pair in names.items() for x in pair))[basis]
    out = F.create_map(F.lit("classification_note"), note, F.lit("classification_basis"), basis_name, F.lit("reviewed_instrumentation"), instrumentation)
    key = F.when(basis == file_basis, F.lit("reviewed_player_count")).otherwise(F.lit("declared_player_count"))
    return F.when(players.isNull(), out).otherwise(F.map_concat(out, F.create_map(key, players.cast("string"))))


def csv_form(text: Column) -> Column:
    """A text as a CSV cell gives it back: line ends are one newline, outer blanks go."""
    return F.trim(F.regexp_replace(text, r"\r\n?", "\n"))


def public_labels(df: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """Adds each label: its first column with a non-blank value, else an empty text."""
    return df.withColumns({label: F.coalesce(*(F.nullif(F.trim(F.col(c)), F.lit("")) for c in sources), F.lit("")) for label, sources in columns.items()})


def normalised_archive(items: DataFrame, persons: DataFrame, key: str, places: DataFrame) -> DataFrame:
    """Archive items with their persons by role and their first place, one row an item.

    persons: (key, role, name, seq); places: (key, place). Names of a role are joined in
    order, each once.
    """
    names = persons.groupBy(key, "role").agg(F.array_sort(F.collect_set(F.struct("seq", "name"))).alias("_n"))
    names = names.select(key, "role", F.array_join(F.array_distinct(F.transform("_n", lambda n: n["name"])), "；").alias("names"))
    roles = names.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("role", "names")))).alias("persons"))
    return items.join(roles, key, "left").join(places.groupBy(key).agg(F.min("place").alias("place")), key, "left")
