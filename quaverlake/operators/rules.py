"""Filters with reasons: names, scopes, addresses, files and parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from . import facets


def category_reason(name: Column, size: Column, pages: Column, prefix: str, subject: str, others: dict[str, str], pure: str, markers: list[str]) -> Column:
    """Why a category isn't a pure one of the subject, or null.

    others: reasons by a phrase that gives them; pure: what the whole normalised name
    must fit; a name that doesn't is mixed if it has a marker, else of no known structure.
    """
    low = F.lower(name)
    malformed = (name != F.trim(name)) | ~name.startswith(prefix) | name.rlike(r"[\x00-\x1f\x7f]|\s{2}|[{}\[\]|<>]")
    rules = [("malformed_name", malformed), (f"not_{subject}", ~F.contains(low, F.lit(subject)))]
    rules += [(reason, F.contains(low, F.lit(phrase))) for reason, phrase in others.items()]
    fits = X.category_name(name).rlike(rf"^(?:{pure})$")
    mixed = reduce(lambda a, b: a | b, (F.contains(low, F.lit(m)) for m in markers))
    rules += [("mixed_instrumentation", ~fits & mixed), ("unsupported_structure", ~fits), ("zero_members", (size == 0) | (pages == 0))]
    return facets.first_reason(*rules)


def mixed_category(name: Column, pages: Column, subject: str, pure: str, exclusions: dict[str, str], families: dict[str, str]) -> Column:
    """struct(reason, family): a reason against a category, or the family of its other instruments.

    One family is the category's, several or a generic one are ``mixed_chamber``.
    """
    low = F.lower(name)
    found = F.array_compact(F.array(*(F.when(F.regexp_replace(low, subject, "").rlike(p), F.lit(f)) for f, p in families.items())))
    reason = facets.first_reason(
        ("empty", pages <= 0),
        ("malformed_or_unrelated", ~low.rlike(subject) | (F.regexp_count(name, F.lit(r"\(")) != F.regexp_count(name, F.lit(r"\)")))),
        ("pure", low.rlike(rf"^(?:{pure})$")),
        *((r, low.rlike(p)) for r, p in exclusions.items()),
        ("alternative_solo", low.rlike(r"^for [^,]+ or [^,]+$") & ~low.rlike(r"\b(?:and|with)\b")),
        ("no_supported_partner", F.size(found) == 0),
    )
    family = F.when((F.size(found) == 1) & ~F.array_contains(found, "generic"), F.element_at(found, 1)).otherwise(F.lit("mixed_chamber"))
    return F.struct(reason.alias("reason"), F.when(reason.isNull(), family).alias("family"))


def scope_outcome(excluded: list[tuple[str, Column]], accepted: Column) -> Column:
    """struct(outcome, reason): excluded by the first reason, accepted, or pending where neither is said."""
    reason = facets.first_reason(*excluded)
    outcome = F.when(reason.isNotNull(), "excluded").when(accepted, "accepted").otherwise("pending")
    return F.struct(outcome.alias("outcome"), reason.alias("reason"))


def url_faults(url: Column, hosts: list[str], paths: dict[str, dict[str, str]], files: str = r"(?i)\.(?:pdf|zip|mid|xml)(?:$|/)") -> Column:
    """What is wrong with a page's address, in order; empty for an approved one.

    paths: a pattern for the whole path, with the patterns of the query's values; the
    query must have just these keys, each once.
    """
    part = lambda what: F.coalesce(F.try_parse_url(url, F.lit(what)), F.lit(""))
    path, query, authority = part("PATH"), part("QUERY"), part("AUTHORITY")
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    key, value = (lambda p: F.substring_index(p, "=", 1)), (lambda p: F.coalesce(F.try_url_decode(F.substr(p, F.instr(p, "=") + 1)), F.lit("")))

    def has(name: str, shape: str) -> Column:
        return F.exists(pairs, lambda p: (key(p) == name) & value(p).rlike(rf"^(?:{shape})$"))

    fits = F.lit(False)
    for pattern, approved in paths.items():
        keys = F.transform(pairs, key)
        same = (F.size(pairs) == len(approved)) & (F.size(F.array_distinct(keys)) == F.size(pairs))
        values = [has(k, v) for k, v in approved.items()]
        own = (F.size(pairs) == 0) | (reduce(lambda a, b: a & b, values, same))
        fits = fits | (path.rlike(rf"^(?:{pattern})$") & own)
    decoded = F.coalesce(F.try_url_decode(path), path)
    return facets.issues(
        ("scheme", part("PROTOCOL") != "https"),
        ("host", ~F.lower(part("HOST")).isin(*hosts)),
        ("credentials", F.contains(authority, F.lit("@"))),
        ("port", F.regexp_extract(authority, r":(\d+)$", 1).isin("", "443") == F.lit(False)),
        ("fragment", F.contains(url, F.lit("#"))),
        ("backslash", F.contains(url, F.lit("\\"))),
        ("file", decoded.rlike(files)),
        ("path", ~fits),
    )


def structural_match(text: Column, patterns: list[str], rejected: list[str]) -> Column:
    """Whether the whole text fits a pattern and has none of the rejected words."""
    fits = reduce(lambda a, b: a | b, (text.rlike(rf"(?i)^(?:{p})$") for p in patterns))
    return fits & ~F.arrays_overlap(F.split(F.lower(text), r"[^\p{L}]+"), F.array(*map(F.lit, rejected)))


def selected(df: DataFrame, categories: str, chosen: list[str] | None = None, **isin: list) -> DataFrame:
    """Rows with any of the chosen categories (an array column) and each other column among its values; none given, all pass."""
    if chosen:
        df = df.where(F.arrays_overlap(F.col(categories), F.array(*map(F.lit, chosen))))
    for column, values in isin.items():
        df = df.where(F.col(column).isin(*values))
    return df


def recalled(parts: Column, lead: str, allowed: list[str], most: int) -> Column:
    """Whether parts (array of struct kind, staves) have the lead, only allowed kinds, and ``most`` of them."""
    kinds = F.transform(parts, lambda p: p["kind"])
    return F.array_contains(kinds, lead) & F.forall(kinds, lambda k: k.isin(lead, *allowed)) & (F.size(parts) <= most) & F.exists(parts, lambda p: p["staves"] > 0)


def extraction_decision(rows: DataFrame, rules: list[tuple[str, str, Column]]) -> DataFrame:
    """Adds disposition and reason_code by the first rule (reason, disposition, condition) that holds; else manual_review."""
    reason = facets.first_reason(*((r, c) for r, _, c in rules))
    disposition = F.coalesce(*(F.when(reason == r, F.lit(d)) for r, d, _ in rules), F.lit("manual_review"))
    return rows.withColumns({"reason_code": F.coalesce(reason, F.lit("no_rule")), "disposition": disposition})


def file_reason(name: Column, heading: Column, kinds: list[str], part_words: list[str], heading_words: list[str], wanted: Column) -> Column:
    """Why a file isn't a score of the wanted kind, or null: its type, its name (a part), its heading, or its work."""
    extension = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    word = lambda text, words: text.rlike(rf"(?i)\b(?:{'|'.join(words)})\b")
    return facets.first_reason(
        ("file_type", ~extension.isin(*kinds)), ("part", word(name, part_words)), ("heading", word(F.coalesce(heading, F.lit("")), heading_words)), ("work", ~F.coalesce(wanted, F.lit(False)))
    )


def view_of(query: str, filters: dict[str, str | None]) -> str:
    """Which view a request is for: categories while there is neither a query nor a category or topic, else works."""
    chosen = [v for k, v in filters.items() if k in ("category", "topic") and v not in (None, "all")]
    return "works" if query.strip() or chosen else "categories"


def related(raw: Column, mark: str, role: str) -> Column:
    """array of struct(id, role) of the objects at any depth of a JSON text that have the key ``mark``.

    A role holds for its object and those below it that have none of their own.
    """
    # Parsing sorts the keys; this one is put first, so that an object's role is known before what stands in it.
    flat = F.to_json(F.try_parse_json(F.regexp_replace(raw, rf'"{role}"(\s*:)', f'"!{role}"$1')))
    role = f"!{role}"
    found = F.regexp_extract_all(flat, F.lit(rf'("{mark}":"(?:[^"\\\\]|\\\\.)*"|"{role}":"(?:[^"\\\\]|\\\\.)*"|[{{}}])'), 1)
    value = lambda token, key: F.substring(token, len(key) + 5, 1 << 20)
    text = lambda token, key: F.regexp_replace(value(token, key), '"$', "")
    start = F.struct(F.array(F.lit(None).cast("string")).alias("roles"), F.expr("cast(array() as array<struct<id:string,role:string>>)").alias("out"))
    own = lambda a: F.element_at(a["roles"], -1)

    def step(a, token):
        rest = F.slice(a["roles"], 1, F.greatest(F.size(a["roles"]) - 1, F.lit(0)))
        return (
            F.when(token == "{", F.struct(F.array_append(a["roles"], own(a)).alias("roles"), a["out"].alias("out")))
            .when(token == "}", F.struct(rest.alias("roles"), a["out"].alias("out")))
            .when(token.startswith(f'"{role}":'), F.struct(F.array_append(rest, text(token, role)).alias("roles"), a["out"].alias("out")))
            .otherwise(F.struct(a["roles"].alias("roles"), F.array_append(a["out"], F.struct(text(token, mark).alias("id"), own(a).alias("role"))).alias("out")))
        )

    return F.aggregate(found, start, step)["out"]
