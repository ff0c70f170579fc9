"""Functions on titles, headings, attributions and instrument labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Entities that headings have.
ENTITIES = {"&nbsp;": " ", "&quot;": '"', "&#39;": "'", "&lt;": "<", "&gt;": ">", "&amp;": "&"}


def heading(text: Column) -> Column:
    """A heading as it is compared: without comments, templates, link targets, tags and quote marks, in lower case."""
    for pattern, instead in (
        (r"(?s)<!--.*?-->", ""), (r"\{\{[^{}]*\}\}", ""), (r"\[\[(?:[^\]|]*\|)?([^\]|]*)\]\]", "$1"), (r"<[^>]*>", ""), (r"'{2,}", ""),
    ):
        text = F.regexp_replace(text, pattern, instead)
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def numbers_after(text: Column, words: str) -> Column:
    """The numbers that follow one of the words (a regular expression), in order."""
    return F.regexp_extract_all(text, F.lit(rf"(?i)(?<![a-z])(?:{words})[.\s]*(\d+)"), 1)


def lost_numbers(original: Column, shown: Column, words: str) -> Column:
    """Numbers after such a word that a title in Han characters doesn't have any more; empty for other titles."""
    digits = F.regexp_extract_all(shown, F.lit(r"(\d+)"), 1)
    lost = F.array_except(numbers_after(original, words), digits)
    return F.when(shown.rlike(r"[\x{3400}-\x{9fff}]"), lost).otherwise(F.array().cast("array<string>"))


def topic_by_rules(label: Column, exact: dict[str, str], patterns: dict[str, str], lead: str, families: dict[str, tuple[str, ...]], mixed: str) -> Column:
    """The topic of an instrumentation label, or null.

    An exact label decides, then the first pattern that fits the whole label. Else the
    label is taken apart at commas, "and" and "&": beside ``lead`` all parts must be of
    ``families``; one family is the topic, several are ``mixed``.
    """
    text = F.trim(F.regexp_replace(F.lower(label), r"\s+", " "))
    rules = [F.when(text == k, F.lit(v)) for k, v in exact.items()]
    rules += [F.when(text.rlike(rf"^(?:{p})$"), F.lit(topic)) for topic, p in patterns.items()]
    parts = F.split(F.regexp_replace(text, r"^for ", ""), r"\s*(?:,| and | & )\s*")
    others = F.array_remove(parts, lead)
    has = {k: F.arrays_overlap(others, F.array(*map(F.lit, names))) for k, names in families.items()}
    known = F.array(*(F.lit(n) for names in families.values() for n in names))
    fits = F.array_contains(parts, lead) & (F.size(others) > 0) & (F.size(F.array_except(others, known)) == 0)
    one = F.array_compact(F.array(*(F.when(v, F.lit(k)) for k, v in has.items())))
    rules.append(F.when(fits, F.when(F.size(one) == 1, F.element_at(one, 1)).otherwise(F.lit(mixed))))
    return F.coalesce(*rules)


def is_wrapped(title: Column, left: str = "《", right: str = "》") -> Column:
    """Whether one pair of marks stands around the whole title: the first mark is closed by the last character."""
    step = lambda c: F.when(c == left, 1).when(c == right, -1).otherwise(0)
    inner = F.split(F.substr(title, F.lit(2), F.greatest(F.length(title) - 2, F.lit(0))), "")
    scan = F.aggregate(
        inner, F.struct(F.lit(0).alias("depth"), F.lit(True).alias("fine")),
        lambda a, c: F.struct((a["depth"] + step(c)).alias("depth"), (a["fine"] & (a["depth"] + step(c) >= 0)).alias("fine")),
    )
    return title.startswith(left) & title.endswith(right) & (F.length(title) > 1) & scan["fine"] & (scan["depth"] == 0)


def wrap_title(title: Column, left: str = "《", right: str = "》") -> Column:
    """A title between marks, unless one pair stands around it all; an empty one stays empty."""
    return F.when(title == "", title).when(is_wrapped(title, left, right), title).otherwise(F.concat(F.lit(left), title, F.lit(right)))


def title_label(translated: Column, status: Column, original: Column) -> Column:
    """What is shown as the title: machine translations give way to the original, outer marks go."""
    shown = F.when(status == "machine", F.coalesce(original, F.lit(""))).otherwise(F.coalesce(F.nullif(translated, F.lit("")), original, F.lit("")))
    return F.regexp_replace(shown, "^《|》$", "")


def closed_title(title: Column, vocabulary: dict[str, str], joint: str = "") -> tuple[Column, Column]:
    """(translation, unknown words): a title of words that are all in the vocabulary is put together from it, else null."""
    words = F.split(F.trim(F.lower(title)), r"\s+")
    table = F.create_map(*(F.lit(x) for pair in vocabulary.items() for x in pair))
    unknown = F.filter(words, lambda w: table[w].isNull())
    done = F.array_join(F.transform(words, lambda w: table[w]), joint)
    return F.when(F.size(unknown) == 0, done), unknown


def replace_longest(text: Column, words: dict[str, str]) -> Column:
    """Replaces dictionary words in one pass, the longest that fits at each place; what was put in isn't looked at again."""
    keys = sorted(words, key=lambda w: (-len(w), w))
    marked = text
    for n, key in enumerate(keys):  # private-use characters stand for the words until all are found
        marked = F.replace(marked, F.lit(key), F.lit(chr(0xE000 + n)))
    for n, key in enumerate(keys):
        marked = F.replace(marked, F.lit(chr(0xE000 + n)), F.lit(words[key]))
    return marked


def role_credit(text: Column, roles: dict[str, str]) -> Column:
    """struct(role, name) of a credit such as "arr. by Name" by the roles' marks (regular expressions), else nulls."""
    out = F.lit(None).cast("struct<role:string,name:string>")
    for role, mark in reversed(roles.items()):
        pattern = rf"(?i)^\(?\s*(?:{mark})\s*(?:by\b)?[\s:]*([^()]+?)\s*\)?$"
        name = F.regexp_extract(text, pattern, 1)
        out = F.when(name != "", F.struct(F.lit(role).alias("role"), name.alias("name"))).otherwise(out)
    return out


def clean_label(label: Column) -> Column:
    """An instrument label as it is looked up: lower case, without numbering, keys in brackets and marks."""
    text = F.regexp_replace(F.lower(label), r"\([^)]*\)|[\d.#:]+|\b(?:i{1,3}|iv|v)\b", " ")
    return F.trim(F.regexp_replace(text, r"[^\p{L}]+", " "))


def display_parts(title: Column, roles: dict[str, str]) -> Column:
    """struct(title, attribution, role, dates, dimensions): what a source put into one title.

    Life or publication dates and sizes go to fields of their own; a last bracket that
    names a role is an attribution.
    """
    dates = F.regexp_extract(title, r"\(?\b(\d{4}(?:\s*[-–]\s*\d{4})?)\)?\s*$", 1)
    rest = F.trim(F.when(dates != "", F.regexp_replace(title, r"[\s,]*\(?\b\d{4}(?:\s*[-–]\s*\d{4})?\)?\s*$", "")).otherwise(title))
    size = F.regexp_extract(rest, r"(\d+(?:\s*[x×]\s*\d+)?\s*(?:cm|mm))\b", 1)
    rest = F.trim(F.when(size != "", F.regexp_replace(rest, r"[\s,;]*\d+(?:\s*[x×]\s*\d+)?\s*(?:cm|mm)\b", "")).otherwise(rest))
    last = F.regexp_extract(rest, r"\(([^()]*)\)\s*$", 1)
    credit = role_credit(last, roles)
    bare = F.when(credit["role"].isNotNull(), F.trim(F.regexp_replace(rest, r"\([^()]*\)\s*$", ""))).otherwise(rest)
    none = lambda c: F.nullif(c, F.lit(""))
    return F.struct(bare.alias("title"), credit["name"].alias("attribution"), credit["role"].alias("role"), none(dates).alias("dates"), none(size).alias("dimensions"))


def any_of(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)
