"""Queries on titles, labels, credits and display projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import titles as T
from ..operators import display as D
from .registry import query, table


def _pick(column, values):
    """One of the values, in turn by a number."""
    return F.element_at(F.array(*map(F.lit, values)), (column % len(values) + 1).cast("int"))


def _sql_list(values):
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


HEADINGS = [
    "For Guitar (Arr.)", "''For <b>2</b>  Guitars''", "{{Tpl|x}}For [[Guitar|guitar]] &amp; flute", "<!-- a\nb -->Full&nbsp;Score", "[[Category]] 'Solo' &lt;3&gt;",
]
_HEADINGS = ["for guitar (arr.)", "for 2 guitars", "for guitar & flute", "full score", "category 'solo' <3>"]


@query(f"SELECT p_partkey, {_sql_list(_HEADINGS)}[p_partkey % 5 + 1] AS heading FROM part")
def heading_forms(spark, d):
    return table(spark, d, "part").select("p_partkey", T.heading(_pick(F.col("p_partkey"), HEADINGS)).alias("heading"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN [] WHEN p_partkey % 3 = 1 THEN [p_size::VARCHAR] ELSE CASE WHEN p_size = 7 THEN [] ELSE ['7'] END END AS lost FROM part""")
def lost_title_numbers(spark, d):
    part = table(spark, d, "part")
    k = F.col("p_partkey") % 3
    original = F.when(k == 2, F.concat(F.col("p_name"), F.lit(" Op. 7"))).otherwise(F.concat(F.col("p_name"), F.lit(", Op."), "p_size"))
    shown = F.when(k == 0, F.concat(F.lit("练习曲 作品"), "p_size")).when(k == 1, F.lit("练习曲")).otherwise(F.concat(F.lit("练习曲"), "p_size"))
    return part.select("p_partkey", T.lost_numbers(original, shown, "op|opus").alias("lost"))


LABELS = {
    "Classical  Guitar": "guitar_unspecified", "for 2 guitars (arr)": "duo", "Guitar trio": "trio", "For guitar, flute and violin": "mixed_chamber", "guitar & flute": "woodwinds",
    "guitar and kazoo": None, "flute and violin": None, "for 12 guitars": "guitar_ensemble", "solo guitar": "solo", "violin, viola and guitar": "strings",
}
_TOPICS = {
    "exact": {"guitar": "guitar_unspecified", "classical guitar": "guitar_unspecified"},
    "patterns": {
        "solo": r"(?:for )?(?:solo guitar|guitar solo|1 guitar)(?: \(arr\))?", "duo": r"(?:for )?(?:2 guitars|guitar duo)(?: \(arr\))?", "trio": r"(?:for )?(?:3 guitars|guitar trio)(?: \(arr\))?",
        "guitar_ensemble": r"(?:for )?(?:(?:[5-9]|[1-9]\d+) guitars|guitar ensemble)(?: \(arr\))?",
    },
    "families": {"strings": ("violin", "viola", "cello"), "woodwinds": ("flute", "oboe")},
}


@query(f"""SELECT p_partkey, {"[" + ", ".join("NULL" if v is None else f"'{v}'" for v in LABELS.values()) + "]"}[p_partkey % {len(LABELS)} + 1] AS topic FROM part""")
def instrumentation_topics(spark, d):
    label = _pick(F.col("p_partkey"), list(LABELS))
    topic = T.topic_by_rules(label, _TOPICS["exact"], _TOPICS["patterns"], "guitar", _TOPICS["families"], "mixed_chamber")
    return table(spark, d, "part").select("p_partkey", topic.alias("topic"))


_TITLES = {"《a》": "《a》", "《a》与《b》": "《《a》与《b》》", "a": "《a》", "《a《b》》": "《a《b》》", "": "", "》a《": "《》a《》", "《a": "《《a》"}


@query(f"SELECT s_suppkey, {_sql_list(_TITLES.values())}[s_suppkey % {len(_TITLES)} + 1] AS title FROM supplier")
def balanced_titles(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", T.wrap_title(_pick(F.col("s_suppkey"), list(_TITLES))).alias("title"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN '曲' || p_size ELSE p_name END AS label FROM part""")
def title_labels(spark, d):
    k = F.col("p_partkey") % 3
    status = F.when(k == 0, "machine").when(k == 1, "reviewed").otherwise("untranslated")
    shown = F.when(k == 2, F.lit("")).otherwise(F.concat(F.lit("《曲"), "p_size", F.lit("》")))
    return table(spark, d, "part").select("p_partkey", T.title_label(shown, status, F.col("p_name")).alias("label"))


_WORDS = {"small": "小", "red": "红", "blue": "蓝", "ring": "环", "widget": "件"}


@query(f"""WITH w AS (SELECT p_partkey, string_split(lower(p_name), ' ') AS w FROM part), v AS (SELECT MAP {{{", ".join(f"'{k}': '{v}'" for k, v in _WORDS.items())}}} AS m)
 SELECT p_partkey, list_filter(w, lambda x: m[x] IS NULL) AS unknown, CASE WHEN len(list_filter(w, lambda x: m[x] IS NULL)) = 0 THEN array_to_string(list_transform(w, lambda x: m[x]), '') END AS title FROM w, v""")
def closed_vocabulary_titles(spark, d):
    title, unknown = T.closed_title(F.col("p_name"), _WORDS)
    return table(spark, d, "part").select("p_partkey", unknown.alias("unknown"), title.alias("title"))


@query("""SELECT p_partkey, replace(replace(replace(replace(p_type, 'ECONOMY', chr(1)), 'ECO', 'x'), 'STANDARD', 'ECO'), chr(1), 'STAN') AS label FROM part""")
def longest_substitution(spark, d):
    """What is put in ("ECO" for "STANDARD") isn't replaced again."""
    words = {"ECONOMY": "STAN", "ECO": "x", "STANDARD": "ECO"}
    return table(spark, d, "part").select("p_partkey", T.replace_longest(F.col("p_type"), words).alias("label"))


_ROLES = {"arranger": r"arr\.|arranged", "editor": r"ed\.|edited", "transcriber": r"transcr(?:ibed|\.)"}
_CREDITS = {"arr. by J. Doe": ("arranger", "J. Doe"), "(Edited by A B)": ("editor", "A B"), "transcribed: X": ("transcriber", "X"), "J. Doe": (None, None), "arr.": (None, None)}


@query(f"""SELECT c_custkey, {"[" + ", ".join("NULL" if v[0] is None else f"'{v[0]}'" for v in _CREDITS.values()) + "]"}[c_custkey % 5 + 1] AS role,
 {"[" + ", ".join("NULL" if v[1] is None else f"'{v[1]}'" for v in _CREDITS.values()) + "]"}[c_custkey % 5 + 1] AS name FROM customer""")
def credit_roles(spark, d):
    credit = T.role_credit(_pick(F.col("c_custkey"), list(_CREDITS)), _ROLES)
    return table(spark, d, "customer").select("c_custkey", credit["role"].alias("role"), credit["name"].alias("name"))


_INSTRUMENTS = {"Guitar 2": "guitar", "1. Flöte (in C)": "flute", "Violin II": "strings", "Kazoo": None, "Git.": "guitar"}


@query(f"""SELECT c_custkey, {"[" + ", ".join("NULL" if v is None else f"'{v}'" for v in _INSTRUMENTS.values()) + "]"}[c_custkey % 5 + 1] AS kind FROM customer""")
def instrument_kinds(spark, d):
    """Labels are cleaned and looked up among aliases; the small table is joined, not a chain of conditions."""
    aliases = spark.createDataFrame([("guitar", "guitar"), ("git", "guitar"), ("flöte", "flute"), ("violin", "strings")], "label string, kind string")
    rows = table(spark, d, "customer").select("c_custkey", T.clean_label(_pick(F.col("c_custkey"), list(_INSTRUMENTS))).alias("label"))
    return rows.join(aliases, "label", "left").select("c_custkey", "kind")


_DISPLAY = {
    "Sonata (arr. by J. Doe) 1801": ("Sonata", "J. Doe", "arranger", "1801", None), "Etude, 21 x 30 cm": ("Etude", None, None, None, "21 x 30 cm"),
    "Waltz (in A)": ("Waltz (in A)", None, None, None, None), "Album (1790-1850)": ("Album", None, None, "1790-1850", None),
}


@query("SELECT p_partkey, " + ", ".join(
    "[" + ", ".join("NULL" if v[n] is None else f"'{v[n]}'" for v in _DISPLAY.values()) + f"][p_partkey % 4 + 1] AS {c}" for n, c in enumerate(("title", "attribution", "role", "dates", "dimensions"))
) + " FROM part")
def display_projection(spark, d):
    parts = T.display_parts(_pick(F.col("p_partkey"), list(_DISPLAY)), _ROLES)
    return table(spark, d, "part").select("p_partkey", *(parts[c].alias(c) for c in ("title", "attribution", "role", "dates", "dimensions")))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_type ELSE 'x' || p_size END AS pages, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS date FROM part""")
def field_fallbacks(spark, d):
    one = lambda k, v: F.create_map(F.lit(k), v)
    details = F.when(F.col("p_partkey") % 2 == 0, one("pages", F.col("p_type"))).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    link = F.when(F.col("p_partkey") % 3 == 0, F.lit("https://x.org")).otherwise(F.col("p_name"))
    native = F.create_map(F.lit("source_pages"), F.concat(F.lit("x"), "p_size"), F.lit("year"), link, F.lit("date"), link)
    out = D.fallback_fields(details, native, [("source_pages", "pages"), ("year", "date"), ("date", "date")])
    return table(spark, d, "part").select("p_partkey", out.alias("m")).select("p_partkey", F.col("m")["pages"].alias("pages"), F.col("m")["date"].alias("date"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'short' END AS note, CASE WHEN p_partkey % 3 = 1 THEN 'unreviewed_note' END AS fault, p_name AS kept FROM part""")
def public_notes(spark, d):
    note = F.when(F.col("p_partkey") % 3 == 0, "Free printing, TEACHING use").when(F.col("p_partkey") % 3 == 1, "free printing").otherwise("")
    details = F.create_map(F.lit("note"), note, F.lit("crawl"), F.lit("x"), F.lit("kept"), F.col("p_name"))
    out = D.project_notes(details, ["crawl"], "note", ["free printing", "teaching use"], "short")
    rows = table(spark, d, "part").select("p_partkey", out.alias("o")).select("p_partkey", "o.*")
    return rows.select("p_partkey", F.col("details")["note"].alias("note"), "fault", F.col("details")["kept"].alias("kept"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name WHEN p_size % 3 = 0 THEN NULL ELSE p_type || '；' || p_brand END AS value FROM part""")
def placeholder_repair(spark, d):
    even, third = F.col("p_size") % 2 == 0, F.col("p_size") % 3 == 0
    names = F.when(third, F.array(F.lit(" "), F.lit(None).cast("string"))).otherwise(F.array(F.col("p_type"), F.lit(""), F.col("p_brand")))
    value = D.repaired_placeholder(F.when(even, F.col("p_name")).otherwise(F.lit("?")), "?", names)
    return table(spark, d, "part").select("p_partkey", value.alias("value"))


_FORMS = {"LP": "recording", "2 sound discs": "recording", "Broschur": "text", "Heft": None}


@query(f"""SELECT p_partkey, coalesce({"[" + ", ".join("NULL" if v is None else f"'{v}'" for v in _FORMS.values()) + "]"}[p_partkey % 4 + 1], CASE WHEN p_size % 2 = 0 THEN 'journal' END) AS material FROM part""")
def material_types(spark, d):
    form = _pick(F.col("p_partkey"), list(_FORMS))
    notes = F.when((F.col("p_size") % 2 == 0) & form.isin("Heft"), "Zeitschrift")
    kind = D.material_type(form, notes, ["LP"], r"(?i)^\d+\s+sound discs?\b", {"Zeitschrift": "journal", "Broschur": "text"})
    return table(spark, d, "part").select("p_partkey", kind.alias("material"))


@query("""SELECT c_custkey, list_filter([CASE WHEN c_custkey % 4 = 0 THEN 'title' END, CASE WHEN c_custkey % 6 = 0 THEN 'composer' END], lambda x: x IS NOT NULL) AS missing FROM customer""")
def identity_checks(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).alias("title"), F.when(F.col("c_custkey") % 6 == 0, F.lit("  ")).otherwise(F.col("c_mktsegment")).alias("composer")
    )
    return D.identity(rows, ["title", "composer"]).select("c_custkey", "missing")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN (json_extract(props, '$.k'))::BIGINT END AS k, CASE event_id % 4 WHEN 1 THEN 'not_an_object' WHEN 2 THEN 'type_of_k' WHEN 3 THEN 'missing_kind' END AS reason FROM events""")
def strict_records(spark, d):
    n = F.col("event_id") % 4
    k = F.get_json_object("props", "$.k")
    raw = (
        F.when(n == 0, F.concat(F.lit('{"kind": "a", "k": '), k, F.lit("}"))).when(n == 1, F.lit("[1"))
        .when(n == 2, F.lit('{"kind": "a", "k": "many"}')).otherwise(F.col("props"))
    )
    out = D.converted(raw, {"kind": "string", "k": "bigint"}, {"kind": ["a", "b"]})
    return table(spark, d, "events").select("event_id", out.alias("o")).select("event_id", "o.record.k", "o.reason")


@query("""SELECT c_custkey, 'b' || c_custkey % 3 AS basis, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN '2' END AS reviewed, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 <> 0 THEN '2' END AS declared FROM customer""")
def public_decisions(spark, d):
    basis = _pick(F.col("c_custkey"), ["file", "source", "audit"])
    players = F.when(F.col("c_custkey") % 2 == 0, F.lit(2))
    m = D.decision_details(basis, F.lit("n"), F.lit("i"), players, {"file": "b0", "source": "b1", "audit": "b2"}, "file")
    rows = table(spark, d, "customer").select("c_custkey", m.alias("m"))
    return rows.select("c_custkey", F.col("m")["classification_basis"].alias("basis"), F.col("m")["reviewed_player_count"].alias("reviewed"), F.col("m")["declared_player_count"].alias("declared"))


@query(r"""SELECT doc_id, md5(trim(regexp_replace(replace(text, chr(10), chr(13) || chr(10)), '\r\n?', chr(10), 'g'), ' ')) AS digest FROM documents""")
def csv_equivalence(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(D.csv_form(F.replace("text", F.lit("\n"), F.lit("\r\n")))).alias("digest"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'shown' WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name END AS label FROM part""")
def label_precedence(spark, d):
    rows = table(spark, d, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, "shown").alias("display"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_brand")).otherwise(F.lit(" ")).alias("zh"), F.col("p_name").alias("en")
    )
    return D.public_labels(rows, {"label": ["display", "zh", "en"]}).select("p_partkey", "label")


@query("""WITH n AS (SELECT l_orderkey, l_returnflag AS role, string_agg(DISTINCT l_suppkey::VARCHAR, '；' ORDER BY l_suppkey::VARCHAR) AS names FROM lineitem GROUP BY ALL),
 p AS (SELECT l_orderkey, string_agg(role || '=' || names, ' ' ORDER BY role) AS persons FROM n GROUP BY 1), s AS (SELECT l_orderkey, min(l_linestatus) AS place FROM lineitem GROUP BY 1)
 SELECT o_orderkey, persons, place FROM orders LEFT JOIN p ON l_orderkey = o_orderkey LEFT JOIN s ON s.l_orderkey = o_orderkey""")
def archive_records(spark, d):
    lines = table(spark, d, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    name = F.col("l_suppkey").cast("string")
    persons = lines.select("o_orderkey", F.col("l_returnflag").alias("role"), name.alias("name"), name.alias("seq"))
    out = D.normalised_archive(table(spark, d, "orders").select("o_orderkey"), persons, "o_orderkey", lines.select("o_orderkey", F.col("l_linestatus").alias("place")))
    text = F.array_join(F.transform(F.map_entries("persons"), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    return out.select("o_orderkey", text.alias("persons"), "place")
