"""Queries on filters with reasons and on rules over evidence and editions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decisions as D
from ..operators import rules as R
from .registry import query, table


def _pick(column, values):
    return F.element_at(F.array(*map(F.lit, values)), (column % len(values) + 1).cast("int"))


def _sql(values):
    return "[" + ", ".join("NULL" if v is None else "'" + str(v).replace("'", "''") + "'" for v in values) + "]"


_NAMES = {
    "For 2 guitars": None, "for guitar": "malformed_name", "For  guitar": "malformed_name", "For violin": "not_guitar", "For electric guitar": "electric_guitar",
    "For guitar and flute": "mixed_instrumentation", "For guitar etudes": "unsupported_structure", "For 3-guitars": None, "For guitar [x]": "malformed_name",
}


@query(f"SELECT c_custkey, coalesce({_sql(_NAMES.values())}[c_custkey % 9 + 1], CASE WHEN c_nationkey = 0 THEN 'zero_members' END) AS reason FROM customer")
def category_reasons(spark, d):
    pure = r"for (?:\d+ )?guitars?(?: \(arr\))?"
    reason = R.category_reason(
        _pick(F.col("c_custkey"), list(_NAMES)), F.col("c_nationkey"), F.lit(1), "For ", "guitar", {"electric_guitar": "electric guitar", "bass_guitar": "bass guitar"}, pure, [" and ", ", "]
    )
    return table(spark, d, "customer").select("c_custkey", reason.alias("reason"))


_MIXED = {
    "For guitar, flute": (None, "woodwinds"), "For guitar, violin, flute": (None, "mixed_chamber"), "For guitar": ("pure", None), "For guitar or piano": ("alternative_solo", None),
    "For guitar and orchestra": ("orchestra", None), "For kazoo": ("malformed_or_unrelated", None), "For guitar and kazoo": ("no_supported_partner", None), "For guitar (arr, flute": ("malformed_or_unrelated", None),
}


@query(f"""SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'empty' ELSE {_sql(v[0] for v in _MIXED.values())}[c_custkey % 8 + 1] END AS reason,
 CASE WHEN c_nationkey <> 3 THEN {_sql(v[1] for v in _MIXED.values())}[c_custkey % 8 + 1] END AS family FROM customer""")
def mixed_categories(spark, d):
    out = R.mixed_category(
        _pick(F.col("c_custkey"), list(_MIXED)), F.col("c_nationkey") - 3 + F.when(F.col("c_nationkey") < 3, 10).otherwise(0), "guitars?", r"for (?:\d+ )?guitars?",
        {"orchestra": "orchestra"}, {"strings": "violin|viola", "woodwinds": "flute|oboe", "keyboard": "piano"},
    )
    return table(spark, d, "customer").select("c_custkey", out["reason"].alias("reason"), out["family"].alias("family"))


@query("""SELECT doc_id, CASE WHEN lang = 'fr' THEN 'excluded' WHEN n_chars < 200 THEN 'excluded' WHEN source = 'src0' THEN 'accepted' ELSE 'pending' END AS outcome,
 CASE WHEN lang = 'fr' THEN 'language' WHEN n_chars < 200 THEN 'short' END AS reason FROM documents""")
def scope_outcomes(spark, d):
    out = R.scope_outcome([("language", F.col("lang") == "fr"), ("short", F.col("n_chars") < 200)], F.col("source") == "src0")
    return table(spark, d, "documents").select("doc_id", out["outcome"].alias("outcome"), out["reason"].alias("reason"))


_URLS = {
    "https://a.org/w/1?p=2&q=x": [], "http://a.org/w/1": ["scheme"], "https://b.org/w/1": ["host"], "https://u@a.org/w/1": ["credentials"], "https://a.org:8080/w/1": ["port"],
    "https://a.org/w/1#t": ["fragment"], "https://a.org/w/1?p=2": ["path"], "https://a.org/w/1?p=2&q=x&q=x": ["path"], "https://a.org/w/a%2Epdf": ["file", "path"], "https://a.org:443/w/12": [],
    "https://a.org/w/1?p=z&q=x": ["path"],
}


@query(f"SELECT page_id, [{', '.join('[' + ', '.join(repr(x) for x in v) + ']::VARCHAR[]' for v in _URLS.values())}][page_id % {len(_URLS)} + 1] AS faults FROM pages")
def url_faults(spark, d):
    faults = R.url_faults(_pick(F.col("page_id"), list(_URLS)), ["a.org"], {r"/w/\d+": {"p": r"\d+", "q": "[a-z]"}})
    return table(spark, d, "pages").select("page_id", faults.alias("faults"))


@query(r"""SELECT p_partkey, regexp_matches(p_name, '(?i)^(small|red) \w+$') AND NOT list_has_any(string_split(lower(p_name), ' '), ['widget']) AS fits FROM part""")
def structural_matches(spark, d):
    return table(spark, d, "part").select("p_partkey", R.structural_match(F.col("p_name"), [r"small \w+", r"red \w+"], ["widget"]).alias("fits"))


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND (o_orderpriority = '1-URGENT' OR o_orderpriority = '2-HIGH')""")
def selector_filters(spark, d):
    rows = table(spark, d, "orders").withColumn("categories", F.array("o_orderpriority", "o_orderstatus"))
    return R.selected(rows, "categories", ["1-URGENT", "2-HIGH"], o_orderstatus=["F", "P"]).select("o_orderkey")


@query("""WITH g AS (SELECT l_orderkey, list(l_returnflag) AS k, max(l_linenumber) AS s FROM lineitem GROUP BY 1)
 SELECT l_orderkey, list_contains(k, 'A') AND NOT list_contains(k, 'N') AND len(k) <= 3 AS recalled FROM g""")
def recalled_members(spark, d):
    part = F.struct(F.col("l_returnflag").alias("kind"), F.col("l_linenumber").alias("staves"))
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list(part).alias("parts"))
    return rows.select("l_orderkey", R.recalled(F.col("parts"), "A", ["R"], 3).alias("recalled"))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 20000 THEN 'too_small' WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_orderpriority = '5-LOW' THEN 'unclear' ELSE 'no_rule' END AS reason_code,
 CASE WHEN o_totalprice < 20000 THEN 'excluded' WHEN o_orderstatus = 'F' THEN 'selected' ELSE 'manual_review' END AS disposition FROM orders""")
def extraction_decisions(spark, d):
    rules = [
        ("too_small", "excluded", F.col("o_totalprice") < 20000), ("finished", "selected", F.col("o_orderstatus") == "F"), ("unclear", "manual_review", F.col("o_orderpriority") == "5-LOW"),
    ]
    return R.extraction_decision(table(spark, d, "orders"), rules).select("o_orderkey", "reason_code", "disposition")


@query("""SELECT 'price' AS rule, o_orderkey::VARCHAR AS key FROM orders WHERE NOT (o_totalprice > 50000) UNION ALL SELECT 'status', o_orderkey::VARCHAR FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
 UNION ALL SELECT 'date', o_orderkey::VARCHAR FROM orders WHERE o_orderdate < TIMESTAMP '1993-01-01'""")
def model_invariants(spark, d):
    rules = {"price": F.col("o_totalprice") > 50000, "status": F.col("o_orderstatus").isin("F", "O"), "date": F.col("o_orderdate") >= F.lit("1993-01-01").cast("timestamp")}
    return D.invariants(table(spark, d, "orders"), "o_orderkey", rules)


_EVIDENCE = [  # status, basis, reason, original, shown, fault
    ("reviewed", "b", "", "Etude", "练习曲", None), ("reviewed", " ", "", "Etude", "练习曲", "basis"), ("machine", "b", "", "Etude", "Etude", "han"), ("retained", "b", "", "Etude", "", "retained"),
    ("retained", "b", "r", "Etude", "", None), ("untranslated", "", "", "Etude", "x", "untranslated"), ("not_applicable", "", "", "", "", None), ("not_applicable", "", "", "x", "", "not_applicable"),
    ("guessed", "b", "", "x", "y", "status"), ("reviewed", None, "", "x", "练", "evidence"),
]


@query(f"SELECT p_partkey, {_sql(e[5] for e in _EVIDENCE)}[p_partkey % 10 + 1] AS fault FROM part")
def translation_faults(spark, d):
    status, basis, reason, original, shown = (_pick(F.col("p_partkey"), [e[n] for e in _EVIDENCE]) for n in range(5))
    return table(spark, d, "part").select("p_partkey", D.translation_fault(status, basis, reason, original, shown).alias("fault"))


@query("""WITH d AS (SELECT o_orderkey AS id, o_custkey % 5 AS seen, o_custkey % 4 AS now, CASE WHEN o_orderkey % 6 = 0 THEN 'solo' WHEN o_orderkey % 6 = 1 THEN 'open' ELSE 'duo' END AS topic,
 CASE WHEN o_orderkey % 2 = 0 THEN 'file' ELSE 'source' END AS basis, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 2 END AS players FROM orders),
 e AS (SELECT l_orderkey AS id, count(*) AS n, bool_and(l_linenumber < 7) AS holds, bool_or(l_returnflag = 'A') AS file FROM lineitem GROUP BY 1),
 x AS (SELECT d.*, n, holds, file FROM d LEFT JOIN e USING (id))
 SELECT id, 'missing_record' AS fault FROM x WHERE id % 13 = 4 UNION ALL SELECT id, 'stale' FROM x WHERE id % 13 <> 4 AND seen <> now UNION ALL SELECT id, 'no_evidence' FROM x WHERE n IS NULL
 UNION ALL SELECT id, 'evidence_differs' FROM x WHERE NOT holds UNION ALL SELECT id, 'no_file' FROM x WHERE basis = 'file' AND NOT coalesce(file, false)
 UNION ALL SELECT id, 'players' FROM x WHERE (topic = 'solo') OR (topic = 'duo' AND players IS NULL) UNION ALL SELECT id, 'open_topic_with_players' FROM x WHERE topic = 'open' AND players IS NOT NULL""")
def decision_faults(spark, d):
    o = table(spark, d, "orders")
    six = F.col("o_orderkey") % 6
    decided = o.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 5).alias("digest"), F.when(six == 0, "solo").when(six == 1, "open").otherwise("duo").alias("topic"),
        F.when(F.col("o_orderkey") % 2 == 0, "file").otherwise("source").alias("basis"), F.when(F.col("o_orderkey") % 5 != 0, 2).alias("players"),
    )
    records = o.where("o_orderkey % 13 <> 4").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 4).alias("digest"))
    evidence = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") == "A", "file").otherwise("field").alias("kind"), F.lit("v").alias("value"), F.when(F.col("l_linenumber") < 7, "v").otherwise("w").alias("actual")
    )
    return D.decision_faults(decided, records, evidence, {"solo": 1, "duo": 2}, "file", ["open"])


@query("""SELECT 'works' AS kind, p_partkey::VARCHAR AS key, 'unknown' AS fault FROM part WHERE p_partkey % 7 = 3 UNION ALL
 SELECT 'works', p_partkey::VARCHAR, 'weight' FROM part WHERE p_retailprice / 10 > 100 OR p_retailprice / 10 <> floor(p_retailprice / 10)""")
def ranking_faults(spark, d):
    part = table(spark, d, "part")
    key = F.col("p_partkey").cast("string").alias("key")
    return D.ranking_faults(part.select(F.lit("works").alias("kind"), key, (F.col("p_retailprice") / 10).alias("weight")), part.where("p_partkey % 7 <> 3").select(F.lit("works").alias("kind"), key))


@query("""SELECT 'works' AS kind, p_partkey::VARCHAR AS key, unnest(list_filter([CASE WHEN p_partkey % 7 = 3 THEN 'unknown' END, CASE WHEN p_size % 5 = 0 THEN 'empty' END, CASE WHEN p_size % 5 = 1 THEN 'blank' END,
 CASE WHEN p_size % 5 = 2 THEN 'repeated' END], lambda x: x IS NOT NULL)) AS fault FROM part""")
def alias_faults(spark, d):
    part = table(spark, d, "part")
    n, name = F.col("p_size") % 5, F.col("p_name")
    lists = F.when(n == 0, F.array().cast("array<string>")).when(n == 1, F.array(name, F.lit(" "))).when(n == 2, F.array(name, name)).otherwise(F.array(name, F.col("p_brand")))
    key = F.col("p_partkey").cast("string").alias("key")
    return D.alias_faults(part.select(F.lit("works").alias("kind"), key, lists.alias("aliases")), part.where("p_partkey % 7 <> 3").select(F.lit("works").alias("kind"), key))


@query("""WITH m AS (SELECT l_suppkey AS c, l_partkey AS p, count(*) AS n FROM lineitem GROUP BY ALL)
 SELECT 'page_without_member' AS rule, c || '/' || p AS key FROM m WHERE p % 10 <> 1 AND c % 10 = 2 UNION ALL SELECT 'member_without_page', c || '/' || p FROM (SELECT l_suppkey AS c, l_partkey AS p FROM lineitem) WHERE p % 10 = 1 AND c % 10 <> 2
 UNION ALL SELECT 'member_twice', c || '/' || p FROM m WHERE n > 1 AND c % 10 <> 2""")
def snapshot_bindings(spark, d):
    lines = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("category"), F.col("l_partkey").alias("member"))
    pages = lines.where("member % 10 <> 1").select("category", F.col("member").alias("page")).distinct()
    return D.binding_faults(pages, lines.where("category % 10 <> 2"))


@query("""SELECT o_orderkey, 'gone' AS fault FROM orders WHERE o_orderkey % 17 = 0 UNION ALL SELECT o_orderkey, 'changed_o_orderstatus' FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 5 = 0 AND o_orderstatus <> 'F'
 UNION ALL SELECT o_orderkey, 'lost_tags' FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 4 = 0""")
def preservation_faults(spark, d):
    before = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.array("o_orderpriority", F.lit("x")).alias("tags"))
    after = before.where("o_orderkey % 17 <> 0").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "F").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 4 == 0, F.array(F.lit("x"), F.lit("y"))).otherwise(F.array_append("tags", F.lit("y"))).alias("tags"),
    )
    return D.preservation(before, after, "o_orderkey", ["o_orderstatus"], ["tags"])


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ['password', 'path'] WHEN event_id % 3 = 1 THEN ['path'] ELSE [] END AS keys FROM events""")
def forbidden_keys(spark, d):
    n = F.col("event_id") % 3
    raw = F.when(n == 0, '{"a": [{"Path": 1}, {"x": {"PASSWORD": "path:"}}], "b": "token"}').when(n == 1, '{"path": {"path": null}}').otherwise('{"a": "\\"path\\":1", "b": ["password"]}')
    return table(spark, d, "events").select("event_id", D.forbidden_paths(raw, ["path", "password", "token"]).alias("keys"))


@query("""WITH p AS (SELECT l_orderkey, count(*) AS n, list(l_returnflag ORDER BY l_linenumber, l_partkey) AS f FROM lineitem GROUP BY 1), f AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 17 = 0)
 SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM f)""")
def accepted_records(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return D.accepted(orders, D.preservation(orders, orders.where("o_orderkey % 17 <> 0"), "o_orderkey", ["o_orderstatus"]), "o_orderkey").select("o_orderkey")


_FILES = {"Sonata.pdf": None, "Sonata.zip": "file_type", "Sonata - guitar part.PDF": "part", "b.pdf": "heading", "c": "file_type"}


@query(f"SELECT c_custkey, coalesce({_sql(_FILES.values())}[c_custkey % 5 + 1], CASE WHEN c_acctbal < 0 THEN 'work' END) AS reason FROM customer")
def file_reasons(spark, d):
    name = _pick(F.col("c_custkey"), list(_FILES))
    reason = R.file_reason(name, F.when(name == "b.pdf", "Sound recordings"), ["pdf"], ["part", "parts"], ["recordings"], F.col("c_acctbal") >= 0)
    return table(spark, d, "customer").select("c_custkey", reason.alias("reason"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'w1:composer w2:editor w3:composer' ELSE 'w9' END AS relations FROM events""")
def nested_relations(spark, d):
    raw = F.when(F.col("event_id") % 2 == 0, '{"a": {"role": "composer", "rel": "w1", "x": [{"b": {"role": "editor", "y": {"rel": "w2"}}}, {"rel": "w3"}]}, "z": {"w": 1}}').otherwise('{"rel": "w9", "role": null}')
    out = R.related(raw, "rel", "role")
    return table(spark, d, "events").select("event_id", F.array_join(F.transform(out, lambda r: F.concat_ws(":", r["id"], r["role"])), " ").alias("relations"))
