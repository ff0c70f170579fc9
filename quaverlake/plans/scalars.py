"""Queries on scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from ..functions import urls
from .registry import query, table


@query("SELECT doc_id, strip_accents(lower(source)) AS folded FROM documents")
def accent_fold(spark, d):
    return table(spark, d, "documents").select("doc_id", X.fold("source").alias("folded"))


@query()
def search_normalise(spark, d):
    return table(spark, d, "documents").select("doc_id", X.search_form("text").alias("form"))


@query(r"""SELECT doc_id, len(list_distinct(regexp_extract_all(lower(text), '[a-z]+|[\x{3400}-\x{9fff}]+|\d+')))::INT AS n_tokens FROM documents""")
def distinct_tokens(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(X.tokens(F.col("text"))).alias("n_tokens"))


@query(r"""SELECT c_custkey, trim(regexp_replace(lower(split_part(x, ',', 2) || ' ' || split_part(x, ',', 1)), '[^a-z0-9]+', ' ', 'g')) AS key
 FROM (SELECT c_custkey, c_mktsegment || ', ' || c_name AS x FROM customer)""")
def composer_key(spark, d):
    name = F.concat_ws(", ", "c_mktsegment", "c_name")
    return table(spark, d, "customer").select("c_custkey", X.composer_key(name).alias("key"))


_RESPONSES = {
    "<p>Verify you are HUMAN, or log": "human_verification_required", "Please log in": "login_required", "You may download this in\n 15 seconds": "membership_wait_pending", "Members only; continue": "membership_required",
    "not public domain": "copyright_restricted", "Not available in your country": "region_restricted", "commercial edition": "commercial_only", "The requested file has been deleted": "deleted", "hello": "not_a_pdf",
    "captcha; please log in": "human_verification_required",
}


@query(f"""SELECT page_id, {list(_RESPONSES.values())}[page_id % 10 + 1] AS html_class, CASE WHEN page_id % 10 = 2 THEN 15 END AS wait FROM pages""")
def response_classes(spark, d):
    body = F.concat(F.element_at(F.array(*map(F.lit, _RESPONSES)), (F.col("page_id") % 10 + 1).cast("int")), F.lit("</p>"))
    return table(spark, d, "pages").select("page_id", X.response_class(body).alias("html_class"), X.wait_seconds(body).alias("wait"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts - INTERVAL 2 HOUR END AS at, event_id % 3 <> 0 OR ts - INTERVAL 2 HOUR <= TIMESTAMP '2024-01-05' AS due FROM events""")
def aware_timestamps(spark, d):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    n = F.col("event_id") % 3
    at = X.aware_timestamp(F.when(n == 0, F.concat(text, F.lit("+02:00"))).when(n == 1, text).otherwise("soon"))
    return table(spark, d, "events").select("event_id", at.alias("at"), X.due(at, F.lit("2024-01-05").cast("timestamp")).alias("due"))


@query("""SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE '{"a":[1,{"x":null,"z":"é"}],"k":' || (json_extract(props, '$.k'))::VARCHAR || '}' END AS doc FROM events""")
def canonical_documents(spark, d):
    raw = F.concat(F.lit('{ "k": '), F.get_json_object("props", "$.k"), F.lit(', "a" : [1, {"z": "\\u00e9", "x": null}]'), F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.lit("}")))
    return table(spark, d, "events").select("event_id", X.canonical_json(raw).alias("doc"))


_FORMS = {"Op.27 Nº2": "op 27 no 2", "Étude—À la façon": "etude a la facon", "練習曲·蕭邦": "练习曲萧邦", "Łódź ﬁne ß": "lodz fine ss", "  ": "", "Sor2Giuliani": "sor 2 giuliani"}


@query(f"""SELECT c_custkey, {list(_FORMS.values())}[c_custkey % {len(_FORMS)} + 1] AS form FROM customer""")
def search_forms(spark, d):
    text = F.element_at(F.array(*map(F.lit, _FORMS)), (F.col("c_custkey") % len(_FORMS) + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", X.search_form(text).alias("form"))


_OSA = {("ca", "abc"): 3, ("sor", "sro"): 1, ("etude", "etude"): 0, ("", "ab"): 2, ("giuliani", "guiliain"): 2, ("abcdef", "badcfe"): 3}


@query(f"""SELECT s_suppkey, {list(_OSA.values())}[s_suppkey % {len(_OSA)} + 1]::INT AS distance FROM supplier""")
def osa_distances(spark, d):
    side = lambda n: F.element_at(F.array(*(F.lit(k[n]) for k in _OSA)), (F.col("s_suppkey") % len(_OSA) + 1).cast("int"))
    return table(spark, d, "supplier").select("s_suppkey", X.osa_distance(side(0), side(1)).alias("distance"))


_SHOWN = {
    "a quiet note\n": True, "write to a.b@c.org": False, "see www.x.org": False, "call +49 30 1234567 8": False, "in sources/x": False, "a" * 64: False, "score.PDF": False, " /tmp/x": False, "C:/x": False,
    "bell \x07": False, "  ": False, "x" * 1601: False, "tab\tis fine": True,
}


@query(f"SELECT c_custkey, {list(_SHOWN.values())}[c_custkey % {len(_SHOWN)} + 1] AS safe FROM customer")
def safe_text(spark, d):
    text = F.element_at(F.array(*map(F.lit, _SHOWN)), (F.col("c_custkey") % len(_SHOWN) + 1).cast("int"))
    return table(spark, d, "customer").select("c_custkey", X.safe_text(text).alias("safe"))


@query("SELECT r_regionkey, sha256(r_regionkey || '|' || r_name) AS digest, md5(r_name) AS short FROM region")
def canonical_digest(spark, d):
    whole = F.concat_ws("|", F.col("r_regionkey").cast("string"), "r_name")
    return table(spark, d, "region").select("r_regionkey", F.sha2(whole, 256).alias("digest"), F.md5("r_name").alias("short"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing.deep') AS missing FROM events""")
def json_path(spark, d):
    v = F.try_parse_json("props")
    return table(spark, d, "events").select("event_id", F.try_variant_get(v, "$.k", "string").alias("k"), F.try_variant_get(v, "$.missing.deep", "string").alias("missing"))


@query("""SELECT p_partkey, (p_size / gcd(p_size, 48))::BIGINT AS num, (48 / gcd(p_size, 48))::BIGINT AS den FROM part""")
def rational_time(spark, d):
    r = N.rational(F.col("p_size").cast("long"), F.lit(48).cast("long"))
    return table(spark, d, "part").select("p_partkey", r["num"].alias("num"), r["den"].alias("den"))


@query("SELECT l_orderkey, l_linenumber, round_even(l_extendedprice * 4, 0) / 4 AS quarter FROM lineitem")
def quarter_rounding(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", N.quarter(F.col("l_extendedprice")).alias("quarter"))


@query("SELECT l_orderkey, l_linenumber, least(0.5 * pow(2.0, l_linenumber - 1), 6.0) AS wait FROM lineitem")
def backoff_times(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", N.backoff(0.5, F.col("l_linenumber"), 6.0).alias("wait"))


@query("""SELECT p_partkey, ((p_size % 8 + 1) * 12 + [0, 2, 4, 5, 7, 9, 11][p_partkey % 7 + 1] + p_size % 3 - 1 - 12)::INT AS pitch FROM part""")
def midi_numbers(spark, d):
    step = F.element_at(F.array(*map(F.lit, "CDEFGAB")), (F.col("p_partkey") % 7 + 1).cast("int"))
    pitch = N.midi_number(step, F.col("p_size") % 3 - 1, F.col("p_size") % 8, F.lit(-12))
    return table(spark, d, "part").select("p_partkey", pitch.alias("pitch"))


@query(r"""SELECT page_id, regexp_extract(url, '[?&]page=([^&#]*)', 1) AS page, 'a b+ü' AS q, '' AS flag FROM pages WHERE regexp_matches(url, '[?&]page=')""")
def query_string(spark, d):
    more = F.concat(F.substring_index("url", "#", 1), F.lit("&q=x&q=a%20b%2B%C3%BC&flag#page=9"))
    m = urls.query_map(more)
    return table(spark, d, "pages").select("page_id", m["page"].alias("page"), m["q"].alias("q"), m["flag"].alias("flag")).where("page is not null")


@query("""SELECT p_partkey, p_brand || '；' || p_type || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE '；' || p_name END AS details FROM part""")
def append_distinct_detail(spark, d):
    value = F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", X.append_detail(F.concat_ws("；", "p_brand", "p_type"), value).alias("details"))


@query("""SELECT o_orderkey, o_orderdate > TIMESTAMP '1995-01-01' AS late, date_diff('day', TIMESTAMP '1992-01-01', o_orderdate)::INT AS days FROM orders""")
def timestamp_checks(spark, d):
    at = F.col("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", (at > F.lit("1995-01-01").cast("timestamp")).alias("late"), F.datediff(at, F.lit("1992-01-01")).alias("days"))


@query("SELECT s_suppkey, '《' || s_name || '》' AS title FROM supplier")
def wrapped_titles(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", X.wrap_title(X.wrap_title(F.col("s_name"))).alias("title"))


@query("SELECT doc_id, left(text, list_max([n FOR n IN range(0, 65) IF strlen(left(text, n)) <= 64])) AS short FROM documents")
def truncated_utf8(spark, d):
    return table(spark, d, "documents").select("doc_id", X.truncate_utf8(F.col("text"), 64).alias("short"))


@query("""SELECT p_partkey, replace(replace(p_type, 'STANDARD', 'S'), 'STEEL', 's') AS label, regexp_replace(trim(regexp_replace(lower(p_name), '[-_\\s]+', ' ', 'g')), '\\.(pdf|zip)$', '') AS name FROM part""")
def dictionary_labels(spark, d):
    return table(spark, d, "part").select(
        "p_partkey", X.longest_first(F.col("p_type"), {"STEEL": "s", "STANDARD": "S"}).alias("label"), X.plain_link(X.category_name(F.col("p_name"))).alias("name")
    )


_COSTS = {("etude", "etdue"): 1, ("练习曲", "大练习曲集"): 0, ("练习曲", "练曲"): 1, ("etude", "练习曲"): 3, ("guitarra", "guitare"): 2, ("guitarra", "gitano"): 3}


@query(f"""SELECT s_suppkey, {list(_COSTS.values())}[s_suppkey % {len(_COSTS)} + 1]::INT AS cost FROM supplier""")
def token_costs(spark, d):
    side = lambda n: F.element_at(F.array(*(F.lit(k[n]) for k in _COSTS)), (F.col("s_suppkey") % len(_COSTS) + 1).cast("int"))
    return table(spark, d, "supplier").select("s_suppkey", X.token_cost(side(1), side(0)).alias("cost"))
