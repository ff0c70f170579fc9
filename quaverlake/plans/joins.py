"""Queries on joins and relationships."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import facets
from ..operators import joins as J
from .registry import query, table


@query("""SELECT n_nationkey, r_name AS region, r_name IS NULL AS unmapped FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 3) ON n_regionkey = r_regionkey""")
def must_match_remap(spark, d):
    nation = table(spark, d, "nation").select("n_nationkey", F.col("n_regionkey").cast("string").alias("region"))
    region = table(spark, d, "region").where("r_regionkey <> 3").select(F.col("r_regionkey").cast("string").alias("k"), "r_name")
    return J.remap(nation, "region", region, "k", "r_name")


@query("""SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def left_anti_stale(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id", "left_anti")


@query("""SELECT doc_id, source FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0)""")
def left_semi_retry(spark, d):
    failed = table(spark, d, "labels").where("quality = 0")
    return table(spark, d, "documents").select("doc_id", "source").join(failed, "doc_id", "left_semi")


@query("""SELECT count(*) FILTER (d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched,
 count(*) FILTER (l.doc_id IS NULL) AS left_only, count(*) FILTER (d.doc_id IS NULL) AS right_only
 FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 0) l USING (doc_id)""")
def full_outer_audit(spark, d):
    return J.audit(table(spark, d, "documents"), table(spark, d, "labels").where("toxic = 0"), "doc_id")


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem l WHERE NOT EXISTS (
 SELECT 1 FROM lineitem x WHERE x.l_returnflag = 'R' AND x.l_orderkey = l.l_orderkey AND x.l_partkey = l.l_partkey AND x.l_suppkey = l.l_suppkey)""")
def exclusion_composite_key(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag")
    keys = ["l_orderkey", "l_partkey", "l_suppkey"]
    return lines.join(lines.where("l_returnflag = 'R'").select(*keys), keys, "left_anti").select("l_orderkey", "l_linenumber", "l_quantity")


@query("""WITH u AS (SELECT p_name, min(p_brand) AS p_brand FROM part GROUP BY p_name HAVING count(DISTINCT p_brand) = 1)
 SELECT p_partkey, u.p_brand AS known_brand FROM part LEFT JOIN u USING (p_name)""")
def unique_reference_lookup(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    known = J.unique_lookup(part, "p_name", "p_brand").withColumnRenamed("p_brand", "known_brand")
    return part.join(known, "p_name", "left").select("p_partkey", "known_brand")


@query("""SELECT user_id, event_id, event_type FROM (
 SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 ELSE 2 END, ts, event_id) AS r FROM events) WHERE r = 1""")
def prioritized_match(spark, d):
    rank = F.when(F.col("event_type") == "purchase", 0).when(F.col("event_type") == "signup", 1).otherwise(2)
    events = table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return J.prioritised(events, ["user_id"], rank, F.col("ts"), F.col("event_id")).select("user_id", "event_id", "event_type")


@query("""WITH e AS (SELECT event_id, user_id, event_type, floor(epoch(ts))::BIGINT AS s FROM events)
 SELECT a.event_id, b.event_id AS range_id FROM e a JOIN e b ON a.user_id = b.user_id AND b.event_type = 'signup'
 AND a.s >= b.s AND a.s < b.s + 86400 AND a.event_type <> 'signup'""")
def range_join(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", F.unix_timestamp("ts").alias("s"))
    ranges = e.where("event_type = 'signup'").select(
        "user_id", F.col("event_id").alias("range_id"), F.col("s").alias("start"), (F.col("s") + 86400).alias("stop")
    )
    points = e.where("event_type <> 'signup'").select("event_id", "user_id", "s")
    return J.range_join(points, "s", ranges, "start", "stop", ["user_id"], 86400).select("event_id", "range_id")


@query("""SELECT a.p_name AS old_name, b.p_name AS new_name, levenshtein(a.p_name, b.p_name) AS distance
 FROM (SELECT DISTINCT p_name, p_brand FROM part WHERE p_partkey % 2 = 0) a JOIN (SELECT DISTINCT p_name, p_brand FROM part WHERE p_partkey % 2 = 1) b
 USING (p_brand) WHERE levenshtein(a.p_name, b.p_name) <= 2""")
def rename_candidates(spark, d):
    part = table(spark, d, "part")
    names = lambda k: part.where(f"p_partkey % 2 = {k}").select("p_name", "p_brand").distinct()
    return J.similar_names(names(0), names(1), "p_name", 2, F.col("p_brand"))


@query("""WITH t AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS f FROM documents)
 SELECT DISTINCT f AS from_id, doc_id AS to_id, 'identical_text' AS kind FROM t WHERE f <> doc_id""")
def star_edges(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return J.star_edges(docs, "digest", "doc_id", "identical_text")


@query("""WITH e AS (SELECT DISTINCT least(l_partkey, l_suppkey) AS f, greatest(l_partkey, l_suppkey) AS t FROM lineitem WHERE l_partkey <> l_suppkey),
 b AS (SELECT f AS node, t AS neighbour FROM e UNION ALL SELECT t, f FROM e)
 SELECT node, neighbour, 'sold' AS kind FROM b WHERE node IN (SELECT s_suppkey FROM supplier WHERE s_nationkey = 3)""")
def one_hop_neighbours(spark, d):
    edges = J.undirected(table(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.lit("sold").alias("kind")), "l_partkey", "l_suppkey")
    nodes = table(spark, d, "supplier").where("s_nationkey = 3").select(F.col("s_suppkey").alias("node"))
    return J.neighbours(edges, nodes, "node")


_FILE_URLS = {
    "HTTPS://U@Ex.org:8080/a%20b+c.PDF?x=1#y": "ex.org/a b+c.PDF?x=1", "http://ex.org/a.html": None, "https://urn.kb.se/resolve?urn=urn%3Anbn%3Ase%3A1": "urn.kb.se/resolve?urn=urn%3Anbn%3Ase%3A1",
    "https://urn.kb.se/resolve?urn=x": None, "ftp://ex.org/a.pdf": None, "http://ex.org/x.zip": "ex.org/x.zip", "http://ex.org/%zz.pdf": "ex.org/%zz.pdf",
}


@query(f"""SELECT page_id, {"[" + ", ".join("NULL" if v is None else f"'{v}'" for v in _FILE_URLS.values()) + "]"}[page_id % {len(_FILE_URLS)} + 1] AS file_key FROM pages""")
def url_file_key(spark, d):
    url = F.element_at(F.array(*map(F.lit, _FILE_URLS)), (F.col("page_id") % len(_FILE_URLS) + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", urls.file_key(url).alias("file_key"))


@query(r"""WITH u AS (SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:@]+)', 1)) AS h, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS p,
 list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: split_part(x, '=', 1)) AS k FROM pages)
 SELECT page_id, (h = 'example.org' OR h LIKE '%.example.org' OR h = 'example.com' OR h LIKE '%.example.com') AND regexp_matches(p, '^/[a-z]{2}/[0-9]+')
 AND len(list_filter(k, lambda x: x NOT IN ('page', 'ref'))) = 0 AS allowed FROM u""")
def url_allow_list(spark, d):
    ok = urls.allowed(F.col("url"), ["example.org", "example.com"], "^/[a-z]{2}/[0-9]+", ["page", "ref"])
    return table(spark, d, "pages").select("page_id", ok.alias("allowed"))


@query(r"""WITH r(prefix, allow) AS (VALUES ('/en/', false), ('/en/7', true), ('/de/1', false)),
 u AS (SELECT page_id AS url, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages)
 SELECT url, coalesce((SELECT allow FROM r WHERE starts_with(path, prefix) ORDER BY length(prefix) DESC, allow DESC LIMIT 1), true) AS allowed FROM u""")
def robots_rules(spark, d):
    rules = spark.createDataFrame([("/en/", False), ("/en/7", True), ("/de/1", False)], "prefix string, allow boolean")
    path = F.regexp_extract("url", r"^https?://[^/?#]+([^?#]*)", 1)
    return facets.robots_allows(rules, table(spark, d, "pages").select(F.col("page_id").alias("url"), path.alias("path")))


@query("""SELECT c_custkey, CASE WHEN c_acctbal < 0 AND c_nationkey <> 7 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def review_overlay(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    seen = F.when(F.col("c_nationkey") == 7, 8).otherwise(F.col("c_nationkey"))  # a review of another state has no effect
    reviews = table(spark, d, "customer").where("c_acctbal < 0").select("c_custkey", F.lit("DEBT").alias("c_mktsegment"), seen.alias("c_nationkey"))
    return J.overlay(base, reviews, "c_custkey", ["c_mktsegment"], guard="c_nationkey").select("c_custkey", "c_mktsegment")


@query("""WITH a AS (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 3),
 b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 10 <> 5)
 SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change
 FROM a FULL JOIN b USING (o_orderkey) WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus""")
def snapshot_diff(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    after = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 7 == 0, "X").otherwise(F.col("o_orderstatus")))
    return J.changes(orders.where("o_orderkey % 10 <> 3"), after.where("o_orderkey % 10 <> 5"), "o_orderkey", ["o_orderstatus"])


@query("""WITH c AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE p_partkey END AS id, CASE WHEN p_partkey % 10 = 4 THEN 'another' ELSE p_name || (p_partkey // 40) END AS p_name FROM part),
 m AS (SELECT p_partkey AS id, p_name || (p_partkey // 40) AS p_name FROM part), n AS (SELECT p_name, count(*) AS k, min(id) AS one FROM m GROUP BY p_name)
 SELECT c.p_partkey, CASE WHEN c.id >= 0 AND c.p_name <> 'another' THEN c.id WHEN c.id < 0 AND k = 1 THEN one END AS matched_id,
 CASE WHEN c.id >= 0 AND c.p_name = 'another' THEN 'conflict' WHEN c.id >= 0 THEN 'id' WHEN k = 1 THEN 'name' WHEN k > 1 THEN 'ambiguous' ELSE 'missing' END AS outcome
 FROM c LEFT JOIN n USING (p_name)""")
def two_phase_association(spark, d):
    name = F.concat("p_name", F.expr("p_partkey div 40").cast("string"))
    part = table(spark, d, "part").select("p_partkey", F.col("p_partkey").alias("id"), name.alias("p_name"))
    chunks = part.withColumns(
        {"id": F.when(F.col("p_partkey") % 3 == 0, F.lit(-1)).otherwise(F.col("id")), "p_name": F.when(F.col("p_partkey") % 10 == 4, F.lit("another")).otherwise(F.col("p_name"))}
    )
    return J.two_phase(chunks, part.select("id", "p_name"), "id", "p_name").select("p_partkey", "matched_id", "outcome")


@query("""WITH g AS (SELECT count(*) AS bad FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)) SELECT n_nationkey, n_name FROM nation, g WHERE bad = 0""")
def all_or_nothing_relations(spark, d):
    region = table(spark, d, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.lit(True).alias("known"))
    nation = table(spark, d, "nation").join(region, "n_regionkey", "left")
    return J.all_or_nothing(nation, [F.col("known")]).select("n_nationkey", "n_name")


@query("""SELECT n_nationkey FROM nation WHERE (SELECT count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey < 4)) = 0""")
def all_or_nothing_with_a_bad_row(spark, d):
    region = table(spark, d, "region").where("r_regionkey < 4").select(F.col("r_regionkey").alias("n_regionkey"), F.lit(True).alias("known"))
    nation = table(spark, d, "nation").join(region, "n_regionkey", "left")
    return J.all_or_nothing(nation, [F.col("known")]).select("n_nationkey")


_ROBOTS = "User-agent: *\nDisallow: /\n\nUser-agent: Reader # ours\nUser-agent: other\nDisallow: /en/\nAllow: /en/7\nDisallow: /*?page=2\nDisallow: /de/1$\nDisallow:\n"


@query(r"""WITH u AS (SELECT page_id AS url, regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1) AS t FROM pages)
 SELECT url, CASE WHEN t LIKE '/%?page=2%' THEN false WHEN t LIKE '/en/7%' THEN true WHEN t LIKE '/en/%' THEN false WHEN t = '/de/1' THEN false ELSE true END AS allowed FROM u""")
def robots_groups(spark, d):
    files = spark.createDataFrame([("h", _ROBOTS)], "host string, body string")
    target = F.regexp_extract("url", r"^https?://[^/?#]+([^#]*)", 1)
    return facets.robots_verdicts(files, table(spark, d, "pages").select(F.col("page_id").alias("url"), F.lit("h").alias("host"), target.alias("target")), "Reader/1.0")


@query("""WITH p AS (SELECT p_partkey % (n * 3 // 4) AS a, p_partkey % (n * 7 // 8) AS b FROM part, (SELECT count(*) AS n FROM part)), u AS (SELECT a FROM p GROUP BY a HAVING count(*) = 1), v AS (SELECT b FROM p GROUP BY b HAVING count(*) = 1)
 SELECT a, b FROM p WHERE a IN (SELECT a FROM u) AND b IN (SELECT b FROM v)""")
def attacks_used_once(spark, d):
    part = table(spark, d, "part")
    n = part.count()
    pairs = part.select((F.col("p_partkey") % (n * 3 // 4)).alias("a"), (F.col("p_partkey") % (n * 7 // 8)).alias("b"))
    return J.matched_once(pairs, "a", "b").select("a", "b")


@query("""WITH l AS (SELECT c_custkey AS l, c_mktsegment AS m, c_nationkey AS n, c_custkey % 50 AS k FROM customer), r AS (SELECT s_suppkey AS r, ['HOUSEHOLD', 'MACHINERY', 'BUILDING'][s_suppkey % 3 + 1] AS m, s_nationkey AS n, s_suppkey % 70 AS k FROM supplier),
 a AS (SELECT m, n, min(r) AS r FROM r GROUP BY ALL HAVING count(*) = 1), b AS (SELECT n, min(r) AS r FROM r GROUP BY ALL HAVING count(*) = 1), c AS (SELECT k, min(r) AS r FROM r GROUP BY ALL HAVING count(*) = 1)
 SELECT l, coalesce(a.r, b.r, c.r) AS r, CASE WHEN a.r IS NOT NULL THEN 0 WHEN b.r IS NOT NULL THEN 1 WHEN c.r IS NOT NULL THEN 2 END::INT AS level
 FROM l LEFT JOIN a USING (m, n) LEFT JOIN b ON l.n = b.n LEFT JOIN c ON l.k = c.k""")
def role_matches(spark, d):
    """By segment and nation, else by nation, else by a number, where only one supplier agrees."""
    left = table(spark, d, "customer").select(F.col("c_custkey").alias("l"), F.col("c_mktsegment").alias("m"), F.col("c_nationkey").alias("n"), (F.col("c_custkey") % 50).alias("k"))
    segment = F.element_at(F.array(*map(F.lit, ("HOUSEHOLD", "MACHINERY", "BUILDING"))), (F.col("s_suppkey") % 3 + 1).cast("int"))
    right = table(spark, d, "supplier").select(F.col("s_suppkey").alias("r"), segment.alias("m"), F.col("s_nationkey").alias("n"), (F.col("s_suppkey") % 70).alias("k"))
    return J.by_precedence(left, right, "l", "r", [["m", "n"], ["n"], ["k"]])
