"""Queries on evidence from files, parts, events and pages, and on composite reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import reports as P
from .registry import query, table


@query("""WITH n AS (SELECT l_partkey, l_linenumber AS staff, min(l_orderkey) AS other FROM lineitem WHERE l_returnflag = 'N' GROUP BY ALL HAVING count(*) = 1)
 SELECT l_orderkey AS tab, l_suppkey, l_linenumber, other FROM lineitem l JOIN n ON l.l_partkey = n.l_partkey AND l_linenumber = staff WHERE l_returnflag = 'A'""")
def unique_counterparts(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    tab = lines.where("l_returnflag = 'A'").withColumn("tab", F.struct("l_orderkey", "l_suppkey", "l_linenumber"))
    normal = lines.where("l_returnflag = 'N'").withColumnRenamed("l_orderkey", "other")
    out = E.unique_counterpart(tab, normal, ["l_partkey", "l_linenumber"], "tab", "other")
    return out.select(F.col("tab.l_orderkey").alias("tab"), "tab.l_suppkey", "tab.l_linenumber", "other")


@query("""WITH g AS (SELECT DISTINCT p_brand, p_size FROM part), m AS (SELECT p_brand, p_size, p_type, p_partkey, row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_type, p_partkey) AS r FROM part WHERE p_retailprice > 950)
 SELECT g.p_brand, g.p_size, p_type, p_partkey FROM g JOIN m USING (p_brand, p_size) WHERE r = 1""")
def first_verified_candidates(spark, d):
    part = table(spark, d, "part")
    manifest = part.withColumn("fine", F.col("p_retailprice") > 950)
    return E.first_verified(part.select("p_brand", "p_size").distinct(), manifest, ["p_brand", "p_size"], ["p_type", "p_partkey"], "fine")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1 AND a.p_partkey % 2 = 0")
def confirmed_pairs(spark, d):
    """Files of equal content in pairs; all are as the journal saw them."""
    return _pairs(spark, d, 10**9)


@query("SELECT p_partkey AS a, p_partkey AS b FROM part WHERE FALSE")
def unconfirmed_pairs(spark, d):
    """One file has changed since: nothing is confirmed."""
    return _pairs(spark, d, 17)


def _pairs(spark, d, changed):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("k"), F.floor(F.col("p_partkey") / 2).alias("sha"), F.lit(1).alias("size"))
    seen = part.where("k % 2 = 0").select(F.col("k").alias("a"), (F.col("k") + 1).alias("b"), *(F.col(c).alias(f"{s}_{c}") for s in "ab" for c in ("sha", "size")))
    seen = seen.join(part.select(F.col("k").alias("b")), "b", "left_semi")
    now = part.withColumn("size", F.when(F.col("k") == changed, 2).otherwise(F.col("size")))
    return E.confirmed_pairs(seen, now, "k", ["sha", "size"]).select("a", "b")


@query("""WITH l AS (SELECT p_name, min(p_partkey)::VARCHAR AS reused FROM part WHERE p_size < 20 GROUP BY 1) SELECT p_partkey, reused FROM part LEFT JOIN l USING (p_name) WHERE p_size >= 20""")
def reused_files(spark, d):
    part = table(spark, d, "part").withColumn("sha", F.md5("p_name"))
    least = F.lpad(F.col("p_partkey").cast("string"), 12, "0")
    library = part.where("p_size < 20").select("sha", least.alias("path"))
    out = E.reusable(part.where("p_size >= 20"), library, "p_partkey", "sha")
    return out.select("p_partkey", F.col("reused").cast("long").cast("string").alias("reused"))


@query("""WITH b AS (SELECT o_custkey AS page, o_orderkey AS top, o_orderkey + 300 AS bottom FROM orders),
 n AS (SELECT *, CASE WHEN top - lag(bottom) OVER (PARTITION BY page ORDER BY top, bottom) <= 700 THEN 0 ELSE 1 END AS new FROM b)
 SELECT page, top, sum(new) OVER (PARTITION BY page ORDER BY top, bottom)::INT AS band_group FROM n""")
def staff_bands(spark, d):
    bands = table(spark, d, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("top"), (F.col("o_orderkey") + 300).alias("bottom"))
    return E.connected_bands(bands, ["page"], "top", "bottom", F.col("top") - F.col("_bottom") <= 700).select("page", "top", "band_group")


@query("""WITH e AS (SELECT user_id, event_id, event_type, row_number() OVER w AS k, lag(event_type) OVER w AS a, lag(event_type, 2) OVER w AS b FROM events WHERE event_type IN ('view', 'click') AND event_id % 5 < 3 WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
 SELECT user_id, bool_and((b IS NULL OR event_type = b) AND (a IS NULL OR event_type <> a)) AS alternates, count(*) AS n FROM e GROUP BY 1""")
def alternating_attacks(spark, d):
    e = table(spark, d, "events").where("event_type in ('view', 'click') and event_id % 5 < 3").select("user_id", "event_id", "event_type")
    return E.alternates(e, ["user_id"], "event_id", "event_type")


@query("""WITH e AS (SELECT user_id, event_id % 3 AS number, event_id, event_type, lead(event_type) OVER w AS t, lead(event_id) OVER w AS c FROM events WHERE event_type IN ('signup', 'error') WINDOW w AS (PARTITION BY user_id, event_id % 3 ORDER BY event_id))
 SELECT user_id, number, event_id AS opened, CASE WHEN t = 'error' THEN c END AS closed FROM e WHERE event_type = 'signup'""")
def part_groups(spark, d):
    e = table(spark, d, "events").select("user_id", (F.col("event_id") % 3).alias("number"), "event_id", "event_type")
    return E.numbered_spans(e, ["user_id"], "number", ["event_id"], "event_type", "signup", "error")


@query("""WITH g AS (SELECT l_orderkey, list(l_linenumber * 100000 + l_partkey ORDER BY l_linenumber * 100000 + l_partkey) AS l FROM lineitem GROUP BY 1) SELECT l_orderkey, l[1:2] AS shown, greatest(len(l) - 2, 0)::INT AS more FROM g""")
def previews(spark, d):
    rows = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.col("l_linenumber") * 100000 + F.col("l_partkey"))).alias("l"))
    return rows.select("l_orderkey", E.first_few(F.col("l"), 2).alias("p")).select("l_orderkey", "p.*")


@query("""WITH g AS (SELECT o_custkey, min(o_orderkey) AS m FROM orders WHERE o_orderstatus = 'P' GROUP BY 1 ORDER BY m, o_custkey LIMIT 40) SELECT o_orderkey FROM orders JOIN g USING (o_custkey)""")
def batch_of_started_groups(spark, d):
    return E.started_groups(table(spark, d, "orders"), "o_custkey", ["o_orderkey"], F.col("o_orderstatus") == "P", 40).select("o_orderkey")


@query("""SELECT c_custkey, row_number() OVER (ORDER BY CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 3 END, c_nationkey % 3, lower(c_name), c_custkey) AS place FROM customer""")
def category_order(spark, d):
    from ..operators import ordered as O

    rank = E.by_rank(F.col("c_mktsegment"), ["MACHINERY", "BUILDING"])
    rows = table(spark, d, "customer").select("c_custkey", rank.alias("family"), (F.col("c_nationkey") % 3).alias("kind"), F.lower("c_name").alias("name"))
    out = O.dense_ids(rows, [F.col("family"), F.col("kind"), F.col("name"), F.col("c_custkey")], "place")
    return out.select("c_custkey", (F.col("place") + 1).alias("place"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey END::BIGINT AS number FROM customer""")
def numeric_ids(spark, d):
    ident = F.concat_ws(":", F.lit("src"), F.when(F.col("c_custkey") % 5 == 0, F.lit("x1")).otherwise(F.format_string("%08d", "c_custkey")))
    return table(spark, d, "customer").select("c_custkey", E.numeric_id(ident).alias("number"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'a=x,b=y' END AS pairs, CASE p_partkey % 4 WHEN 1 THEN 'lengths' WHEN 2 THEN 'repeated' WHEN 3 THEN 'unsorted' END AS fault FROM part""")
def association_pairs(spark, d):
    n = F.col("p_partkey") % 4
    of = lambda *v: F.array(*map(F.lit, v))
    a = F.when(n == 1, of("a")).when(n == 2, of("a", "a")).when(n == 3, of("b", "a")).otherwise(of("a", "b"))
    z = E.zipped(a, of("x", "y"))
    text = F.array_join(F.transform(z["pairs"], lambda p: F.concat_ws("=", p["a"], p["b"])), ",")
    return table(spark, d, "part").select("p_partkey", text.alias("pairs"), z["fault"].alias("fault"))


@query("""SELECT p_partkey, CASE WHEN p_name = p_type THEN [p_name, p_brand] ELSE [p_name, p_type, p_brand] END AS names FROM part""")
def merged_names(spark, d):
    return table(spark, d, "part").select("p_partkey", E.rotated_merge(F.array("p_name", "p_type"), F.array("p_brand", "p_name")).alias("names"))


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity <= 20 AND l_discount >= 0.02 AND l_tax <= 0.06 AND l_returnflag <> 'N'""")
def label_boxes(spark, d):
    one = F.lit(1.0)
    boxes = table(spark, d, "lineitem").withColumns(
        {"x0": F.col("l_quantity"), "width": F.lit(50.0), "y0": F.col("l_discount"), "y1": F.col("l_tax"), "height": one, "text": F.when(F.col("l_returnflag") == "N", "12").otherwise(F.col("l_returnflag"))}
    )
    return E.label_candidates(boxes, 0.4, 0.02, 0.06, 5).select("l_orderkey", "l_linenumber")


@query("""WITH k AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS r, CASE l_returnflag WHEN 'A' THEN 'guitar' WHEN 'R' THEN 'flute' ELSE 'N' END AS label, l_returnflag AS f, count(*) AS n FROM lineitem GROUP BY ALL),
 w AS (SELECT l_orderkey, string_agg(CASE WHEN n > 1 AND f <> 'N' THEN n || ' ' || label ELSE label END, ', ' ORDER BY r) AS instrumentation, sum(n)::BIGINT AS players, bool_and(f = 'A') AS alone, bool_or(f = 'N') AS unknown FROM k GROUP BY 1)
 SELECT l_orderkey, instrumentation, players, CASE WHEN unknown THEN 'unspecified' WHEN NOT alone THEN 'mixed' WHEN players = 1 THEN 'solo' WHEN players = 2 THEN 'duo' ELSE 'ensemble' END AS topic FROM w""")
def classified_parts(spark, d):
    names = {"A": "guitar", "R": "flute"}
    return E.classified_parts(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", names, {1: "solo", 2: "duo"}, "A", "ensemble", "mixed")


@query("""SELECT l_orderkey, CASE WHEN bool_or(l_returnflag = 'A' AND l_quantity > 45) THEN 'differs' WHEN bool_or(l_quantity > 45) THEN 'partial' ELSE 'agrees' END AS status, count(*) AS groups FROM lineitem GROUP BY 1""")
def crosscheck_rollup(spark, d):
    outcome = F.when(F.col("l_quantity") <= 45, "same").when(F.col("l_returnflag") == "A", "different").otherwise("missing")
    return E.crosscheck_status(table(spark, d, "lineitem").withColumn("outcome", outcome), "l_orderkey", "outcome")


@query("""WITH f AS (SELECT p_name AS digest, p_partkey // 2 AS inode, CASE WHEN p_partkey % 10 < 2 THEN 3 ELSE 1 END AS links, p_size AS size FROM part),
 n AS (SELECT digest, inode, count(*) AS paths, max(links) AS links, max(size) AS size FROM f GROUP BY ALL), k AS (SELECT *, min(inode) OVER (PARTITION BY digest) AS kept FROM n)
 SELECT digest, sum(CASE WHEN inode <> kept AND paths >= links THEN size ELSE 0 END)::BIGINT AS bytes, count(*) FILTER (inode <> kept AND paths >= links AND size > 0) AS inodes FROM k GROUP BY 1""")
def reclaimable_inodes(spark, d):
    links = F.when(F.col("p_partkey") % 10 < 2, 3).otherwise(1)
    files = table(spark, d, "part").select(F.col("p_name").alias("digest"), F.expr("p_partkey div 2").alias("inode"), links.alias("links"), F.col("p_size").alias("size"))
    return E.reclaimable(files, "inode", "links", "size")


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, NULL AS missing FROM events""")
def deep_fields(spark, d):
    out = E.flattened(F.col("props"), {"k": "$.k", "missing": "$.a.b[0]"})
    return table(spark, d, "events").select("event_id", out.alias("o")).select("event_id", "o.*")


@query("""SELECT lang, count(*) AS records, count(*) FILTER (regexp_matches(text, 'é')) AS with_script, count(DISTINCT source) AS attributed, count(*) FILTER (quality IS NULL) AS pending FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def translation_coverage(spark, d):
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return P.coverage(docs, ["lang"], F.col("text").rlike("é"), "source", F.col("quality").isNull())


@query("""WITH f AS (SELECT l_orderkey, l_linestatus AS format, count(*) AS files, count(*) FILTER (l_returnflag = 'A') AS verified FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL)
 SELECT o_orderkey, string_agg(format || ':' || verified || '/' || files, ' ' ORDER BY format) AS files, coalesce(sum(files), 0)::BIGINT AS n FROM orders LEFT JOIN f ON l_orderkey = o_orderkey GROUP BY 1""")
def offline_edition(spark, d):
    works = table(spark, d, "orders").select("o_orderkey")
    files = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("format"), F.col("l_linenumber").alias("name"), (F.col("l_returnflag") == "A").alias("verified"), F.col("l_returnflag").alias("flag"))
    out = P.offline_edition(works, files, files.where("flag = 'N'"), "o_orderkey", ["o_orderkey", "name", "flag"])
    text = F.array_join(F.transform("files", lambda f: F.format_string("%s:%d/%d", f["format"], f["verified"], f["files"])), " ")
    return out.select("o_orderkey", F.when(F.size("files") > 0, text).alias("files"), "n")


@query("""WITH m AS (SELECT l_orderkey, l_returnflag AS part FROM lineitem WHERE l_linenumber <= 2), r AS (SELECT l_orderkey, bool_or(part = 'A') AND NOT bool_or(part = 'N') AS ok FROM m GROUP BY 1)
 SELECT o_orderkey, CASE WHEN ok IS NULL THEN 'not_extracted' WHEN NOT ok THEN 'rejected' WHEN o_orderstatus = 'F' THEN 'known' ELSE 'commit' END AS step FROM orders LEFT JOIN r ON l_orderkey = o_orderkey""")
def staged_expansion(spark, d):
    """Recall, extraction, review and commit as one staged plan: each record's last step."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    parts = table(spark, d, "lineitem").where("l_linenumber <= 2").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    extracted = parts.agg((F.bool_or(F.col("l_returnflag") == "A") & ~F.bool_or(F.col("l_returnflag") == "N")).alias("accepted"))
    return P.expansion_steps(orders, extracted, orders.where("o_orderstatus = 'F'"), "o_orderkey")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'stale' WHEN p_partkey % 5 = 0 THEN 'unknown' WHEN p_partkey % 3 = 0 THEN 'applied' ELSE 'unreviewed' END AS outcome,
 CASE WHEN p_partkey % 3 = 0 AND p_partkey % 7 <> 0 AND p_partkey % 5 <> 0 THEN 'new ' || p_name ELSE p_name END AS title FROM part WHERE p_partkey % 5 <> 0 OR p_partkey % 7 = 0
 UNION ALL SELECT -p_partkey, 'unknown', NULL FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 7 <> 0
 UNION ALL SELECT p_partkey, 'unreviewed', p_name FROM part WHERE p_partkey % 5 = 0 AND p_partkey % 7 <> 0""")
def title_review_audit(spark, d):
    part = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("title"))
    seven, five, three = (F.col("p_partkey") % n == 0 for n in (7, 5, 3))
    reviews = part.where(seven | five | three).select(
        F.when(five & ~seven, -F.col("p_partkey")).otherwise(F.col("p_partkey")).alias("p_partkey"),
        F.when(seven, F.lit("other")).otherwise(F.col("title")).alias("expected"), F.concat(F.lit("new "), "title").alias("title"),
    )
    return P.reviewed_titles(part, reviews, "p_partkey", "title")


@query("""WITH g AS (SELECT p_name, p_type, min(p_partkey) AS keep, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1)
 SELECT p_partkey, keep, CASE WHEN p_partkey = keep THEN 'keep' WHEN p_size > 45 THEN 'skip_unverified' ELSE 'link' END AS action FROM part JOIN g USING (p_name, p_type)""")
def dedup_dry_run(spark, d):
    files = table(spark, d, "part").withColumn("verified", F.col("p_size") <= 45)
    return P.dedup_plan(files, ["p_name", "p_type"], "p_partkey", "verified")


@query("""SELECT c_mktsegment AS source, count(*) AS records, count(*) FILTER (c_acctbal > 0) AS published, count(*) FILTER (o IS NULL) AS without_files, coalesce(sum(o), 0)::BIGINT AS files FROM customer
 LEFT JOIN (SELECT o_custkey, count(*) AS o FROM orders GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1""")
def integration_report(spark, d):
    records = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("source"), (F.col("c_acctbal") > 0).alias("published"))
    return P.integration_report(records, table(spark, d, "orders").select(F.col("o_custkey").alias("id")), "id", "source", "published")


@query("""WITH f AS (SELECT source, count(*) AS n, max(doc_id) AS last FROM documents GROUP BY 1), l AS (SELECT source, count(*) AS n, max(doc_id) AS last FROM documents WHERE doc_id % 50 <> 7 AND source <> 'src3' GROUP BY 1)
 SELECT f.source, CASE WHEN l.source IS NULL THEN 'removed' WHEN f.n = l.n AND f.last = l.last THEN 'resume' ELSE 'refetch' END AS action FROM f LEFT JOIN l USING (source)""")
def snapshot_resume(spark, d):
    docs = table(spark, d, "documents").select("source", "doc_id")
    return P.resume_plan(docs, docs.where("doc_id % 50 <> 7 and source <> 'src3'"), "source", "doc_id")


@query("""WITH r AS (SELECT o_orderkey, o_orderkey % 4 AS votes, o_orderstatus FROM orders) SELECT o_orderkey, CASE WHEN votes = 0 THEN 'pending' WHEN votes = 1 AND o_orderstatus = 'F' THEN 'conflict' ELSE 'decided' END AS state FROM r""")
def compiled_reviews(spark, d):
    o = table(spark, d, "orders")
    one = o.where("o_orderkey % 4 <> 0").select("o_orderkey", F.lit("a").alias("topic"))
    two = o.where("o_orderkey % 4 = 1 and o_orderstatus = 'F'").select("o_orderkey", F.lit("b").alias("topic"))
    return P.compiled_review(o.select("o_orderkey"), one.union(two).union(one), "o_orderkey", "topic").select("o_orderkey", "state")
