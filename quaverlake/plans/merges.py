"""Queries on merges of sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import merges as M
from .registry import query, table


@query("""SELECT 'c:' || c_custkey AS id, c_name AS name, 'c' AS source_id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
 UNION ALL SELECT 's:' || s_suppkey, s_name, 's' FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""")
def multi_source_merge(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    cm = table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("category"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    sm = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id"), F.col("l_returnflag").alias("category"))
    return M.merge_sources({"c": (c, cm), "s": (s, sm)})[0]


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN ['reviewed'] ELSE list_filter([CASE WHEN p_size > 40 THEN 'large' WHEN p_brand LIKE '%1' THEN 'first' END], lambda x: x IS NOT NULL) END AS a,
 list_filter([CASE WHEN p_retailprice > 1500 THEN 'dear' END], lambda x: x IS NOT NULL) AS b FROM part)
 SELECT p_partkey, array_to_string(list_concat(a, b), ',') AS topics FROM t""")
def topic_precedence(spark, d):
    review = F.when(F.col("p_partkey") % 11 == 0, F.array(F.lit("reviewed")))
    t = M.topics(
        [("large", F.col("p_size") > 40), ("first", F.col("p_brand").endswith("1"))], review, [("dear", F.col("p_retailprice") > 1500)]
    )
    return table(spark, d, "part").select("p_partkey", F.array_join(t, ",").alias("topics"))


@query("""SELECT p_partkey, coalesce(CASE WHEN p_partkey % 5 = 0 THEN 'id' || p_partkey END, CASE WHEN p_brand LIKE '%2' THEN 'b' || p_brand END) AS name_zh FROM part""")
def translation_precedence(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    by_id = part.where("p_partkey % 5 = 0").select("p_partkey", F.concat(F.lit("id"), F.col("p_partkey").cast("string")).alias("zh"))
    by_brand = part.where("p_brand like '%2'").select("p_brand", F.concat(F.lit("b"), "p_brand").alias("zh"))
    return M.translate(part, [(by_id, ["p_partkey"]), (by_brand, ["p_brand"])], "name")[0].select("p_partkey", "name_zh")


@query("""WITH m AS (SELECT source AS name, doc_id FROM documents), f AS (SELECT * FROM m), l AS (SELECT CASE WHEN name LIKE '%1' THEN name || 'x' ELSE name END AS name, doc_id FROM m WHERE doc_id % 9 <> 0)
 , g AS (SELECT * FROM f WHERE name NOT IN (SELECT name FROM l)), n AS (SELECT * FROM l WHERE name NOT IN (SELECT name FROM f))
 SELECT a.name AS old_name, b.name AS new_name, levenshtein(a.name, b.name) AS distance,
 count(*)::DOUBLE / ((SELECT count(*) FROM g WHERE g.name = a.name) + (SELECT count(*) FROM n WHERE n.name = b.name) - count(*)) AS jaccard
 FROM g a JOIN n b USING (doc_id) GROUP BY a.name, b.name HAVING levenshtein(a.name, b.name) <= 2 AND jaccard >= 0.8""")
def category_drift(spark, d):
    m = table(spark, d, "documents").select(F.col("source").alias("name"), "doc_id")
    live = m.where("doc_id % 9 <> 0").withColumn("name", F.when(F.col("name").endswith("1"), F.concat("name", F.lit("x"))).otherwise(F.col("name")))
    return M.drift(m, live, "name", "doc_id", 2, 0.8, F.substring("name", 1, 1))


@query("""WITH s AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT c_custkey AS k, c_custkey % 20 AS n FROM customer WHERE c_custkey % 4 <> 0)
 SELECT coalesce(c.k, s.k) AS k, CASE WHEN c.k IS NULL THEN 'unverified' WHEN s.k IS NULL THEN 'remove' WHEN c.n = s.n THEN 'keep' ELSE 'adjust' END AS action, coalesce(s.n, 0) AS members
 FROM c FULL JOIN s ON c.k = s.k""")
def count_reconciliation(spark, d):
    declared = table(spark, d, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k"), (F.col("c_custkey") % 20).alias("n"))
    return M.reconcile(declared, table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k", "n")


@query("""SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN 'kept' END) AS status FROM customer""")
def receipt_carry_over(spark, d):
    c = table(spark, d, "customer")
    found = c.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("status"))
    return M.carry_receipts(found, c.where("c_custkey % 2 = 0").select("c_custkey", F.lit("kept").alias("status")), "c_custkey", ["status"])


@query("""SELECT event_id, trim(json_extract_string(props, '$.k')) AS k FROM events WHERE trim(coalesce(json_extract_string(props, '$.k'), '')) <> ''""")
def closed_projection(spark, d):
    props = F.from_json("props", "map<string,string>")
    details = M.project_details(props, ["k"])
    return table(spark, d, "events").select("event_id", details["k"].alias("k")).where("k is not null")
