"""Queries on set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sets as S
from .registry import query, table


@query("SELECT doc_id, source FROM documents")
def append_disjoint(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    out, clash = S.append_new(docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 3 = 0"), "doc_id")
    return out.join(clash, "doc_id", "left_anti")


@query("SELECT doc_id FROM documents WHERE doc_id % 2 = 0 AND doc_id % 3 <> 0")
def append_refused(spark, d):
    """The keys for which an append is refused."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    return S.append_new(docs.where("doc_id % 3 <> 0"), docs.where("doc_id % 2 = 0 or doc_id % 3 = 0"), "doc_id")[1]


@query("""SELECT (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)) + (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 100 = 1)) = 0 AS equal,
 (SELECT count(*) FROM customer WHERE c_custkey % 100 <> 1 AND c_custkey NOT IN (SELECT o_custkey FROM orders)) AS left_only, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey % 100 = 1) AS right_only""")
def exact_set_equality(spark, d):
    known = table(spark, d, "customer").where("c_custkey % 100 <> 1").select(F.col("c_custkey").alias("o_custkey"))
    return S.same_set(known, table(spark, d, "orders"), "o_custkey")


@query("SELECT event_type, min(event_id) AS event_id FROM events GROUP BY 1")
def first_seen_order(spark, d):
    return S.first_seen(table(spark, d, "events"), "event_type", ["event_id"])


@query("""SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber < 4 EXCEPT ALL SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber > 2""")
def multiset_difference(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = lambda c: rows.where(c).select("l_orderkey", "l_partkey")
    return S.set_difference(part("l_linenumber < 4"), part("l_linenumber > 2"))


@query("""WITH s AS (SELECT o_custkey, list(DISTINCT o_orderpriority) FILTER (o_orderkey % 2 = 0) AS a, list(DISTINCT o_orderpriority) FILTER (o_orderkey % 2 = 1) AS b FROM orders GROUP BY 1)
 SELECT o_custkey, CASE WHEN len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) = 0 THEN 0.0 ELSE len(list_intersect(coalesce(a, []), coalesce(b, [])))::DOUBLE / len(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) END AS jaccard FROM s""")
def array_jaccard(spark, d):
    side = lambda k: F.collect_set(F.when(F.col("o_orderkey") % 2 == k, F.col("o_orderpriority")))
    sets = table(spark, d, "orders").groupBy("o_custkey").agg(side(0).alias("a"), side(1).alias("b"))
    return sets.select("o_custkey", S.jaccard(F.col("a"), F.col("b")).alias("jaccard"))


@query(r"""SELECT page_id, list_sort(regexp_extract_all(url, '[0-9]')) = list_sort(regexp_extract_all((page_id + 800)::VARCHAR || '2', '[0-9]')) AS same_digits FROM pages""")
def digit_multisets(spark, d):
    digits = lambda c: F.regexp_extract_all(c, F.lit(r"([0-9])"), 1)
    other = F.concat((F.col("page_id") + 800).cast("string"), F.lit("2"))
    return table(spark, d, "pages").select("page_id", S.same_multiset(digits(F.col("url")), digits(other)).alias("same_digits"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'TWICE' WHEN c_custkey % 5 = 0 THEN 'ONCE' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def ordered_supplements(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    first = base.where("c_custkey % 2 = 0 or c_custkey % 5 = 0").select("c_custkey", F.lit(1).alias("seq"), F.col("c_mktsegment").alias("expected"), F.lit("ONCE").alias("c_mktsegment"))
    second = base.where("c_custkey % 2 = 0").select("c_custkey", F.lit(2).alias("seq"), F.lit("ONCE").alias("expected"), F.lit("TWICE").alias("c_mktsegment"))
    stale = base.select("c_custkey", F.lit(3).alias("seq"), F.lit("never").alias("expected"), F.lit("LOST").alias("c_mktsegment"))
    return S.fold_supplements(base, first.union(second).union(stale), "c_custkey", "c_mktsegment")


@query("""WITH s AS (SELECT o_orderkey // 1000 AS k, min(o_orderkey) AS a, max(o_orderkey) + 1 AS b FROM orders GROUP BY 1)
 , l AS (SELECT *, max(b) OVER (ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM s)
 SELECT count(*) AS shards, min(a) AS first, max(b) AS last, count(*) FILTER (a < r) = 0 AS disjoint, count(*) FILTER (a <> r) = 0 AS contiguous,
 count(*) FILTER (a > r) = 0 AS complete FROM l""")
def shard_completeness(spark, d):
    shards = table(spark, d, "orders").groupBy(F.expr("o_orderkey div 1000").alias("k")).agg(F.min("o_orderkey").alias("start"), (F.max("o_orderkey") + 1).alias("stop"))
    return S.shard_report(shards)


@query("""WITH e AS (SELECT l_partkey AS a, l_suppkey AS b, l_returnflag AS type, min(l_linenumber) AS n FROM lineitem GROUP BY ALL),
 o AS (SELECT a, b, type FROM e WHERE n <> 2), w AS (SELECT a, b, type FROM e WHERE a % 50 <> 1), x AS (SELECT p_partkey AS id FROM part WHERE p_partkey % 3 = 0)
 SELECT a, b, type, 'lost' AS fault FROM o WHERE a % 50 = 1 UNION ALL
 SELECT a, b, type, 'foreign' FROM w WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.a = w.a AND o.b = w.b AND o.type = w.type) AND a NOT IN (SELECT id FROM x) AND b NOT IN (SELECT id FROM x)""")
def edge_set_changes(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), F.col("l_returnflag").alias("type"))
    edges = lines.agg(F.min("l_linenumber").alias("n"))
    added = table(spark, d, "part").where("p_partkey % 3 = 0").select(F.col("p_partkey").alias("id"))
    keys = ["a", "b", "type"]
    return S.edge_changes(edges.where("n <> 2").select(*keys), edges.where("a % 50 <> 1").select(*keys), added)


@query("""SELECT count(*) = 0 AS subset, count(*) AS missing FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 13 <> 5))""")
def subset_verdict(spark, d):
    known = table(spark, d, "customer").where("c_custkey % 13 <> 5").select(F.col("c_custkey").alias("o_custkey"))
    return S.is_subset(table(spark, d, "orders"), known, "o_custkey")


@query("""SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) INTERSECT SELECT doc_id FROM labels""")
def subset_members(spark, d):
    labels = table(spark, d, "labels")
    return table(spark, d, "documents").select("doc_id").join(labels.where("quality = 1"), "doc_id", "left_anti").intersect(labels.select("doc_id"))


@query("""SELECT s_suppkey AS id, s_name AS name, 'supplier' AS kind FROM supplier UNION ALL SELECT c_custkey + 1000000, c_name, 'customer' FROM customer""")
def union_sources(spark, d):
    a = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    b = table(spark, d, "customer").select((F.col("c_custkey") + 1000000).alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    return S.union_disjoint([a, b], "id")[0]
