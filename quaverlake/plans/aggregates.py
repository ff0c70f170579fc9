"""Queries on facets, counts and groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as A
from ..operators import facets
from .registry import query, table


@query("SELECT lang, count(*) AS work_count, count(DISTINCT source) AS source_count FROM documents GROUP BY lang")
def topic_browse(spark, d):
    return facets.topic_counts(table(spark, d, "documents"), "lang", "source")


@query("""SELECT topic, count(doc_id) AS work_count, count(DISTINCT source) AS source_count
 FROM (VALUES ('en'), ('it')) v(topic) LEFT JOIN documents ON lang = topic GROUP BY topic""")
def topic_counts_fixed_vocabulary(spark, d):
    topics = spark.createDataFrame([("en",), ("it",)], "topic string")
    return facets.topic_counts(table(spark, d, "documents").withColumnRenamed("lang", "topic"), "topic", "source", topics)


@query("""SELECT p_partkey, p_name FROM part p WHERE EXISTS (SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 WHERE l_partkey = p.p_partkey AND l_returnflag = 'R' AND l_linestatus = 'F' AND s_nationkey < 5)""")
def facet_same_membership(spark, d):
    supplier = table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    bridge = table(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_suppkey", "l_returnflag", "l_linestatus")
    bridge = bridge.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return facets.same_membership(
        table(spark, d, "part").select("p_partkey", "p_name"), bridge, "p_partkey",
        F.col("l_returnflag") == "R", F.col("l_linestatus") == "F", F.col("s_nationkey") < 5,
    )


_REASON = "CASE WHEN l_quantity < 5 THEN 'too_few' WHEN l_discount > 0.08 THEN 'discounted' WHEN l_returnflag = 'R' THEN 'returned' END"


@query(f"SELECT l_orderkey, l_linenumber, {_REASON} AS reason FROM lineitem")
def reject_reason_cascade(spark, d):
    rules = (("too_few", F.col("l_quantity") < 5), ("discounted", F.col("l_discount") > 0.08), ("returned", F.col("l_returnflag") == "R"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", facets.first_reason(*rules).alias("reason"))


@query("""SELECT signal, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN p_size > 40 THEN 'large' END, CASE WHEN p_retailprice > 1500 THEN 'dear' END,
 CASE WHEN p_brand LIKE '%1' THEN 'first' END], lambda x: x IS NOT NULL)) AS signal FROM part) GROUP BY signal""")
def signal_census(spark, d):
    signals = {"large": F.col("p_size") > 40, "dear": F.col("p_retailprice") > 1500, "first": F.col("p_brand").endswith("1")}
    return facets.signal_census(table(spark, d, "part"), signals)


@query("SELECT CASE WHEN p_size > 40 THEN 'large' WHEN p_retailprice > 1500 THEN 'dear' ELSE 'rest' END AS tier, count(*) AS n FROM part GROUP BY 1")
def tier_census(spark, d):
    return facets.tier_census(table(spark, d, "part"), [("large", F.col("p_size") > 40), ("dear", F.col("p_retailprice") > 1500)], "rest")


@query("""SELECT count(*) AS orders, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 100000) AS large,
 count(DISTINCT o_custkey) AS customers FROM orders""")
def conditional_counts(spark, d):
    return table(spark, d, "orders").agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
        F.count_if(F.col("o_totalprice") > 100000).alias("large"), F.count_distinct("o_custkey").alias("customers"),
    )


@query("""SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def latest_per_key(spark, d):
    return A.latest(table(spark, d, "events").select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id")


@query("""SELECT l_orderkey, list(DISTINCT l_suppkey ORDER BY l_suppkey) AS l_suppkey, min(l_linestatus) AS l_linestatus,
 count(DISTINCT l_linestatus) > 1 AS drift FROM lineitem GROUP BY l_orderkey""")
def group_collapse(spark, d):
    return A.collapse(table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_linestatus"), ["l_orderkey"], "l_suppkey", ["l_linestatus"])


@query("""SELECT c_nationkey, count(DISTINCT c_mktsegment) AS variants, list(DISTINCT c_mktsegment ORDER BY c_mktsegment) AS seen
 FROM customer GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) > 1""")
def variant_conflict(spark, d):
    return A.conflicts(table(spark, d, "customer"), "c_nationkey", "c_mktsegment")


@query("SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, d):
    return A.duplicates(table(spark, d, "part"), "p_name", "p_brand")


@query("SELECT label::VARCHAR AS value, count(*) AS n FROM embeddings GROUP BY label")
def histogram_map(spark, d):
    return A.histogram(table(spark, d, "embeddings"), "label")


@query(r"""WITH t AS (SELECT doc_id % 50 AS k, doc_id % 2 AS side, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents),
 c AS (SELECT k, w, count(*) FILTER (side = 0) AS a, count(*) FILTER (side = 1) AS b FROM t GROUP BY k, w)
 SELECT k, sum(least(a, b))::BIGINT AS shared, sum(a)::BIGINT AS left_size, sum(b)::BIGINT AS right_size FROM c GROUP BY k""")
def multiset_overlap(spark, d):
    words = table(spark, d, "documents").select(
        (F.col("doc_id") % 50).alias("k"), (F.col("doc_id") % 2).alias("side"),
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1)).alias("w"),
    )
    return A.multiset_overlap(words.where("side = 0"), words.where("side = 1"), ["k"], "w")


@query("""SELECT l_returnflag, l_linestatus, count(*) AS records, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup_formats(spark, d):
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("records"), F.count_distinct("l_suppkey").alias("suppliers"))


@query("""SELECT count(*) AS works, count(DISTINCT c_nationkey) AS composers, count(*) FILTER (n > 1) AS multi, sum(n)::BIGINT AS memberships
 FROM (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL)""")
def global_summary(spark, d):
    orders = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, d, "customer").select("c_custkey", "c_nationkey").join(orders, "c_custkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return rows.agg(
        F.count(F.lit(1)).alias("works"), F.count_distinct("c_nationkey").alias("composers"), F.count_if(F.col("n") > 1).alias("multi"), F.sum("n").alias("memberships")
    )


@query("""SELECT o_custkey, CASE WHEN bool_or(o_orderstatus = 'P') THEN 'P' WHEN bool_or(o_orderstatus = 'O') THEN 'O' ELSE 'F' END AS status FROM orders GROUP BY o_custkey""")
def worst_status(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(A.worst(F.col("o_orderstatus"), ["P", "O", "F"]).alias("status"))


@query("""SELECT p_name, max(greatest(p_size, 0)) AS weight FROM part GROUP BY p_name""")
def max_weight_merge(spark, d):
    return table(spark, d, "part").groupBy("p_name").agg(F.max(F.greatest("p_size", F.lit(0))).alias("weight"))


@query("""SELECT sha256(text) AS digest, (count(DISTINCT doc_id) - 1) * max(n_chars) AS reclaimable FROM documents GROUP BY 1""")
def reclaimable_bytes(spark, d):
    docs = table(spark, d, "documents").select(F.sha2("text", 256).alias("digest"), "n_chars", "doc_id")
    return A.reclaimable(docs, ["digest"], "n_chars", "doc_id")


@query("""SELECT source, min(n_chars) AS low, max(n_chars) AS high, sum(n_chars)::BIGINT AS total, max(n_chars) - min(n_chars) AS span FROM documents GROUP BY source""")
def series_range(spark, d):
    n = F.col("n_chars")
    return table(spark, d, "documents").groupBy("source").agg(F.min(n).alias("low"), F.max(n).alias("high"), F.sum(n).alias("total"), (F.max(n) - F.min(n)).alias("span"))


@query("""SELECT o_custkey, list(DISTINCT o_orderkey ORDER BY o_orderkey) AS works FROM orders GROUP BY o_custkey""")
def key_to_set(spark, d):
    """A key's set is one array: for keys that bound it, such as a file's works. Others stay rows."""
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderkey")).alias("works"))


@query(r"""SELECT lang, count(*) FILTER (regexp_matches(text, '[àâçéèêëîïôûùü]')) AS accented, count(*) FILTER (NOT regexp_matches(text, '[àâçéèêëîïôûùü]')) AS plain FROM documents GROUP BY lang""")
def script_coverage(spark, d):
    has = F.col("text").rlike("[àâçéèêëîïôûùü]")
    return table(spark, d, "documents").groupBy("lang").agg(F.count_if(has).alias("accented"), F.count_if(~has).alias("plain"))


@query("""SELECT user_id, list(DISTINCT CASE WHEN value < 0 THEN 'negative' WHEN event_type = 'error' THEN 'error' ELSE 'none' END
 ORDER BY CASE WHEN value < 0 THEN 'negative' WHEN event_type = 'error' THEN 'error' ELSE 'none' END) AS blockers FROM events GROUP BY user_id""")
def blocker_rollup(spark, d):
    why = F.when(F.col("value") < 0, "negative").when(F.col("event_type") == "error", "error").otherwise("none")
    return table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set(why)).alias("blockers"))
