"""Queries on plans of acquisitions and on the extension points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import acquisition as A
from ..operators import extension as X
from .registry import query, table


def _log(spark, d):
    e = table(spark, d, "events")
    status = F.create_map(*(F.lit(x) for x in ("signup", "verified", "error", "network_error", "view", "membership_wait_pending", "click", "manual_review", "purchase", "deleted")))[F.col("event_type")]
    return e.select((F.col("user_id") * 40 + F.col("event_id") % 40).alias("file"), F.col("event_id").alias("number"), status.alias("status"), F.when(F.col("event_type") == "view", F.col("ts")).alias("retry_after"), "props", "value", "user_id")


@query("""WITH l AS (SELECT user_id * 40 + event_id % 40 AS file, event_id, event_type, ts FROM events), s AS (SELECT file, count(*) AS attempts, arg_max(event_type, event_id) AS t, arg_max(ts, event_id) AS due FROM l GROUP BY 1),
 w AS (SELECT DISTINCT file FROM l UNION SELECT p_partkey * 40 + 39 FROM part)
 SELECT file, coalesce(attempts, 0) AS attempts, CASE WHEN t IN ('signup', 'purchase') THEN 'done' WHEN t IS NULL THEN 'start' WHEN t = 'click' THEN 'review' WHEN attempts >= 3 THEN 'give_up' WHEN t = 'view' AND due > TIMESTAMP '2024-01-15' THEN 'wait' ELSE 'retry' END AS action
 FROM w LEFT JOIN s USING (file)""")
def next_attempts(spark, d):
    log = _log(spark, d)
    wanted = log.select("file").union(table(spark, d, "part").select(F.col("p_partkey") * 40 + 39))
    return A.next_actions(wanted, log, "file", F.lit("2024-01-15").cast("timestamp"))


@query("""SELECT file, attempts, CASE WHEN t IN ('signup', 'purchase') THEN 'done' ELSE 'stop' END AS action FROM (SELECT user_id * 40 + event_id % 40 AS file, count(*) AS attempts, arg_max(event_type, event_id) AS t FROM events GROUP BY 1)""")
def stopped_batch(spark, d):
    """One attempt that a human has to confirm stops all that isn't done."""
    log = _log(spark, d)
    status = F.when((F.col("status") == "manual_review") & (F.col("user_id") == 1), "human_verification_required").otherwise(F.col("status"))
    return A.next_actions(log, log.withColumn("status", status), "file", F.lit("2024-01-15").cast("timestamp"))


@query("""SELECT c_custkey, (row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1) // 20 AS batch FROM customer""")
def translation_batches(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return A.batches(rows, [F.col("c_mktsegment"), F.col("c_custkey")], 20).select("c_custkey", "batch")


@query("""WITH l AS (SELECT user_id * 40 + event_id % 40 AS file, user_id % 3 AS format, arg_max(event_type, event_id) AS t, arg_max(props, event_id) AS p, arg_max(user_id, event_id) AS s FROM events GROUP BY ALL)
 SELECT format, count(*) AS files, count(*) FILTER (t = 'signup') AS verified, count(DISTINCT p) FILTER (t = 'signup') AS contents, coalesce(sum(s) FILTER (t = 'signup'), 0)::BIGINT AS bytes FROM l GROUP BY 1""")
def asset_receipts(spark, d):
    log = _log(spark, d).select("file", (F.col("user_id") % 3).alias("format"), "number", "status", F.md5("props").alias("sha256"), F.col("user_id").alias("size"))
    return A.receipts(log, "file", "format")


@query("""WITH m AS (SELECT s_suppkey AS member, s_nationkey AS digest FROM supplier), w AS (SELECT DISTINCT l_suppkey + (l_partkey % 2) * 1000 AS member, l_linenumber AS digest FROM lineitem)
 SELECT w.member, w.digest, CASE WHEN m.digest IS NULL THEN 'missing' WHEN m.digest = w.digest THEN 'extract' ELSE 'differs' END AS step FROM w LEFT JOIN m USING (member)""")
def member_extraction(spark, d):
    members = table(spark, d, "supplier").select(F.col("s_suppkey").alias("member"), F.col("s_nationkey").cast("long").alias("digest"))
    wanted = table(spark, d, "lineitem").select((F.col("l_suppkey") + F.col("l_partkey") % 2 * 1000).alias("member"), F.col("l_linenumber").cast("long").alias("digest")).distinct()
    return A.extraction_plan(wanted, members, "member", "digest")


@query("""SELECT p_partkey, 'p_name' AS field, 'small' AS rule FROM part WHERE p_name LIKE 'small%' UNION ALL SELECT p_partkey, 'p_name', 'ends_g' FROM part WHERE p_name LIKE '%g' UNION ALL SELECT p_partkey, 'p_type', 'ends_g' FROM part WHERE p_type LIKE '%g'
 UNION ALL SELECT p_partkey, 'p_type', 'eco' FROM part WHERE p_type LIKE 'ECO%'""")
def declared_rules(spark, d):
    rules = spark.createDataFrame([("small", "p_name", "^small"), ("ends_g", None, "g$"), ("eco", "p_type", "^ECO")], "rule string, field string, pattern string")
    return X.rule_hits(table(spark, d, "part"), "p_partkey", ["p_name", "p_type"], rules)


@query("""SELECT c_custkey AS id, c_name AS name, 'c' AS source_id, NULL AS nation FROM customer UNION ALL SELECT s_suppkey, s_name, 's', s_nationkey FROM supplier""")
def adapter_sources(spark, d):
    adapters = X.Adapters()

    @adapters.add("customers")
    def customers(spark, source):
        return table(spark, source["path"], "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))

    @adapters.add("suppliers")
    def suppliers(spark, source):
        return table(spark, source["path"], "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))

    return adapters.read(spark, [{"id": "c", "adapter": "customers", "path": d}, {"id": "s", "adapter": "suppliers", "path": d}])


@query("""SELECT p_partkey, 0 AS place, p_type AS headings, 'File|' || p_name AS chunk FROM part UNION ALL SELECT p_partkey, 1, p_type, 'File|x' FROM part WHERE p_partkey % 2 = 0""")
def table_functions(spark, d):
    X.register_table_functions(spark)
    text = F.concat(F.lit("=="), "p_type", F.lit("==\n{{File|"), "p_name", F.lit("}}\n"), F.when(F.col("p_partkey") % 2 == 0, "{{File|x}}").otherwise(""))
    table(spark, d, "part").select("p_partkey", text.alias("text")).createOrReplaceTempView("_wikitext")
    return spark.sql("SELECT p_partkey, f.* FROM _wikitext, LATERAL wikitext_files(text) f")
