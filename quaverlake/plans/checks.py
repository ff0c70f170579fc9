"""Queries on data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as C
from .registry import query, table


@query("""SELECT 'nation_region' AS rule, n_nationkey::VARCHAR AS key FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)
 UNION ALL SELECT 'part_unique', p_partkey::VARCHAR FROM part GROUP BY p_partkey HAVING count(*) > 1
 UNION ALL SELECT 'quality_flag', doc_id::VARCHAR FROM labels WHERE quality NOT IN (0, 1)
 UNION ALL SELECT 'order_customer', o_orderkey::VARCHAR FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
 UNION ALL SELECT 'debt', c_custkey::VARCHAR FROM customer WHERE c_acctbal < 0""")
def violations(spark, d):
    t = lambda n: table(spark, d, n)
    return C.violations(
        C.references(t("nation"), "nation_region", "n_nationkey", "n_regionkey", t("region"), "r_regionkey"),
        C.unique(t("part"), "part_unique", "p_partkey"),
        C.rule(t("labels"), "quality_flag", "doc_id", ~F.col("quality").isin(0, 1)),
        C.references(t("orders"), "order_customer", "o_orderkey", "o_custkey", t("customer"), "c_custkey"),
        C.rule(t("customer"), "debt", "c_custkey", F.col("c_acctbal") < 0),
    )


_RULES = {"marks": ("error", r"[%$#]{3}"), "shouting": ("review", r"!!"), "bars": ("info", r" \| ")}
_FIELD = """SELECT doc_id, '{f}' AS field, r.rule, r.severity FROM documents, (VALUES ('marks', 'error', '[%$#]{{3}}'), ('shouting', 'review', '!!'), ('bars', 'info', ' \\| ')) r(rule, severity, p) WHERE regexp_matches({f}, r.p)"""


@query(" UNION ALL ".join(_FIELD.format(f=f) for f in ("text", "source")))
def text_defects(spark, d):
    return C.findings(table(spark, d, "documents").select("doc_id", "text", "source"), "doc_id", ["text", "source"], _RULES)


@query("SELECT severity, rule, count(*) AS n, severity = 'error' AS blocks FROM (" + _FIELD.format(f="text") + ") GROUP BY severity, rule")
def defect_readiness(spark, d):
    return C.readiness(C.findings(table(spark, d, "documents").select("doc_id", "text"), "doc_id", ["text"], _RULES))


_PRINTS = """c AS (SELECT source, doc_id // 1000 AS part, count(*) AS n, md5(string_agg(sha256(text), '' ORDER BY doc_id)) AS f FROM documents GROUP BY ALL),
 f AS (SELECT source, sum(n)::BIGINT AS rows, md5(string_agg(f, '' ORDER BY part)) AS fingerprint FROM c GROUP BY source)"""


@query(f"WITH {_PRINTS} SELECT * FROM f")
def input_fingerprint(spark, d):
    return C.fingerprints(table(spark, d, "documents"), "source", "doc_id", F.sha2("text", 256))


@query(f"""WITH {_PRINTS} SELECT source, CASE WHEN source LIKE '%1' THEN 'changed' WHEN source = 'src0' THEN 'new' ELSE 'unchanged' END AS state FROM f""")
def stale_fingerprints(spark, d):
    now = C.fingerprints(table(spark, d, "documents"), "source", "doc_id", F.sha2("text", 256))
    stored = now.where("source <> 'src0'").withColumn("fingerprint", F.when(F.col("source").endswith("1"), "x").otherwise(F.col("fingerprint")))
    return C.compared_fingerprints(now, stored, "source")
