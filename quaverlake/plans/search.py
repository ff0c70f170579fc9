"""Search queries over documents, taken as records: source is the composer, the first line the title, the rest metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import search as S
from .registry import query, table

_QUERY = "the and"


def _norm(c):
    return F.trim(F.regexp_replace(F.lower(c), r"[^a-z0-9]+", " "))


def index(spark, d, query):
    """Documents as search lines. Rows that lack a term altogether are left at the scan, before anything is normalised."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "text")
    raw = F.lower(F.concat_ws(" ", "source", "text"))
    for term in query.split():
        docs = docs.where(F.contains(raw, F.lit(term)))
    first = F.substring_index("text", "\n", 1)
    fields = {"composer": F.col("source"), "title": first, "metadata": F.substr("text", F.length(first) + 1)}
    return docs.select("id", *(S.lines(F.array(_norm(c))).alias(f) for f, c in fields.items()))


_INDEX = r"""i AS (SELECT doc_id AS id, trim(regexp_replace(lower(source), '[^a-z0-9]+', ' ', 'g')) AS composer,
 trim(regexp_replace(lower(split_part(text, chr(10), 1)), '[^a-z0-9]+', ' ', 'g')) AS title,
 trim(regexp_replace(lower(substr(text, length(split_part(text, chr(10), 1)) + 1)), '[^a-z0-9]+', ' ', 'g')) AS metadata FROM documents)"""


def _cost(term):
    one = lambda f, c: (
        f"CASE WHEN {f} = '{term}' THEN {c[0]} WHEN list_contains(string_split({f}, ' '), '{term}') THEN {c[1]} "
        f"WHEN contains(' ' || {f}, ' {term}') THEN {c[2]} WHEN contains({f}, '{term}') THEN {c[3]} END"
    )
    return f"least({', '.join(one(f, c) for f, c in S.COSTS.items())})"


@query(f"""WITH {_INDEX}, s AS (SELECT id, ({' + '.join(map(_cost, _QUERY.split()))})::DOUBLE
 - CASE WHEN composer = '{_QUERY}' THEN 0.75 WHEN title = '{_QUERY}' THEN 0.5 ELSE 0.0 END AS relevance FROM i)
 SELECT id, relevance FROM s WHERE relevance IS NOT NULL""")
def search_exact_ranked(spark, d):
    return S.exact(index(spark, d, _QUERY), _QUERY).select("id", "relevance")


def _words(c):
    """Lower case, digits apart from letters, one space between words."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), r"(?<=[a-z])(?=[0-9])|(?<=[0-9])(?=[a-z])", " "), r"[^a-z0-9]+", " "))


def catalog(spark, d):
    """(works, bridge, categories): parts as works of their brands, in the nations of their suppliers."""
    part = table(spark, d, "part")
    name = F.concat_ws(" ", "p_name", F.concat(F.lit("No."), F.col("p_size")))
    works = part.select(
        F.col("p_partkey").alias("id"), F.array(_words(name)).alias("title"), F.array(_words("p_brand")).alias("composer"), F.array(_words("p_type")).alias("metadata"),
        _words("p_brand").alias("composer_key"), (F.col("p_partkey") % 11 != 3).alias("attributed"), (F.col("p_partkey") % 4).alias("weight"),
        F.when(F.col("p_size") > 25, "original").otherwise("unspecified").alias("declared_kind"), F.lower("p_name").alias("sort_title"), F.col("p_brand").alias("sort_composer"),
    )
    supplier = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("category"))
    bridge = table(spark, d, "lineitem").select(F.col("l_partkey").alias("id"), "l_suppkey").join(supplier, "l_suppkey").select("id", "category").distinct()
    kind = F.when(F.col("n_nationkey") % 3 == 0, "original").when(F.col("n_nationkey") % 3 == 1, "arrangement").otherwise("unspecified")
    categories = table(spark, d, "nation").select(F.col("n_nationkey").alias("category"), _words("n_name").alias("name"), kind.alias("kind"), F.col("n_regionkey").alias("source"))
    return works, bridge, categories


_WORDS = r"trim(regexp_replace(regexp_replace(regexp_replace(lower({0}), '([a-z])([0-9])', '\1 \2', 'g'), '([0-9])([a-z])', '\1 \2', 'g'), '[^a-z0-9]+', ' ', 'g'))"
_CATALOG = f"""w AS (SELECT p_partkey AS id, {_WORDS.format("p_name || ' No.' || p_size")} AS title, {_WORDS.format('p_brand')} AS composer, {_WORDS.format('p_type')} AS type,
 p_partkey % 11 <> 3 AS attributed, p_partkey % 4 AS weight, CASE WHEN p_size > 25 THEN 'original' ELSE 'unspecified' END AS declared, lower(p_name) AS sort_title, p_brand AS sort_composer FROM part),
 c AS (SELECT n_nationkey AS category, {_WORDS.format('n_name')} AS name, CASE n_nationkey % 3 WHEN 0 THEN 'original' WHEN 1 THEN 'arrangement' ELSE 'unspecified' END AS kind, n_regionkey AS source FROM nation),
 m AS (SELECT DISTINCT l_partkey AS id, s_nationkey AS category FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
 e AS (SELECT m.id, category, name, source, CASE WHEN kind = 'unspecified' AND declared <> 'unspecified' THEN declared ELSE kind END AS kind FROM m JOIN c USING (category) JOIN w USING (id))"""


def _list_cost(term):
    def one(f, c):
        words = f"list_contains(flatten(list_transform({f}, lambda x: string_split(x, ' '))), '{term}')"
        rest = "" if term.isdigit() else f"WHEN len(list_filter({f}, lambda x: contains(' ' || x, ' {term}'))) > 0 THEN {c[2]} WHEN len(list_filter({f}, lambda x: contains(x, '{term}'))) > 0 THEN {c[3]}"
        return f"CASE WHEN list_contains({f}, '{term}') THEN {c[0]} WHEN {words} THEN {c[1]} {rest} END"

    return f"least({', '.join(one(f, c) for f, c in S.COSTS.items())})"


_ALIASES = [("brand 2", "zwei"), ("brand 17", "siebzehn"), ("brand 17", "dix sept")]


@query(f"""WITH {_CATALOG}, s AS (SELECT id, list(DISTINCT name) AS names FROM e WHERE source IN (1, 2) AND kind = 'original' GROUP BY id),
 a AS (SELECT w.*, CASE WHEN attributed THEN [w.composer] ELSE [] END AS own, CASE WHEN NOT attributed THEN [] WHEN w.composer = 'brand 2' THEN [w.composer, 'zwei']
 WHEN w.composer = 'brand 17' THEN [w.composer, 'siebzehn', 'dix sept'] ELSE [w.composer] END AS names2, list_concat([type], names) AS metadata FROM w JOIN s USING (id)),
 f AS (SELECT id, weight, sort_composer, sort_title, own, [title] AS title, names2 AS composer, metadata FROM a),
 r AS (SELECT *, ({' + '.join(map(_list_cost, ['no', '1', 'ring']))})::DOUBLE AS relevance FROM f WHERE len(list_filter(list_concat(title, composer, metadata), lambda x: contains(' ' || x || ' ', ' no 1 '))) > 0)
 SELECT id, relevance, 'exact' AS match_type, row_number() OVER (ORDER BY relevance, weight DESC, sort_composer, sort_title, id) AS place FROM r WHERE relevance IS NOT NULL
 ORDER BY relevance, weight DESC, sort_composer, sort_title, id LIMIT 18""")
def search_catalog_page(spark, d):
    return _searched(spark, d, "no 1 ring")


@query(f"""WITH {_CATALOG}, s AS (SELECT DISTINCT id FROM e WHERE source IN (1, 2) AND kind = 'original'),
 r AS (SELECT id, weight, sort_composer, sort_title, CASE WHEN title LIKE '%ring%' THEN 4 ELSE NULL END AS t, title FROM w JOIN s USING (id) WHERE composer = 'brand 17' AND attributed AND title LIKE '%ring%')
 SELECT id, (1 + CASE WHEN list_contains(string_split(title, ' '), 'ring') THEN 3 WHEN contains(' ' || title, ' ring') THEN 4 ELSE 7 END)::DOUBLE AS relevance, 'alias' AS match_type,
 row_number() OVER (ORDER BY relevance, weight DESC, sort_composer, sort_title, id) AS place FROM r QUALIFY place <= 18""")
def search_by_alias(spark, d):
    return _searched(spark, d, "sept ring")


def _searched(spark, d, text):
    works, bridge, categories = catalog(spark, d)
    members = S.eligible(bridge, works, categories, [F.col("source").isin(1, 2), F.col("kind") == "original"])
    names = spark.createDataFrame(_ALIASES, "composer_key string, alias string")
    nothing = spark.createDataFrame([], "id long, alias string")
    hits = S.exact(S.with_aliases(S.scoped(works, members, ["name"]), names, nothing), text)
    order = [F.col("relevance"), F.desc("weight"), F.col("sort_composer"), F.col("sort_title"), F.col("id")]
    return S.first_page(hits, order, 18).select("id", "relevance", "match_type", "place")


@query("""WITH v AS (SELECT DISTINCT p_partkey AS id, unnest(string_split(lower(p_name), ' ')) AS word FROM part),
 h AS (SELECT id, term, min(levenshtein(word, term)) AS cost FROM v, (VALUES ('widgt', 1), ('smal', 1)) t(term, k) WHERE levenshtein(word, term) <= 1 GROUP BY ALL)
 SELECT id, 'fuzzy' AS mode, sum(cost)::DOUBLE AS relevance FROM h GROUP BY id HAVING count(*) = 2 AND sum(cost) <= 2
 UNION ALL SELECT p_partkey, 'exact', 7.0 FROM part WHERE FALSE""")
def search_recovers_typos(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lower("p_name").alias("name"))
    rows = part.select("id", S.lines(F.array("name")).alias("title"), F.lit("\n").alias("composer"), F.lit("\n").alias("metadata"))
    words = part.select("id", F.explode(F.split("name", " ")).alias("word")).distinct()
    mode, hits = S.search(rows, words, "widgt smal", F.levenshtein)
    return hits.select("id", F.lit(mode).alias("mode"), "relevance")


def postings(spark, d):
    return table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), 1))).alias("word"))


@query("""WITH p AS (SELECT DISTINCT item_id AS id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM benchmark),
 t(term, k) AS (VALUES ('thatt', 1), ('tionn', 1)), h AS (SELECT id, term, min(levenshtein(word, term)) AS cost FROM p, t
 WHERE abs(length(word) - length(term)) <= k AND levenshtein(word, term) <= k GROUP BY ALL)
 SELECT id, sum(cost)::BIGINT AS cost FROM h GROUP BY id HAVING count(*) = 2 AND sum(cost) <= 2""")
def search_fuzzy_lev(spark, d):
    return S.fuzzy(postings(spark, d), "thatt tionn", F.levenshtein)


@query()
def search_fuzzy_osa(spark, d):
    return S.fuzzy(postings(spark, d), "htat tionh", X.osa_distance)


@query(f"""WITH {_CATALOG}, h AS (SELECT id, title, composer, type, sort_composer, sort_title, {" + ".join(f"CASE WHEN contains(composer, '{t}') OR contains(title, '{t}') OR contains(type, '{t}') THEN 0 ELSE 1 END" for t in ("brand", "econ"))} AS miss FROM w),
 mm AS (SELECT *, title || ' ' || composer || ' econ' AS query FROM h WHERE miss = 0), w6 AS (SELECT query, min(id) AS id, arg_min(sort_title, id) AS label FROM mm GROUP BY 1 ORDER BY 2 LIMIT 6)
 SELECT row_number() OVER (ORDER BY id) AS place, 'work' AS kind, label, query FROM w6""")
def topk_suggest(spark, d):
    return _suggested(spark, d, "brand econ")


@query(f"""WITH {_CATALOG}, mm AS (SELECT * FROM w WHERE composer LIKE '%brand 1%' AND list_contains(string_split(composer, ' '), '1') OR (list_contains(string_split(title, ' '), '1') AND contains(composer, 'brand'))),
 cc AS (SELECT composer AS query, min(id) AS id, arg_min(sort_composer, id) AS label FROM mm WHERE list_contains(string_split(composer, ' '), '1') GROUP BY 1 ORDER BY 2 LIMIT 3),
 v AS (SELECT title || ' ' || composer AS query, min(id) AS id, arg_min(sort_title, id) AS label FROM mm GROUP BY 1 ORDER BY 2 LIMIT 6),
 u AS (SELECT 0 AS part, id, 'composer' AS kind, label, query FROM cc UNION ALL SELECT 1, id, 'work', label, query FROM v)
 SELECT row_number() OVER (ORDER BY part, id) AS place, kind, label, query FROM u ORDER BY part, id LIMIT 6""")
def suggest_composers(spark, d):
    return _suggested(spark, d, "brand 1")


def _suggested(spark, d, text):
    works = catalog(spark, d)[0].withColumns({"canonical": F.concat_ws(" ", F.element_at("title", 1), F.element_at("composer", 1)), "work_label": F.col("sort_title"), "composer_label": F.col("sort_composer")})
    index = works.withColumns({c: S.lines(F.col(c)) for c in ("title", "composer", "metadata")})
    return S.suggest(S.exact(index, text), text, [F.col("id")])


@query("""SELECT c_mktsegment AS category, count(*) AS records, count(*) FILTER (c_acctbal >= 0) AS sound FROM customer WHERE c_nationkey < 10 GROUP BY 1""")
def category_browse(spark, d):
    rows = table(spark, d, "customer").where("c_nationkey < 10").groupBy(F.col("c_mktsegment").alias("category"))
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("c_acctbal") >= 0).alias("sound"))


@query(r"""WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents)
 SELECT doc_id FROM w WHERE w IN ('the', 'and', 'was') GROUP BY doc_id HAVING count(*) = 3""")
def posting_intersection(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.lower("text").alias("text"))
    terms = ["the", "and", "was"]
    for t in terms:  # documents without a term are left out before their words are taken apart
        docs = docs.where(F.contains("text", F.lit(t)))
    words = F.filter(F.array_distinct(F.regexp_extract_all("text", F.lit("([a-z]+)"), 1)), lambda w: w.isin(*terms))
    postings = docs.select(F.col("doc_id").alias("id"), F.explode(words).alias("word"))
    return S.all_postings(postings, terms).select(F.col("id").alias("doc_id"))


@query("""WITH n AS (SELECT c_nationkey AS category, count(*) FILTER (c_acctbal >= 0) AS members FROM customer GROUP BY 1)
 SELECT n_name AS name, coalesce(members, 0) AS work_count, CASE WHEN n_nationkey % 3 = 1 THEN 1 ELSE 0 END AS last, n_nationkey FROM nation LEFT JOIN n ON category = n_nationkey
 WHERE n_nationkey % 3 = 1 OR members > 20""")
def category_browse_kinds(spark, d):
    """Categories of a kind, or with members that declare it, with these members' number."""
    kinds = table(spark, d, "nation").withColumn("last", (F.col("n_nationkey") % 3 == 1).cast("int"))
    members = table(spark, d, "customer").where("c_acctbal >= 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("members"))
    out = kinds.join(members, "n_nationkey", "left").where("last = 1 or members > 20")
    return out.select(F.col("n_name").alias("name"), F.coalesce("members", F.lit(0)).alias("work_count"), "last", "n_nationkey")
