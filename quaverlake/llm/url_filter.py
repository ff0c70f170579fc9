"""URL filter: path rules first, then empirical-Bayes reputation of the host.

Each labelled page is a Bernoulli outcome (bad or not). Beta-binomial priors shrink
the rate of a host towards that of its registered domain, that towards its suffix's,
and that towards the overall rate. The strength of each prior is estimated from the
data: the share of same-outcome pairs within the groups of a level gives the
intra-class correlation rho, and (1 - rho) / rho is the prior's number of pages.
A host is blocked when the lower bound of its posterior bad rate is above a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: (host with path, verdict); the longest that fits wins.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Limits of an estimated prior's strength, in pages.
K_MIN, K_MAX = 1.0, 10000.0


#: Suffixes of two labels under which domains are registered; every other last label is a suffix.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "org.br", "com.cn", "net.cn", "org.cn",
    "ac.jp", "co.jp", "ne.jp", "or.jp", "co.kr", "or.kr", "co.in", "org.in", "co.nz", "org.nz", "co.za", "org.za",
    "com.mx", "com.ar", "com.tr", "com.tw", "com.hk", "com.sg", "co.il", "com.pl",
)


def host_levels(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without user and port; an address is its own domain and suffix."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    address = bare.rlike(r"^[0-9]+(\.[0-9]+){3}$") | bare.startswith("[")
    two = F.regexp_extract(bare, r"[^.]+\.[^.]+$", 0).isin(*suffixes)
    domain = F.when(two, F.regexp_extract(bare, r"([^.]*\.)?[^.]+\.[^.]+$", 0)).otherwise(F.regexp_extract(bare, r"([^.]*\.)?[^.]*$", 0))
    suffix = F.when(two, F.regexp_extract(bare, r"[^.]+\.[^.]+$", 0)).otherwise(F.regexp_extract(bare, r"[^.]*$", 0))
    return F.when(address, bare).otherwise(domain), F.when(address, bare).otherwise(suffix)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty where the url is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, common.UPPER, common.LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, slash, tail = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + tail)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def _strength(bad_pairs: float, pairs: float, p: float) -> float:
    """A prior's pages from the ordered pairs of pages within the groups of a level, and of bad pages."""
    if pairs <= 0 or not 0 < p < 1:
        return K_MAX
    rho = (bad_pairs / pairs - p * p) / (p * (1.0 - p))
    return K_MAX if rho <= 0 else min(max((1.0 - rho) / rho, K_MIN), K_MAX)


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of each host's bad rate from rows (host, bad); a null ``bad`` is unlabelled.

    Returns host, n, n_bad, rate (posterior mean) and low (its lower bound). Hosts with
    unlabelled pages only take their domain's prior.
    """
    counts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("b")
    )
    domain, suffix = host_levels(F.col("host"))
    counts = counts.withColumn("domain", domain).withColumn("suffix", suffix)
    counts = common.stage(counts, "hosts")

    def level(keys: list[str], tag: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("n").alias(f"n_{tag}"), F.sum("b").alias(f"b_{tag}"))

    domains, suffixes = level(["suffix", "domain"], "d"), level(["suffix"], "s")
    # One row of sums; they become literals, so nothing is joined for them.
    n, b = counts.agg(F.sum("n"), F.sum("b")).first()
    n, b = float(n or 0), float(b or 0)
    p = b / n if n else 0.0
    k = {}
    for tag, df, x, y in (("h", counts, "n", "b"), ("d", domains, "n_d", "b_d"), ("s", suffixes, "n_s", "b_s")):
        x, y = F.col(x).cast("double"), F.col(y).cast("double")
        pairs, bad = df.agg(F.sum(x * (x - 1)), F.sum(y * (y - 1))).first()
        k[tag] = F.lit(_strength(bad or 0.0, pairs or 0.0, p))
    p_all = F.lit((b + 1.0) / (n + 2.0))
    out = counts.join(domains, ["suffix", "domain"]).join(suffixes, "suffix")
    p_s = (F.col("b_s") + k["s"] * p_all) / (F.col("n_s") + k["s"])
    p_d = (F.col("b_d") + k["d"] * F.col("p_s")) / (F.col("n_d") + k["d"])
    out = out.withColumn("p_s", p_s).withColumn("p_d", p_d)
    out = out.withColumn("a", F.col("b") + k["h"] * F.col("p_d")).withColumn(
        "t", F.col("n") + k["h"]
    )
    mean = F.col("a") / F.col("t")
    sd = F.sqrt(mean * (F.lit(1.0) - mean) / (F.col("t") + F.lit(1.0)))
    return out.select(
        "host", "n", F.col("b").alias("n_bad"), mean.alias("rate"), (mean - F.lit(z) * sd).alias("low")
    )


def noisy(html: Column) -> Column:
    """The label of a page: bad (1) with five runs of symbols or more; null html is unlabelled."""
    return (F.regexp_count(html, F.lit(r"###|%%%|\$\$\$|\*\*\*|!!")) >= 5).cast("int")


def url_filter(pages: DataFrame, bad: Column, rules=RULES, max_bad: float = 0.05, z: float = 1.645) -> DataFrame:
    """Verdict of every page: page_id, host, path, rule, verdict, bad_rate, bad_rate_low.

    ``bad`` labels a page (1 bad, 0 good, null unlabelled). The longest fitting rule
    decides; without one, pages of a host whose lower posterior bound exceeds
    ``max_bad`` are blocked. A null url, or one without ``://``, has the empty host and
    path, and that host's reputation decides. Rows with equal page_id are judged each
    on its own; an empty table gives an empty result.
    """
    host, path = url_parts(F.col("url"))
    hosts = common.stage(host_reputation(pages.select(host.alias("host"), bad.alias("bad")), z), "reputation")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .join(hosts, "host")
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("low") > max_bad, "block").otherwise("allow")).alias("verdict"),
            F.col("rate").alias("bad_rate"),
            F.col("low").alias("bad_rate_low"),
        )
    )


def op5_url_filter(spark, sf_dir):
    pages = common.read(spark, sf_dir, "pages")
    return url_filter(pages, noisy(F.col("html"))).drop("bad_rate", "bad_rate_low")


def _k(tag: str) -> str:
    rho = f"((bad_pairs_{tag} / pairs_{tag} - p * p) / (p * (1.0 - p)))"
    return (
        f"CASE WHEN pairs_{tag} <= 0 OR p <= 0 OR p >= 1 THEN 10000.0 WHEN {rho} <= 0 THEN 10000.0 "
        f"ELSE least(greatest((1.0 - {rho}) / {rho}, 1.0), 10000.0) END AS k_{tag}"
    )


OP5_SQL = f"""
WITH u AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         (len(regexp_extract_all(html, '###|%%%|\\$\\$\\$|\\*\\*\\*|!!')) >= 5)::INT AS bad
  FROM pages
), q AS (
  SELECT page_id, bad,
         translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), g AS (
  SELECT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare,
         count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS b
  FROM q GROUP BY host
), h AS (
  SELECT host, n, b,
         CASE WHEN bare LIKE '[%' OR regexp_matches(bare, '^[0-9]+(\\.[0-9]+){{3}}$') THEN bare
              WHEN regexp_extract(bare, '[^.]+\\.[^.]+$') IN {SUFFIXES} THEN regexp_extract(bare, '([^.]*\\.)?[^.]+\\.[^.]+$')
              ELSE regexp_extract(bare, '([^.]*\\.)?[^.]*$') END AS domain,
         CASE WHEN bare LIKE '[%' OR regexp_matches(bare, '^[0-9]+(\\.[0-9]+){{3}}$') THEN bare
              WHEN regexp_extract(bare, '[^.]+\\.[^.]+$') IN {SUFFIXES} THEN regexp_extract(bare, '[^.]+\\.[^.]+$')
              ELSE regexp_extract(bare, '[^.]*$') END AS suffix
  FROM g
), d AS (SELECT suffix, domain, sum(n) AS n_d, sum(b) AS b_d FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n_s, sum(b) AS b_s FROM h GROUP BY ALL),
t AS (
  SELECT *, CASE WHEN n_all > 0 THEN b_all / n_all ELSE 0.0 END AS p
  FROM (SELECT sum(n) AS n_all, sum(b) AS b_all, sum(n * (n - 1)) AS pairs_h, sum(b * (b - 1)) AS bad_pairs_h FROM h),
       (SELECT sum(n_d * (n_d - 1)) AS pairs_d, sum(b_d * (b_d - 1)) AS bad_pairs_d FROM d),
       (SELECT sum(n_s * (n_s - 1)) AS pairs_s, sum(b_s * (b_s - 1)) AS bad_pairs_s FROM s)
), k AS (SELECT (b_all + 1.0) / (n_all + 2.0) AS p_all, {_k("h")}, {_k("d")}, {_k("s")} FROM t),
r AS (
  SELECT host, a / tt AS m, tt FROM (
    SELECT host, b + k_h * ((b_d + k_d * ((b_s + k_s * p_all) / (n_s + k_s))) / (n_d + k_d)) AS a, n + k_h AS tt
    FROM h JOIN d USING (suffix, domain) JOIN s USING (suffix), k)
), j AS (
  SELECT q.*, CASE WHEN m - 1.645 * sqrt(m * (1.0 - m) / (tt + 1.0)) > 0.05 THEN 'block' ELSE 'allow' END AS said,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM q JOIN r USING (host)
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' ELSE said END AS verdict
FROM j
"""
