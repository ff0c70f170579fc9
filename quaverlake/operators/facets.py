"""Facet predicates, reject cascades and censuses."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The name of the first rule that holds, else null; a null condition doesn't hold."""
    return F.coalesce(*(F.when(cond, F.lit(name)) for name, cond in rules))


def kept(df: DataFrame, *rules: tuple[str, Column]) -> DataFrame:
    return df.where(first_reason(*rules).isNull())


def issues(*rules: tuple[str, Column]) -> Column:
    """All names of rules that hold, in order."""
    return F.array_compact(F.array(*(F.when(cond, F.lit(name)) for name, cond in rules)))


def effective_kind(category_kind: Column, declared: Column) -> Column:
    """A category's kind; an unspecified one gives way to the record's own."""
    return F.when((category_kind == "unspecified") & (declared != "unspecified"), declared).otherwise(category_kind)


def same_membership(works: DataFrame, bridge: DataFrame, key: str, *facets: Column) -> DataFrame:
    """Works of which one single membership satisfies all facets.

    The facets filter the bridge's rows; the semi join keeps each work once.
    """
    return works.join(bridge.where(reduce(lambda a, b: a & b, facets)), key, "left_semi")


def signal_census(df: DataFrame, signals: dict[str, Column]) -> DataFrame:
    """Rows per signal; a row may have several."""
    return (
        df.select(F.explode(issues(*signals.items())).alias("signal")).groupBy("signal").agg(F.count(F.lit(1)).alias("n"))
    )


def tier_census(df: DataFrame, tiers: list[tuple[str, Column]], other: str) -> DataFrame:
    """Rows per tier: the first that holds, so the counts add up to the rows."""
    return df.groupBy(F.coalesce(first_reason(*tiers), F.lit(other)).alias("tier")).agg(F.count(F.lit(1)).alias("n"))


def topic_counts(df: DataFrame, topic: str, source: str, vocabulary: DataFrame | None = None) -> DataFrame:
    """Works and distinct sources by topic; topics of the vocabulary without works have zeros."""
    counts = df.groupBy(topic).agg(F.count(F.lit(1)).alias("work_count"), F.count_distinct(source).alias("source_count"))
    if vocabulary is None:
        return counts
    out = vocabulary.join(counts, topic, "left")
    return out.select(*vocabulary.columns, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("work_count", "source_count")))


def robots_allows(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Per url path the verdict of its longest matching rule; allow wins ties, no rule allows.

    rules: (prefix, allow); urls: (url, path). A path is cut to the lengths that rules
    have and no others, so the join is an equi join and its rows are few.
    """
    lengths = sorted(r.n for r in rules.select(F.length("prefix").alias("n")).distinct().collect())  # no more than the longest rule's length
    best = urls.select("url", F.lit(None).cast("boolean").alias("allow")).where("false")
    if lengths:
        cuts = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("path"))
        prefixes = urls.select("url", "path", F.explode(cuts).alias("n")).select("url", F.expr("substring(path, 1, n)").alias("prefix"))
        matched = prefixes.join(rules, "prefix").groupBy("url").agg(F.max(F.struct(F.length("prefix").alias("n"), "allow")).alias("m"))
        best = matched.select("url", "m.allow")
    return urls.select("url").distinct().join(best, "url", "left").select("url", F.coalesce("allow", F.lit(True)).alias("allowed"))


def robots_rules(files: DataFrame, agent: str) -> DataFrame:
    """(host, pattern, length, allow): the rules that robots files (host, body) have for an agent.

    Groups that name the agent, the longest name first, go before those for all (*). A
    line of agents after a rule begins a new group; comments and empty rules don't count.
    """
    lines = files.select("host", F.posexplode(F.split("body", r"\r\n?|\n")).alias("n", "line"))
    lines = lines.withColumn("line", F.trim(F.substring_index("line", "#", 1))).where(F.contains("line", F.lit(":")))
    key, value = F.lower(F.trim(F.substring_index("line", ":", 1))), F.trim(F.substr("line", F.instr("line", ":") + 1))
    lines = lines.select("host", "n", key.alias("key"), value.alias("value")).where("key in ('user-agent', 'allow', 'disallow')")
    order = W.partitionBy("host").orderBy("n")
    opens = (F.col("key") == "user-agent") & (F.coalesce(F.lag("key").over(order), F.lit("allow")) != "user-agent")
    lines = lines.withColumn("group", F.sum(opens.cast("int")).over(order)).where("group > 0")
    name = F.lower("value")
    fits = (name == "*") | ((name != "") & F.contains(F.lit(agent.lower()), name))
    weight = F.when(name == "*", 0).otherwise(F.length("value"))
    groups = lines.where("key = 'user-agent'").where(fits).groupBy("host", "group").agg(F.max(weight).alias("weight"))
    groups = groups.withColumn("most", F.max("weight").over(W.partitionBy("host"))).where("weight = most").select("host", "group")
    rules = lines.where("key <> 'user-agent' and value <> ''").join(groups, ["host", "group"])
    anchored = F.col("value").endswith("$")
    quoted = F.concat(F.lit("^\\Q"), F.replace(F.when(anchored, F.regexp_replace("value", r"\$$", "")).otherwise(F.col("value")), F.lit("*"), F.lit("\\E.*\\Q")), F.lit("\\E"))
    pattern = F.when(anchored, F.concat(quoted, F.lit("$"))).otherwise(quoted)
    length = F.length(F.regexp_replace("value", r"\*|\$+$", ""))
    return rules.select("host", pattern.alias("pattern"), length.alias("length"), (F.col("key") == "allow").alias("allow"))


def robots_verdicts(files: DataFrame, urls: DataFrame, agent: str) -> DataFrame:
    """(url, allowed) of urls (url, host, target): the longest rule of the host that fits decides, allow wins ties, none allows."""
    hits = urls.join(robots_rules(files, agent), "host").where(F.expr("target rlike pattern"))
    best = hits.groupBy("url").agg(F.max(F.struct("length", "allow")).alias("m")).select("url", "m.allow")
    return urls.select("url").distinct().join(best, "url", "left").select("url", F.coalesce("allow", F.lit(True)).alias("allowed"))
