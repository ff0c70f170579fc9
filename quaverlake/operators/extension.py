"""Extension points: rules that are data, readers by name, and table functions for use in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def rule_hits(df: DataFrame, key: str, fields: list[str], rules: DataFrame) -> DataFrame:
    """(key, field, rule) where a field's text fits a rule (rule, field, pattern); a rule without a field holds for all.

    Rules are rows, so a new one needs no code: the pattern is a column of the join.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields))).alias("t")
    texts = df.select(key, pairs).select(key, "t.*")
    every = F.explode(F.array(*map(F.lit, fields)))
    named = rules.where("field is not null").unionByName(rules.where("field is null").drop("field").withColumn("field", every))
    return texts.join(named, "field").where(F.expr("text rlike pattern")).select(key, "field", "rule")


class Adapters:
    """Readers of sources by the name that a source's registry row gives."""

    def __init__(self):
        self._readers: dict[str, Callable[[SparkSession, dict], DataFrame]] = {}

    def add(self, name: str):
        def register(reader):
            if name in self._readers:
                raise ValueError(f"two adapters {name}")
            self._readers[name] = reader
            return reader

        return register

    def read(self, spark: SparkSession, sources: list[dict]) -> DataFrame:
        """The rows of all sources with the source's id; an adapter that isn't known fails before anything is read."""
        missing = sorted({s["adapter"] for s in sources} - set(self._readers))
        if missing or not sources:
            raise ValueError(f"no adapters {missing}" if missing else "no sources")
        out = None
        for source in sources:
            rows = self._readers[source["adapter"]](spark, source).withColumn("source_id", F.lit(source["id"]))
            out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
        return out


def register_table_functions(spark: SparkSession) -> None:
    """Registers ``wikitext_files(text)`` and ``html_parts(text)`` for LATERAL joins in SQL."""
    from pyspark.sql.functions import udtf

    from ..sources import markup

    class Files:
        def eval(self, text: str):
            for place, (headings, chunk) in enumerate(markup.file_chunks(text or "")):
                yield place, "/".join(headings), chunk

    class Parts:
        def eval(self, text: str):
            for place, (heading, part) in enumerate(markup.sections(text or "")):
                yield place, heading, part

    spark.udtf.register("wikitext_files", udtf(Files, returnType="place int, headings string, chunk string"))
    spark.udtf.register("html_parts", udtf(Parts, returnType="place int, heading string, part string"))
