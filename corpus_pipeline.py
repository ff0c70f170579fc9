"""A corpus from raw documents: classified, deduplicated, decontaminated, mixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quaverlake.llm import common, decontaminate, exact_dedup, mixing, ngram_join, quality

#: Each stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality", quality.keep_good),
    ("exact_dedup", exact_dedup.keep_distinct),
    ("near_dedup", ngram_join.keep_one),
    ("decontaminate", decontaminate.keep_clean),
    ("mix", mixing.mixed),
]

#: SQL can't express the classifier and the mix; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed corpus: columns of documents, with size, source_size, target and taken."""
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
