"""Scans with explicit schemas; bad input fails, nothing is inferred."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document a file (or an array of them)."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def manifest(spark: SparkSession, path: str, item: str, model_type: str, version: int) -> DataFrame:
    """The items of manifests {model_type, schema_version, items}; another type or version fails."""
    schema = f"model_type string, schema_version int, items array<{item}>"
    rows = json_documents(spark, path, schema)
    ok = F.col("model_type").eqNullSafe(model_type) & F.col("schema_version").eqNullSafe(version)
    checked = F.when(ok, F.col("items")).otherwise(
        F.raise_error(F.concat(F.lit("unexpected manifest "), F.coalesce("model_type", F.lit("?")), F.lit(" in "), F.input_file_name()))
    )
    return rows.select(F.explode(checked).alias("item")).select("item.*")


def csv_strict(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV of strings with a header that has the columns; other arity or a missing column fails.

    Further columns are allowed and dropped; a byte order mark is not part of the first name.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.where("block = 0").withColumn("n", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "n").alias("header"))
    heads = first.select(F.regexp_replace("header", "^\ufeff", "").alias("header")).distinct().limit(2).collect()
    if not heads:
        raise ValueError(f"no header in {path}")
    if len(heads) > 1:
        raise ValueError(f"files of {path} have different headers: {[r.header for r in heads]}")
    header = next(csv.reader([heads[0].header]))
    header = [c.strip() for c in header]
    missing = [c for c in columns if c not in header]
    if missing or len(set(header)) != len(header):
        raise ValueError(f"header of {path} lacks {missing}" if missing else f"header of {path} repeats a name")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("multiLine", True).option("enforceSchema", True)
    return rows.csv(path).select(*columns)


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Sources (id, name, homepage, allowed_hosts); ids must be unique slugs, with hosts."""
    rows = json_documents(spark, path, "id string, name string, homepage string, allowed_hosts array<string>")
    bad = rows.where(~F.coalesce(F.col("id").rlike("^[a-z0-9_-]+$"), F.lit(False)) | (F.coalesce(F.size("allowed_hosts"), F.lit(0)) < 1))
    twice = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    broken = bad.select("id").union(twice.select("id")).limit(5).collect()  # a few for the message
    if broken:
        raise ValueError(f"broken sources: {[r.id for r in broken]}")
    return rows


def by_category(spark: SparkSession, paths: dict[str, str], schema: str) -> DataFrame:
    """JSON lists of several files, in one scan, with the name under which each is listed."""
    files = {path.rstrip("/").rsplit("/", 1)[-1]: name for name, path in paths.items()}
    if len(files) < len(paths):
        raise ValueError("two categories in files of one name")
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(list(paths.values()))
    names = F.create_map(*(F.lit(x) for pair in files.items() for x in pair))
    return rows.withColumn("category", names[F.element_at(F.split(F.input_file_name(), "/"), -1)])
