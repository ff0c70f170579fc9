"""Sinks: checked writes and replacement of whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import joins


def _files(spark, path: str):
    """(Hadoop's paths, file context) at ``path``."""
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs, jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        jvm.org.apache.hadoop.fs.Path(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )


def _pointer(path: str) -> str:
    return f"{path}/_current"


def replace_table(df: DataFrame, path: str) -> None:
    """Writes a new version of the table, then moves the pointer to it in one rename.

    ``read_table`` sees the old rows or the new ones, never none. The version before the
    last is deleted, so a reader that has just opened the old one can finish.
    """
    spark = df.sparkSession
    hadoop, files = _files(spark, path)
    before = current_version(spark, path)
    name = f"v{int(before[1:].split('-')[0]) + 1 if before else 1:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/_versions/{name}")
    lines = spark.createDataFrame([(name,)], "value string").coalesce(1)
    lines.write.mode("overwrite").text(f"{path}/_next-{name}")
    part = next(p for p in _listing(spark, f"{path}/_next-{name}") if p.startswith("part-"))
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    files.rename(hadoop.Path(f"{path}/_next-{name}/{part}"), hadoop.Path(_pointer(path)), overwrite)
    files.delete(hadoop.Path(f"{path}/_next-{name}"), True)
    for old in _listing(spark, f"{path}/_versions"):
        if old not in (name, before):
            files.delete(hadoop.Path(f"{path}/_versions/{old}"), True)


def _listing(spark, path: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().getName() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]


def current_version(spark, path: str) -> str | None:
    hadoop, files = _files(spark, path)
    pointer = hadoop.Path(_pointer(path))
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        return bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()


def read_table(spark, path: str) -> DataFrame:
    """The rows of the table's last whole version."""
    name = current_version(spark, path)
    if name is None:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path}/_versions/{name}")


def publish(df: DataFrame, violations: DataFrame, path: str) -> None:
    """Replaces a table unless there are violations."""
    first = violations.limit(5).collect()
    if first:
        raise ValueError(f"not published: {first}")
    replace_table(df, path)


def write_manifest(df: DataFrame, path: str, key: str) -> None:
    """CSV with array columns joined by bars, in order of the key."""
    columns = [F.array_join(c, " | ").alias(c) if kind.startswith("array") else F.col(c) for c, kind in df.dtypes]
    df.orderBy(key).select(*columns).write.mode("overwrite").option("header", True).csv(path)


def append_rows(path: str, additions: DataFrame, key: str) -> int:
    """Appends rows with new keys as a new version; a key that repeats or is there already fails. Returns the number appended."""
    spark = additions.sparkSession
    there = read_table(spark, path)
    n, keys = additions.count(), additions.select(key).distinct().count()
    if n != keys:
        raise ValueError(f"{n - keys} of the new rows repeat a key")
    clash = joins.audit(there, additions, key).first().matched
    if clash:
        raise ValueError(f"{clash} keys are in {path} already")
    replace_table(there.unionByName(additions), path)
    return n


def write_typed(df: DataFrame, path: str, model_type: str, version: int) -> None:
    """Replaces a typed table; one of another type or of a later version is not overwritten."""
    spark = df.sparkSession
    if current_version(spark, path):
        there = read_table(spark, path).select("model_type", "schema_version").distinct().limit(2).collect()
        if any(r.model_type != model_type or r.schema_version > version for r in there):
            raise ValueError(f"{path} holds {[tuple(r) for r in there]}")
    replace_table(df.withColumns({"model_type": F.lit(model_type), "schema_version": F.lit(version)}), path)


def write_ledger(df: DataFrame, path: str, key: str) -> int:
    """Writes review rows as compressed JSON and reads them back; a row that doesn't come back as it was fails. Returns the rows."""
    df.orderBy(key).write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(path)
    back = df.sparkSession.read.schema(df.schema).json(path)
    lost = df.exceptAll(back).limit(1).collect() or back.exceptAll(df).limit(1).collect()
    if lost:
        raise ValueError(f"the ledger differs: {lost}")
    return back.count()
