"""Streams: attempt logs, windows and re-delivered members."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ..operators import staging

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def events(spark: SparkSession, path: str, schema: str = EVENTS, pattern: str | None = None) -> DataFrame:
    """The files of a folder, as they come; with ``pattern`` those whose names fit it."""
    reader = spark.readStream.schema(schema)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).parquet(path)


def windowed_counts(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by window and type; rows later than ``late`` are left out."""
    counts = stream.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("window_start"), "event_type", "n")


def latest_state(stream: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The latest row of each key, kept as streaming state (update mode)."""
    return stream.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("m")).select(key, "m.*")


def once(stream: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """Rows of each key once within the watermark, however often they are delivered."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and ends; a restart goes on from the checkpoint."""
    if mode == "append":
        query = stream.writeStream.format("parquet").option("path", path)
    else:  # each batch's changed rows, with its number: the last one of a key counts
        query = stream.writeStream.foreachBatch(lambda df, n: df.withColumn("batch", F.lit(n)).write.mode("append").parquet(path))
    query.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run(stream: DataFrame, spark: SparkSession, mode: str = "append") -> DataFrame:
    """The rows of a stream that is run to its end, from a table in the shared folder."""
    folder = f"{staging.shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    run_to_table(stream, f"{folder}/rows", f"{folder}/checkpoint", mode)
    schema = stream.schema if mode == "append" else T.StructType([*stream.schema.fields, T.StructField("batch", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{folder}/rows")


def last_of(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of the updates (with ``batch``) of each key the last one."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("m")).select(*keys, "m.*")


#: The phases of an attempt with those that may stand before each; null is none.
PHASES = {"started": (None, "finished"), "streaming": ("started", "streaming"), "finished": ("started", "streaming")}


def phase_faults(attempts: DataFrame, key: str, order: str, phase: str) -> DataFrame:
    """Log rows whose phase can't follow the one before it, with that one."""
    out = attempts.withColumn("before", F.lag(phase).over(W.partitionBy(key).orderBy(order)))
    fits = F.lit(False)
    for name, befores in PHASES.items():
        known = F.col("before").isin(*[b for b in befores if b]) | (F.col("before").isNull() if None in befores else F.lit(False))
        fits = fits | ((F.col(phase) == name) & F.coalesce(known, F.lit(False)))
    return out.where(~F.coalesce(fits, F.lit(False))).select(key, order, phase, "before")


def conflicts(deliveries: DataFrame, member: str, digest: str) -> DataFrame:
    """(member, contents, deliveries) of members that came again with another content."""
    found = deliveries.groupBy(member).agg(F.count_distinct(digest).alias("contents"), F.count(F.lit(1)).alias("deliveries"))
    return found.where("contents > 1")
