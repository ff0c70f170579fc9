"""Exact deduplication by stateful streaming.

A stream of (digest, doc_id, locator) rows feeds one keyed state in RocksDB, which
is on the executors' disks and checkpointed to the shared folder. The state never
expires: it holds, by digest of the normalised text, the largest doc_id seen, the
locator (file) of that row and the number of rows. The state itself is the result;
the state data source reads it.

Digests that were hit more than once are checked on their full bytes: rows whose
digest is among the hits (a bitmap of fixed size sorts out most others at the scan)
are grouped by the whole text. Copies collapse before the shuffle, so a group that
holds a third of all rows leaves each task as one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: The bitmap of hits: 2**24 bits in 512 rows of 4 KB, so 2 MB are broadcast, whatever the input.
BITMAP_BITS = 24
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    return common.lower_ascii(text)


def _digest(norm: Column) -> Column:
    return F.sha2(norm, 256)


def _state(staged: DataFrame, path: str, max_bytes_per_trigger: int) -> DataFrame:
    """Runs the stream over the table at ``path`` to its end; returns (digest, doc_id, locator, n)."""
    spark = staged.sparkSession
    own = spark.newSession()  # the settings below end with it
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "64")
    # A store lets go of its memory as soon as its batch is committed; what comes after needs it.
    own.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    # Many small stores: without this each reserves some MB of disk ahead.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    checkpoint = common.new_path(spark, "dedup-state")
    rows = (
        own.readStream.schema(staged.schema)
        .option("maxBytesPerTrigger", max_bytes_per_trigger)
        .parquet(path)
    )
    folded = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("last"), F.count(F.lit(1)).alias("n")
    )
    query = (
        folded.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.lastProgress is None:  # nothing came in
        return spark.createDataFrame([], "digest string, doc_id long, locator string, n long")
    state = spark.read.format("statestore").load(checkpoint)
    last, n = (f"value.{f.name}" for f in state.schema["value"].dataType.fields)
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col(f"{last}.doc_id").alias("doc_id"),
        F.col(f"{last}.locator").alias("locator"),
        F.col(n).alias("n"),
    )


def exact_dedup(
    docs: DataFrame, max_bytes_per_trigger: int = 1 << 32, digest=_digest
) -> DataFrame:
    """One row per row of ``docs`` (columns doc_id, text; others are ignored).

    Returns doc_id, keep_id, group_size, kept, text_sha256, keep_locator. Texts are
    equal when identical after lower-casing A-Z; of equal texts the largest doc_id
    stays. A null text is the empty text; empty texts equal each other. A null doc_id
    is smaller than all others, and a group with null ids only has the keep_id null.
    Repeated rows of one doc_id and text are one document: each counts in group_size
    and all have the same ``kept``. An empty table gives an empty result.
    ``digest`` maps the normalised text to the state's key; texts that collide under
    it are told apart by their bytes.
    """
    spark = docs.sparkSession
    norm = normalised(F.col("text"))
    # The second key (64 bits and length) tells texts of one digest apart in the last join.
    keys = [
        digest(norm).alias("digest"),
        F.xxhash64(norm, F.octet_length(norm)).alias("tag"),
    ]
    staged_path = common.new_path(spark, "dedup-rows")
    staged = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *keys,
        F.sha2(norm, 256).alias("text_sha256"),
        F.input_file_name().alias("locator"),
    )
    staged.write.parquet(staged_path)
    staged = spark.read.schema(staged.schema).parquet(staged_path)

    state = _state(staged, staged_path, max_bytes_per_trigger)
    hit_bit = F.conv(F.substring(F.sha2(F.col("digest"), 256), 1, BITMAP_BITS // 4), 16, 10).cast("long")
    bitmap = (
        state.where("n > 1")
        .select(hit_bit.alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
    )
    probe = docs.select("doc_id", norm.alias("norm")).select(
        F.col("doc_id").cast("long").alias("doc_id"), "norm", digest(F.col("norm")).alias("digest")
    )
    probe = probe.withColumn("bit", hit_bit).withColumn("bucket", F.expr("bitmap_bucket_number(bit)"))
    at = "bitmap_bit_position(bit)"
    is_set = F.expr(
        f"(shiftright(cast(conv(hex(substring(bits, cast({at} div 8 as int) + 1, 1)), 16, 10) as int),"
        f" cast({at} % 8 as int)) & 1) = 1"
    )
    groups = (
        probe.join(F.broadcast(bitmap), "bucket")
        .where(is_set)
        .groupBy("digest", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(
            "digest",
            F.xxhash64("norm", F.octet_length("norm")).alias("tag"),
            "keep_id",
            "group_size",
        )
    )
    work = common.Scratch(spark)
    groups = work.stage(groups, "dedup-groups")
    # The file that holds the row which stays, from the state; collided digests have none.
    located = state.where("n > 1").select("digest", F.col("doc_id").alias("keep_id"), "locator")
    groups = work.stage(
        groups.join(located.withColumnRenamed("locator", "keep_locator"), ["digest", "keep_id"], "left"),
        "dedup-located",
    )
    work.drop("dedup-groups")
    out = staged.join(groups, ["digest", "tag"], "left")
    found = F.col("group_size").isNotNull()
    keep = F.when(found, F.col("keep_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
        F.when(found, F.col("keep_locator")).otherwise(F.col("locator")).alias("keep_locator"),
    )


def op9_exact_dedup(spark, sf_dir):
    out = exact_dedup(common.read(spark, sf_dir, "documents"))
    return out.drop("keep_locator")


OP9_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""


def keep_distinct(spark, docs, sf_dir):
    """Pipeline stage: of equal texts the row with the largest doc_id, one row of each text.

    Null counts as the empty text. Where the largest doc_id's row repeats, or no row of a
    text has a doc_id, one of these rows stays. An empty table gives an empty result;
    other columns pass.
    """
    judged = exact_dedup(docs).groupBy("doc_id", "text_sha256")
    judged = judged.agg(F.max("kept").alias("_kept"), F.count(F.lit(1)).alias("_n")).where("not _kept or _n > 1")
    marks = common.stage(judged.withColumnsRenamed({"doc_id": "_doc", "text_sha256": "_sha"}), "dedup-marks")
    rows = docs.withColumn("_own", F.sha2(normalised(F.col("text")), 256))
    doubtful, clear = common.split_by_ids(rows, "_own", marks.select("_sha"))
    same = (doubtful["_own"] == marks["_sha"]) & doubtful["doc_id"].cast("long").eqNullSafe(marks["_doc"])
    doubtful = doubtful.join(marks, same, "left")
    # Equal rows are combined before they meet, however many there are.
    every = F.struct(*docs.columns)
    again = doubtful.where("_kept").groupBy("_sha", "_doc").agg(F.min_by(every, F.xxhash64(*docs.columns)).alias("row"))
    return clear.select(*docs.columns).unionByName(doubtful.where("_sha is null").select(*docs.columns)).unionByName(again.select("row.*"))
