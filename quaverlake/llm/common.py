"""Shared helpers: staging tables in the cluster's shared folder and text expressions."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests) gets one of its own; a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file:///tmp/checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows and bytes of the Arrow batches that staged tables are made of, at most; they bound the memory of executors and workers.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@contextmanager
def small_batches(spark: SparkSession):
    """Within it the session's queries pass small Arrow batches to Python; afterwards its own settings hold again."""
    before = {k: spark.conf.get(k, None) for k in BATCH}
    try:
        for k, v in BATCH.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df: DataFrame, tag: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back.

    Cuts the lineage: a lost executor costs no work of earlier stages.
    """
    return Scratch(df.sparkSession).stage(df, tag)


class Scratch:
    """Tables staged on the way to a result; those that it doesn't read are dropped by their tags."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, {}

    def stage(self, df: DataFrame, tag: str) -> DataFrame:
        path = new_path(self.spark, tag)
        with small_batches(self.spark):
            df.write.parquet(path)
        trim(self.spark)
        self.paths.setdefault(tag, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tags: str) -> None:
        """Deletes the tables of these tags and lets go of the shuffles and broadcasts that made them.

        These are in the executors' memory and on their disks until the driver collects
        its garbage.
        """
        for tag in tags:
            for path in self.paths.pop(tag, []):
                drop_path(self.spark, path)
        release(self.spark)


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of frames that are not referred to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim(spark)


def trim(spark: SparkSession) -> None:
    """Gives the system back what the driver's JVM has freed outside of its heap.

    Compilers and short-lived threads free their memory, but the C library keeps it for
    each arena, and over many jobs that grows to hundreds of MB. JVMs that lack the
    command (it came with 17.0.9, for glibc) are left as they are.
    """
    sc = spark.sparkContext
    args = sc._gateway.new_array(sc._jvm.Object, 4)  # name, operation, parameters, signature
    args[0] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    args[1] = "systemTrimNativeHeap"
    # The server's own class isn't open to calls from Python, its interface is.
    methods = sc._jvm.Class.forName("javax.management.MBeanServer").getMethods()
    invoke = next(m for m in methods if m.getName() == "invoke")
    try:
        invoke.invoke(sc._jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JJavaError:
        pass


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; null is taken as empty."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Bits of the filter of ids: 2**24 bits in rows of 4 KB, so 2 MB are broadcast, whatever the input.
FILTER_BITS = 24


def _flagged(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` joined with a bitmap of ``ids`` (one column), and whether a row's ``column`` may be among them."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS)) + 1
    bits = ids.select(bit(ids.columns[0]).alias("_bit")).distinct()
    bitmap = bits.groupBy(F.expr("bitmap_bucket_number(_bit)").alias("_bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(_bit))").alias("_bits")
    )
    at = "cast(bitmap_bit_position(_bit) as int)"
    is_set = F.expr(f"(shiftright(cast(conv(hex(substring(_bits, {at} div 8 + 1, 1)), 16, 10) as int), {at} % 8) & 1) = 1")
    df = df.withColumn("_bit", bit(column)).withColumn("_bucket", F.expr("bitmap_bucket_number(_bit)"))
    return df.join(F.broadcast(bitmap), "_bucket", "left"), F.coalesce(is_set, F.lit(False))


def rows_with_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``ids`` (one column); few others remain.

    A filter before a join: it keeps the texts of other rows out of the shuffle. With
    more ids than bits it lets all rows pass, which the join bears.
    """
    flagged, may = _flagged(df, column, ids)
    return flagged.where(may).select(*df.columns)


def split_by_ids(df: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``column`` may be among ``ids`` (one column), and those that surely aren't."""
    flagged, may = _flagged(df, column, ids)
    return flagged.where(may).select(*df.columns), flagged.where(~may).select(*df.columns)


def rows_without_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` isn't among ``ids``: only those that may be are joined with them."""
    doubtful, clear = split_by_ids(df, column, ids)
    named = ids.select(F.col(ids.columns[0]).alias("_id")).distinct()
    return clear.unionByName(doubtful.join(named, doubtful[column] == named["_id"], "left_anti"))
