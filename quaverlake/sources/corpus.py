"""Scans of whole corpora of files: archives of scores, checks of formats, texts of printed pages."""

from __future__ import annotations

import importlib.util
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import archives, music

#: The bytes with which files of a format begin.
MAGIC = {"mid": "4D546864", "mxl": "504B0304", "pdf": "25504446"}


def score_scan(spark: SparkSession, paths: list[str], suffix: str = ".mxl") -> DataFrame:
    """Part names, clefs and harmonies of the scores in tar archives; members are read on the executors as they stream.

    A member that can't be read gives one row with its issue; unsafe archives fail.
    """
    spark.dataSource.register(archives.TarMembers)
    members = spark.read.format("tar_members").option("path", ",".join(paths)).option("suffix", suffix).load()
    return music.read_marks(members.select(F.col("member").alias("id"), "body"))


def candidate_scan(spark: SparkSession, paths: list[str], candidates: DataFrame, member: str, most: int = 100_000) -> DataFrame:
    """JSON members (member, body as text) that candidates name, and no others; keys that repeat fail.

    The names go to the readers, so other members aren't read; more than ``most`` names
    are joined instead, behind the scan.
    """
    spark.dataSource.register(archives.TarMembers)
    names = [r[0] for r in candidates.select(member).distinct().limit(most + 1).collect()]  # most + 1 at most
    scan = spark.read.format("tar_members").option("path", ",".join(paths)).option("suffix", ".json").option("json", "true")
    if names and len(names) <= most and not any("," in n for n in names):
        scan = scan.option("names", ",".join(names))
    rows = scan.load().select("member", F.col("body").cast("string").alias("body"))
    return rows.join(candidates.select(F.col(member).alias("member")).distinct(), "member", "left_semi")


def format_faults(files: DataFrame) -> DataFrame:
    """(id, fault) of files (id, format, body): an unknown format, other first bytes than it has, or contents that can't be read."""
    known = F.create_map(*(F.lit(x) for pair in MAGIC.items() for x in pair))[F.col("format")]
    first = F.hex(F.substring("body", 1, 4))
    fault = F.when(known.isNull(), "unknown_format").when(F.length("body") == 0, "empty").when(first != known, "other_format")
    rows = files.withColumn("fault", fault)
    plain = rows.where("fault is not null").select("id", "fault")
    rest = rows.where("fault is null")
    parts = [music.read_midi(rest.where("format = 'mid'")), music.read_marks(rest.where("format = 'mxl'"))]
    for part in parts:
        plain = plain.union(part.where("issue is not null").select("id", F.concat(F.lit("unreadable: "), "issue").alias("fault")))
    return plain


def read_pages(files: DataFrame) -> DataFrame:
    """(id, page, text, width, height, issue) of PDF files (id, body), where a reader is installed on the executors.

    Without one, and for files that it can't read, a file gives one row with its issue.
    """

    def pages(body: bytes) -> list[tuple]:
        if not importlib.util.find_spec("pypdf"):
            raise ValueError("no reader of PDF files is installed")
        from pypdf import PdfReader

        return [(n, p.extract_text(), float(p.mediabox.width), float(p.mediabox.height)) for n, p in enumerate(PdfReader(io.BytesIO(body)).pages)]

    def rows_of(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows: list[tuple] = []
            for i, body in zip(pdf.id, pdf.body):
                try:
                    rows += [(i, *p, None) for p in pages(bytes(body))]
                except Exception as e:  # a reader's own kinds of errors
                    rows.append((i, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["id", "page", "text", "width", "height", "issue"], dtype=object)

    return files.select("id", "body").mapInPandas(rows_of, "id string, page int, text string, width double, height double, issue string")
