"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select token positions of a window and ignore the others, so a seed still
matches when ignored tokens were substituted. The seeds of all benchmark items are
joined with those of the documents; a bitmap of the benchmark's seeds (fixed size)
sorts out nearly all document seeds at the scan. Around each hit the two token
sequences are compared along their diagonal and the longest stretch that is similar enough is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import text_runs, window_hashes, words_of

#: 1 selects a token, 0 ignores it. Any two substitutions in 13 tokens leave one mask whole somewhere.
MASKS = ("1111111", "101010011101", "111101011", "11100110101")
OFFSETS = tuple(tuple(k for k, c in enumerate(m) if c == "1") for m in MASKS)
SPAN = max(map(len, MASKS))
#: Items of fewer tokens than MIN_ITEM are too common to be told from chance inside a text: they match whole texts only.
MIN_ITEM = 6
#: Tokens compared on each side of a hit.
CONTEXT = 96
#: An overlap counts with so many tokens (or the whole item, if shorter) and this share of equal ones.
MIN_OVERLAP, MIN_SHARE = 13, 0.8
#: The share in whole numbers, so that stretches of just that share are exact.
_TENTHS, _NEEDED = 10, round(MIN_SHARE * 10)
#: The bitmap of the benchmark's seeds: 4 MB, whatever the benchmark.
BITMAP_BITS = 25

#: Tokens are runs of ASCII letters, digits and all characters beyond ASCII.
_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def token_hashes(texts: list[bytes]) -> list[np.ndarray]:
    h, _, _, first = words_of([t.decode().lower().encode() for t in texts], _BLANK)
    return [h[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def _hashed(batch, id_column: str):
    """(id, token hashes) of the batch's rows, hashed by runs of texts."""
    ids = batch.column(id_column).to_pylist()
    for run, texts in text_runs(batch):
        yield from zip(ids[run], token_hashes(texts))


def whole_seed(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seed of a text of fewer tokens than MIN_ITEM as a whole."""
    return window_hashes(h, tuple(range(len(h)))) + np.uint64(2000 + len(h)), np.zeros(1, np.int64)


def seeds(h: np.ndarray, short: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of all masks, and of whole windows of each length in ``short``."""
    hashes, at = [], []
    for k, offsets in enumerate([*OFFSETS, *(tuple(range(n)) for n in short)]):
        w = window_hashes(h, offsets)
        hashes.append(w + np.uint64(k if k < len(OFFSETS) else 1000 + len(offsets)))
        at.append(np.arange(len(w)))
    return np.concatenate(hashes), np.concatenate(at)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _item_rows(batches):
    """(item_id, n, tokens, seeds) of the benchmark's items."""
    for batch in batches:
        out = {"item_id": [], "n": [], "tokens": [], "seeds": []}
        for item, h in _hashed(batch, "item_id"):
            if not len(h):
                continue
            s, at = seeds(h, (len(h),) if len(h) < SPAN else ()) if len(h) >= MIN_ITEM else whole_seed(h)
            out["item_id"].append(item)
            out["n"].append(len(h))
            out["tokens"].append(h.astype("<u8").tobytes())
            out["seeds"].append([{"h": int(x), "at": int(p)} for x, p in zip(s.view(np.int64), at)])
        yield pa.RecordBatch.from_pydict(
            out,
            schema=pa.schema(
                [("item_id", pa.int64()), ("n", pa.int32()), ("tokens", pa.binary()),
                 ("seeds", pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))]
            ),
        )


def _stretches(same: np.ndarray, ats: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(from, to, equal) of the longest stretch through each place: ``least`` tokens or more, MIN_SHARE of them equal.

    One that begins or ends with other tokens is cut to its equal ones where ``least``
    allows it. Places without a stretch have none.
    """
    n, out = len(same), set()
    if n < least:
        return []
    total = np.concatenate([[0], np.cumsum(same)])
    level = _TENTHS * total - _NEEDED * np.arange(n + 1)  # a stretch counts if it doesn't fall
    for at in ats:
        # The lowest levels up to the place, and the last end behind it that is as high.
        low = np.minimum.accumulate(level[: at + 1])
        begins = np.flatnonzero(np.concatenate([[True], low[1:] < low[:-1]]))
        high = np.maximum.accumulate(level[at + 1 :][::-1])[::-1]
        ends = at + np.searchsorted(-high, -level[begins], side="right")
        k = int(np.where(ends > at, ends - begins, 0).argmax())
        b, e = int(begins[k]), int(ends[k])
        if e <= at or e - b < least:
            continue
        while e - b > least and e - 1 > at and not same[e - 1]:
            e -= 1
        while e - b > least and b < at and not same[b]:
            b += 1
        out.add((b, e, int(total[e] - total[b])))
    return sorted(out)


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Overlaps of documents (doc_id, text) and benchmark items (item_id, text), one row a pair.

    Returns doc_id, item_id, doc_start, doc_end (tokens of the document), n_tokens and
    n_equal of the pair's longest overlap; pairs without one have no row. Tokens are
    runs of letters, digits and characters beyond ASCII, in lower case. Null, empty and blank texts match
    nothing. Items that repeat are matched each by its own item_id; rows that repeat a
    doc_id are one document; null ids are left out. Empty tables give an empty result;
    other columns are ignored.
    """
    spark = docs.sparkSession
    work = common.Scratch(spark)
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    items = work.stage(
        items.mapInArrow(_item_rows, "item_id long, n int, tokens binary, seeds array<struct<h:long,at:int>>"), "bench-items"
    )
    short = tuple(sorted(r.n for r in items.where(F.col("n").between(MIN_ITEM, SPAN - 1)).select("n").distinct().collect()))  # lengths: under SPAN rows
    words = items.select(F.explode("seeds").alias("s")).select("s.h").distinct()
    first, second = F.col("h").bitwiseAND((1 << BITMAP_BITS) - 1), F.shiftrightunsigned("h", 32).bitwiseAND((1 << BITMAP_BITS) - 1)
    maps = (
        words.select(F.explode(F.array(first + 1, second + 1)).alias("bit"))
        .groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
        .collect()  # 2**BITMAP_BITS bits at most
    )
    bits = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for m in maps:  # the value v is bit v - 1, in buckets of 4096 bytes numbered from 1
        bits[(m.bucket - 1) * 4096 : m.bucket * 4096] = np.frombuffer(bytes(m.bits), np.uint8)
    shared = spark.sparkContext.broadcast(bits.tobytes())

    def regions(batches):
        """Stretches of documents around seeds that may be the benchmark's."""
        table = np.frombuffer(shared.value, np.uint8)
        has = lambda b: (table[b >> 3] >> (b & 7).astype(np.uint8)) & 1
        for batch in batches:
            out = {"doc_id": [], "start": [], "tokens": [], "seeds": []}
            for doc, h in _hashed(batch, "doc_id"):
                s, at = seeds(h, short) if len(h) >= MIN_ITEM or not len(h) else whole_seed(h)
                one, two = _bits(s)
                found = np.flatnonzero(has(one))
                found = found[has(two[found]) == 1]
                if not len(found):
                    continue
                found = found[np.argsort(at[found], kind="stable")]
                p = at[found]
                cuts = np.flatnonzero(np.diff(p) > 2 * CONTEXT + SPAN) + 1
                for part in np.split(found, cuts):
                    q = at[part]
                    lo, hi = max(0, int(q[0]) - CONTEXT), min(len(h), int(q[-1]) + SPAN + CONTEXT)
                    out["doc_id"].append(doc)
                    out["start"].append(lo)
                    out["tokens"].append(h[lo:hi].astype("<u8").tobytes())
                    out["seeds"].append([{"h": int(x), "at": int(y)} for x, y in zip(s[part].view(np.int64), q)])
            yield pa.RecordBatch.from_pydict(
                out,
                schema=pa.schema(
                    [("doc_id", pa.int64()), ("start", pa.int32()), ("tokens", pa.binary()),
                     ("seeds", pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32())])))]
                ),
            )

    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    regions = work.stage(
        known.mapInArrow(regions, "doc_id long, start int, tokens binary, seeds array<struct<h:long,at:int>>"), "bench-regions"
    )
    theirs = items.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.h", F.col("s.at").alias("item_at"))
    ours = regions.select("doc_id", "start", F.explode("seeds").alias("s")).select("doc_id", "start", "s.h", F.col("s.at").alias("at"))
    hits = (
        ours.join(theirs, "h")
        .groupBy("doc_id", "start", "item_id", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.collect_set("at").alias("ats"))
    )

    def verify(batches):
        for batch in batches:
            out = {"doc_id": [], "item_id": [], "doc_start": [], "doc_end": [], "n_tokens": [], "n_equal": []}
            for r in batch.to_pylist():
                doc, item = np.frombuffer(r["tokens"], "<u8"), np.frombuffer(r["item_tokens"], "<u8")
                # The stretch of the diagonal that both have, in the document's tokens.
                lo = max(r["start"], r["shift"])
                hi = min(r["start"] + len(doc), r["shift"] + len(item))
                same = doc[lo - r["start"] : hi - r["start"]] == item[lo - r["shift"] : hi - r["shift"]]
                ats = [at - lo for at in sorted(r["ats"]) if lo <= at < hi]
                for b, e, equal in _stretches(same, ats, min(MIN_OVERLAP, len(item))):
                    for k, v in zip(out, (r["doc_id"], r["item_id"], b + lo, e + lo, e - b, equal)):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(
                out, schema=pa.schema([(k, pa.int64() if k.endswith("_id") else pa.int32()) for k in out])
            )

    texts = regions.select("doc_id", "start", "tokens")
    known_items = items.select("item_id", F.col("tokens").alias("item_tokens"))
    found = (
        hits.join(texts, ["doc_id", "start"])
        .join(known_items, "item_id")
        .mapInArrow(verify, "doc_id long, item_id long, doc_start int, doc_end int, n_tokens int, n_equal int")
    )
    best = F.max(F.struct("n_equal", "n_tokens", (-F.col("doc_start")).alias("s"), "doc_end"))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("m")).select(
        "doc_id", "item_id", (-F.col("m.s")).alias("doc_start"), "m.doc_end", "m.n_tokens", "m.n_equal"
    )
    found = work.stage(found, "bench-overlaps")
    shared.unpersist()
    work.drop("bench-items", "bench-regions")
    return found


def op1_decontaminate(spark, sf_dir):
    return overlaps(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "benchmark"))


def keep_clean(spark, docs, sf_dir):
    """Pipeline stage: documents without an overlap with the benchmark.

    Of rows that share a doc_id all go if one overlaps; rows without one are judged by
    their own text. Null and empty texts stay; an empty table gives an empty result.
    """
    benchmark = common.read(spark, sf_dir, "benchmark")
    leaked = common.stage(overlaps(docs.where("doc_id is not null"), benchmark).select("doc_id").distinct(), "leaked")
    named = docs.where("doc_id is not null").join(leaked, "doc_id", "left_anti").select(*docs.columns)
    key = F.xxhash64("text")
    unnamed = docs.where("doc_id is null")
    texts = unnamed.where("text is not null").select(key.alias("doc_id"), "text")
    if texts.isEmpty():
        return named.unionByName(unnamed)
    leaked = common.stage(overlaps(texts, benchmark).select(F.col("doc_id").alias("_key")).distinct(), "leaked")
    return named.unionByName(unnamed.withColumn("_key", key).join(leaked, "_key", "left_anti").select(*docs.columns))
