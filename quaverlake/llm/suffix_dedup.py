"""Removal of repeated byte strings by prefix-free parsing.

Rolling-hash triggers cut every text into phrases. A position is the trigger of the
windows (strings of LENGTH bytes) in whose middle its hash is smallest, so equal
windows have equal triggers at equal offsets, wherever they stand. A trigger with the
stretch of text that its windows cover is a phrase of the dictionary; the sequence of
a text's phrases is its parse.

Corpus order follows from both. Phrases are ordered by their core, which all windows
of the trigger contain, and then as wholes. A phrase that occurs again as a whole has
all its windows repeated: equal phrases follow each other in the parse's order. Others
with an equal core may share some windows. For these the dictionary's suffixes are
sorted, up to LENGTH bytes, with one phrase of each repeated class among them; a window
is repeated if its suffix equals a neighbour's in that order.

Texts that occur more than once as wholes need no parse but one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common
from .tokens import mixed, powers, prefix_sums, text_runs

#: Strings of so many bytes that occur twice are removed.
LENGTH = 200
#: Bytes of a trigger, and where triggers stand in a window: from EDGE bytes after its start to EDGE before its end.
GRAM, EDGE = 8, 50
PLACES = LENGTH - 2 * EDGE - GRAM + 1
#: Texts are parsed in runs of about so many bytes.
RUN_BYTES = 1 << 19
#: Texts of a task that are remembered at most.
SEEN = 1 << 18
#: Phrases with one core that are sorted in memory at most; beyond, their windows are grouped by Spark.
BLOCK_BYTES = 1 << 21


def phrases(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first window, number of windows less one, core, whole) of the phrases of some texts."""
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    n = len(raw)
    empty = np.zeros(0, np.int64)
    if n < LENGTH + 1:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    sums, down = prefix_sums(raw), powers(n + 1)[1]
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
    grams = (grams & np.uint64((1 << 64) - (1 << 31))) | np.arange(len(grams), dtype=np.uint64)
    # Smallest of PLACES neighbours: of 64 by doubling, then of two that overlap.
    width = 1
    while width * 2 <= PLACES:
        grams = np.minimum(grams[:-width], grams[width:])
        width *= 2
    grams = np.minimum(grams[: len(grams) - (PLACES - width)], grams[PLACES - width :])
    starts = n - LENGTH
    trigger = (grams[EDGE : EDGE + starts] & np.uint64((1 << 31) - 1)).astype(np.int64)
    own = np.repeat(np.arange(len(texts)), np.diff(begins))[:starts]
    valid = np.arange(starts) + LENGTH < begins[own + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    t = trigger[at]
    cut = np.flatnonzero(t[1:] != t[:-1]) + 1
    first = at[np.concatenate([[0], cut])]
    last = at[np.concatenate([cut - 1, [len(at) - 1]])]
    t = t[np.concatenate([[0], cut])]

    def piece(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return (sums[j] - sums[i]) * down[i]

    core = mixed(piece(t - EDGE, t + LENGTH - EDGE - PLACES + 1), 11)
    shape = ((t - first) << 16 | (last - first)).astype(np.uint64)
    whole = mixed(piece(first, last + LENGTH) + mixed(shape, 12), 13)
    text = own[first]
    return text, first - begins[text], last - first, core, whole


def _runs(texts: list[bytes]):
    begin = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > RUN_BYTES:
            yield begin, k
            begin, held = k, 0
        held += len(t) + 1
    if begin < len(texts):
        yield begin, len(texts)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _key(text: bytes) -> tuple[int, int]:
    """(doc, tag): 60 and 24 bits that name a text; ``_DOC`` and ``_TAG`` are the same in SQL."""
    digest = hashlib.md5(text, usedforsecurity=False).hexdigest()
    return int(digest[:15], 16), int(digest[15:21], 16)


def _parsed(batches):
    """Phrases as (doc, place, core, whole); of equal texts that one task sees, the first is parsed.

    place: tag (24 bits), first window (31 bits) and number of windows less one (7 bits).
    """
    seen: set[tuple[int, int]] = set()  # saves work only, so it may be forgotten
    for batch in batches:
        for _, run in text_runs(batch):
            if len(seen) > SEEN:
                seen.clear()
            texts, keys = [], []
            for raw in run:
                if len(raw) >= LENGTH and (key := _key(raw)) not in seen:
                    seen.add(key)
                    texts.append(raw)
                    keys.append(key)
            for i, j in _runs(texts):
                text, first, more, core, whole = phrases(texts[i:j])
                docs, tags = (np.array(x, np.int64) for x in zip(*keys[i:j]))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc": docs[text],
                        "place": (tags[text] << 38) | (first << 7) | more,
                        "core": core.view(np.int64),
                        "whole": whole.view(np.int64),
                    }
                )


def _contexts(batches):
    """Rows (doc, text, places array<struct<place, core>>) -> (core, doc, place, phrase)."""
    for batch in batches:
        out = {"core": [], "doc": [], "place": [], "phrase": []}
        for doc, text, places in zip(batch.column("doc").to_pylist(), batch.column("text"), batch.column("places").to_pylist()):
            raw = (text.as_py() or "").encode()
            for p in places:
                first, more = (p["place"] >> 7) & 0x7FFFFFFF, p["place"] & 127
                out["core"].append(p["core"])
                out["doc"].append(doc)
                out["place"].append(p["place"])
                out["phrase"].append(raw[first : first + more + LENGTH])
        yield pa.RecordBatch.from_pydict(
            out, schema=pa.schema([("core", pa.int64()), ("doc", pa.int64()), ("place", pa.int64()), ("phrase", pa.binary())])
        )


def sorted_suffixes(block: list[bytes]) -> list[np.ndarray]:
    """Of each phrase of a dictionary, which of its windows equal another window of the block.

    The suffixes of all phrases, cut to LENGTH bytes, are sorted; equal ones are neighbours.
    """
    raw = np.frombuffer(b"".join(block), np.uint8)
    counts = np.array([len(p) - LENGTH + 1 for p in block])
    begins = np.concatenate([[0], np.cumsum([len(p) for p in block])[:-1]])
    at = np.repeat(begins, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at]).view(f"S{LENGTH}").ravel()
    order = np.argsort(suffixes, kind="stable")
    ranked = suffixes[order]
    equal = ranked[1:] == ranked[:-1]
    hit = np.zeros(len(at) + 1, bool)
    hit[:-2][equal] = True
    hit[1:-1] |= equal
    found = np.zeros(len(at), bool)
    found[order] = hit[:-1]
    return np.split(found, np.cumsum(counts)[:-1])


def _suffix_sorted(batches):
    """Phrases in order of their cores -> (doc, place, from, to, a, b).

    Rows with a null ``a`` are runs of repeated windows. A core with too many phrases for
    memory gives one row per window with its digest (a, b) instead.
    """
    schema = pa.schema([(c, pa.int64()) for c in ("doc", "place", "from", "to", "a", "b")])
    block: list[tuple[int, int, bytes]] = []
    state = {"held": 0, "core": None, "begin": 0, "loose": False, "own": 0}

    def emit(rows):
        return pa.RecordBatch.from_pydict(dict(zip(schema.names, map(list, zip(*rows)))) if rows else {c: [] for c in schema.names}, schema=schema)

    def flush(part):
        rows = []
        for (doc, place, _), hit in zip(part, sorted_suffixes([p for _, _, p in part]) if part else []):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
            first = (place >> 7) & 0x7FFFFFFF
            rows += [(doc, place, first + int(i), first + int(j) - 1, None, None) for i, j in zip(edge[::2], edge[1::2])]
        return emit(rows)

    def windows(part):
        for doc, place, phrase in part:
            first = (place >> 7) & 0x7FFFFFFF
            rows = []
            for k in range(len(phrase) - LENGTH + 1):
                a, b = np.frombuffer(_digest(phrase[k : k + LENGTH]), "<i8").tolist()
                rows.append((doc, place, first + k, first + k, a, b))
            yield emit(rows)

    for batch in batches:
        for core, doc, place, phrase in zip(*(batch.column(c).to_pylist() for c in ("core", "doc", "place", "phrase"))):
            if core != state["core"]:
                if state["held"] > BLOCK_BYTES // 2:
                    yield flush(block)
                    block, state["held"] = [], 0
                state.update(core=core, begin=len(block), loose=False, own=0)
            block.append((doc, place, phrase))
            state["held"] += len(phrase)
            state["own"] += len(phrase)
            if state["loose"] or state["own"] > BLOCK_BYTES:
                yield flush(block[: state["begin"]])
                yield from windows(block[state["begin"] :])
                block, state["held"] = [], 0
                state.update(begin=0, loose=True)
    if block:
        yield flush(block)


def _removed(batches):
    """Rows (doc_id, text, whole, spans) -> the result's rows."""
    for batch in batches:
        out = {"doc_id": batch.column("doc_id"), "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "spans": []}
        for text, whole, spans in zip(batch.column("text"), batch.column("whole").to_pylist(), batch.column("spans").to_pylist()):
            raw = (text.as_py() or "").encode()
            cover: list[list[int]] = []
            if whole and len(raw) >= LENGTH:
                cover = [[0, len(raw)]]
            else:
                for s in sorted((s["from"], s["to"]) for s in spans or ()):
                    if cover and s[0] <= cover[-1][1]:
                        cover[-1][1] = max(cover[-1][1], s[1] + LENGTH)
                    else:
                        cover.append([s[0], s[1] + LENGTH])
            digest, at = hashlib.sha256(), 0
            for i, j in cover:
                digest.update(raw[at:i])
                at = j
            digest.update(raw[at:])
            out["n_bytes"].append(len(raw))
            out["n_removed"].append(sum(j - i for i, j in cover))
            out["n_spans"].append(len(cover))
            out["kept_sha256"].append(digest.hexdigest())
            out["spans"].append([{"start": i, "end": j} for i, j in cover])
        yield pa.RecordBatch.from_pydict(out, schema=_RESULT)


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]
)

_MD5 = "md5(cast(coalesce(text, '') as binary))"
_DOC = f"cast(conv(substring({_MD5}, 1, 15), 16, 10) as bigint)"
_TAG = f"cast(conv(substring({_MD5}, 16, 6), 16, 10) as bigint)"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans.

    Removes each byte that a string of 200 bytes covers which also starts elsewhere, in
    the same text or another one; texts are UTF-8 and judged as they came. ``spans`` has
    the maximal removed runs. A null text is empty; texts under 200 bytes keep all.
    Rows that repeat are texts of their own, so they remove each other, whatever their
    doc_ids; these may be null or repeat, as texts are named by a digest of 84 bits.
    Phrases that occur again as wholes are told by two hashes of 64 bits. An empty table
    gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs.withColumn("doc", F.expr(_DOC)).withColumn("tag", F.expr(_TAG))
    wholes = docs.groupBy("doc", "tag").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    work = common.Scratch(docs.sparkSession)
    wholes = work.stage(wholes.select("doc", "tag", F.lit(True).alias("whole")), "repeat-wholes")

    parse = docs.select("text").mapInArrow(_parsed, "doc long, place long, core long, whole long")
    of_core, of_whole = W.partitionBy("core"), W.partitionBy("core", "whole")
    in_order = of_whole.orderBy("doc", "place")
    ranked = (
        parse.withColumn("rank", F.row_number().over(in_order))
        .withColumn("n", F.count(F.lit(1)).over(of_whole))
        .withColumn("low", F.min("whole").over(of_core))
        .withColumn("high", F.max("whole").over(of_core))
        .where("n > 1 or low < high")
        .select("doc", "place", "core", (F.col("n") > 1).alias("again"), F.expr("low < high and rank = 1").alias("sort"))
    )
    ranked = work.stage(ranked, "repeat-parse")

    # The phrases whose suffixes are to be sorted, with their bytes.
    wanted = ranked.where("sort").select("doc", F.shiftright("place", 38).alias("tag"), F.struct("place", "core").alias("p"))
    wanted = wanted.groupBy("doc", "tag").agg(F.collect_list("p").alias("places"))
    wanted = work.stage(wanted, "repeat-wanted")
    texts = common.rows_with_ids(docs.select("doc", "tag", "text"), "doc", wanted.select("doc"))
    dictionary = (
        texts.join(wanted, ["doc", "tag"])
        .dropDuplicates(["doc", "tag"])
        .select("doc", "text", "places")
        .mapInArrow(_contexts, "core long, doc long, place long, phrase binary")
    )
    found = (
        dictionary.repartition("core")
        .sortWithinPartitions("core")
        .mapInArrow(_suffix_sorted, "doc long, place long, `from` long, `to` long, a long, b long")
    )
    found = work.stage(found, "repeat-suffixes")
    loose = found.where("a is not null").withColumn("n", F.count(F.lit(1)).over(W.partitionBy("a", "b"))).where("n > 1")
    runs = (
        found.where("a is null").select("doc", "place", "from", "to")
        .union(loose.select("doc", "place", "from", "to"))
        .union(
            ranked.where("again").select(
                "doc", "place",
                F.shiftright("place", 7).bitwiseAND(0x7FFFFFFF).alias("from"),
                (F.shiftright("place", 7).bitwiseAND(0x7FFFFFFF) + F.col("place").bitwiseAND(127)).alias("to"),
            )
        )
    )
    spans = runs.groupBy("doc", F.shiftright("place", 38).alias("tag")).agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    marks = spans.join(wholes, ["doc", "tag"], "full").select("doc", "tag", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))
    marks = work.stage(marks, "repeat-spans")
    work.drop("repeat-wholes", "repeat-parse", "repeat-wanted", "repeat-suffixes")
    out = docs.join(marks, ["doc", "tag"], "left").select("doc_id", "text", "whole", "spans")
    return out.mapInArrow(
        _removed,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>",
    )


def op2_suffix_dedup(spark, sf_dir):
    return remove_repeats(common.read(spark, sf_dir, "documents")).drop("spans")
