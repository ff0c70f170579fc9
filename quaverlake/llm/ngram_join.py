"""N-gram Jaccard join with PartEnum signatures.

A document is the set of its 5-word shingles. Sets of at most 1.25 times each other's
size can reach a Jaccard similarity of 0.8, and then differ in at most (|A| + |B|) / 9
elements. Sizes are cut into bands of that ratio; a set signs for its own band's
instance and the next one's, so each pair that can link meets in one instance.

In an instance with the distance bound k the shingle domain is partitioned by hash into
n1 parts of n2 cells. Of n1 > k / (k2 + 1) parts, one differs in at most k2 cells; the
subsets of n2 - k2 cells of each part are enumerated and each is one signature. Sets
that are close enough share one. A signature of no elements says nothing; ``spare`` more
parts make up for those, and sets with too many of them sign in further namespaces (see
``signatures``). So no link is lost.

Equal sets are one class from the start, for which one document searches. A set more
than a fifth of whose shingles no other class has can't link with any (the others are
less than 0.8 of it alone), so only the rest sign. Within a bucket of equal signatures
the smallest document is the hub; each document is verified with the hub it met most,
and where a bucket still holds several components, its documents are compared in full:
those of a cluster of such buckets are dealt to blocks of bounded size, and each two
blocks that share a bucket are compared in one task that returns a forest of links. No
pair of documents becomes a row, however large a group of near copies is.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components
from .tokens import mixed, text_runs, window_hashes, words_of

WORDS = 5
#: Similar: PERCENT_OF_UNION of the union is shared.
PERCENT = 80

def shingles(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its word shingles; a shorter text is one shingle."""
    h, _, _, first = words_of([t.lower() for t in texts])
    windows = window_hashes(h, tuple(range(words)))  # those across texts aren't used
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            s = np.sort(windows[a : b - words + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        else:
            s = window_hashes(h[a:b], tuple(range(b - a))) if b > a else h[:0]
        out.append(s)
    return out


def _shingled(batch):
    """(slice, shingle sets) by runs of the batch's texts."""
    for run, texts in text_runs(batch):
        yield run, shingles(texts)


def bands(limit: int) -> list[tuple[int, int]]:
    """Size bands (from, to), the first of them of size 1 each."""
    out, low = [], 1
    while low <= limit:
        high = max(low, low * 100 // PERCENT)
        out.append((low, high))
        low = high + 1
    return out


#: Partitions of the domain that a set with many empty cells tries.
LEVELS = 5

_BANDS = bands(1 << 40)
_TOPS = np.array([b[1] for b in _BANDS])


def scheme(j: int, level: int = 0) -> tuple[int, int, int, int]:
    """(n1, n2, k2, spare) of instance j, which has the pairs within band j - 1 and between it and band j."""
    high = _BANDS[j][1] + _BANDS[max(j - 1, 0)][1]
    k = high * (100 - PERCENT) // (100 + PERCENT)  # |A ^ B| <= (|A| + |B|) (1 - s) / (1 + s)
    if k == 0:
        return 0, 0, 0, 0
    if k <= 8:
        return 1, k + 3, k, 0
    parts = k // 2 + 1
    spare = 3 + parts // 7
    # Two of three cells hold more elements than one of two, but take half as many signatures again.
    return parts + spare, 2 if level == 0 else 3, 1, spare


def _small(elements: np.ndarray, j: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of a set in an instance of one part, and which of them are of no elements."""
    _, n2, k2, _ = scheme(j)
    cell = ((mixed(elements, 100 + seed) >> np.uint64(32)) % np.uint64(n2)).astype(np.int64)
    sums, held = np.zeros(n2, np.uint64), np.bincount(cell, minlength=n2)
    np.add.at(sums, cell, mixed(elements, 2))
    kept = [list(keep) for keep in combinations(range(n2), n2 - k2)]
    empty = np.array([not held[keep].any() for keep in kept])
    labels = np.array([(j << 48) + (c << 32) for c in range(len(kept))], np.uint64)
    sigs = np.array([sums[keep].sum(dtype=np.uint64) for keep in kept], np.uint64) + mixed(labels, 3)
    return mixed(sigs), empty


def _large(sets: list[np.ndarray], instances: list[int], level: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same for instances of many parts, with one cell of each left out in turn."""
    n2 = scheme(instances[0], level)[1]
    cells = np.array([scheme(j, level)[0] * n2 for j in instances])
    begin = np.concatenate([[0], np.cumsum(cells)])
    total = int(begin[-1])
    sizes = [len(s) for s in sets]
    elements = np.concatenate(sets)
    cell = (mixed(elements, 100 + level) >> np.uint64(32)) % np.repeat(cells, sizes).astype(np.uint64)
    cell = cell.astype(np.int64) + np.repeat(begin[:-1], sizes)
    value = mixed(elements, 2)
    sums = np.bincount(cell, (value & np.uint64(0xFFFFFFFF)).astype(float), total).astype(np.uint64) + (
        np.bincount(cell, (value >> np.uint64(32)).astype(float), total).astype(np.uint64) << np.uint64(32)
    )
    held = np.bincount(cell, minlength=total)
    # The content of a part without one of its cells.
    sums = np.repeat(sums.reshape(-1, n2).sum(1, dtype=np.uint64), n2) - sums
    empty = np.repeat(held.reshape(-1, n2).sum(1), n2) == held
    owner = np.repeat(np.arange(len(sets)), cells)
    label = (np.array(instances, np.uint64) << np.uint64(48))[owner] + (np.arange(total) - begin[owner]).astype(np.uint64)
    sigs = mixed(sums + mixed(label, 3))
    return [(sigs[a:b], empty[a:b]) for a, b in zip(begin[:-1].tolist(), begin[1:].tolist())]


def signatures(sets: list[np.ndarray], instances: list[int], common_ones: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each set its signatures in its instance, and in how many parts a set that is equal must meet it.

    Leaving the same elements out of two sets doesn't take them farther apart, so sets
    sign without ``common_ones`` (sorted). A set with more empty cells than it may have
    signs again on the next level, with all its elements and another partition of the
    domain each time; the empty cells of the last level are signatures too. Of two sets
    that link the one that needs fewer levels has enough full cells on its last one, and
    the other signs there too.
    """
    out: list[list] = [[] for _ in sets]
    todo = [i for i, j in enumerate(instances) if scheme(j)[0] and len(sets[i])]
    if todo:
        flat = np.concatenate([sets[i] for i in todo])
        if len(common_ones):
            rare = common_ones[np.minimum(np.searchsorted(common_ones, flat), len(common_ones) - 1)] != flat
        else:
            rare = np.ones(len(flat), bool)
        cuts = np.cumsum([len(sets[i]) for i in todo])[:-1]
        elements = dict(zip(todo, (sets[i][keep] for i, keep in zip(todo, np.split(rare, cuts)))))
    for level in range(LEVELS):
        if not todo:
            break
        large = [i for i in todo if scheme(instances[i])[0] > 1]
        signed = dict(zip(large, _large([elements[i] for i in large], [instances[i] for i in large], level))) if large else {}
        again = []
        for i in todo:
            sigs, empty = signed[i] if i in signed else _small(elements[i], instances[i], level)
            n1, _, _, spare = scheme(instances[i], level)
            allowed = spare * 3 // 5
            out[i].append((mixed(sigs[~empty], 20 + level), n1 - allowed if n1 > 1 else 0))
            lacking = int(empty.reshape(-1, scheme(instances[i], level)[1]).any(1).sum()) if i in signed else int(empty.any())
            if lacking > allowed:
                elements[i] = sets[i]
                again.append(i)
                if level == LEVELS - 1:
                    out[i].append((mixed(sigs[empty], 40), 0))
        todo = again
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return [
        (np.concatenate([x for x, _ in o]), np.repeat(np.array([n for _, n in o], np.int32), [len(x) for x, _ in o])) if o else nothing
        for o in out
    ]


def _set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sums of scrambled elements for each set; equal for equal sets."""
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    out = []
    for salt in (5, 6):
        p = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(mixed(flat, salt), out=p[1:])
        out.append((p[at[1:]] - p[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _sets(batches):
    for batch in batches:
        for run, sets in _shingled(batch):
            a, b = _set_ids(sets)
            ids = batch.column("doc_id").slice(run.start, run.stop - run.start)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "n": n, "a": a, "b": b})


#: Entries of the shingle count in one task's group, about.
PART = 1 << 22
#: Place of a shingle that several documents of a run have.
SHARED = 0xFFFF


def _dealer(parts: int):
    """A map of documents to (part, run, head, body): their shingles by ranges of the hash, a run of texts at a time.

    A body has 32 bits of each shingle's hash beyond its part and the document's place
    in the run; a shingle leaves a run once, however many documents have it. The head
    has the run's doc_ids and set sizes.
    """
    bits = parts.bit_length() - 1

    def dealt(batches):
        for batch in batches:
            for run, found in _shingled(batch):
                ids = batch.column("doc_id").slice(run.start, run.stop - run.start).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = np.array([len(s) for s in found], np.int64)
                if not sizes.sum():
                    continue
                flat, place = np.concatenate(found), np.repeat(np.arange(len(found), dtype=np.uint16), sizes)
                order = np.argsort(flat)
                flat, place = flat[order], place[order]
                new = np.concatenate([[True], flat[1:] != flat[:-1]])
                alone = new & np.concatenate([new[1:], [True]])
                place = np.where(alone, place, np.uint16(SHARED))[new]
                flat = flat[new]
                part = (flat >> np.uint64(64 - bits)).astype(np.int64)
                low = (flat >> np.uint64(32 - bits)).astype(np.uint32)
                # The same documents give the same name, also when a lost task runs again.
                name = int(mixed(np.array([mixed(flat).sum(), mixed(ids.view(np.uint64), 9).sum()], np.uint64)).sum().view(np.int64))
                at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                ends = np.concatenate([at[1:], [len(part)]])
                bodies = [low[x:y].tobytes() + place[x:y].tobytes() for x, y in zip(at.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([*part[at].tolist(), name % parts], pa.int32()),
                        "run": pa.array([name] * (len(at) + 1), pa.int64()),
                        "head": pa.array([False] * len(at) + [True]),
                        "body": pa.array([*bodies, ids.tobytes() + sizes.tobytes()], pa.binary()),
                    }
                )

    return dealt


_COUNTS = pa.schema([("run", pa.int64()), ("head", pa.bool_()), ("body", pa.binary())])


def _counted(table: pa.Table) -> pa.Table:
    """One part's shingles -> by run, how many of each document are held by no other one; heads pass."""
    heads = table.filter(table.column("head")).select(_COUNTS.names).cast(_COUNTS)
    table = table.filter(pa.compute.invert(table.column("head")))
    bodies = table.column("body").to_pylist()
    if not bodies:
        return heads
    n = [len(x) // 6 for x in bodies]
    low = np.concatenate([np.frombuffer(x, np.uint32, k) for x, k in zip(bodies, n)])
    place = np.concatenate([np.frombuffer(x, np.uint16, k, 4 * k) for x, k in zip(bodies, n)])
    key = (low.astype(np.uint64) << np.uint64(32)) | np.arange(len(low), dtype=np.uint64)
    key.sort()
    new = np.concatenate([[True], key[1:] >> np.uint64(32) != key[:-1] >> np.uint64(32)])
    own = (key[new & np.concatenate([new[1:], [True]])] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    own = own[place[own] != SHARED]
    row = np.repeat(np.arange(len(n)), n)[own]
    kinds, counts = np.unique((row << 16) | place[own], return_counts=True)
    cuts = np.searchsorted(kinds >> 16, np.arange(len(n) + 1)).tolist()
    place, counts = (kinds & 0xFFFF).astype(np.uint16), counts.astype(np.uint32)
    bodies = [counts[x:y].tobytes() + place[x:y].tobytes() for x, y in zip(cuts, cuts[1:])]
    runs = table.column("run").to_pylist()
    kept = [(r, b) for r, b in zip(runs, bodies) if b]
    out = {"run": [r for r, _ in kept], "head": [False] * len(kept), "body": [b for _, b in kept]}
    return pa.concat_tables([heads, pa.table(out, schema=_COUNTS)])


def _summed(table: pa.Table) -> pa.Table:
    """One run's counts -> (doc_id, n, own)."""
    head, counts = None, []
    for is_head, body in zip(table.column("head").to_pylist(), table.column("body").to_pylist()):
        if is_head:
            head = np.frombuffer(body, np.int64)
        else:
            counts.append(body)
    ids, n = head[: len(head) // 2], head[len(head) // 2 :]
    own = np.zeros(len(ids), np.int64)
    for body in counts:
        k = len(body) // 6
        own[np.frombuffer(body, np.uint16, k, 4 * k)] += np.frombuffer(body, np.uint32, k)
    return pa.table({"doc_id": ids, "n": n, "own": own})


def _able(texts: DataFrame, shingles_in_all: int) -> DataFrame:
    """(doc_id, n): documents so many of whose shingles others have that they may link with one.

    ``own`` is never more than the truth, as truncated hashes and runs with the same
    documents only make shingles look shared.
    """
    parts = 1 << max(6, (shingles_in_all // PART).bit_length())
    dealt = texts.mapInArrow(_dealer(parts), "part int, run long, head boolean, body binary")
    counted = dealt.groupBy("part").applyInArrow(_counted, "run long, head boolean, body binary")
    summed = counted.groupBy("run").applyInArrow(_summed, "doc_id long, n long, own long")
    return summed.where(f"n > 0 and (n - own) * 100 >= n * {PERCENT}").select("doc_id", "n")


def _signer(common_ones: np.ndarray):
    """A map of documents to (sig, doc_id, need) rows."""

    def signed(batches):
        for batch in batches:
            for run, sets in _shingled(batch):
                owners = batch.column("doc_id").slice(run.start, run.stop - run.start).to_numpy(zero_copy_only=False)
                own = np.searchsorted(_TOPS, [len(s) for s in sets])
                for up in (0, 1):
                    rows = signatures(sets, [int(j) + up for j in own], common_ones)
                    if sum(len(x) for x, _ in rows):
                        yield pa.RecordBatch.from_pydict(
                            {
                                "sig": np.concatenate([x for x, _ in rows]).view(np.int64),
                                "doc_id": np.repeat(owners.astype(np.int64), [len(x) for x, _ in rows]),
                                "need": np.concatenate([n for _, n in rows]),
                            }
                        )

    return signed


#: Sets that are looked at for common shingles, in how many of them one is common, and how many are left out at most.
#: Which are found changes the work only, not the result.
SAMPLE, COMMON, MOST_COMMON = 3000, 3, 1 << 16


def _common_shingles(texts: DataFrame, work: common.Scratch) -> np.ndarray:
    """Shingles that many dissimilar documents have, such as those of boilerplate lines."""
    few = texts.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    chosen = texts.join(F.broadcast(few), "doc_id").mapInArrow(_exploded, "doc_id long, h long")
    chosen = work.stage(chosen, "ngram-sample")
    often = chosen.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    # Documents most of whose shingles are common are near copies of each other: theirs don't count.
    shares = chosen.join(often, "h").groupBy("doc_id").agg(F.avg((F.col("df") >= COMMON).cast("int")).alias("share"))
    apart = chosen.join(shares.where("share <= 0.5"), "doc_id")
    often = apart.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= COMMON)
    rows = often.orderBy(F.desc("df"), "h").limit(MOST_COMMON).select("h").collect()
    work.drop("ngram-sample")
    return np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))


def _exploded(batches):
    """(doc_id, h): the shingles of texts."""
    for batch in batches:
        for run, found in _shingled(batch):
            ids = batch.column("doc_id").slice(run.start, run.stop - run.start).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": np.repeat(ids, [len(s) for s in found]), "h": np.concatenate(found).view(np.int64)})


def _verified(batches):
    """Pairs (a, b) with their texts -> (a, b) of those that link."""
    last, held = None, np.zeros(0, np.uint64)
    for batch in batches:
        linked = []
        for a, x, y in zip(batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b")):
            if last != (a, x):
                last, held = (a, x), shingles([(x.as_py() or "").encode()])[0]
            t = shingles([(y.as_py() or "").encode()])[0]
            both = len(np.intersect1d(held, t, assume_unique=True))
            linked.append(100 * both >= PERCENT * (len(held) + len(t) - both) and both > 0)
        yield pa.RecordBatch.from_pydict({"a": batch.column("a"), "b": batch.column("b")}).filter(pa.array(linked, pa.bool_()))


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of doc_ids that link."""
    a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(_verified, "a long, b long")


#: Shingles in a block, about; and the ratio of neighbouring size bands of a cluster's blocks.
BLOCK, BAND = 1 << 16, 1.05
#: Bands farther apart hold no sets that can link.
FAR = int(np.ceil(np.log(100 / PERCENT) / np.log(BAND))) + 1


def _compared(table: pa.Table) -> pa.Table:
    """Two blocks' documents (left, doc_id, c, text), or one's -> links between components, a forest of them."""
    left = np.array(table.column("left").to_pylist(), bool)
    ids, label = table.column("doc_id").to_pylist(), table.column("c").to_pylist()
    sets = []
    for batch in table.select(["text"]).to_batches():
        for _, found in _shingled(batch):
            sets += found
    flat, size = np.concatenate(sets), np.array([len(s) for s in sets])
    _, flat = np.unique(flat, return_inverse=True)
    begin = np.concatenate([[0], np.cumsum(size)])
    right = np.arange(len(sets)) if left.all() else np.flatnonzero(~left)
    there = np.concatenate([flat[begin[j] : begin[j + 1]] for j in right])
    at = np.concatenate([[0], np.cumsum(size[right])])[:-1]
    root = {c: c for c in label}

    def find(c):
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    links, here = [], np.zeros(int(flat.max()) + 1 if len(flat) else 1, np.int32)
    for i in np.flatnonzero(left).tolist():
        mine = flat[begin[i] : begin[i + 1]]
        here[mine] = 1
        both = np.add.reduceat(here[there], at)
        here[mine] = 0
        for j in right[100 * both >= PERCENT * (size[i] + size[right] - both)].tolist():
            x, y = find(label[i]), find(label[j])
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _blocks(live: DataFrame, sized: DataFrame, work: common.Scratch) -> tuple[DataFrame, DataFrame]:
    """Blocks (block, doc_id, n) of the documents of ``live`` (sig, doc_id), and the tasks (task, block, left) that compare them.

    Documents that share buckets, over any number of steps, are a cluster. A small one is
    a block; a large one is dealt by size and hash, and two of its blocks are a task if
    they share a bucket and their sizes are near enough.
    """
    hubs = live.groupBy("sig").agg(F.min("doc_id").alias("hub"))
    edges = live.join(hubs, "sig").where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    edges = work.stage(edges, "ngram-edges")
    clusters = components(edges, "ngram-clusters").withColumnsRenamed({"node": "doc_id", "component": "cluster"})
    of = work.stage(clusters.join(sized, "doc_id"), "ngram-clustered")
    total = of.groupBy("cluster").agg(F.sum("n").alias("all"))
    of = of.join(total, "cluster").withColumn("band", F.when(F.col("all") <= BLOCK, F.lit(0)).otherwise(F.floor(F.log(BAND, "n"))))
    total = of.groupBy("cluster", "band").agg(F.ceil(F.sum("n") / BLOCK).alias("k"))
    of = of.join(total, ["cluster", "band"]).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("k")))
    blocks = of.select(F.struct("cluster", "band", "part").alias("block"), "doc_id", "n", (F.col("all") > BLOCK).alias("dealt"))
    blocks = work.stage(blocks, "ngram-blocks")
    alone = blocks.select("block").distinct()
    alone = alone.select(F.struct(F.col("block").alias("p"), F.col("block").alias("q")).alias("task"))
    held = live.join(blocks.where("dealt"), "doc_id").select("sig", "block").distinct()
    held = work.stage(held, "ngram-held")
    near = F.abs(F.col("p.band") - F.col("q.band")) <= FAR
    two = held.withColumnRenamed("block", "p").join(held.withColumnRenamed("block", "q"), "sig")
    two = two.where(near & (F.col("p") < F.col("q"))).select(F.struct("p", "q").alias("task")).distinct()
    tasks = work.stage(alone.union(two), "ngram-tasks")
    sides = tasks.select("task", F.col("task.p").alias("block"), F.lit(True).alias("left")).union(
        tasks.where("task.p <> task.q").select("task", F.col("task.q").alias("block"), F.lit(False).alias("left"))
    )
    return blocks, sides


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their shingle sets is at least 0.8;
    component_id is the smallest doc_id reachable by links. Null, empty and blank texts
    have no shingles and link with nothing; texts of less than five words are one
    shingle. Rows with a null doc_id link with nothing and have a null component_id.
    Rows that repeat a doc_id are taken as one document with all their links. An empty
    table gives an empty result; other columns are ignored.
    """
    work = common.Scratch(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = work.stage(docs.mapInArrow(_sets, "doc_id long, n long, a long, b long"), "ngram-sets")
    known = sets.where("n > 0 and doc_id is not null")
    classes = known.groupBy("a", "b", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = known.join(classes.where("copies > 1"), ["a", "b", "n"]).where("doc_id <> rep").select("doc_id", "rep").distinct()
    copies = work.stage(classes, "ngram-copies")
    # Documents that only repeat another's set are linked by it; those with several texts search with all.
    own = F.struct("a", "b", "n")
    several = known.groupBy("doc_id").agg(F.min(own).alias("x"), F.max(own).alias("y")).where("x <> y").select("doc_id")
    repeats = work.stage(copies.select("doc_id").distinct().join(several, "doc_id", "left_anti"), "ngram-repeats")

    searching = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    searching = common.rows_without_ids(searching, "doc_id", repeats)
    able = work.stage(_able(searching, known.agg(F.sum("n")).first()[0] or 0), "ngram-able")
    texts = common.rows_with_ids(searching, "doc_id", able.select("doc_id")).join(able, "doc_id", "left_semi")
    texts = work.stage(texts, "ngram-texts")
    work.drop("ngram-repeats")

    signed = texts.mapInArrow(_signer(_common_shingles(texts, work)), "sig long, doc_id long, need int")
    signed = work.stage(signed, "ngram-signed")
    hubs = signed.groupBy("sig").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("last")).where("hub < last")
    met = work.stage(signed.join(hubs.select("sig", "hub"), "sig"), "ngram-met")
    work.drop("ngram-signed")

    # Each document is verified with the hub it met most; documents that link meet in so many parts at least.
    sizes = able.groupBy("doc_id").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    pairs = met.where("doc_id <> hub").groupBy("hub", "doc_id", "need").agg(F.count(F.lit(1)).alias("n"))
    of = lambda c: sizes.select(F.col("doc_id").alias(c), F.col("least").alias(f"l_{c}"), F.col("most").alias(f"m_{c}"))
    # Each two elements that differ take one part at most from those in which the sets must meet.
    enough = F.greatest(F.lit(1), F.col("need") - F.expr(f"(m_hub + m_doc_id) * {100 - PERCENT} div {100 + PERCENT} div 2"))
    fits = (F.col("m_hub") * 100 >= F.col("l_doc_id") * PERCENT) & (F.col("m_doc_id") * 100 >= F.col("l_hub") * PERCENT)
    pairs = pairs.join(of("hub"), "hub").join(of("doc_id"), "doc_id").where(fits & (F.col("n") >= enough))
    best = pairs.groupBy("doc_id").agg(F.max_by("hub", F.struct("n", -F.col("hub"))).alias("a"))
    best = work.stage(best.select("a", F.col("doc_id").alias("b")), "ngram-best")
    linked = work.stage(_verify(best, texts), "ngram-linked")
    links = linked.union(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    found = components(links, "ngram-first")

    # Buckets that still hold several components are compared in full.
    placed = met.select("sig", "doc_id").distinct().join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    placed = placed.select("sig", "doc_id", F.coalesce("component", "doc_id").alias("c"))
    split = placed.groupBy("sig").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("sig")
    live = work.stage(placed.join(split, "sig", "left_semi"), "ngram-live")
    work.drop("ngram-met", "ngram-best")
    blocks, sides = _blocks(live.select("sig", "doc_id"), able, work)
    where = live.select("doc_id", "c").distinct()
    members = work.stage(blocks.select("block", "doc_id").distinct().join(where, "doc_id"), "ngram-members")
    rows = sides.join(members, "block").join(texts, "doc_id").select("task", "left", "doc_id", "c", "text")
    more = work.stage(rows.groupBy("task").applyInArrow(_compared, "a long, b long"), "ngram-more")
    if not more.isEmpty():
        found = components(links.union(more), "ngram-last")
    result = found.select(F.col("node").alias("doc_id"), "component")
    work.drop(*(tag for tag in list(work.paths) if tag != "ngram-sets"))
    return sets.join(result, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def op3_ngram_join(spark, sf_dir):
    return jaccard_components(common.read(spark, sf_dir, "documents"))


def keep_one(spark, docs, sf_dir):
    """Pipeline stage: of each component the document with the smallest doc_id; rows without a doc_id stay."""
    gone = jaccard_components(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM w
), e AS (SELECT doc_id, unnest(s) AS sh FROM s),
i AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM i JOIN s p ON p.doc_id = x JOIN s q ON q.doc_id = y
  WHERE 100 * shared >= 80 * (len(p.s) + len(q.s) - shared)
), r AS (
  WITH RECURSIVE t(n, c) AS (
    SELECT doc_id, doc_id FROM s
    UNION
    SELECT b.n, t.c FROM t JOIN (SELECT x AS m, y AS n FROM l UNION ALL SELECT y, x FROM l) b ON b.m = t.n
  ) SELECT n, min(c) AS c FROM t GROUP BY n
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, r.c AS component_id FROM s JOIN r ON r.n = s.doc_id
"""
