"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

Seeds are minimizers: of STEP neighbouring K-word windows the one with the smallest
hash. A first pass finds out which seeds several documents have; only their places are
carried on, each with CONTEXT words on both sides (four bits a word). All places are
sorted by seed and the words after it, and again by seed and the words before it. A
place is compared with its neighbours of other documents in both orders. Of those that
have a similar stretch of CHAIN words around the seed it is joined with the most similar
one and with the smallest document. That finds most partners in linear time. Seeds with
more places than that compares are searched in full: their places are dealt to blocks,
and in a task of two blocks each place is compared with all of the other one. Of its
similar places it is joined with those that reach farthest to either side, and with the
most similar one; so work grows with the square of a seed's places, rows don't.

The matches of two documents are chained in order of both, with a cost for gaps,
through a Fenwick tree of best scores; chains, also of one match, are aligned word by
word between their seeds and beyond their ends. Stretches that are similar enough count
on both sides, and stretches of a document that touch are one passage.

Texts of equal words are one class: one of them is searched, and each is one passage
from end to end.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from . import common
from .tokens import mixed, text_runs, window_hashes, words_of

K, STEP = 5, 6
#: Seeds of a run of a few repeated words of which one is taken; less than CHAIN words.
EVERY = 8
#: Words between two seeds of a chain at most, in either document, and how far the two may differ.
GAP, SLIP = 40, 16
#: A chain counts with so many words and this share of equal ones; passages are at least PASSAGE words.
CHAIN, SHARE, PASSAGE = 24, 0.8, 45
#: Words around a chain in which its ends are searched.
MARGIN = 48
#: Words on each side of a seed that go with its place, and neighbours on each side that a place is compared with.
CONTEXT, NEAR = 24, 3
#: Words beside the seed that places of a group share, and by how many a later candidate must be more similar.
PREFIX, BETTER = 8, 3
#: Places in a block of a seed's places, about, and pairs of places that a task compares at once.
BLOCK, PAIRS = 1 << 12, 1 << 17
#: Places of a task from which they are compared as rows and columns, not as a list of pairs.
TILE = 64
#: Words of a stretch of CHAIN words through a seed that must be equal beside it, or one word off.
SIDE = CHAIN - K
LEAST = int(SHARE * CHAIN) - K
#: The bitmap of shared seeds: 16 MB, whatever the input.
BITMAP_BITS = 27
#: Seeds in one task's group, about.
PART = 1 << 22

_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def _hashed(batch):
    """(slice, word hashes, first) by runs of the batch's texts."""
    for run, texts in text_runs(batch):
        h, _, _, first = words_of([t.decode().lower().encode() for t in texts], _BLANK)
        yield run, h, first


def minimizers(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, positions in ``h``) of some texts' words."""
    v = window_hashes(h, tuple(range(K)))
    if len(v) < STEP:
        return v[:0], np.zeros(0, np.int64)
    low = np.uint64((1 << 30) - 1)
    w = (v & ~low) | np.arange(len(v), dtype=np.uint64)
    width = 1
    while width * 2 <= STEP:
        w = np.minimum(w[:-width], w[width:])
        width *= 2
    w = np.minimum(w[: len(w) - (STEP - width)], w[STEP - width :])
    text = np.searchsorted(first, np.arange(len(w)), side="right") - 1
    at = (w[np.arange(len(w)) + STEP + K - 1 <= first[text + 1]] & low).astype(np.int64)
    if not len(at):
        return v[at], at
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    # In a run that repeats less than K words, such as one word, the first seed stands for EVERY.
    again = np.concatenate([[False], (v[at[1:]] == v[at[:-1]]) & (np.diff(at) < K)])
    begin = np.flatnonzero(~again)
    at = at[(np.arange(len(at)) - np.repeat(begin, np.diff(np.append(begin, len(at))))) % EVERY == 0]
    return v[at], at


def _listed(batches):
    """(doc, n, a, b): number of words and digest of each text."""
    for batch in batches:
        for run, h, first in _hashed(batch):
            d = [hashlib.blake2b(h[i:j].tobytes(), digest_size=16).digest() for i, j in zip(first[:-1], first[1:])]
            d = np.frombuffer(b"".join(d), "<i8").reshape(-1, 2)
            ids = batch.column("doc").slice(run.start, run.stop - run.start)
            yield pa.RecordBatch.from_pydict({"doc": ids, "n": np.diff(first).astype(np.int64), "a": d[:, 0].copy(), "b": d[:, 1].copy()})


def _ranges(seeds: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each seed the part of the hash range, and 32 bits beyond it."""
    bits = parts.bit_length() - 1
    return (seeds >> np.uint64(64 - bits)).astype(np.int64), (seeds >> np.uint64(32 - bits)).astype(np.uint32)


def _probes(part: np.ndarray, low: np.ndarray, parts: int) -> list[np.ndarray]:
    """Two bits of the bitmap for each seed, in its part's slice."""
    size = (1 << BITMAP_BITS) // parts
    return [part * size + (mixed(low.astype(np.uint64), salt) % np.uint64(size)).astype(np.int64) for salt in (31, 32)]


def _dealer(parts: int):
    """A map of documents to (part, body): the seeds of a run of texts, once each, and whether two of its documents have them."""

    def dealt(batches):
        for batch in batches:
            for _, h, first in _hashed(batch):
                seeds, at = minimizers(h, first)
                if not len(seeds):
                    continue
                text = np.searchsorted(first, at, side="right") - 1
                order = np.lexsort((text, seeds))
                seeds, text = seeds[order], text[order]
                new = np.flatnonzero(np.concatenate([[True], seeds[1:] != seeds[:-1]]))
                several = (text[new] != text[np.append(new[1:], len(text)) - 1]).astype(np.uint8)
                part, low = _ranges(seeds[new], parts)
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
                ends = np.append(cuts[1:], len(part))
                bodies = [low[x:y].tobytes() + several[x:y].tobytes() for x, y in zip(cuts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict({"part": pa.array(part[cuts], pa.int32()), "body": pa.array(bodies, pa.binary())})

    return dealt


def _shared(parts: int):
    """A map of one part's seeds to its slice of the bitmap of those that several documents have."""

    def shared(key, table):
        bodies = table.column("body").to_pylist()
        n = [len(x) // 5 for x in bodies]
        low = np.concatenate([np.frombuffer(x, np.uint32, k) for x, k in zip(bodies, n)])
        several = np.concatenate([np.frombuffer(x, np.uint8, k, 4 * k) for x, k in zip(bodies, n)])
        order = np.argsort(low)
        low, several = low[order], several[order]
        begin = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        held = np.diff(np.append(begin, len(low))) + np.add.reduceat(several.astype(np.int64), begin)
        part = key[0].as_py()
        size = (1 << BITMAP_BITS) // parts
        bits = np.zeros(size, np.uint8)
        for probe in _probes(np.full(int((held > 1).sum()), part), low[begin[held > 1]], parts):
            bits[probe - part * size] = 1
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    return shared


def _shared_seeds(docs: DataFrame, words: int) -> tuple[bytes, int]:
    """The bitmap of seeds that several documents have, and its number of parts."""
    parts = 1 << min(16, max(6, (words // PART).bit_length()))
    dealt = docs.mapInArrow(_dealer(parts), "part int, body binary")
    slices = dealt.groupBy("part").applyInArrow(_shared(parts), "part int, bits binary").collect()  # 2**BITMAP_BITS bits
    out = np.zeros((parts, (1 << BITMAP_BITS) // parts // 8), np.uint8)
    for r in slices:
        out[r.part] = np.frombuffer(bytes(r.bits), np.uint8)
    return out.tobytes(), parts


def _nibbles(words: np.ndarray) -> np.ndarray:
    """Rows of CONTEXT words of four bits -> rows of bytes, in the same order."""
    return np.ascontiguousarray((words[:, ::2] << 4) | words[:, 1::2])


def _placer(bitmap, parts: int):
    """A map of documents to (seed, doc, pos, right, left): places of shared seeds with the words after and before them."""

    def placed(batches):
        table = np.frombuffer(bitmap.value, np.uint8)
        has = lambda b: (table[b >> 3] >> (7 - (b & 7)).astype(np.uint8)) & 1
        for batch in batches:
            for run, h, first in _hashed(batch):
                seeds, at = minimizers(h, first)
                if not len(seeds):
                    continue
                one, two = _probes(*_ranges(seeds, parts), parts)
                keep = (has(one) & has(two)) == 1
                seeds, at = seeds[keep], at[keep]
                text = np.searchsorted(first, at, side="right") - 1
                ids = batch.column("doc").slice(run.start, run.stop - run.start).to_numpy(zero_copy_only=False).astype(np.int64)
                short = np.append((h >> np.uint64(60)).astype(np.uint8), np.uint8(0))
                columns = {"seed": seeds.view(np.int64), "doc": ids[text], "pos": (at - first[text]).astype(np.int32)}
                for name, steps in (("right", K + np.arange(CONTEXT)), ("left", -1 - np.arange(CONTEXT))):
                    place = at[:, None] + steps
                    inside = (place >= first[text][:, None]) & (place < first[text + 1][:, None])
                    # Beyond a text's ends stand words that are as good as random.
                    other = (mixed(place.astype(np.uint64) * np.uint64(31) + ids[text].astype(np.uint64)[:, None], 33) >> np.uint64(60)).astype(np.uint8)
                    packed = _nibbles(np.where(inside, short[np.where(inside, place, len(h))], other))
                    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(CONTEXT // 2), len(at), [None, pa.py_buffer(packed)])
                    columns[name] = fixed.cast(pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return placed


def _sided(column) -> np.ndarray:
    """The words of a context column, one byte each."""
    packed = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CONTEXT // 2)
    out = np.empty((len(packed), CONTEXT), np.uint8)
    out[:, ::2], out[:, 1::2] = packed >> 4, packed & 15
    return out


def likeness(right: np.ndarray, left: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal words (or one word off) of the best stretch of SIDE words around the seeds of the places i and j."""

    def side(words: np.ndarray) -> np.ndarray:
        a, b = words[i], words[j]
        same = a[:, :SIDE] == b[:, :SIDE]
        same |= a[:, :SIDE] == b[:, 1 : SIDE + 1]
        same[:, 1:] |= a[:, 1:SIDE] == b[:, : SIDE - 1]
        out = np.zeros((len(i), SIDE + 1), np.int8)
        np.cumsum(same, axis=1, out=out[:, 1:])
        return out

    return (side(right) + side(left)[:, ::-1]).max(axis=1) if len(i) else np.zeros(0, np.int8)


def _matched_places(d: np.ndarray, p: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    """Matches (hub, doc, hub_pos, pos) of the places i and j; the smaller document is the hub."""
    turn = d[i] > d[j]
    hub, doc = np.where(turn, j, i), np.where(turn, i, j)
    schema = pa.schema([("hub", pa.int64()), ("doc", pa.int64()), ("hub_pos", pa.int32()), ("pos", pa.int32())])
    return pa.RecordBatch.from_arrays([pa.array(d[hub]), pa.array(d[doc]), pa.array(p[hub], pa.int32()), pa.array(p[doc], pa.int32())], schema=schema)


def _neighbours(batches, first_side: str):
    """Places in order of (seed, one side, doc, pos) -> their matches (hub, doc, hub_pos, pos) with similar ones."""

    def runs_of(rows):
        """Where runs of one document's places of a seed begin."""
        return np.concatenate([[0], np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1, [rows.shape[1]]])

    def smallest(group: np.ndarray, d: np.ndarray, p: np.ndarray) -> list[np.ndarray]:
        """Of each row places of its group's smallest and second smallest documents: its document's third place goes with their third one."""
        order = np.lexsort((p, d, group))
        g, e = group[order], d[order]
        at = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (e[1:] != e[:-1])]))  # one a document of a group
        size = np.diff(np.append(at, len(g)))
        rank = np.empty(len(g), np.int64)
        rank[order] = np.arange(len(g)) - np.repeat(at, size)
        heads = np.flatnonzero(np.concatenate([[True], g[at][1:] != g[at][:-1]]))
        one = heads[np.searchsorted(g[at][heads], group)]
        two = np.minimum(one + 1, len(at) - 1)
        two = np.where(g[at][two] == group, two, one)
        return [order[at[k] + np.minimum(rank, size[k] - 1)] for k in (one, two)]

    def done(rows, right, left, begin: int, end: int):
        s, d, p = rows
        cut = runs_of(rows)
        run = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        i = np.arange(begin, end)

        def tried(j, best, score, more: int = 0):
            """Takes the places j where they are similar, and more so by ``more`` words than those so far."""
            fits = (j >= 0) & (j < len(s)) & (score + more <= SIDE)
            fits[fits] = (s[j[fits]] == s[i[fits]]) & (d[j[fits]] != d[i[fits]])
            at = np.flatnonzero(fits)
            like = likeness(right, left, i[at], j[at])
            better = (like >= LEAST) & (like >= score[at] + more)
            best[at[better]], score[at[better]] = j[at[better]], like[better]

        # First the smallest documents of the seed's places, then of those that also share PREFIX words on this side.
        seed = np.cumsum(np.concatenate([[False], s[1:] != s[:-1]]))
        side = right if first_side == "right" else left
        near = np.cumsum(np.concatenate([[False], (s[1:] != s[:-1]) | (side[1:, :PREFIX] != side[:-1, :PREFIX]).any(axis=1)]))
        low, score = np.full(len(i), -1), np.zeros(len(i), np.int8)
        for group in (seed, near):
            for j in smallest(group, d, p):
                tried(j[i], low, score, BETTER)
        best = low.copy()
        for j in (cut[run[i]] - 1, cut[run[i] + 1], *(i + k for k in range(-NEAR, NEAR + 1) if k)):
            tried(j, best, score, BETTER)
        one, two = np.flatnonzero(low >= 0), np.flatnonzero((best >= 0) & (best != low))
        i, j = np.concatenate([i[one], i[two]]), np.concatenate([low[one], best[two]])
        return _matched_places(d, p, i, j)

    held, start = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("seed", "doc", "pos")])
        right, left = _sided(batch.column("right")), _sided(batch.column("left"))
        if held is not None:
            rows, right, left = np.concatenate([held[0], rows], axis=1), np.concatenate([held[1], right]), np.concatenate([held[2], left])
        cut = runs_of(rows)
        stay = min(int(cut[-2]), rows.shape[1] - NEAR)  # the last run may go on
        if stay > start:
            yield done(rows, right, left, start, stay)
            keep = max(0, min(stay - NEAR, int(cut[np.searchsorted(cut, stay, side="right") - 1]) - 1))
            rows, right, left, start = rows[:, keep:], right[keep:], left[keep:], stay - keep
        held = (rows, right, left)
    if held is not None:
        yield done(*held, start, held[0].shape[1])


def _front(words: np.ndarray) -> np.ndarray:
    """The first 16 words of context rows in 64 bits, the first one highest."""
    packed = _nibbles(words[:, :16]).astype(np.uint64)
    return (packed << np.arange(56, -8, -8).astype(np.uint64)).sum(axis=1, dtype=np.uint64)


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words of two fronts that are equal or may be so one word off."""
    four, ones = np.uint64(4), np.uint64(0x1111111111111111)

    def unequal(x: np.ndarray) -> np.ndarray:
        x |= x >> np.uint64(1)
        x |= x >> np.uint64(2)
        return x & ones

    # The last word's later neighbour is not in the front, and the first has none before it.
    last, first = np.uint64(0xFFFFFFFFFFFFFFF0), np.uint64(0x0FFFFFFFFFFFFFFF)
    off = unequal(a ^ b) & unequal(a ^ (b << four)) & last & (unequal(a ^ (b >> four)) | ~first)
    return np.uint8(16) - np.bitwise_count(off)


def may_fit(right: np.ndarray, left: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether ``likeness`` of the fronts' places i and j can reach LEAST; never false where it does.

    Of the SIDE words either all lie in the two fronts, or all but SIDE - 16 in one.
    """
    r, w = _agreeing(right[i], right[j]), _agreeing(left[i], left[j])
    return (r + w >= LEAST) | (r >= LEAST - (SIDE - 16)) | (w >= LEAST - (SIDE - 16))


def _planes(right: np.ndarray, left: np.ndarray) -> np.ndarray:
    """(3, 4, places): four bits of all words of a place, of those one word on and of those one word back, the words after it in the low half of 64 bits."""
    moved = np.arange(CONTEXT), np.append(np.arange(1, CONTEXT), CONTEXT - 1), np.append(0, np.arange(CONTEXT - 1))  # at the ends a word stands again
    out = np.zeros((3, 4, len(right), 8), np.uint8)
    for plane, at in zip(out, moved):
        for first, words in ((0, right), (4, left)):
            for bit in range(4):
                plane[bit, :, first : first + CONTEXT // 8] = np.packbits(words[:, at] >> bit & 1, axis=1, bitorder="little")
    return out.view("<u8")[..., 0]


def _tile(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Like ``may_fit``, of places in rows with places in columns, by their planes."""
    missed = []
    unequal, more, off = (np.empty((one.shape[-1], two.shape[-1]), np.uint16) for _ in range(3))
    for low in (0, 32):
        a, b = ((x >> np.uint64(low)).astype(np.uint16) for x in (one[0], two))  # the first 16 words
        for n, moved in enumerate(b):
            out = unequal if n else off
            np.bitwise_xor(a[0][:, None], moved[0], out=out)
            for k in range(1, 4):
                np.bitwise_xor(a[k][:, None], moved[k], out=more)
                out |= more
            if n:
                off &= unequal
        missed.append(np.bitwise_count(off))
    most = 16 - (LEAST - (SIDE - 16))
    return (missed[0] <= most) | (missed[1] <= most) | (missed[0] + missed[1] <= 32 - LEAST)


def _compared(planes: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which words around the places i and j are equal, and which are equal or one word off, as their planes have them."""
    a = [x[i] for x in planes[0]]
    equal = near = None
    for moved in planes:
        unequal = a[0] ^ moved[0][j]
        for k in range(1, 4):
            unequal |= a[k] ^ moved[k][j]
        equal = ~unequal if equal is None else equal
        near = equal.copy() if near is None else near | ~unequal
    return equal, near


def _bits(x: np.ndarray) -> np.ndarray:
    """The bits of 64-bit numbers in rows, the lowest first."""
    parts = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return ((parts[:, None] & (1 << np.arange(8, dtype=np.uint8))[:, None]) != 0).view(np.int8).reshape(64, -1)


def alike(near: np.ndarray) -> np.ndarray:
    """Whether ``likeness`` of two places reaches LEAST, by the words that are equal or one word off."""
    same = _bits(near)
    level = same[32 : 32 + SIDE].sum(axis=0, dtype=np.int8)
    out = level >= LEAST
    for k in range(SIDE):
        level += same[k]
        level -= same[32 + SIDE - 1 - k]
        out |= level >= LEAST
    return out


def reaches(equal: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How far to the right and left stretches of CHAIN words and SHARE through two places' seeds reach, and all equal words."""
    down, whole = Fraction(SHARE).limit_denominator(20).as_integer_ratio()
    up = whole - down
    lowest = np.int8(-up * (2 * CONTEXT + K) - 1)  # no stretch counts that goes on from there
    same = _bits(equal)
    level = np.zeros((2, CONTEXT + 1, len(equal)), np.int8)
    for out, first in zip(level, (0, 32)):
        for k in range(CONTEXT):
            np.multiply(same[first + k], np.int8(whole), out=out[k + 1])
            out[k + 1] -= np.int8(down)
            out[k + 1] += out[k]
            np.maximum(out[k + 1], lowest, out=out[k + 1])
    ahead = level.copy()  # the best level with so many words or more
    for k in range(CONTEXT - 1, -1, -1):
        np.maximum(ahead[:, k], ahead[:, k + 1], out=ahead[:, k])
    found = []
    for own, other in ((0, 1), (1, 0)):
        reach = np.zeros(len(equal), np.int8)
        for k in range(CONTEXT + 1):
            good = level[own, k] + ahead[other, max(SIDE - k, 0)] >= -K * up
            np.maximum(reach, good.view(np.int8) * np.int8(k + 1), out=reach)
        found.append(reach - np.int8(1))
    held = np.uint64((1 << CONTEXT) - 1)
    return found[0], found[1], np.bitwise_count(equal & (held | held << np.uint64(32)))


def _may_fit_of(right: np.ndarray, left: np.ndarray, planes: np.ndarray, here: np.ndarray, begin: np.ndarray, end: np.ndarray):
    """Pairs (i, j) of the places ``here`` with those from ``begin`` to ``end`` that may fit, in order; all of a place in one yield."""
    size = end - begin
    few, many = np.flatnonzero(size < TILE), np.flatnonzero(size >= TILE)
    fronts = _front(right), _front(left)
    total = np.cumsum(size[few])
    x = 0
    while x < len(few):
        y = max(x + 1, int(np.searchsorted(total, (total[x - 1] if x else 0) + PAIRS, side="right")))
        n = size[few[x:y]]
        i = np.repeat(here[few[x:y]], n)
        j = np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[few[x:y]], n)
        fits = may_fit(*fronts, i, j)
        yield i[fits], j[fits]
        x = y
    for run in np.split(many, np.flatnonzero(np.diff(begin[many])) + 1) if len(many) else []:
        low, n = begin[run[0]], size[run[0]]
        step = max(1, PAIRS // n)
        for x in range(0, len(run), step):
            i = here[run[x : x + step]]
            row, column = np.divmod(np.flatnonzero(_tile(planes[:, :, i], planes[:, :, low : low + n])), n)
            yield i[row], low + column


def _searched(rows: np.ndarray, right: np.ndarray, left: np.ndarray):
    """Whole tasks (seed, p, q, side, doc, pos), in that order -> matches of each place with those of its task's other block, or of its only one."""
    # Places with equal words around them are one class; if several documents have them, they go with its first one and two stand for all.
    context = np.ascontiguousarray(np.concatenate([_nibbles(right), _nibbles(left)], axis=1)).view(np.uint64).T
    order = np.lexsort((rows[5], rows[4], *context, *rows[3::-1]))
    rows, right, left, context = rows[:, order], right[order], left[order], context[:, order]
    new = np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0) | (context[:, 1:] != context[:, :-1]).any(axis=0)])
    begin, of = np.flatnonzero(new), np.cumsum(new) - 1
    first = rows[4] == rows[4][begin][of]
    second = np.flatnonzero(~first & np.concatenate([[False], first[:-1]]))
    other = np.full(len(begin), -1)
    other[of[second]] = second
    shared = other[of] >= 0
    own = np.flatnonzero(shared & (rows[1] == rows[2]))
    if len(own):
        yield _matched_places(rows[4], rows[5], own, np.where(first[own], other[of[own]], begin[of[own]]))
    keep = ~shared
    keep[begin] = keep[second] = True
    rows, right, left, searches = rows[:, keep], right[keep], left[keep], ~shared[keep]
    s, p, q, side, d, at = rows
    cut = np.flatnonzero(np.concatenate([[True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0), [True]]))
    run = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
    # A task of two blocks has two runs next to each other, if both have places.
    twin = np.where(p == q, run, np.where(side == 0, run + 1, run - 1))
    held = (twin >= 0) & (twin < len(cut) - 1)
    held[held] = (rows[:3, cut[twin[held]]] == rows[:3][:, held]).all(axis=0)
    here = np.flatnonzero(searches & held)
    planes = _planes(right, left)
    order = np.lexsort((at, d))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order) - 1, -1, -1)  # of equal values that of the smallest document and place counts
    for i, j in _may_fit_of(right, left, planes, here, cut[twin[here]], cut[twin[here] + 1]):
        other = d[i] != d[j]
        i, j = i[other], j[other]
        equal, near = _compared(planes, i, j)
        fits = alike(near)
        i, j, equal = i[fits], j[fits], equal[fits]
        if len(i):
            begin = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
            best = [order[-1 - np.maximum.reduceat(value * len(order) + rank[j], begin) % len(order)] for value in map(np.int64, reaches(equal))]
            one, two = np.tile(i[begin], len(best)), np.concatenate(best)
            one, two = np.divmod(np.unique(one * len(order) + two), len(order))
            yield _matched_places(d, at, one, two)


def _exhaustive(batches):
    """Places in order of (seed, p, q, side), in tasks p, q -> matches of each place with all that its task compares it with."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("seed", "p", "q", "side", "doc", "pos")])
        now = rows, _sided(batch.column("right")), _sided(batch.column("left"))
        if held is not None:
            now = np.concatenate([held[0], now[0]], axis=1), np.concatenate([held[1], now[1]]), np.concatenate([held[2], now[2]])
        last = (now[0][:3] == now[0][:3, -1:]).all(axis=0)  # the last task may go on in the next batch
        stay = int(last.argmax())
        if stay:
            yield from _searched(now[0][:, :stay], now[1][:stay], now[2][:stay])
        held = now[0][:, stay:], now[1][stay:], now[2][stay:]
    if held is not None:
        yield from _searched(*held)


def _in_blocks(places: DataFrame) -> DataFrame:
    """Places of seeds with more of them than neighbours are compared, once for each task (seed, p, q) of theirs: two blocks, or one."""
    often = places.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NEAR + 1)
    k = F.ceil(F.col("n") / BLOCK)
    # Places with equal words around them are in one block.
    own = places.join(often, "seed").withColumns({"own": F.pmod(F.xxhash64("right", "left"), k), "other": F.explode(F.sequence(F.lit(0).cast("long"), k - 1))})
    return own.select(
        "seed", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).cast("int").alias("side"), "doc", "pos", "right", "left"
    )


class Fenwick:
    """Prefix maxima with their owners."""

    def __init__(self, n: int):
        self.best = [(float("-inf"), -1)] * (n + 1)

    def put(self, k: int, score: float, owner: int) -> None:
        k += 1
        entry = (score, owner)
        while k < len(self.best):
            if self.best[k] < entry:
                self.best[k] = entry
            k += k & -k

    def top(self, k: int) -> tuple[float, int]:
        """The best of the first k."""
        out = (float("-inf"), -1)
        while k > 0:
            if self.best[k] > out:
                out = self.best[k]
            k -= k & -k
        return out


def chains(x: list[int], y: list[int], seed_score: float = 10.0, gap_cost: float = 0.25) -> list[list[int]]:
    """Chains of matches (x, y), as lists of their numbers; y ascends.

    f(i) = seed_score + max(0, f(j) - gap_cost * (x_i - x_j + y_i - y_j)) over j that is
    smaller in both; the Fenwick tree over the ranks of x gives the best j.
    """
    rank = {v: k for k, v in enumerate(sorted(set(x)))}
    tree = Fenwick(len(rank))
    score, back = [0.0] * len(x), [-1] * len(x)
    at = 0
    while at < len(x):
        end = at
        while end < len(x) and y[end] == y[at]:  # equal y can't follow each other
            reach = gap_cost * (x[end] + y[end])
            top, j = tree.top(rank[x[end]])
            score[end] = seed_score
            if j >= 0 and top - reach > 0:
                score[end] += top - reach
                back[end] = j
            end += 1
        for i in range(at, end):
            tree.put(rank[x[i]], score[i] + gap_cost * (x[i] + y[i]), i)
        at = end
    used, out = [False] * len(x), []
    for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        chain.reverse()
        part: list[int] = []
        for i in chain:
            if part:
                dx, dy = x[i] - x[part[-1]], y[i] - y[part[-1]]
                if dx > GAP + K or dy > GAP + K or abs(dx - dy) > SLIP:
                    out.append(part)
                    part = []
            part.append(i)
        if part:
            out.append(part)
    return out


def needed(found: list[list[int]], x: list[int], y: list[int]) -> list[list[int]]:
    """Chains of two documents without those that lie in solid stretches of others, in both documents.

    A stretch is solid if its seeds leave out one word at most between them, so that
    SHARE of its words are equal whatever that word is; it has CHAIN words or more.
    """
    if len(found) < 2:
        return found
    low_x, low_y = min(x), min(y)
    solid_x, solid_y = np.zeros(max(x) - low_x + K, bool), np.zeros(max(y) - low_y + K, bool)
    out = []
    for c in sorted(found, key=len, reverse=True):
        x0, x1, y0, y1 = x[c[0]] - low_x, x[c[-1]] - low_x + K, y[c[0]] - low_y, y[c[-1]] - low_y + K
        if solid_x[x0:x1].all() and solid_y[y0:y1].all():
            continue
        out.append(c)
        begin = c[0]
        for i, j in zip(c, [*c[1:], -1]):
            if j < 0 or x[j] - x[i] != y[j] - y[i] or x[j] - x[i] > K + 1:
                n = x[i] - x[begin] + K
                if n >= CHAIN:
                    solid_x[x[begin] - low_x : x[i] - low_x + K] = True
                    solid_y[y[begin] - low_y : y[i] - low_y + K] = True
                begin = j
    return out


def _chained(batches):
    """Matches in order of (hub, doc, pos) -> chains (hub, doc, hub_from, hub_to, from, to, seeds)."""
    names = ["hub", "doc", "hub_from", "hub_to", "from", "to"]
    schema = pa.schema([(n, pa.int64()) for n in names] + [("seeds", pa.binary())])
    held: list[np.ndarray] = []

    def done(hub: np.ndarray, doc: np.ndarray, x: np.ndarray, y: np.ndarray):
        out: dict = {n: [] for n in schema.names}
        if len(hub):
            new = np.ones(len(hub), bool)  # a match that was found twice counts once
            new[1:] = (hub[1:] != hub[:-1]) | (doc[1:] != doc[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
            hub, doc, x, y = hub[new], doc[new], x[new], y[new]
            cut = np.flatnonzero((hub[1:] != hub[:-1]) | (doc[1:] != doc[:-1])) + 1
            begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(hub)]])
            for i, j in zip(begin.tolist(), end.tolist()):
                xs, ys = x[i:j].tolist(), y[i:j].tolist()
                for c in needed(chains(xs, ys), xs, ys) if j - i > 1 else [[0]]:
                    a, b = c[0], c[-1]
                    for n, v in zip(names, (hub[i], doc[i], xs[a] - MARGIN, xs[b] + K + MARGIN, ys[a] - MARGIN, ys[b] + K + MARGIN)):
                        out[n].append(int(v))
                    out["seeds"].append(np.array([[xs[k] for k in c], [ys[k] for k in c]], "<i4").tobytes())
        return pa.RecordBatch.from_pydict(out, schema=schema)

    for batch in batches:
        held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("hub", "doc", "hub_pos", "pos")]))
        now = np.concatenate(held, axis=1)
        same = (now[0] == now[0, -1]) & (now[1] == now[1, -1])  # the last pair may go on in the next batch
        stay = int(np.flatnonzero(same)[0]) if not same.all() else 0
        if stay:
            yield done(*now[:, :stay])
        held = [now[:, stay:]]
    if held:
        yield done(*np.concatenate(held, axis=1))


def _extracted(batches):
    """Rows (doc, text, parts array<struct<from, to>>) -> (doc, from, to, words)."""
    schema = pa.schema([("doc", pa.int64()), ("from", pa.int64()), ("to", pa.int64()), ("words", pa.binary())])
    for batch in batches:
        out: dict = {n: [] for n in schema.names}
        docs, parts = batch.column("doc").to_pylist(), batch.column("parts")
        for run, h, first in _hashed(batch):
            short = (h >> np.uint64(40)).astype("<u2")
            for k in range(run.start, run.stop):
                own = short[first[k - run.start] : first[k - run.start + 1]]
                for p in parts[k].as_py():
                    for n, v in zip(schema.names, (docs[k], p["from"], p["to"], own[max(0, p["from"]) : p["to"]].tobytes())):
                        out[n].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short runs of words."""
    row = [0] * (len(b) + 1)
    for v in a.tolist():
        last = 0
        for k, w in enumerate(b.tolist()):
            last, row[k + 1] = row[k + 1], last + 1 if v == w else max(row[k + 1], row[k])
    return row[-1]


def _extension(same: np.ndarray) -> tuple[int, int]:
    """(words, equal ones) of the best-scoring prefix: 1 for equal words, -2 for others."""
    if not len(same):
        return 0, 0
    score = np.cumsum(np.where(same, 1, -2))
    k = int(score.argmax())
    return (k + 1, int(same[: k + 1].sum())) if score[k] > 0 else (0, 0)


def align(hub: np.ndarray, doc: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[int, int, int, int, int]:
    """(hub from, hub to, from, to, equal words) of a chain with the seeds (x, y)."""
    equal = K
    for a, b, c, d in zip(x[:-1].tolist(), x[1:].tolist(), y[:-1].tolist(), y[1:].tolist()):
        # the words from one seed to the next; the last seed's K words are counted above
        if b - a == d - c:
            equal += int((hub[a:b] == doc[c:d]).sum())
        else:
            equal += _common(hub[a:b], doc[c:d])
    i, j = int(x[0]), int(y[0])
    n = min(i, j)
    more, good = _extension((hub[i - n : i] == doc[j - n : j])[::-1])
    hub_from, doc_from, equal = i - more, j - more, equal + good
    i, j = int(x[-1]) + K, int(y[-1]) + K
    n = min(len(hub) - i, len(doc) - j)
    more, good = _extension(hub[i : i + n] == doc[j : j + n])
    return hub_from, i + more, doc_from, j + more, equal + good


def _matched(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Places of a longest common subsequence of two short runs of words."""
    a, b = a.tolist(), b.tolist()
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def equal_words(hub: np.ndarray, doc: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Places (hub, doc) of the equal words of a chain with the seeds (x, y) and around it, in order."""
    n = int(min(x[0], y[0]))
    starts_x, starts_y = [int(x[0]) - n, *x.tolist()], [int(y[0]) - n, *y.tolist()]
    m = int(min(len(hub) - x[-1], len(doc) - y[-1]))
    out = []
    for a, b, c, d in zip(starts_x, [*starts_x[1:], int(x[-1]) + m], starts_y, [*starts_y[1:], int(y[-1]) + m]):
        if b - a == d - c:
            at = np.flatnonzero(hub[a:b] == doc[c:d])
            out.append(np.stack([at + a, at + c]))
        else:
            out.append(np.array(_matched(hub[a:b], doc[c:d]), np.int64).reshape(-1, 2).T + np.array([[a], [c]]))
    return np.concatenate(out, axis=1)


def good_parts(at: np.ndarray) -> list[tuple[int, int]]:
    """Stretches (first, last) of equal words ``at`` with CHAIN words and SHARE of equal ones in both documents.

    Together they cover all such stretches: from each run's begin the longest one, but
    for those inside others.
    """
    e = at.shape[1]
    if e < CHAIN * SHARE:
        return []
    level = 10 * np.arange(e) - round(SHARE * 10) * at  # by document; a stretch counts if 10 * equal >= 8 * words
    slack = 10 - round(SHARE * 10)
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1).any(axis=0)]))
    out: list[tuple[int, int]] = []
    for p in begins.tolist():
        fits = (level[:, p:] - level[:, p : p + 1] + slack >= 0).all(axis=0) & (at[:, p:] - at[:, p : p + 1] + 1 >= CHAIN).all(axis=0)
        if fits.any():
            q = p + int(np.flatnonzero(fits)[-1])
            if not out or q > out[-1][1]:
                out.append((p, q))
    return out


def _aligned(batches):
    """Chains with their words -> (doc, from, to, ref, share) for both documents of each that is similar enough, or of its parts that are."""
    schema = pa.schema([("doc", pa.int64()), ("from", pa.int64()), ("to", pa.int64()), ("ref", pa.int64()), ("share", pa.float64())])
    for batch in batches:
        out: dict = {n: [] for n in schema.names}
        for r in batch.to_pylist():
            x, y = np.frombuffer(r["seeds"], "<i4").reshape(2, -1)
            i, j = max(0, r["hub_from"]), max(0, r["from"])
            a, b, c, d, equal = align(np.frombuffer(r["hub_words"], "<u2"), np.frombuffer(r["words"], "<u2"), x - i, y - j)
            stretches = [(a, b, c, d, equal / max(b - a, d - c))]
            if min(b - a, d - c) < CHAIN or stretches[0][-1] < SHARE:  # good parts aren't lost with the others
                at = equal_words(np.frombuffer(r["hub_words"], "<u2"), np.frombuffer(r["words"], "<u2"), x - i, y - j)
                stretches = []
                for p, q in good_parts(at):
                    (a, c), (b, d) = at[:, p].tolist(), (at[:, q] + 1).tolist()
                    stretches.append((a, b, c, d, (q - p + 1) / max(b - a, d - c)))
            for a, b, c, d, share in stretches:
                for row in ((r["doc"], c + j, d + j, r["hub"], share), (r["hub"], a + i, b + i, r["doc"], share)):
                    for n, v in zip(schema.names, row):
                        out[n].append(v)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def fuzzy_passages(docs: DataFrame) -> DataFrame:
    """Passages of PASSAGE words or more that other documents have too, one row each.

    Returns doc_id, start_word, end_word, n_words, ref_doc_id (a document that has the
    best part of it) and identity (share of equal words there, at least 0.8; words count
    as equal if 16 bits of their hashes are). One stretch of a passage at least has
    PASSAGE words that one other document has. Words are runs of letters, digits and
    characters beyond ASCII, in lower case. Null, empty and short texts have no passages;
    rows without a doc_id are left out; rows that repeat a doc_id are one document and
    don't match each other. An empty table gives an empty result; other columns are
    ignored.
    """
    spark = docs.sparkSession
    work = common.Scratch(spark)
    docs = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), "text")
    rows = work.stage(docs.mapInArrow(_listed, "doc long, n long, a long, b long"), "chain-texts")
    classes = rows.where(F.col("n") >= PASSAGE).groupBy("a", "b").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
    copies = work.stage(rows.join(classes, ["a", "b"]).select("doc", "n", "low", "high"), "chain-copies")
    wholes = copies.select(
        "doc", F.lit(0).cast("long").alias("from"), F.col("n").alias("to"),
        F.when(F.col("doc") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("ref"), F.lit(1.0).alias("share"),
    )
    # Copies need no search beside their class's first document; those with further texts do.
    text = F.struct("a", "b")
    several = rows.groupBy("doc").agg(F.min(text).alias("x"), F.max(text).alias("y")).where("x <> y").select("doc")
    repeats = work.stage(copies.where("doc <> low").select("doc").distinct().join(several, "doc", "left_anti"), "chain-repeats")
    searched = common.rows_without_ids(docs, "doc", repeats)

    bitmap, parts = _shared_seeds(searched, rows.agg(F.sum("n")).first()[0] or 0)
    bitmap = spark.sparkContext.broadcast(bitmap)
    places = searched.mapInArrow(_placer(bitmap, parts), "seed long, doc long, pos int, right binary, left binary")
    places = work.stage(places, "chain-places")
    bitmap.unpersist()
    match = "hub long, doc long, hub_pos int, pos int"
    by = lambda side: places.repartitionByRange("seed", side, "doc").sortWithinPartitions("seed", side, "doc", "pos").mapInArrow(partial(_neighbours, first_side=side), match)
    tasks = _in_blocks(places).repartition("seed", "p", "q").sortWithinPartitions("seed", "p", "q", "side")
    # Each search is chained on its own: further matches may make other chains of two documents' repeats.
    searches = [work.stage(m, "chain-matches") for m in (by("right").union(by("left")), tasks.mapInArrow(_exhaustive, match))]
    work.drop("chain-places")
    found, more = (
        matches.repartition("hub", "doc")
        .sortWithinPartitions("hub", "doc", "pos", "hub_pos")
        .mapInArrow(_chained, "hub long, doc long, hub_from long, hub_to long, `from` long, `to` long, seeds binary")
        for matches in searches
    )
    found = found.union(more).distinct()
    found = work.stage(found, "chains")
    wanted = found.select("doc", "from", "to").union(found.select("hub", "hub_from", "hub_to")).distinct()
    wanted = work.stage(wanted.groupBy("doc").agg(F.collect_list(F.struct("from", "to")).alias("parts")), "chain-parts")
    texts = common.rows_with_ids(searched, "doc", wanted.select("doc"))
    words = texts.join(wanted, "doc").mapInArrow(_extracted, "doc long, `from` long, `to` long, words binary")
    words = work.stage(words.dropDuplicates(["doc", "from", "to"]), "chain-words")
    theirs = words.select(*(F.col(c).alias(f"hub_{c}") for c in ("from", "to", "words")), F.col("doc").alias("hub"))
    aligned = (
        found.join(words, ["doc", "from", "to"])
        .join(theirs, ["hub", "hub_from", "hub_to"])
        .mapInArrow(_aligned, "doc long, `from` long, `to` long, ref long, share double")
    )
    spans = aligned.union(wholes).groupBy("doc", "from", "to").agg(F.max(F.struct("share", "ref")).alias("m"))
    spans = work.stage(spans.select("doc", "from", "to", "m.share", "m.ref"), "chain-spans")
    work.drop(*(tag for tag in list(work.paths) if tag != "chain-spans"))
    order = W.partitionBy("doc").orderBy("from", "to")
    reach = F.max("to").over(order.rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("new", F.when(F.col("from") <= reach, 0).otherwise(1)).withColumn("passage", F.sum("new").over(order))
    whole = spans.groupBy("doc", "passage").agg(
        F.min("from").alias("start_word"),
        F.max("to").alias("end_word"),
        F.max(F.struct((F.col("to") - F.col("from")).alias("n"), "share", "ref")).alias("best"),
    )
    n = F.col("end_word") - F.col("start_word")
    return whole.where(F.col("best.n") >= PASSAGE).select(
        F.col("doc").alias("doc_id"), "start_word", "end_word", n.alias("n_words"), F.col("best.ref").alias("ref_doc_id"), F.col("best.share").alias("identity")
    )


def op8_chaining(spark, sf_dir):
    return fuzzy_passages(common.read(spark, sf_dir, "documents"))
