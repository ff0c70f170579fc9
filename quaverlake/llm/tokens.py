"""Hashes of words and word windows in numpy, for use on the executors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are hashed in runs of about so many bytes, which bounds a worker's memory.
RUN_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base modulo 2**64 and of its inverse."""
    size = max(RUN_BYTES + 1, 1 << (n - 1).bit_length() if n > 1 else 1)
    if size not in _POWERS:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS.clear()
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    up, down = _POWERS[size]
    return up[:n], down[:n]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash: the hash of raw[i:j] is (p[j] - p[i]) * base ** -i."""
    p = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * powers(len(raw))[0], out=p[1:])
    return p


#: Of each byte whether it separates words.
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def runs(sizes: list[int], limit: int = RUN_BYTES):
    """Slices of neighbouring texts of about ``limit`` bytes."""
    begin = held = 0
    for k, s in enumerate(sizes):
        if held and held + s > limit:
            yield slice(begin, k)
            begin, held = k, 0
        held += s
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def text_runs(batch: pa.RecordBatch, limit: int = RUN_BYTES, rows: int = 1 << 16):
    """(slice, texts in UTF-8) of neighbouring rows of about ``limit`` bytes; only one run is in Python's memory at once.

    Null is taken as empty. A run has ``rows`` rows at most.
    """
    texts = batch.column("text").cast(pa.binary())
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for run in runs((sizes + max(1, limit // rows)).tolist(), limit):
        yield run, [t or b"" for t in texts.slice(run.start, run.stop - run.start).to_pylist()]


def words_of(texts: list[bytes], blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, ends, first) of the words of some texts.

    A word is a run of bytes that ``blank`` doesn't mark; starts and ends are positions
    in the texts joined with a newline each. Text k has the words first[k] to
    first[k + 1].
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    inside = np.zeros(len(raw) + 1, np.int8)
    inside[1:] = ~blank[raw]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    p = prefix_sums(raw)
    hashes = mixed((p[ends] - p[starts]) * powers(len(raw) + 1)[1][starts])
    limits = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(starts, limits)])
    return hashes, starts, ends, first


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h + np.uint64((salt * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019) % (1 << 64))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def window_hashes(h: np.ndarray, offsets: tuple[int, ...]) -> np.ndarray:
    """Hash of the words at ``offsets`` from each position where the last one still exists."""
    n = len(h) - max(offsets)
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, o in enumerate(offsets):
        factor = np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1)
        out += h[o : o + n] * factor
    return mixed(out)
