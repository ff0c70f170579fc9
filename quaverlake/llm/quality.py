"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage of the whole text
is encoded: shares of byte classes, repeated neighbouring words and lengths go through
a learned tanh layer. Gated attention, softmax(w' (tanh(V h) * sigmoid(U h))), weighs
the passages; the score is a logistic function of the weighted mean. Only document
labels are known, so attention learns which passages speak for them.

The model is fitted with Adam on the driver from a bounded sample of labelled
documents (``sample`` rows, by the hash of doc_id). Scoring maps over the documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import text_runs

PASSAGE = 64
#: Labelled documents that the model is fitted on, at most.
SAMPLE = 4000
#: Texts are encoded in runs of about so many bytes, which bounds a worker's memory.
RUN_BYTES = 1 << 19
#: Rows of a run at most.
ROWS = 512

#: Byte classes: each character below has one; letters, digits and the rest follow.
_SIGNS = " \n\t.,;:!?|#$%&*<>{}[]()\"'-_/\\@=+~^`"
N_CLASSES = len(_SIGNS) + 5
_CLASS = np.full(256, len(_SIGNS) + 4, np.uint8)  # control characters
for _k, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = _k
_CLASS[ord("a") : ord("z") + 1] = len(_SIGNS)
_CLASS[ord("A") : ord("Z") + 1] = len(_SIGNS) + 1
_CLASS[ord("0") : ord("9") + 1] = len(_SIGNS) + 2
_CLASS[128:] = len(_SIGNS) + 3
N_FEATURES = N_CLASSES + 6


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the number of passages of each text."""
    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    n_passages = np.maximum(1, -(-n_words // PASSAGE))
    first = np.concatenate([[0], np.cumsum(n_passages)])
    total = int(first[-1])
    x = np.zeros((total, N_FEATURES), np.float32)
    # Each byte belongs to the passage of the word that it ends, follows or is in.
    raw = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    starts = ~space
    starts[1:] &= space[:-1]
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    seen = np.cumsum(starts)
    before = np.concatenate([[0], np.cumsum(n_words)])[:-1]
    rank = np.clip(seen - before[doc] - 1, 0, None)
    passage = first[doc] + np.minimum(rank // PASSAGE, n_passages[doc] - 1)
    counts = np.bincount(passage * N_CLASSES + _CLASS[raw], minlength=total * N_CLASSES)
    counts = counts.reshape(total, N_CLASSES).astype(np.float32)
    n_bytes = np.maximum(counts.sum(1), 1)
    x[:, :N_CLASSES] = np.sqrt(counts / n_bytes[:, None])
    # Words that repeat one of the three before them.
    flat = np.fromiter((hash(w) for ws in words for w in ws), np.int64, int(n_words.sum()))
    owner = np.repeat(np.arange(len(texts)), n_words)
    at = first[owner] + (np.arange(len(flat)) - before[owner]) // PASSAGE
    held = np.maximum(np.bincount(at, minlength=total), 1)
    for lag in (1, 2, 3):
        same = np.zeros(len(flat), bool)
        same[lag:] = (flat[lag:] == flat[:-lag]) & (owner[lag:] == owner[:-lag])
        x[:, N_CLASSES + lag - 1] = np.bincount(at, weights=same, minlength=total) / held
    n_held = np.bincount(at, minlength=total)
    x[:, N_CLASSES + 3] = np.log1p(n_held) / 4
    x[:, N_CLASSES + 4] = np.minimum(n_bytes / held, 40) / 10
    x[:, N_CLASSES + 5] = np.repeat(np.log1p(n_words) / 10, n_passages)
    return x, n_passages


def _forward(m: dict, x: np.ndarray, n: np.ndarray) -> dict:
    at = np.concatenate([[0], np.cumsum(n)[:-1]])
    bag = np.repeat(np.arange(len(n)), n)
    h = np.tanh(((x - m["mean"]) / m["std"]) @ m["We"] + m["be"])
    t, g = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-np.clip(h @ m["U"], -30, 30)))
    a = (t * g) @ m["w"]
    a = np.exp(a - np.maximum.reduceat(a, at)[bag])
    a = a / np.add.reduceat(a, at)[bag]
    z = np.add.reduceat(h * a[:, None], at, axis=0)
    logit = z @ m["c"] + m["b"][0]
    return {"bag": bag, "h": h, "t": t, "g": g, "a": a, "z": z, "p": 1 / (1 + np.exp(-np.clip(logit, -30, 30)))}


def fit(x: np.ndarray, n: np.ndarray, y: np.ndarray, hidden: int = 16, epochs: int = 40, seed: int = 7) -> dict:
    """Fits the network on bags: features x of all passages, n passages a bag, labels y."""
    rng = np.random.default_rng(seed)
    f = x.shape[1]
    x = x.astype(np.float64)
    m = {
        "mean": x.mean(0) if len(x) else np.zeros(f),
        "std": (x.std(0) if len(x) else np.zeros(f)) + 0.05,
        "We": rng.normal(0, 1 / np.sqrt(f), (f, hidden)),
        "be": np.zeros(hidden),
        "V": rng.normal(0, 0.3, (hidden, hidden)),
        "U": rng.normal(0, 0.3, (hidden, hidden)),
        "w": rng.normal(0, 0.3, hidden),
        "c": rng.normal(0, 0.3, hidden),
        "b": np.zeros(1),
    }
    if not len(n):
        return m | {"b": np.array([2.0])}  # nothing is known against any document
    learned = ["We", "be", "V", "U", "w", "c", "b"]
    mom = {k: [np.zeros_like(m[k]), np.zeros_like(m[k])] for k in learned}
    first = np.concatenate([[0], np.cumsum(n)])
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(n))
        for k in range(0, len(n), 64):
            ids = np.sort(order[k : k + 64])
            rows = np.concatenate([np.arange(first[i], first[i + 1]) for i in ids])
            xb, nb, yb = x[rows], n[ids], y[ids]
            s = _forward(m, xb, nb)
            bag, h, t, g, a, z = (s[q] for q in ("bag", "h", "t", "g", "a", "z"))
            d = (s["p"] - yb) / len(ids)
            dz = d[:, None] * m["c"]
            da = (h * dz[bag]).sum(1)
            at = np.concatenate([[0], np.cumsum(nb)[:-1]])
            da = a * (da - np.add.reduceat(a * da, at)[bag])  # through the softmax
            dtg = da[:, None] * m["w"]
            dt, dg = dtg * g * (1 - t * t), dtg * t * g * (1 - g)
            dh = a[:, None] * dz[bag] + dt @ m["V"].T + dg @ m["U"].T
            de = dh * (1 - h * h)
            grad = {
                "c": z.T @ d, "b": np.array([d.sum()]), "w": (t * g).T @ da, "V": h.T @ dt, "U": h.T @ dg,
                "We": ((xb - m["mean"]) / m["std"]).T @ de, "be": de.sum(0),
            }
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for q in learned:
                u, v = mom[q]
                gq = grad[q] + 1e-4 * m[q]
                u[...] = 0.9 * u + 0.1 * gq
                v[...] = 0.999 * v + 0.001 * gq * gq
                m[q] = m[q] - rate * (u / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return m


def _encoded(batches):
    for batch in batches:
        for run, texts in text_runs(batch, RUN_BYTES, ROWS):
            yield run, batch, texts


def sample_bags(docs: DataFrame, labels: DataFrame, label: str, sample: int):
    """(features, passages a bag, labels) of at most ``sample`` labelled documents, held-out ones excluded."""
    spark = docs.sparkSession
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    known = [(r.doc_id, r.y) for r in known.collect()]  # ``sample`` rows at most
    few = spark.createDataFrame(known, "doc_id long, y int") if known else spark.createDataFrame([], "doc_id long, y int")

    def bags(batches):
        for run, batch, texts in _encoded(batches):
            x, n = encode(texts)
            at = np.concatenate([[0], np.cumsum(n)])
            part = batch.slice(run.start, run.stop - run.start)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id"),
                    "y": part.column("y"),
                    "x": [x[i:j].astype("<f4").tobytes() for i, j in zip(at, at[1:])],
                }
            )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(few), "doc_id")
    # One text of each document, so that no more rows than the sample has come back.
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("y").alias("y"))
    rows = chosen.mapInArrow(bags, "doc_id long, y int, x binary").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.x)))
    xs = [np.frombuffer(r.x, "<f4").reshape(-1, N_FEATURES) for r in rows]
    x = np.concatenate(xs) if xs else np.zeros((0, N_FEATURES), np.float32)
    return x, np.array([len(v) for v in xs], np.int64), np.array([r.y for r in rows], float)


def held_out(doc_id):
    """True for rows kept back from learning: crc32 of doc_id as text has the remainder 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Inputs of a score are the text's passages alone. A null or empty text is one empty
    passage and is scored like any other. Documents without a label, duplicate labels
    (the smallest counts) and null labels (ignored) are fine; without any label every
    score is the prior 0.88. A null doc_id is not held out. Repeated rows are scored
    each; an empty table gives an empty result.
    """
    model = fit(*sample_bags(docs, labels, label, sample))

    def score(batches):
        for run, batch, texts in _encoded(batches):
            x, n = encode(texts)
            p = _forward(model, x.astype(np.float64), n)["p"] if len(n) else np.zeros(0)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").slice(run.start, run.stop - run.start), "score": p})

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op10_quality(spark, sf_dir):
    return classify(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))


def keep_good(spark, docs, sf_dir):
    """Pipeline stage: documents that the classifier doesn't reject.

    Each row is judged by its own text in one pass that carries all columns along; rows
    that repeat are judged each, and a null or empty text as one empty passage. Without
    labels all rows stay; an empty table gives an empty result.
    """
    labels = common.read(spark, sf_dir, "labels")
    model = fit(*sample_bags(docs, labels, "quality", SAMPLE))

    def chosen(batches):
        for run, batch, texts in _encoded(batches):
            x, n = encode(texts)
            keep = _forward(model, x.astype(np.float64), n)["p"] >= 0.7
            yield batch.slice(run.start, run.stop - run.start).filter(pa.array(keep))

    return docs.mapInArrow(chosen, docs.schema)
