"""The stages one by one against plain versions."""

import collections

import corpus_pipeline
from pyspark.sql import functions as F
from test_llm import DOCS, brute_components, edited, prose

BENCH = prose(77, 40, 10**6)


def documents(spark):
    base = prose(1, 120, 10**6)
    texts = [(i, prose(i + 10, 120, 10**6)) for i in range(40)]
    texts += [(100, base), (101, base.upper()), (102, base), (110, edited(base, 3, 2)), (120, prose(5, 50, 10**6) + " " + BENCH)]
    texts += [(200 + i, " | ".join(prose(i + 500, 120).split())) for i in range(40)]
    texts += [(None, prose(600, 90, 10**6)), (301, None), (302, "")]
    rows = [(i, t, "en", f"s{(i or 0) % 3}" if i != 301 else None, len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, DOCS).withColumn("rank", F.lit("x"))


def test_stages(spark, tmp_path):
    docs = documents(spark)
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    every = ids(docs)
    assert list(stages) == ["quality", "exact_dedup", "near_dedup", "decontaminate", "mix"]

    good = stages["quality"](spark, docs, d)
    assert good.columns == docs.columns
    assert {i for i in every if i is not None and i < 120} <= ids(good) and not any(i and 200 <= i < 240 for i in ids(good))

    kept = stages["exact_dedup"](spark, docs, d)
    assert kept.columns == docs.columns and every - ids(kept) == {100, 101, 301}

    near = stages["near_dedup"](spark, docs, d)
    texts = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None]
    gone = {i for i, _, c in brute_components(texts) if c != i}
    assert near.columns == docs.columns and every - ids(near) == gone == {101, 102, 110}

    clean = stages["decontaminate"](spark, docs, d)
    assert clean.columns == docs.columns and every - ids(clean) == {120}

    mixed = stages["mix"](spark, docs, d).collect()
    sums = collections.Counter()
    for r in mixed:
        sums[r.source] += r.taken
        assert 0 < r.taken <= 2 * r["size"]
    # nearly all texts have 120 words, so a target is met to about one text
    assert all(abs(sums[r.source] - r.target) <= 120 for r in mixed)

    out = corpus_pipeline.run(spark, d)
    assert ids(out) <= every - {100, 101, 110, 120} and set(docs.columns) < set(out.columns)


def test_stages_on_odd_rows(spark, tmp_path):
    """Rows without ids or with shared ones, repeated rows, clashing columns and empty tables."""
    d = str(tmp_path)
    spark.createDataFrame([(1, BENCH), (2, "so short")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{d}/labels.parquet")
    texts = [(None, "same"), (None, "SAME"), (7, "x"), (7, "x"), (7, "y y"), (8, "y y"), (None, BENCH), (9, "so short"), (10, None), (11, ""), (12, "é " * 40000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    docs = spark.createDataFrame(rows, DOCS)
    for c in ("size", "target", "taken", "source_size", "n", "rank", "kept", "key", "component_id"):
        docs = docs.withColumn(c, F.lit("x"))
    docs.write.parquet(f"{d}/documents.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: collections.Counter((r.doc_id, r.text) for r in df.collect())
    for name in ("quality", "exact_dedup", "near_dedup", "decontaminate"):
        assert stages[name](spark, docs, d).columns == docs.columns
        assert stages[name](spark, docs.limit(0), d).count() == 0
    assert stages["mix"](spark, docs.limit(0), d).count() == 0

    kept = pairs(stages["exact_dedup"](spark, docs, d))
    assert [k for k in kept if k[1] and k[1].lower() == "same"] in ([(None, "same")], [(None, "SAME")])
    del kept[(None, "same")], kept[(None, "SAME")]
    assert kept == collections.Counter([(7, "x"), (8, "y y"), (None, BENCH), (9, "so short"), (11, ""), (12, "é " * 40000)])

    clean = pairs(stages["decontaminate"](spark, docs, d))
    assert pairs(docs) - clean == collections.Counter([(None, BENCH), (9, "so short")])

    same = spark.createDataFrame([(None, "w " * 10, "en", "s", 20)] * 100 + [(5, "w " * 40, "en", "t", 80)], DOCS)
    got = stages["mix"](spark, same, d)
    assert got.columns == [*DOCS.replace(" long", "").replace(" string", "").split(", "), "size", "source_size", "target", "taken"]
    taken = collections.Counter()
    for r in got.collect():
        taken[r.source] += r.taken
        assert abs(r.target - {"s": 1480.0, "t": 80.0}[r.source]) < 1e-6
    assert taken == {"s": 1480, "t": 80}


def test_run_matches_plain_versions(spark, tmp_path):
    """The whole pipeline against its five stages written down plainly."""
    import re

    import numpy as np
    import pytest
    from test_llm import brute_targets

    from quaverlake.llm import quality

    d = str(tmp_path)
    docs = documents(spark)
    docs.write.parquet(f"{d}/documents.parquet")
    labels = spark.createDataFrame([(i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)], "doc_id long, quality int")
    labels.write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, BENCH)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")

    rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
    model = quality.fit(*quality.sample_bags(docs, labels, "quality", quality.SAMPLE))

    def good(text):
        x, n = quality.encode([text.encode()])
        return quality._forward(model, x.astype(np.float64), n)["p"][0] >= 0.7

    rows = [r for r in rows if good(r[1])]
    last = {}
    for r in rows:
        key = re.sub("[A-Z]", lambda m: m[0].lower(), r[1])
        if key not in last or (r[0] if r[0] is not None else -1) > (last[key][0] if last[key][0] is not None else -1):
            last[key] = r
    rows = list(last.values())
    component = {i: c for i, _, c in brute_components([(i, t) for i, t, _ in rows if i is not None])}
    rows = [r for r in rows if r[0] is None or component[r[0]] == r[0]]
    item = BENCH.lower().split()
    grams = {tuple(item[k : k + 13]) for k in range(len(item) - 12)}
    rows = [r for r in rows if not any(tuple(w[k : k + 13]) in grams for w in [r[1].lower().split()] for k in range(len(w) - 12))]
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = brute_targets(sizes)

    got = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in got} <= {i for i, _, _ in rows}
    taken = collections.Counter()
    for r in got:
        taken[r.source] += r.taken
        assert (r.source_size, r["size"]) == (sizes[r.source], len(r.text.split())) and r.target == pytest.approx(want[r.source])
    lengths = {s: min(len(t.split()) for _, t, x in rows if x == s and t.split()) for s in want if sizes[s]}
    assert all(0 <= want[s] - taken[s] < lengths[s] + 1 for s in lengths)
    whole = {s for s in want if want[s] >= sizes[s]}
    assert {r.doc_id for r in got if r.source in whole} == {i for i, t, s in rows if s in whole and t.split()}
