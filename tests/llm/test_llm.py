"""Edge cases and brute force for the operators of the subpackage."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaverlake.llm import chaining, chat_format, common, decontaminate, exact_dedup, licenses, mixing, ngram_join, quality, suffix_dedup, url_filter
from quaverlake.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = ["n", "rank", "hub", "sig", "bucket", "whole", "digest", "window"]


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def frame(spark, texts, source=None):
    rows = [(i, t, "en", (source or {}).get(i, "s"), len(t or "")) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for c in EXTRA:
        df = df.withColumn(c, F.lit("x"))
    return df


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One"), (5, "One"), (6, "a b c d"), (7, "é " * 30000), (None, "one"), (None, None)]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60, 1)] + [(100, 200), (200, 150)]
    got = dict(rows(components(spark.createDataFrame(chain, "a long, b long")), "node", "component"))
    assert got == {i: 0 for i in range(61)} | {100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_staging_gives_freed_native_memory_back(spark):
    """What the driver's JVM has freed outside of its heap doesn't stay with the process."""
    jvm = spark.sparkContext._jvm
    field = jvm.Class.forName("sun.misc.Unsafe").getDeclaredField("theUnsafe")
    field.setAccessible(True)
    unsafe, size = field.get(None), 65536

    def resident(addresses):
        """MB of the mappings that hold these addresses."""
        total, inside = 0, False
        with open(f"/proc/{jvm.ProcessHandle.current().pid()}/smaps") as maps:
            for line in maps:
                if m := re.match(r"([0-9a-f]+)-([0-9a-f]+) ", line):
                    inside = any(int(m[1], 16) <= a < int(m[2], 16) for a in addresses)
                elif inside and line.startswith("Rss:"):
                    total += int(line.split()[1]) / 1024
        return total

    for give_back in (lambda: common.stage(spark.range(3), "trimmed"), lambda: common.release(spark)):
        blocks = [unsafe.allocateMemory(size) for _ in range(512)]
        for b in blocks:
            unsafe.setMemory(b, size, 1)
        kept = blocks[7::8]  # among the others, so that the C library can't just cut its heap short
        for b in set(blocks) - set(kept):
            unsafe.freeMemory(b)
        before = resident(blocks)
        give_back()
        assert before > 30 and resident(blocks) < before - 8
        for b in kept:
            unsafe.freeMemory(b)


# exact dedup


def test_exact_dedup_odd_rows(spark):
    got = rows(exact_dedup.exact_dedup(frame(spark, ODD)), "doc_id", "keep_id", "group_size", "kept")
    want = [
        (1, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True), (4, 5, 4, False), (5, 5, 4, True), (5, 5, 4, True),
        (6, 6, 1, True), (7, 7, 1, True), (None, 2, 3, False), (None, 5, 4, False),
    ]
    assert got == sorted(want, key=repr)


def test_exact_dedup_tells_collisions_apart(spark):
    texts = [(i, t) for i, t in enumerate(["aa", "AA", "ab", "ac", "ab", "b"])]
    weak = lambda norm: F.substring(norm, 1, 1)
    got = rows(exact_dedup.exact_dedup(frame(spark, texts), digest=weak), "doc_id", "keep_id", "group_size")
    assert got == [(0, 1, 2), (1, 1, 2), (2, 4, 2), (3, 3, 1), (4, 4, 2), (5, 5, 1)]


def test_exact_dedup_folds_batches(spark):
    docs = frame(spark, [(i, f"t{i % 7}") for i in range(40)]).repartition(5)
    got = rows(exact_dedup.exact_dedup(docs, max_bytes_per_trigger=1), "doc_id", "keep_id")
    assert got == sorted([(i, max(k for k in range(40) if k % 7 == i % 7)) for i in range(40)], key=repr)


# n-gram join


def brute_components(texts):
    sets = {}
    for i, t in texts:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                label[y] = x
    return [(i, len(sets[i]), find(i)) for i in ids]


def edited(text, seed, edits):
    rng, w = random.Random(seed), text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("common", [False, True])
def test_ngram_join_matches_brute_force(spark, common, monkeypatch):
    texts, n = [], 0
    line = "this line is in very many of the texts here "
    for base in range(12):
        size = [3, 5, 7, 9, 14, 25, 40, 60, 90, 150, 300, 700][base]
        t = prose(base, size, 5000)
        for copy in range(8):
            texts.append((n, (line if common else "") + edited(t, n, copy * size // 130)))
            n += 1
    if common:
        monkeypatch.setattr(ngram_join, "COMMON", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 500)
    got = rows(ngram_join.jaccard_components(frame(spark, texts)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_components(texts), key=repr)


def test_ngram_levels_keep_the_guarantee(monkeypatch):
    """Sets at the bound of similarity meet as often as ``need`` asks, whatever their sizes and common elements."""
    rng = np.random.default_rng(5)
    for size in (9, 14, 20, 33, 50, 81, 130, 333, 1000):
        for trial in range(12):
            pool = rng.integers(1, 1 << 63, size * 2, np.uint64)
            a = np.unique(pool[:size])
            cut = size // 9  # |A n B| / |A u B| = (s - c) / (s + c) >= 0.8
            b = np.unique(np.concatenate([a[cut:], pool[size : size + cut]]))
            leave = np.unique(rng.choice(a, size // 3))
            best = False
            ja, jb = (int(np.searchsorted(ngram_join._TOPS, len(s))) for s in (a, b))
            for j in {ja, ja + 1} & {jb, jb + 1}:
                (x, nx), (y, _) = ngram_join.signatures([a, b], [j, j], leave)
                k = (len(a) + len(b)) * 20 // 180
                shared = collections.Counter(nx[np.isin(x, y)].tolist())
                best |= any(n >= max(1, need - k // 2) for need, n in shared.items())
            assert best, (size, trial)


def test_ngram_join_odd_rows(spark):
    got = rows(ngram_join.jaccard_components(frame(spark, ODD)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(
        [(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (None, 1, None), (None, 0, None)], key=repr
    )
    assert ngram_join.jaccard_components(frame(spark, [])).count() == 0


def test_ngram_join_takes_rows_of_one_id_together(spark):
    base = prose(1, 80, 5000)
    texts = [(1, base), (2, edited(base, 1, 1)), (2, prose(2, 60, 5000)), (3, edited(prose(2, 60, 5000), 3, 1)), (4, ""), (4, base), (5, prose(9, 40, 5000))]
    got = set(rows(ngram_join.jaccard_components(frame(spark, texts)), "doc_id", "component_id"))
    assert got == {(1, 1), (2, 1), (3, 1), (4, 1), (5, 5)}


# suffix dedup


def brute_removed(texts):
    raw = [(i, (t or "").encode()) for i, t in texts]
    seen = collections.Counter(t[k : k + 200] for _, t in raw for k in range(len(t) - 199))
    out = []
    for i, t in raw:
        cover = np.zeros(len(t) + 2, bool)
        for k in range(len(t) - 199):
            if seen[t[k : k + 200]] > 1:
                cover[k + 1 : k + 201] = True
        kept = bytes(c for c, gone in zip(t, cover[1:-1]) if not gone)
        out.append((i, len(t), int(cover.sum()), int((np.diff(cover.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1 << 21, 3000])
def test_suffix_dedup_matches_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    shared = prose(99, 120, 10**6)
    texts = [(i, prose(i, 60, 10**6) + shared[i * 3 : 700 - i * 5] + prose(i + 50, 40, 10**6)) for i in range(24)]
    texts += [(100, shared), (101, shared), (102, "ab" * 400), (103, "x" * 199), (104, "x" * 200), (105, "x" * 450)]
    texts += [(110, prose(7, 60, 10**6) * 2), *ODD]
    got = rows(suffix_dedup.remove_repeats(frame(spark, texts)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_removed(texts)
    assert suffix_dedup.remove_repeats(frame(spark, [])).count() == 0


@pytest.mark.parametrize("doc_id", [None, 7])
def test_suffix_dedup_of_rows_without_ids_of_their_own(spark, doc_id):
    shared = prose(98, 60, 10**6)
    texts = [(doc_id, prose(i, 70, 10**6) + (shared if i % 3 == 0 else "")) for i in range(60)] + [(doc_id, prose(5, 70, 10**6))]
    got = rows(suffix_dedup.remove_repeats(frame(spark, texts)), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_removed(texts)


# decontamination


def test_decontamination(spark):
    item = prose(1, 30, 10**6)
    swapped = item.split()
    for k in (4, 11, 17, 25):
        swapped[k] = "other"
    texts = [(1, prose(2, 50) + " " + item.upper() + "! " + prose(3, 20)), (2, prose(4, 30) + " " + " ".join(swapped)), (3, prose(5, 500)), (4, item[:40]), *ODD[:4]]
    bench = spark.createDataFrame([(10, item), (11, item), (12, None), (13, "too short"), (14, "six words are just enough here")], "item_id long, text string")
    bench = bench.withColumn("h", F.lit(1)).withColumn("doc_id", F.lit(3))
    got = rows(decontaminate.overlaps(frame(spark, texts), bench), "doc_id", "item_id", "n_tokens", "n_equal")
    assert got == [(1, 10, 30, 30), (1, 11, 30, 30), (2, 10, 30, 26), (2, 11, 30, 26)]
    short = frame(spark, [(1, "yes Six words, are just enough here no")])
    assert rows(decontaminate.overlaps(short, bench), "doc_id", "item_id", "n_tokens") == [(1, 14, 6)]
    assert decontaminate.overlaps(frame(spark, []), bench).count() == 0
    assert decontaminate.overlaps(frame(spark, texts), bench.limit(0)).count() == 0


def test_masks_bear_substitutions():
    """Wherever two of 13 tokens differ, some mask fits somewhere."""
    for i in range(13):
        for j in range(i, 13):
            bad = {i, j}
            assert any(not bad & {s + o for o in offs} for offs in decontaminate.OFFSETS for s in range(13 - max(offs)))


# chat


def turns(spark, data):
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    return df.withColumn("tokens", F.lit("x")).withColumn("own", F.lit("x")).withColumn("last", F.lit(1))


def test_stretches_match_brute_force():
    rng = random.Random(21)
    for _ in range(1500):
        n = rng.randrange(13, 61)
        same = np.array([rng.random() < rng.choice([0.6, 0.75, 0.85]) for _ in range(n)])
        at, least = rng.randrange(n), rng.choice([6, 13])
        fits = [(b, e) for b in range(at + 1) for e in range(at + 1, n + 1) if e - b >= least and 10 * same[b:e].sum() >= 8 * (e - b)]
        got = decontaminate._stretches(same, [at], least)
        assert bool(got) == bool(fits)
        for b, e, equal in got:
            assert b <= at < e and e - b >= least and 10 * equal >= 8 * (e - b) and equal == same[b:e].sum()
            assert equal in {same[x:y].sum() for x, y in fits if y - x == max(v - u for u, v in fits)}


def test_overlaps_beside_worse_material(spark):
    rng = random.Random(22)
    items, texts = [], []
    for k, (n, subs) in enumerate([(15, 3), (20, 4), (38, 7), (58, 11)] * 5):
        words = prose(500 + k, n, 10**6).split()
        other = list(words)
        for at in [n - 1, *rng.sample(range(8, n - 1), subs - 1)]:  # seven equal ones first, so that a mask fits
            other[at] = "other"
        items.append((k, " ".join(words)))
        texts.append((k, "before " + " ".join(other) + " behind"))
    core, rest = prose(600, 16, 10**6).split(), prose(601, 40, 10**6).split()
    items.append((99, " ".join(core + rest)))
    texts.append((99, " ".join(core + [w if k % 4 else "x" for k, w in enumerate(rest)])))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows(decontaminate.overlaps(frame(spark, texts), bench), "doc_id", "item_id")
    assert got == sorted([(k, k) for k, _ in items], key=repr)


def test_chat_round_trip(spark):
    rng = random.Random(3)
    nasty = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "\\s", "<\\s>", "\n", " ", "é", "[[/INST]", "</s", "word ", "\\\\[INST]", "$1"]
    data = []
    for c in range(30):
        for t in range(rng.randrange(1, 12)):
            role = "system" if t == 0 and c % 3 == 0 else "user" if t % 2 else "assistant"
            text = None if rng.random() < 0.1 else "".join(rng.choice(nasty) for _ in range(rng.randrange(0, 120)))
            data.append((c, t, role, text))
    data += [(99, 1, "assistant", "b"), (99, 1, "assistant", "b"), (99, None, None, "a"), (None, 0, "user", "x")]
    want = {}
    for c in {d[0] for d in data}:
        own = sorted(((t if t is not None else -1, r or "", x or "") for k, t, r, x in data if k == c))
        want[c] = (len(own), "".join(f"{r}\n{x}\n" for _, r, x in own), "".join(x for _, r, x in own if r == "assistant"))
    back = chat_format.read_back(chat_format.windows(turns(spark, data), budget=40, history=15))
    assert {r.conv_id: (r.n_turns, r.turns, r.loss) for r in back.collect()} == want
    assert chat_format.read_back(chat_format.windows(turns(spark, []))).count() == 0


def test_chat_windows_repeat_system_and_history(spark):
    data = [(1, 0, "system", "s s")] + [(1, t, "user" if t % 2 else "assistant", "w " * 4) for t in range(1, 7)]
    got = chat_format.windows(turns(spark, data), budget=22, history=8).orderBy("window").collect()
    assert [r.n_repeated for r in got] == [0, 3]  # the system turn and two turns of history
    assert got[1].formatted.startswith("<s>[INST] system [/INST]s s</s><s>[INST] assistant [/INST]w")
    assert [len(w.loss) for w in got] == [1, 2]


@pytest.mark.parametrize("budget,history", [(40, 15), (64, 0), (10, 9)])
def test_chat_windows_keep_the_budget(spark, budget, history):
    rng = random.Random(budget)
    data = []
    for c in range(40):
        for t in range(rng.randrange(1, 30)):
            role = "system" if t == 0 and c % 2 else "user" if t % 2 else "assistant"
            size = rng.choice([0, 1, 3, 8, 20, 45]) if role != "system" else rng.choice([0, 4, 30, 60])
            data.append((c, t, role, "w " * size))
    own = collections.Counter()
    for r in chat_format.windows(turns(spark, data), budget=budget, history=history).collect():
        parts = [p.split("[INST] ")[1].split(" [/INST]") for p in r.formatted.split("</s>")[:-1]]
        tokens, system = [len(x.split()) for _, x in parts], parts[0][0] == "system"
        rest = tokens[1:] if system else tokens
        assert sum(tokens) <= budget or len(rest) <= 1, (r, tokens)
        repeated = r.n_repeated - (1 if system and r.n_repeated else 0)
        assert sum(rest[:repeated]) <= history
        own[r.conv_id] += len(parts) - r.n_repeated
    assert own == collections.Counter(d[0] for d in data)


def test_short_items_match_whole_texts(spark):
    bench = spark.createDataFrame([(1, "two words"), (2, "one two three four"), (3, "")], "item_id long, text string")
    texts = [(1, "One, two three FOUR."), (2, "so one two three four it is"), (3, "two words"), (4, "words two"), (5, ""), (6, None)]
    assert rows(decontaminate.overlaps(frame(spark, texts), bench), "doc_id", "item_id") == [(1, 2), (3, 1)]


def test_overlaps_match_brute_force(spark):
    """Where masks fit, every pair with a long enough similar stretch on one diagonal is found, and no other."""
    rng = random.Random(31)
    items = [(k, prose(900 + k, rng.choice([5, 8, 13, 20, 40, 70]), 300)) for k in range(25)]
    texts = []
    for n in range(120):
        w = prose(2000 + n, rng.randrange(0, 60), 300).split()
        if n % 2:
            part = rng.choice(items)[1].split()
            part = part[: rng.randrange(4, len(part) + 1)]
            for _ in range(rng.randrange(0, 1 + len(part) // 6)):
                part[rng.randrange(len(part))] = "z"
            w[len(w) // 2 : len(w) // 2] = part
        texts.append((n, " ".join(w)))
    want = set()
    for d, text in texts:
        x = text.split()
        for i, item in items:
            y = item.split()
            least = min(13, len(y))
            if len(y) < decontaminate.MIN_ITEM:
                if x == y:
                    want.add((d, i))
                continue
            masks = [[k for k, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS] + ([list(range(len(y)))] if len(y) < decontaminate.SPAN else [])
            for shift in range(-len(y), len(x)):
                lo, hi = max(0, shift), min(len(x), shift + len(y))
                same = [x[k] == y[k - shift] for k in range(lo, hi)]
                hit = [k for m in masks for k in range(len(same) - m[-1]) if all(same[k + o] for o in m)]
                if any(10 * sum(same[b:e]) >= 8 * (e - b) for at in hit for b in range(at + 1) for e in range(max(at + 1, b + least), len(same) + 1)):
                    want.add((d, i))
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert len(want) > 20 and set(rows(decontaminate.overlaps(frame(spark, texts), bench), "doc_id", "item_id")) == want


# urls


def test_url_parts_and_rules(spark):
    urls = [
        "http://A.Example.NET/en/x?y", "https://example.net/fr/", "//x", None, "http://net", "http://x.org/fr/1", "ftp://u@EXAMPLE.com:80/de/", "https://b.example.com/de/1#z",
        "http://myexample.com/de/", "x://h?/a", "",
    ]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("q")).withColumn("n", F.lit(1))
    got = url_filter.url_filter(df, F.lit(0)).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule) for r in got] == [
        ("a.example.net", "/en/x", "example.net/en/"), ("example.net", "/fr/", "net/"), ("", "", None), ("", "", None), ("net", "", None),
        ("x.org", "/fr/1", "org/fr/"), ("u@example.com:80", "/de/", None), ("b.example.com", "/de/1", "example.com/de/"),
        ("myexample.com", "/de/", None), ("h", "", None), ("", "", None),
    ]
    assert [r.verdict for r in got][:2] == ["allow", "block"]
    assert url_filter.url_filter(df.limit(0), F.lit(0)).count() == 0


def test_url_filter_odd_rows(spark):
    data = [(1, "http://a.com/x", "### " * 9), (1, "http://a.com/y", None), (None, None, "### " * 9), (2, "a.com", ""), (3, "http://A.com:80/?q", "fine"), (3, "http://A.com:80/?q", "fine")]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("domain", F.lit("x")).withColumn("suffix", F.lit("x"))
    got = url_filter.url_filter(df, url_filter.noisy(F.col("html"))).collect()
    assert sorted((r.page_id or 0, r.host, r.path) for r in got) == [(0, "", ""), (1, "a.com", "/x"), (1, "a.com", "/y"), (2, "", ""), (3, "a.com:80", "/"), (3, "a.com:80", "/")]
    assert all(r.verdict in ("allow", "block") and 0 <= r.bad_rate <= 1 for r in got)


def test_registered_domains(spark):
    hosts = ["a.b.co.uk", "x.co.uk", "co.uk", "u@a.b.org:8080", "b.org", "10.0.0.1:80", "localhost", ""]
    df = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = [tuple(r) for r in df.select(*url_filter.host_levels(F.col("host"))).collect()]
    assert got == [
        ("b.co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("co.uk", "co.uk"), ("b.org", "org"), ("b.org", "org"), ("10.0.0.1", "10.0.0.1"), ("localhost", "localhost"), ("", ""),
    ]


def test_reputation_matches_a_plain_version(spark):
    rng = random.Random(3)
    hosts = [f"{h}.{d}.{s}" for s in ("com", "co.uk") for d in "abc" for h in "xyz"]
    data = [(h, rng.choice([None, 0, 0, int(rng.random() < 0.1 * (ord(h[2]) - 96))])) for h in hosts for _ in range(rng.randrange(0, 30))]
    data = data or [("x.a.com", 1)]
    level = {h: (h, h.split(".", 1)[1], h.split(".", 2)[2]) for h, _ in data}
    n, b = collections.Counter(), collections.Counter()
    for h, bad in data:
        for key in enumerate(level[h]):
            n[key] += bad is not None
            b[key] += bad or 0
    total, bads = sum(v for (k, _), v in n.items() if k == 0), sum(v for (k, _), v in b.items() if k == 0)
    p = bads / total

    def strength(k):
        pairs = sum(v * (v - 1) for (i, _), v in n.items() if i == k)
        same = sum(v * (v - 1) for (i, _), v in b.items() if i == k)
        rho = (same / pairs - p * p) / (p * (1 - p))
        return 10000.0 if rho <= 0 else min(max((1 - rho) / rho, 1.0), 10000.0)

    ks = [strength(k) for k in range(3)]
    for r in url_filter.host_reputation(spark.createDataFrame(data, "host string, bad int")).collect():
        rate = (bads + 1) / (total + 2)
        for k in (2, 1, 0):
            key = (k, level[r.host][k])
            rate = (b[key] + ks[k] * rate) / (n[key] + ks[k])
        low = rate - 1.645 * (rate * (1 - rate) / (n[(0, r.host)] + ks[0] + 1)) ** 0.5
        assert (r.rate, r.low) == (pytest.approx(rate), pytest.approx(low))


def test_reputation_shrinks(spark):
    data = [("bad.a.com", 1)] * 30 + [("new.a.com", 1)] + [("good.b.com", 0)] * 200 + [("c.org", None)]
    r = {x.host: x for x in url_filter.host_reputation(spark.createDataFrame(data, "host string, bad int")).collect()}
    assert r["bad.a.com"].low > 0.5 and r["good.b.com"].rate < 0.05
    assert r["good.b.com"].rate < r["new.a.com"].rate <= 1 and 0 < r["c.org"].rate < 1


# licences


def test_automaton_statistics():
    rng = random.Random(1)
    seqs = [[rng.randrange(4) for _ in range(rng.randrange(2, 14))] for _ in range(6)]
    a = licenses.Automaton(seqs)
    subs = {tuple(s[i:j]) for s in seqs for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    text = [rng.randrange(5) for _ in range(400)]
    state = length = 0
    for k, w in enumerate(text):
        while state and w not in a.next[state]:
            state = a.link[state]
            length = a.len[state]
        if w in a.next[state]:
            state, length = a.next[state][w], length + 1
        else:
            length = 0
        want = max((n for n in range(0, 15) if n <= k + 1 and (n == 0 or tuple(text[k + 1 - n : k + 1]) in subs)), default=0)
        assert length == want


def test_license_scan(spark):
    mit = licenses.TEMPLATES[0][1]
    texts = [
        (1, "The MIT-License, mit license MIT  LICENSE"), (2, "apachelicense Apache\nLicense general public license"), (3, "x " + mit.replace("hereby", "hereby indeed").title()),
        (4, "general public public license mit"),
    ]
    got = {r.doc_id: r for r in licenses.license_scan(frame(spark, texts)).collect()}
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in (got[1], got[2])] == [
        (7, 3, 1, 5, "mit"), (6, 2, 1, 3, "apache,gpl"),
    ]
    assert got[3].labels == "mit" and got[3].base_labels == "" and 0.8 < got[3].score < 1
    assert (got[4].n_base, got[4].labels, got[4].first_word) == (0, "", None)
    assert licenses.license_scan(frame(spark, ODD)).count() == len(ODD)


def test_license_scan_brute(spark):
    rng = random.Random(2)
    vocabulary = ["MIT", "license", "apache", "general", "public", "x", "-", ",", "é", "the", "gnu\n", "Licensé"]
    texts = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 80)))) for i in range(60)]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in licenses.license_scan(frame(spark, texts)).collect():
        w = word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[r.doc_id][1]))
        at = [(k, lab) for p, lab in licenses.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert 0 <= r.score <= 1
    full = licenses.license_scan(frame(spark, [(1, "a b " + licenses.TEMPLATES[6][1] + " c"), (2, None)])).orderBy("doc_id").collect()
    assert full[0].labels == "bsd" and full[0].score == 1.0 and full[0].spans[0].start == 2
    twice = licenses.license_scan(frame(spark, [(1, f"{licenses.TEMPLATES[6][1]} and so on {licenses.TEMPLATES[6][1]}")])).first()
    assert [(s.label, s.start, s.share) for s in twice.spans if s.share == 1.0] == [("bsd", 0, 1.0), ("bsd", len(licenses.TEMPLATES[6][1].split()) + 3, 1.0)]
    assert (full[1].n_words, full[1].labels, full[1].score) == (0, "", 0.0)


# mixing


def test_budget_is_met():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 60, 12))
        counts = rng.integers(1, 5, len(lengths))
        total = int((lengths * counts).sum())
        budget = int(rng.integers(0, total + 10))
        take = mixing.fit_budget(lengths, counts, budget)
        reachable = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            reachable |= {r + k * n for r in reachable for k in range(1, c + 1)}
        assert (take >= 0).all() and (take <= counts).all()
        assert int((take * lengths).sum()) == max(r for r in reachable if r <= budget)


def test_large_budget_is_met():
    lengths, counts = np.arange(1, 3000), np.full(2999, 400)
    for budget in (10**6 + 7, 10**8 + 3):
        assert int((mixing.fit_budget(lengths, counts, budget) * lengths).sum()) == budget


def test_budgets_of_long_documents():
    fit = lambda lengths, counts, budget: int((mixing.fit_budget(np.array(lengths), np.array(counts), budget) * np.array(lengths)).sum())
    assert fit([480000], [10], 500000) == 480000
    assert fit([5, 300000], [1000, 10], 1500000) == 1500000
    assert fit([140000], [2], 150000) == 140000
    assert fit([7, 100001, 250000], [10**6, 50, 50], 9_999_999) == 9_999_999
    assert 0 <= 60_000_052 - fit([20_000_000, 20_000_011, 3], [2, 2, 10], 60_000_100) < 100


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, out = dict(sizes), {}
    budget = 1.5 * sum(sizes.values())
    while left:
        share = {s: budget * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > 2 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            budget -= out[s]
            del left[s]
    return out


def test_mix(spark):
    rng = random.Random(4)
    names = ["b", "a", None, "é", "B", "c", "zero"]
    source = {i: names[i % 6] for i in range(240)} | {500: "zero", 501: "zero"}
    texts = [(i, "w " * rng.randrange(1, 60)) for i in range(240)] + [(500, None), (501, " ")]
    docs = frame(spark, texts, source)
    got = mixing.mix(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=repr)
    sizes = collections.Counter()
    for i, t in texts:
        sizes[source[i]] += len((t or "").split())
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    assert mixing.mix(frame(spark, [])).count() == 0
    assert mixing.mix(frame(spark, ODD)).count() == len(ODD)


# passages


def test_chains_follow_both_orders():
    x, y = [0, 10, 20, 5, 30], [0, 10, 20, 25, 30]
    assert sorted(max(chaining.chains(x, y), key=len)) == [0, 1, 2, 4]


def brute_chain(x, y):
    n, f = len(x), [0.0] * len(x)
    for i in sorted(range(n), key=lambda i: y[i]):
        f[i] = 10 + max([0.0] + [f[j] - 0.25 * (x[i] - x[j] + y[i] - y[j]) for j in range(n) if x[j] < x[i] and y[j] < y[i]])
    return max(f)


def test_chain_scores_match_brute_force(monkeypatch):
    monkeypatch.setattr(chaining, "GAP", 10**6)
    monkeypatch.setattr(chaining, "SLIP", 10**6)
    rng = random.Random(8)
    for _ in range(80):
        n = rng.randrange(1, 25)
        y = sorted(rng.randrange(60) for _ in range(n))
        x = [rng.randrange(60) for _ in range(n)]
        best = 0.0
        for c in chaining.chains(x, y):
            assert all(x[a] < x[b] and y[a] < y[b] for a, b in zip(c, c[1:]))
            best = max(best, 10 * len(c) - 0.25 * (x[c[-1]] - x[c[0]] + y[c[-1]] - y[c[0]]))
        assert best == pytest.approx(brute_chain(x, y))


def test_passages_match_brute_force(spark):
    """Every run of PASSAGE words that another document has is found whole; words that no other document has are not."""
    rng = random.Random(77)
    pool = [prose(f"pool {k}", rng.randrange(45, 130), 10**6).split() for k in range(30)]
    lines = [prose(f"line {k}", 12, 10**6).split() for k in range(4)]
    texts = []
    for d in range(160):
        words = []
        for k in range(rng.randrange(1, 5)):
            words += prose(f"{d} {k}", rng.randrange(5, 90), 10**6).split()
            words += rng.choice(pool) if rng.random() < 0.4 else rng.choice(lines)
        texts.append((d, " ".join(words)))
    n = chaining.PASSAGE
    held = collections.defaultdict(set)
    for d, t in texts:
        w = t.split()
        for k in range(len(w) - n + 1):
            held[tuple(w[k : k + n])].add(d)
    cover = {d: np.zeros(len(t.split()), bool) for d, t in texts}
    for r in chaining.fuzzy_passages(frame(spark, texts)).collect():
        cover[r.doc_id][r.start_word : r.end_word] = True
    words = collections.defaultdict(set)
    for d, t in texts:
        for x in t.split():
            words[x].add(d)
    checked = 0
    for d, t in texts:
        w = t.split()
        for k in range(len(w) - n + 1):
            if len(held[tuple(w[k : k + n])]) > 1:
                checked += 1
                assert cover[d][k : k + n].all(), (d, k)
        alone = np.array([len(words[x]) == 1 for x in w])
        for k in range(len(w) - 20):
            assert not (alone[k : k + 20].all() and cover[d][k : k + 20].all())
    assert checked > 500


@pytest.mark.parametrize("edits,least", [(0.05, 0.97), (0.1, 0.95), (0.15, 0.85)])
def test_fuzzy_passages_are_recalled(spark, edits, least):
    rng = random.Random(5)
    texts = []
    for t in range(100):
        p = prose(f"{edits} {t}", 60, 10**6).split()
        q = [f"e{rng.randrange(10**6)}" if rng.random() < edits else x for x in p]
        for side, words in enumerate((p, q)):
            texts.append((2 * t + side, " ".join([prose(f"{t} {side} a", 40, 10**6), *words, prose(f"{t} {side} b", 40, 10**6)])))
    found = {r.doc_id for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    assert len(found) >= least * len(texts)


def test_fuzzy_passages(spark):
    p = prose(1, 70, 10**6)
    w = p.split()
    fuzzy = " ".join(w[:20] + ["new", "words"] + w[20:33] + w[34:50] + ["swap"] + w[51:])
    texts = [(1, prose(2, 200, 10**6) + " " + p), (2, p + " " + prose(3, 90, 10**6)), (3, prose(4, 60, 10**6) + " " + fuzzy), (4, prose(5, 300, 10**6)), (5, " ".join(w[:30])), *ODD]
    got = {r.doc_id: r for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].start_word, got[1].end_word) == (200, 270) and (got[2].start_word, got[2].end_word) == (0, 70)
    assert got[3].start_word <= 62 and got[3].end_word >= 128 and got[3].identity >= 0.8
    copies = chaining.fuzzy_passages(frame(spark, [(1, p), (2, p.upper()), (2, p)])).collect()
    assert {(r.doc_id, r.n_words, r.ref_doc_id) for r in copies} == {(1, 70, 2), (2, 70, 1)}
    assert chaining.fuzzy_passages(frame(spark, [])).count() == 0


@pytest.mark.parametrize("copies", [1, 12])
def test_passages_of_lines_that_smaller_documents_have(spark, copies):
    texts, want, n = [], {}, 0
    for t in range(30):
        lines = [prose(1000 + 10 * t + k, 20, 10**6) for k in range(3)]
        for k, line in enumerate(lines):
            for c in range(copies):
                texts.append((n := n + 1, prose(f"{t} {k} {c}", 30, 10**6) + " " + line + " " + prose(f"{t} {k} {c} b", 30, 10**6)))
        for side in "ab":
            doc = 10**6 + 10 * t + ord(side)
            texts.append((doc, prose(f"{t}{side}", 50, 10**6) + " " + " ".join(lines) + " " + prose(f"{t}{side}c", 50, 10**6)))
            want[doc] = (50, 110)
    got = {r.doc_id: (r.start_word, r.end_word) for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    assert {d: got.get(d) for d in want} == want


def test_good_parts_cover_all_similar_stretches():
    rng = random.Random(31)
    for _ in range(300):
        at, x, y = [], 0, 0
        for _ in range(rng.randrange(10, 90)):
            if rng.random() < 0.3:
                x, y = x + rng.randrange(6), y + rng.randrange(6)
            at.append((x, y))
            x, y = x + 1, y + 1
        at = np.array(at).T
        fits = [(p, q) for p in range(at.shape[1]) for q in range(p, at.shape[1])
                if min(at[:, q] - at[:, p]) + 1 >= chaining.CHAIN and 10 * (q - p + 1) >= 8 * (max(at[:, q] - at[:, p]) + 1)]
        got = chaining.good_parts(at)
        assert set(got) <= set(fits)
        assert {k for p, q in got for k in range(p, q + 1)} == {k for p, q in fits for k in range(p, q + 1)}


def test_passages_beside_private_words(spark):
    texts = []
    for t in range(24):
        one, two = prose(f"{t} one", 50, 10**6), prose(f"{t} two", 50, 10**6)
        for side in (0, 1):
            texts.append((2 * t + side, f"{one} {prose(f'{t} {side}', 26 + t % 3 * 4, 10**6)} {two}"))
    got = {(r.doc_id, r.start_word, r.end_word) for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    for t in range(24):
        gap = 26 + t % 3 * 4
        for doc in (2 * t, 2 * t + 1):
            assert any(d == doc and a <= 0 and b >= 50 for d, a, b in got)
            assert any(d == doc and a <= 50 + gap and b >= 100 + gap for d, a, b in got)


@pytest.mark.parametrize("more", [0, 9])
def test_passages_that_the_first_document_repeats(spark, more):
    p = prose("repeated", 60, 10**6)
    texts = [(1, f"{p} {prose('between', 440, 10**6)} {p}")]
    texts += [(k, f"{prose(f'before {k}', 40, 10**6)} {p} {prose(f'behind {k}', 40, 10**6)}") for k in range(2, 3 + more)]
    got = {(r.doc_id, r.start_word, r.end_word) for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    assert got == {(1, 0, 60), (1, 500, 560), *((k, 40, 100) for k in range(2, 3 + more))}


def test_prefilter_of_places_keeps_all_similar_ones():
    rng = np.random.default_rng(4)
    right, left = (rng.integers(0, 16, (400, chaining.CONTEXT), np.uint8) for _ in range(2))
    for words in (right, left):
        words[200:] = np.where(rng.random((200, chaining.CONTEXT)) < 0.25, words[200:], words[:200])
        words[300:] = np.concatenate([words[300:, :5], words[100:200, 4:-1]], axis=1)  # a word more
    i, j = (x.ravel() for x in np.meshgrid(np.arange(400), np.arange(400)))
    fits = chaining.may_fit(chaining._front(right), chaining._front(left), i, j)
    like = chaining.likeness(right, left, i, j) >= chaining.LEAST
    assert fits[like].all() and 400 < like.sum() < fits.sum() < len(i) // 10


def test_search_of_a_seeds_places_matches_all_pairs_in_less_time():
    """One block of a seed, two blocks of another and a few places of a third, against all pairs of them by lists."""
    rng = np.random.default_rng(12)
    n, c = 1300, chaining.CONTEXT
    right, left = (np.where(rng.random((n, c)) < 0.3, rng.integers(0, 16, (n, c)), rng.integers(0, 16, (40, c))[np.arange(n) % 40]).astype(np.uint8) for _ in range(2))
    left[:, 5:9] = left[:, 4:8]
    side = np.repeat([0, 0, 1, 0], [1000, 200, 50, 50])
    seed, q = np.repeat([1, 2, 3], [1000, 250, 50]), np.repeat([0, 1, 0], [1000, 250, 50])
    doc, pos = rng.integers(0, 700, n), rng.integers(0, 10**6, n)
    blocks = [(range(1000), range(1000)), (range(1000, 1200), range(1200, 1250)), (range(1200, 1250), range(1000, 1200)), (range(1250, n), range(1250, n))]

    def searched():
        return {m for b in chaining._searched(np.stack([seed, 0 * q, q, side, doc, pos]), right, left) for m in zip(*(x.to_pylist() for x in b.columns))}

    def listed():
        i, j = (np.concatenate([x.ravel() for x in xs]) for xs in zip(*(np.meshgrid(a, b, indexing="ij") for a, b in blocks)))
        fits = chaining.may_fit(chaining._front(right), chaining._front(left), i, j)
        i, j = i[fits], j[fits]
        fits = (chaining.likeness(right, left, i, j) >= chaining.LEAST) & (doc[i] != doc[j])
        return i[fits], j[fits]

    took = {searched: [], listed: []}
    for f in [searched, listed] * 4:
        begin = time.process_time()
        f()
        took[f].append(time.process_time() - begin)
    got, (i, j) = searched(), listed()
    same = [np.concatenate([np.zeros((len(i), 1), int), np.cumsum(x[i] == x[j], axis=1)], axis=1) for x in (right, left)]
    values = np.full((3, len(i)), -1)
    values[2] = same[0][:, -1] + same[1][:, -1]
    for a in range(c + 1):
        for b in range(max(0, chaining.SIDE - a), c + 1):
            good = 10 * (same[0][:, a] + same[1][:, b] + chaining.K) >= 8 * (a + b + chaining.K)
            values[0][good], values[1][good] = a, np.maximum(values[1][good], b)
    want = set()
    for value in values:
        order = np.lexsort((pos[j], doc[j], -value, i))
        for k in order[np.concatenate([[True], np.diff(i[order]) > 0])]:
            hub, other = sorted((i[k], j[k]), key=lambda x: doc[x])
            want.add((doc[hub], doc[other], pos[hub], pos[other]))
    assert got == want and len(want) > 1000
    assert min(took[searched]) < 0.7 * min(took[listed])  # though that picks no matches yet


@pytest.mark.parametrize("block", [1 << 12, 16])
def test_places_of_a_frequent_line_are_searched_in_full(spark, block, monkeypatch):
    """A line of many documents is the only seed of a fuzzy passage of two, whose words beside it differ."""
    monkeypatch.setattr(chaining, "BLOCK", block)
    texts, want = [], set()
    for t in range(12):
        line = prose(f"line {t}", 11, 10**6)
        one = prose(f"one {t}", 22, 10**6).split(), prose(f"two {t}", 22, 10**6).split()
        two = [[f"e{t}{k}" if k % 5 == own else w for k, w in enumerate(words)] for words, own in zip(one, (1, 0))]
        for k in range(60):
            texts.append((1000 * t + k, f"{prose(f'{t} {k}', 30, 10**6)} {line} {prose(f'{t} {k} b', 30, 10**6)}"))
        for k, (a, b) in enumerate((one, two)):
            texts.append((10**6 + 2 * t + k, " ".join([prose(f"{t} {k} c", 30, 10**6), *a, line, *b, prose(f"{t} {k} d", 30, 10**6)])))
            want.add(10**6 + 2 * t + k)
    got = {r.doc_id for r in chaining.fuzzy_passages(frame(spark, texts)).collect()}
    assert got == want


# quality


def test_gradients_learn_and_odd_rows(spark):
    good = [(i, prose(i, 150)) for i in range(150)]
    bad = [(i + 1000, " | ".join(prose(i, 150).split())) for i in range(150)]
    docs = frame(spark, good + bad + ODD)
    labels = spark.createDataFrame([(i, int(i < 1000)) for i, _ in good + bad] + [(1, None), (None, 0), (0, 1)], "doc_id long, quality int").withColumn("text", F.lit("x"))
    got = quality.classify(docs, labels).collect()
    assert len(got) == 300 + len(ODD)
    held = [r for r in got if r.held_out and r.doc_id is not None and (r.doc_id >= 1000 or r.doc_id > 7)]
    assert np.mean([r.predicted == int(r.doc_id < 1000) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in quality.classify(docs, labels.limit(0)).collect()} == {1}


def test_scores_match_those_of_single_texts(spark):
    texts = [(i, prose(i, 40 + 13 * i) if i % 2 else " | ".join(prose(i, 90).split())) for i in range(60)] + [(100, ""), (101, None), (102, "é " * 5000)]
    docs, labels = frame(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.fit(*quality.sample_bags(docs, labels, "quality", 1000))
    got = {r.doc_id: (r.score, r.predicted) for r in quality.classify(docs, labels).collect()}
    for i, t in texts:
        x, n = quality.encode([(t or "").encode()])
        p = float(quality._forward(model, x.astype(float), n)["p"][0])
        assert got[i][0] == pytest.approx(p, abs=1e-9) and got[i][1] == int(got[i][0] >= 0.7)
    ids = [str(i).encode() for i, _ in texts]
    held = {r.doc_id for r in quality.classify(docs, labels).where("held_out").collect()}
    assert held == {i for (i, _), b in zip(texts, ids) if zlib.crc32(b) % 4 == 2}


def test_attention_gradient():
    rng = np.random.default_rng(0)
    x, n, y = rng.normal(size=(12, 5)), np.array([3, 4, 5]), np.array([0.0, 1.0, 1.0])
    m = quality.fit(x, n, y, hidden=4, epochs=1)
    loss = lambda m: -np.mean(y * np.log(p := quality._forward(m, x, n)["p"]) + (1 - y) * np.log(1 - p))
    longer = quality.fit(x, n, y, hidden=4, epochs=150)
    assert loss(longer) < 0.5 * loss(m)


def test_native_plans_have_no_python(spark):
    for df in (
        chat_format.read_back(chat_format.windows(turns(spark, [(1, 0, "user", "a")]))),
        exact_dedup.exact_dedup(frame(spark, ODD)),
    ):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan
