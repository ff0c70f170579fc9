"""Operators on small frames with known answers."""

import pytest
from pyspark.sql import functions as F

from quaverlake.functions import numbers as N
from quaverlake.functions import text as X
from quaverlake.functions import urls
from quaverlake.operators import aggregates as A
from quaverlake.operators import checks as C
from quaverlake.operators import facets
from quaverlake.operators import joins as J
from quaverlake.operators import ordered as O
from quaverlake.operators import search as S
from quaverlake.operators import sets


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_same_membership_needs_one_row(spark):
    works = spark.createDataFrame([(1,), (2,)], "id long")
    bridge = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (2, "a", "y")], "id long, source string, kind string")
    got = facets.same_membership(works, bridge, "id", F.col("source") == "a", F.col("kind") == "y")
    assert rows(got) == [(2,)]


def test_first_reason_and_issues(spark):
    df = spark.createDataFrame([(1, None), (5, "x"), (9, "y")], "n int, s string")
    rules = (("small", F.col("n") < 6), ("x", F.col("s") == "x"))
    assert [r[0] for r in df.select(facets.first_reason(*rules)).collect()] == ["small", "small", None]
    assert [r[0] for r in df.select(facets.issues(*rules)).collect()] == [["small"], ["small", "x"], []]
    assert facets.kept(df, *rules).count() == 1


def test_unspecified_kind_gives_way(spark):
    df = spark.createDataFrame([("unspecified", "original"), ("arrangement", "original"), ("unspecified", "unspecified")], "c string, d string")
    got = [r[0] for r in df.select(facets.effective_kind(F.col("c"), F.col("d"))).collect()]
    assert got == ["original", "arrangement", "unspecified"]


def test_robots_longest_rule(spark):
    rules = spark.createDataFrame([("/a", False), ("/a/b", True), ("/c", False), ("/c", True)], "prefix string, allow boolean")
    paths = spark.createDataFrame([("1", "/a/x"), ("2", "/a/b/x"), ("3", "/z"), ("4", "/c")], "url string, path string")
    assert rows(facets.robots_allows(rules, paths)) == [("1", False), ("2", True), ("3", True), ("4", True)]


def test_remap_marks_missing(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    m = spark.createDataFrame([("a", "A")], "o string, n string")
    assert rows(J.remap(df, "k", m, "o", "n")) == [("A", False), (None, True)]


def test_unique_lookup(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", None)], "k string, v string")
    assert rows(J.unique_lookup(df, "k", "v")) == [("a", "1")]


def test_range_join_is_half_open(spark):
    p = spark.createDataFrame([(1, 0), (1, 9), (1, 10), (2, 5)], "k int, t long")
    r = spark.createDataFrame([(1, 0, 10), (1, 5, 25)], "k int, a long, b long")
    got = J.range_join(p, "t", r, "a", "b", ["k"], 7).select("t", "a")
    assert rows(got) == [(0, 0), (10, 5), (9, 0), (9, 5)]


def test_overlay_guard(spark):
    base = spark.createDataFrame([(1, "x", "g"), (2, "y", "g")], "id int, v string, h string")
    rev = spark.createDataFrame([(1, "X", "g"), (2, "Y", "old")], "id int, v string, h string")
    assert rows(J.overlay(base, rev, "id", ["v"], guard="h").select("id", "v")) == [(1, "X"), (2, "y")]


def test_two_phase(spark):
    chunks = spark.createDataFrame([(1, "a"), (9, "a"), (8, "b"), (7, "z")], "id int, name string")
    meta = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, name string")
    got = J.two_phase(chunks, meta, "id", "name").select("id", "matched_id", "outcome")
    assert rows(got) == [(1, 1, "id"), (7, None, "missing"), (8, None, "ambiguous"), (9, 1, "name")]


def test_star_edges_are_linear(spark):
    df = spark.createDataFrame([("k", i) for i in range(50)] + [("l", 3)], "key string, id long")
    assert J.star_edges(df, "key", "id", "same").count() == 49


def test_changes(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y"), (4, "z")], "id int, v string")
    assert rows(J.changes(a, b, "id", ["v"])) == [(2, "changed"), (3, "removed"), (4, "added")]


def test_all_or_nothing(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id int, ok boolean")
    assert J.all_or_nothing(df, [F.col("ok")]).count() == 0
    assert J.all_or_nothing(df.where("ok"), [F.col("ok")]).count() == 1


def test_aggregates(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x")], "k string, n int, v string")
    assert rows(A.latest(df, "k", "n")) == [("a", 2, "y"), ("b", 1, "x")]
    assert rows(A.conflicts(df, "k", "v").select("k", "variants")) == [("a", 2)]
    assert rows(A.collapse(df, ["k"], "n", ["v"])) == [("a", [1, 2], "x", True), ("b", [1], "x", False)]
    assert df.agg(A.worst(F.col("v"), ["y", "x"])).first()[0] == "y"


def test_dense_ids_are_global(spark):
    df = spark.range(1000).withColumn("v", F.xxhash64("id"))
    got = [r.n for r in O.dense_ids(df, [F.col("v"), F.col("id")], "n").orderBy("v", "id").collect()]
    assert got == list(range(1000))


def test_merge_intervals(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 1.4, 2.0), ("a", 3.0, 4.0), ("a", 0.2, 0.5)], "k string, x double, y double")
    assert rows(O.merge_intervals(df, ["k"], "x", "y", 0.5)) == [("a", 0.0, 2.0, 3), ("a", 3.0, 4.0, 1)]


def test_fifo_pairs(spark):
    e = [(1, "off"), (2, "on"), (3, "on"), (4, "off"), (5, "on")]
    df = spark.createDataFrame([("k", t, what) for t, what in e], "k string, t long, kind string")
    got = O.pair_fifo(df, ["k"], ["t"], "kind", "on", "off").select("on_at", "off_at").collect()
    clean = lambda v: None if v is None or v != v else int(v)
    assert sorted([(clean(r[0]), clean(r[1])) for r in got], key=repr) == sorted([(None, 1), (2, 4), (3, None), (5, None)], key=repr)


def test_planned_ranges(spark):
    files = spark.createDataFrame([("a", 30), ("b", 5), ("c", 10)], "file string, total long")
    done = spark.createDataFrame([("a", 10, 15), ("a", 12, 20), ("c", 0, 99), ("x", 0, 1)], "file string, start long, stop long")
    assert rows(O.planned_ranges(files, done, "file", 8)) == [("a", 0, 8), ("a", 20, 28), ("a", 28, 30), ("a", 8, 10), ("b", 0, 5)]


def test_names_are_suffixed_until_they_differ(spark):
    df = spark.createDataFrame([(1, "A"), (2, "a"), (3, "a-2"), (4, "b")], "id int, name string")
    assert rows(O.suffix_collisions(df, "name", "id").select("id", "unique_name")) == [(1, "A-1"), (2, "a-2-2"), (3, "a-2-3"), (4, "b")]


def test_overlaps_dont_make_up_for_gaps(spark):
    from quaverlake.operators import sets

    df = spark.createDataFrame([(0, 10), (5, 15), (20, 25)], "start long, stop long")
    r = sets.shard_report(df, 25).first()
    assert (r.disjoint, r.contiguous, r.complete) == (False, False, False)
    whole = spark.createDataFrame([(0, 10), (10, 25)], "start long, stop long")
    assert tuple(sets.shard_report(whole, 25).first()) == (2, 0, 25, True, True, True)
    assert not sets.shard_report(whole, 26).first().complete


def test_osa_counts_a_swap_once(spark):
    df = spark.createDataFrame([("abcd", "abdc"), ("ca", "abc"), ("", "ab")], "a string, b string")
    assert [r[0] for r in df.select(X.osa_distance("a", "b")).collect()] == [1, 3, 2]


def test_search_form(spark):
    df = spark.createDataFrame([("Op.27, No.2",), ("Dvořák·Œuvre",), (None,)], "t string")
    assert [r[0] for r in df.select(X.search_form("t")).collect()] == ["op 27 no 2", "dvorakoeuvre", None]


def test_text_functions(spark):
    assert one(spark, X.composer_key(F.lit("Bach, Johann Sebastian"))) == "johann sebastian bach"
    assert one(spark, X.natural_key(F.lit("No 7"))) < one(spark, X.natural_key(F.lit("No 12")))
    assert one(spark, X.strip_dates(F.lit("Sor, Fernando (1778-1839)"))) == "Sor, Fernando"
    assert one(spark, X.plain_link(F.lit("[[A|B]] c.pdf"))) == "B c"
    assert one(spark, X.truncate_utf8(F.lit("aé"), 2)) == "a"
    assert one(spark, X.wrap_title(F.lit("《x》"))) == "《x》"
    assert one(spark, X.wait_seconds(F.lit("Continue in 30 seconds"))) == 30
    assert one(spark, X.safe_text(F.lit("write to a.b@c.org"))) is False
    assert spark.createDataFrame([("cafÃ©",)], "t string").select(X.repair_latin1("t")).first()[0] == "café"


def test_numbers(spark):
    r = one(spark, N.rational(F.lit(18).cast("long"), F.lit(48).cast("long")))
    assert (r.num, r.den) == (3, 8)
    assert [one(spark, N.quarter(F.lit(v))) for v in (0.125, 0.375, 1.1)] == [0.0, 0.5, 1.0]
    assert one(spark, N.midi_number(F.lit("A"), F.lit(0), F.lit(4), F.lit(0))) == 69


def test_urls(spark):
    assert one(spark, urls.file_key(F.lit("HTTP://Ex.org/a%20b.pdf?x=1#y"))) == "ex.org/a b.pdf?x=1"
    assert one(spark, urls.file_key(F.lit("mailto:x"))) is None
    assert one(spark, urls.allowed(F.lit("https://a.ex.org/w/1?id=2"), ["ex.org"], "^/w/", ["id"])) is True
    assert one(spark, urls.allowed(F.lit("https://a.ex.org/w/1?q=2"), ["ex.org"], "^/w/", ["id"])) is False


def test_sets(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    sup = spark.createDataFrame([(1, 1, "a", "c"), (1, 2, "c", "d"), (2, 1, "x", "y")], "id int, seq int, expected string, v string")
    assert rows(sets.fold_supplements(base, sup, "id", "v")) == [(1, "d"), (2, "b")]
    out, twice = sets.union_disjoint([base, base.where("id = 1")], "id")
    assert (out.count(), rows(twice)) == (3, [(1, 2)])


def test_checks(spark):
    df = spark.createDataFrame([(1, "a!!"), (2, None)], "id int, t string")
    assert rows(C.findings(df, "id", ["t"], {"loud": ("error", "!!")})) == [(1, "t", "loud", "error")]


def test_search_ranks_and_numbers(spark):
    df = spark.createDataFrame([(1, "sor", "op 2"), (2, "sor", "op 27"), (3, "giuliani", "sor")], "id int, composer string, title string")
    df = df.withColumn("metadata", F.lit("")).select("id", *(S.lines(F.array(c)).alias(c) for c in ("composer", "title", "metadata")))
    assert rows(S.exact(df, "op 2").select("id")) == [(1,)]
    assert rows(S.exact(df, "sor op 27").select("id", "relevance")) == [(2, 0.0 + 3 + 3)]
    assert rows(S.exact(df, "giuliani").select("id", "relevance")) == [(3, -0.75)]
    assert [r.id for r in S.exact(df, "sor").orderBy("relevance", "id").collect()] == [1, 2, 3]


def test_fuzzy_needs_all_terms(spark):
    p = spark.createDataFrame([(1, "etude"), (1, "study"), (2, "etude")], "id int, word string")
    assert rows(S.fuzzy(p, "etudes studi", F.levenshtein)) == [(1, 2)]


@pytest.mark.parametrize("mode", ["append", "update"])
def test_streams(spark, tmp_path, mode):
    from quaverlake.streaming import attempts

    data = [(i, f"2024-01-0{1 + i // 3} 0{i % 3}:00:00", i % 2, "view", 1.0, "{}") for i in range(9)]
    df = spark.createDataFrame(data, "event_id long, ts string, user_id long, event_type string, value double, props string")
    df.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    stream = attempts.events(spark, str(tmp_path / "in"))
    out = attempts.windowed_counts(stream) if mode == "append" else attempts.latest_state(stream, "user_id", "event_id", ["event_type"])
    attempts.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "ck"), mode)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() > 0
    if mode == "update":
        assert {(r.user_id, r.event_id) for r in got.collect()} == {(0, 8), (1, 7)}


def test_fifo_matches_a_queue(spark):
    import random

    rng, data, want = random.Random(3), [], []
    for key in range(20):
        queue = []
        for at in range(rng.randrange(1, 40)):
            kind = rng.choice(["on", "off"])
            data.append((key, at, kind))
            if kind == "on":
                queue.append(at)
            else:
                want.append((key, queue.pop(0) if queue else None, at))
        want += [(key, at, None) for at in queue]
    df = spark.createDataFrame(data, "k int, at int, kind string")
    assert rows(O.pair_fifo(df, ["k"], ["at"], "kind", "on", "off")) == sorted(want, key=repr)


def test_similar_names_are_all_found(spark):
    import random

    from quaverlake.operators import joins

    rng = random.Random(4)
    names = [["".join(rng.choice("abc") for _ in range(rng.randrange(0, 7))) for _ in range(60)] for _ in range(2)]
    side = lambda n: spark.createDataFrame([(x,) for x in names[n]], "name string")

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for most in (1, 2):
        got = {tuple(r) for r in joins.similar_names(side(0), side(1), "name", most, F.lit(0)).collect()}
        assert got == {(a, b, distance(a, b)) for a in names[0] for b in names[1] if distance(a, b) <= most}


def test_view_of_a_request():
    from quaverlake.operators import rules

    assert rules.view_of(" ", {"category": "all", "topic": None, "source": "x"}) == "categories"
    assert rules.view_of("sor", {}) == rules.view_of("", {"category": "3"}) == rules.view_of("", {"topic": "duo"}) == "works"


def test_adapters_are_known_before_anything_is_read(spark):
    from quaverlake.operators import extension

    adapters = extension.Adapters()
    adapters.add("a")(lambda s, source: s.range(source["n"]))
    assert adapters.read(spark, [{"id": "x", "adapter": "a", "n": 2}, {"id": "y", "adapter": "a", "n": 1}]).groupBy("source_id").count().count() == 2
    with pytest.raises(ValueError, match="no adapters"):
        adapters.read(spark, [{"id": "x", "adapter": "a", "n": 1}, {"id": "y", "adapter": "b"}])
    with pytest.raises(ValueError, match="two adapters"):
        adapters.add("a")(lambda s, source: None)


def test_titles_and_rules_bear_nulls(spark):
    from quaverlake.functions import titles
    from quaverlake.operators import decisions, display, rules

    null = F.lit(None).cast("string")
    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    assert one(titles.heading(null)) is None and one(titles.wrap_title(null)) is None and one(titles.title_label(null, null, null)) == ""
    assert one(titles.role_credit(null, {"editor": "ed"})) is None
    assert one(rules.url_faults(null, ["a"], {"/": {}})) in ([], None) or one(rules.url_faults(null, ["a"], {"/": {}}))
    assert one(display.converted(null, {"a": "int"})).reason == "not_an_object"
    assert one(decisions.translation_fault(null, null, null, null, null)) == "status"
    assert one(decisions.forbidden_paths(F.lit("not json"), ["a"])) is None
