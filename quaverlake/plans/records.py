"""Queries on readers of pages, exchange formats and transports, and on what sinks write."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import records as R
from ..sources import transport
from .registry import query, table


def _pages(spark, d):
    """Orders of a customer as pages of a feed; customers by 7 have a page twice, by 11 one that is missing."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("feed"), "o_orderkey", "o_orderstatus")
    page = F.expr("o_orderkey % 4").cast("int")
    rows = o.groupBy("feed", page.alias("page")).agg(F.array_sort(F.collect_list(F.struct(F.expr("o_orderkey div 8").alias("k"), "o_orderkey"))).alias("items"))
    rows = rows.withColumn("next", F.when(F.col("page") < 3, F.col("page") + 1))
    twice = rows.where("feed % 7 = 0 and page = 1")
    return rows.where("not (feed % 11 = 0 and page = 2)").unionByName(twice)


_PAGES = """p AS (SELECT o_custkey AS feed, (o_orderkey % 4)::INT AS page FROM orders GROUP BY ALL), q AS (SELECT * FROM p WHERE NOT (feed % 11 = 0 AND page = 2)),
 r AS (SELECT * FROM q UNION ALL SELECT * FROM q WHERE feed % 7 = 0 AND page = 1),
 s AS (SELECT feed, count(*) AS n, count(DISTINCT page) AS pages, min(page) AS a, max(page) AS b, count(*) FILTER (page = 3) AS ends FROM r GROUP BY 1)"""


@query(f"""WITH {_PAGES} SELECT feed, unnest(list_filter([CASE WHEN n <> pages THEN 'page_twice' END, CASE WHEN pages <> b - a + 1 THEN 'page_missing' END, CASE WHEN ends <> 1 THEN 'no_end' END], lambda x: x IS NOT NULL)) AS fault FROM s""")
def paged_feed_faults(spark, d):
    return R.page_faults(_pages(spark, d), "feed")


@query("""WITH i AS (SELECT o_custkey AS feed, o_orderkey % 4 AS page, o_orderkey // 8 AS k, o_orderkey FROM orders WHERE NOT (o_custkey % 11 = 0 AND o_orderkey % 4 = 2))
 SELECT feed, k, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY feed, k ORDER BY page, o_orderkey) AS r FROM i) WHERE r = 1""")
def paged_feed_items(spark, d):
    return R.paged_items(_pages(spark, d), "feed", "k")


@query("""SELECT doc_id, 'missing' AS fault FROM documents WHERE doc_id % 3 <> 0 AND doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL
 SELECT doc_id, 'unrequested' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0)""")
def unanswered_requests(spark, d):
    return R.unanswered(table(spark, d, "documents").where("doc_id % 3 <> 0"), table(spark, d, "labels"), "doc_id")


@query("""WITH o AS (SELECT o_custkey AS feed, o_orderkey // 5000 AS start, o_orderkey % 997 AS id FROM orders), g AS (SELECT feed, start, count(*) AS n FROM o GROUP BY ALL),
 t AS (SELECT feed, count(*) AS items, count(DISTINCT id) AS ids FROM o GROUP BY 1), x AS (SELECT feed, max(n) AS longest, count(*) AS pages FROM g GROUP BY 1)
 SELECT feed, unnest(list_filter([CASE WHEN feed % 5 = 0 AND pages > 1 AND (SELECT count(DISTINCT start % 2) FROM g WHERE g.feed = t.feed) > 1 THEN 'totals_differ' END, CASE WHEN items <> ids THEN 'record_twice' END,
 CASE WHEN ids <> items + CASE WHEN feed % 5 = 0 AND (SELECT max(start % 2) FROM g WHERE g.feed = t.feed) = 1 THEN 1 ELSE 0 END THEN 'incomplete' END, CASE WHEN longest > 6 THEN 'page_too_long' END], lambda v: v IS NOT NULL)) AS fault FROM t JOIN x USING (feed)""")
def pager_consistency(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("feed"), F.expr("o_orderkey div 5000").alias("start"), (F.col("o_orderkey") % 997).alias("id"))
    total = o.groupBy("feed").agg(F.count(F.lit(1)).alias("total"))
    pages = o.groupBy("feed", "start").agg(F.collect_list("id").alias("ids")).join(total, "feed").withColumn("size", F.lit(6))
    odd = (F.col("feed") % 5 == 0) & (F.col("start") % 2 == 1)
    return R.pager_faults(pages.withColumn("total", F.col("total") + odd.cast("int")), "feed")


@query("""SELECT p_partkey, ['T ' || p_name] AS titles, [p_brand, p_type] AS names, p_partkey::VARCHAR AS id FROM part""")
def marc_records(spark, d):
    xml = F.concat(
        F.lit('<record xmlns="http://www.loc.gov/MARC21/slim"><controlfield tag="001">'), F.col("p_partkey").cast("string"), F.lit('</controlfield><datafield tag="245" ind1="0"><subfield code="a">T '), "p_name",
        F.lit('</subfield><subfield code="c">x</subfield></datafield><datafield tag="700"><subfield code="a">'), "p_brand", F.lit('</subfield></datafield><datafield tag="700"><subfield code="a">'), "p_type",
        F.lit("</subfield></datafield></record>"),
    )
    out = R.marc_fields(xml, {"titles": ("245", "a"), "names": ("700", "a")})
    return table(spark, d, "part").select("p_partkey", out["titles"].alias("titles"), out["names"].alias("names"), R.marc_control(xml, "001").alias("id"))


@query("""SELECT p_partkey, p_name AS label, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_type END AS maker FROM part""")
def linked_data_records(spark, d):
    n = F.col("p_partkey") % 3
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    maker = F.when(n == 0, q(F.col("p_brand"))).when(n == 1, F.concat(F.lit('[{"@language": "de", "@value": '), q(F.col("p_type")), F.lit("}]"))).otherwise("null")
    raw = F.concat(F.lit('{"rdfs:label": {"@value": '), q(F.col("p_name")), F.lit('}, "dc:maker": '), maker, F.lit("}"))
    out = R.linked_data(raw, {"label": "rdfs:label", "maker": "dc:maker"})
    return table(spark, d, "part").select("p_partkey", out["label"].alias("label"), out["maker"].alias("maker"))


@query("""SELECT p_partkey, p_name AS title, p_brand AS composer, NULL AS opus FROM part""")
def notation_headers(spark, d):
    text = F.concat(
        F.lit('\\version "2"\n\\header {\n  title = "'), "p_name", F.lit('"\n  composer="'), "p_brand", F.lit('"\n  title = "again"\n}\n\\score { opus = "1" }'),
    )
    m = R.header_fields(text)
    return table(spark, d, "part").select("p_partkey", m["title"].alias("title"), m["composer"].alias("composer"), m["opus"].alias("opus"))


@query("""SELECT c_custkey, ['v' || c_custkey || '.zip='|| c_name] AS links FROM customer""")
def readme_links(spark, d):
    text = F.concat(F.lit("# Releases\n* ["), "c_name", F.lit("](v"), F.col("c_custkey").cast("string"), F.lit(".zip) and [home](https://x.org/)\n[broken]()"))
    return table(spark, d, "customer").select("c_custkey", F.transform(R.index_lines(text, r"\.zip$"), lambda x: F.concat_ws("=", x["target"], x["label"])).alias("links"))


@query("""SELECT l_suppkey, list_sort(list_distinct(list(l_partkey))) AS ids FROM lineitem WHERE l_suppkey % 10 <> 0 GROUP BY 1""")
def member_multimap(spark, d):
    rows = table(spark, d, "lineitem").select(F.when(F.col("l_suppkey") % 10 != 0, F.col("l_suppkey")).alias("l_suppkey"), "l_partkey")
    return R.member_map(rows, "l_suppkey", "l_partkey")


@query("""SELECT n_name AS name, 'pure' AS list, row_number() OVER (ORDER BY 1) * 0 + n_regionkey AS family FROM nation UNION ALL SELECT r_name, 'mixed', NULL FROM region""")
def configured_categories(spark, d):
    pure = table(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("family"))
    return R.config_union({"pure": pure, "mixed": table(spark, d, "region").select(F.col("r_name").alias("name"))}, "name", [F.col("list"), F.col("name")])


@query("""SELECT event_id, props, NULL AS fault FROM events WHERE event_id % 10 <> 3 UNION ALL SELECT event_id, NULL, 'a damaged transport' FROM events WHERE event_id % 10 = 3""")
def transport_round_trip(spark, d):
    """Documents packed and unpacked; every tenth payload is damaged in between."""
    raw = table(spark, d, "events").select("event_id", F.regexp_replace("props", r"\s", "").alias("raw"), "props")
    packed = transport.packed_documents(raw, "raw", "q1")
    packed = packed.withColumn("packed", F.when(F.col("event_id") % 10 == 3, F.regexp_replace("packed", '"payload": "H', '"payload": "A')).otherwise(F.col("packed")))
    back = transport.unpacked_documents(packed, "packed", "q1")
    same = F.when(F.col("document") == F.col("raw"), F.col("props"))
    return back.select("event_id", same.alias("props"), "fault")


@query("""SELECT doc_id, text FROM documents""")
def rendered_rows(spark, d):
    """Cells of rendered table lines, read back: bars and line ends come back as they were."""
    cell = F.regexp_replace("text", r"\s*\n\s*", "\n")
    rows = table(spark, d, "documents").select("doc_id", "text", F.concat(F.lit("a|b "), cell, F.lit("|")).alias("cell"))
    back = R.rendered_cells(R.rendered_table(rows, ["doc_id", "cell"]))
    fine = (back[0] == F.col("doc_id").cast("string")) & (back[1] == F.col("cell")) & (F.size(back) == 2)
    return rows.withColumn("back", back).select("doc_id", F.when(fine, F.col("text")).alias("text"))


@query("""SELECT p_partkey, substr(s, 1, 2) || '/' || substr(s, 3, 2) || '/' || s || '.pdf' AS path FROM (SELECT p_partkey, sha256(p_name) AS s FROM part)""")
def object_paths(spark, d):
    return table(spark, d, "part").select("p_partkey", R.object_path(F.sha2("p_name", 256), ".pdf").alias("path"))


@query("""SELECT (s_suppkey || '.bin') AS path, CASE WHEN s_suppkey % 5 = 0 THEN 'gone' WHEN s_suppkey % 5 = 1 THEN 'content' ELSE 'touched' END AS fault FROM supplier WHERE s_suppkey % 5 < 3
 UNION ALL SELECT (s_suppkey || '.new'), 'new' FROM supplier WHERE s_suppkey % 5 = 0""")
def changed_inputs(spark, d):
    n = F.col("s_suppkey") % 5
    s = table(spark, d, "supplier")
    scan = s.select("s_suppkey", F.concat(F.col("s_suppkey").cast("string"), F.lit(".bin")).alias("path"), F.lit(3).alias("size"), F.lit(1).alias("modified"), F.sha2("s_name", 256).alias("sha256"))
    after = scan.withColumns({"path": F.when(n == 0, F.replace("path", F.lit(".bin"), F.lit(".new"))).otherwise(F.col("path")), "modified": F.when(n.isin(1, 2), 2).otherwise(1), "sha256": F.when(n == 1, "x").otherwise(F.col("sha256"))})
    return R.changed_files(scan, after)


def _midi(spark, d):
    """A MIDI file a user: an on at each signup, an off at each error, at the event's number as tick; broken for users by 10."""
    import struct

    import pandas as pd

    def files(pdf: pd.DataFrame) -> pd.DataFrame:
        def number(n):
            out = [n & 127]
            while n := n >> 7:
                out.insert(0, n & 127 | 128)
            return bytes(out)

        pdf, last, track = pdf.sort_values("event_id"), 0, b"\x00\xc0\x18"
        for at, kind in zip(pdf.event_id, pdf.event_type):
            track += number(int(at) - last) + bytes([0x90, 60, 64 if kind == "signup" else 0])
            last = int(at)
        user = int(pdf.user_id.iloc[0])
        track = track + b"\x00\xff\x2f\x00" if user % 10 else b"\x00\x40\x40"
        body = b"MThd" + struct.pack(">IHHH", 6, 0, 1, 96) + b"MTrk" + struct.pack(">I", len(track)) + track
        return pd.DataFrame({"id": [str(user)], "body": [body]})

    events = table(spark, d, "events").where("event_type in ('signup', 'error')").select("user_id", "event_id", "event_type")
    return events.groupBy("user_id").applyInPandas(files, "id string, body binary")


@query("""SELECT user_id::VARCHAR AS id, event_id AS tick, CASE event_type WHEN 'signup' THEN 'on' ELSE 'off' END AS kind, NULL AS issue FROM events WHERE event_type IN ('signup', 'error') AND user_id % 10 <> 0
 UNION ALL SELECT DISTINCT user_id::VARCHAR, 0, 'program', NULL FROM events WHERE event_type IN ('signup', 'error') AND user_id % 10 <> 0
 UNION ALL SELECT DISTINCT user_id::VARCHAR, NULL, NULL, 'ValueError: data byte without a status' FROM events WHERE event_type IN ('signup', 'error') AND user_id % 10 = 0""")
def midi_file_events(spark, d):
    from ..sources import music

    return music.read_midi(_midi(spark, d)).select("id", "tick", "kind", "issue")


@query("""SELECT p_partkey::VARCHAR AS id, 0 AS measure, 0.0::DOUBLE AS onset, 60 + p_size % 3 - 1 - 12 AS pitch, 'A' AS voice, NULL AS issue FROM part WHERE p_partkey % 20 <> 0
 UNION ALL SELECT p_partkey::VARCHAR, 0, 1.5, 64 - 12, 'A', NULL FROM part WHERE p_partkey % 20 <> 0 UNION ALL SELECT p_partkey::VARCHAR, 1, 3.0, 62 - 12, 'B', NULL FROM part WHERE p_partkey % 20 <> 0
 UNION ALL SELECT p_partkey::VARCHAR, NULL, NULL, NULL, NULL, 'ParseError' FROM part WHERE p_partkey % 20 = 0""")
def score_notes(spark, d):
    from ..sources import music

    note = lambda step, alter, duration, voice: (
        f"<note><pitch><step>{step}</step><alter>{alter}</alter><octave>4</octave></pitch><duration>{duration}</duration><voice>{voice}</voice></note>"
    )
    head = "<score-partwise><part id='P1'><measure><attributes><divisions>2</divisions><transpose><chromatic>0</chromatic><octave-change>-1</octave-change></transpose></attributes>"
    alter = (F.col("p_size") % 3 - 1).cast("string")
    parts = note("C", "%s", 3, "A").split("%s")
    tail = note("E", 0, 3, "A") + "</measure><measure>" + note("D", 0, 1, "B") + "</measure></part></score-partwise>"
    xml = F.concat(F.lit(head + parts[0]), alter, F.lit(parts[1] + tail), F.when(F.col("p_partkey") % 20 == 0, "<").otherwise(""))
    out = music.read_notes(table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), xml.cast("binary").alias("body")))
    onset = F.col("onset_num") / F.col("onset_den")
    return out.select("id", "measure", onset.alias("onset"), "pitch", "voice", F.substring_index("issue", ":", 1).alias("issue"))


@query("""SELECT p_partkey AS page_id, CASE WHEN p_partkey % 9 <> 0 THEN 'Works/' || p_type END AS heading, CASE WHEN p_partkey % 9 <> 0 THEN 'File|name=' || p_name || '{{x|}}' END AS chunk,
 CASE WHEN p_partkey % 9 = 0 THEN 'template without an end' END AS issue FROM part""")
def wikitext_files(spark, d):
    from ..sources import markup

    text = F.concat(
        F.lit("==Other==\n{{Filed|a}}\n<!-- {{File|no}} -->\n==Works==\n=== "), "p_type", F.lit(" ===\n{{File|name="), "p_name", F.lit("{{x|}}"), F.when(F.col("p_partkey") % 9 == 0, "}").otherwise("}}"),
        F.lit("\n==End==\n"),
    )
    out = markup.read_wikitext(table(spark, d, "part").select(F.col("p_partkey").alias("page_id"), text.alias("wikitext")))
    return out.select("page_id", F.when(F.col("headings").isNotNull(), F.array_join("headings", "/")).alias("heading"), "chunk", "issue")


@query("""SELECT user_id::VARCHAR AS id, CASE WHEN user_id % 4 = 1 THEN 'other_format' ELSE 'unreadable: ValueError: data byte without a status' END AS fault FROM (SELECT DISTINCT user_id FROM events WHERE event_type IN ('signup', 'error'))
 WHERE user_id % 4 = 1 OR user_id % 10 = 0""")
def file_format_faults(spark, d):
    from ..sources import corpus

    return corpus.format_faults(_midi(spark, d).withColumn("format", F.when(F.col("id").cast("int") % 4 == 1, "pdf").otherwise("mid")))
