"""Readers on small hand-made inputs."""

import io
import json
import struct
import tarfile

import pytest
from pyspark.sql import functions as F

from quaverlake.sources import archives, markup, music, readers, sinks


def test_manifest_checks_type(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text(json.dumps({"model_type": "Work", "schema_version": 1, "items": [{"id": "a"}, {"id": "b"}]}))
    assert readers.manifest(spark, str(path), "struct<id:string>", "Work", 1).count() == 2
    with pytest.raises(Exception, match="unexpected manifest"):
        readers.manifest(spark, str(path), "struct<id:string>", "Work", 2).collect()


def test_strict_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,name,more\n1,"a, b",x\n2,c,y\n')
    assert [tuple(r) for r in readers.csv_strict(spark, str(path), ["id", "name"]).collect()] == [("1", "a, b"), ("2", "c")]
    with pytest.raises(ValueError, match="lacks"):
        readers.csv_strict(spark, str(path), ["id", "title"])


def test_registry(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps([{"id": "a", "name": "A", "homepage": "h", "allowed_hosts": ["x"]}]))
    assert readers.registry(spark, str(path)).count() == 1
    path.write_text(json.dumps([{"id": "a b", "name": "A", "homepage": "h", "allowed_hosts": ["x"]}]))
    with pytest.raises(ValueError, match="broken"):
        readers.registry(spark, str(path))


def _tar(path, members):
    with tarfile.open(path, "w:gz") as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size = len(body)
            tar.addfile(info, io.BytesIO(body))


def test_tar_members(spark, tmp_path):
    spark.dataSource.register(archives.TarMembers)
    path = tmp_path / "a.tar.gz"
    _tar(path, [("x/1.json", b"{}"), ("x/1.json", b"{}"), ("x/2.json", b"[1]"), ("y.txt", b"-")])
    df = spark.read.format("tar_members").option("path", str(path)).option("suffix", ".json").load()
    assert sorted((r.member, r.size) for r in df.collect()) == [("x/1.json", 2), ("x/2.json", 3)]
    _tar(path, [("x", b"1"), ("x", b"2")])
    with pytest.raises(Exception, match="two different members"):
        spark.read.format("tar_members").option("path", str(path)).load().collect()


def test_midi(spark):
    track = bytes([0, 0xC0, 24, 0, 0x90, 60, 64, 0x60, 60, 0, 0, 0xFF, 0x2F, 0])
    body = b"MThd" + struct.pack(">IHHH", 6, 0, 1, 96) + b"MTrk" + struct.pack(">I", len(track)) + track
    got = music.read_midi(spark.createDataFrame([("f", bytearray(body))], "id string, body binary")).orderBy("ordinal").collect()
    assert [(r.tick, r.kind, r.pitch, r.program) for r in got] == [(0, "program", None, 24), (0, "on", 60, None), (96, "off", 60, None)]


def test_notes(spark):
    note = "<note>{}<pitch><step>{}</step><octave>3</octave></pitch><duration>{}</duration><voice>1</voice></note>"
    xml = "<score-partwise><part id='P1'><measure><attributes><divisions>2</divisions></attributes>{}{}{}</measure><measure>{}</measure></part></score-partwise>"
    xml = xml.format(note.format("", "C", 4), note.format("<chord/>", "E", 4), note.format("", "G", 1), note.format("", "C", 2))
    got = music.read_notes(spark.createDataFrame([("f", bytearray(xml.encode()))], "id string, body binary")).collect()
    assert [(r.measure, r.onset_num, r.onset_den, r.pitch) for r in got] == [(0, 0, 1, 48), (0, 0, 1, 52), (0, 2, 1, 55), (1, 5, 2, 48)]


def test_wikitext(spark):
    text = "==A==\n===B===\n{{File|x={{T|1}}|y}}\n==C==\n{{File|z}}\n{{Other}}"
    got = markup.read_wikitext(spark.createDataFrame([(1, text)], "page_id long, wikitext string")).orderBy("place").collect()
    assert [(r.headings, r.chunk) for r in got] == [(["A", "B"], "File|x={{T|1}}|y"), (["C"], "File|z")]


def test_sections():
    assert markup.sections("<p>a<script>x</script></p><h1>T</h1><p>b</p>") == [("", "a"), ("T", "b")]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    sinks.replace_table(df, path)
    sinks.replace_table(spark.range(5), path)
    assert sinks.read_table(spark, path).count() == 5
    assert sinks.append_rows(path, spark.range(5, 7), "id") == 2
    with pytest.raises(ValueError, match="already"):
        sinks.append_rows(path, spark.range(1), "id")
    with pytest.raises(ValueError, match="repeat"):
        sinks.append_rows(path, spark.range(20, 21).union(spark.range(20, 21)), "id")
    assert sorted(r.id for r in sinks.read_table(spark, path).collect()) == list(range(7))
    with pytest.raises(ValueError, match="not published"):
        sinks.publish(df, df, path)
    sinks.write_manifest(df.withColumn("p", F.array(F.lit("a"), F.lit("b"))), str(tmp_path / "m"), "id")
    assert spark.read.csv(str(tmp_path / "m"), header=True).first().p == "a | b"


def test_csv_files_must_have_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id,name\n1,x\n")
    (tmp_path / "b.csv").write_text("id,name\n2,y\n")
    assert sorted(tuple(r) for r in readers.csv_strict(spark, str(tmp_path), ["id", "name"]).collect()) == [("1", "x"), ("2", "y")]
    (tmp_path / "c.csv").write_text("id,title\n3,z\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.csv_strict(spark, str(tmp_path), ["id"])


def test_category_files_are_one_scan(spark, tmp_path):
    for n in "ab":
        (tmp_path / f"{n}.json").write_text(json.dumps([{"id": n}, {"id": n * 2}]))
    rows = readers.by_category(spark, {"A": str(tmp_path / "a.json"), "B": str(tmp_path / "b.json")}, "id string")
    assert sorted((r.category, r.id) for r in rows.collect()) == [("A", "a"), ("A", "aa"), ("B", "b"), ("B", "bb")]


def test_archive_bounds_and_json(spark, tmp_path):
    spark.dataSource.register(archives.TarMembers)
    path = tmp_path / "a.tar.gz"
    load = lambda **o: spark.read.format("tar_members").option("path", str(path)).options(**o).load().collect()
    _tar(path, [("x/1.json", b'{"id": 1}'), ("x/2.json", b'{"id": 3}')])
    assert [r.member for r in load(names="x/1.json", json="true", idKey="id")] == ["x/1.json"]
    for options, message in (({"maxMembers": "1"}, "more than"), ({"maxBytes": "10"}, "more than"), ({"json": "true", "idKey": "id"}, "another one")):
        with pytest.raises(Exception, match=message):
            load(**options)
    _tar(path, [("x/1.json", b'{"id": 1, "id": 1}')])
    with pytest.raises(Exception, match="repeats"):
        load(json="true")


def test_broken_files_give_an_issue(spark):
    bad = b"MThd" + struct.pack(">IHHH", 6, 0, 1, 96) + b"MTrk" + struct.pack(">I", 4) + bytes([0, 60, 64, 0])
    meta = bytes([0, 0x90, 60, 64, 0, 0xFF, 0x21, 1, 5, 0, 60, 0])  # the meta event ends the running status
    files = [("a", bytearray(bad)), ("b", bytearray(bad[:14] + b"MTrk" + struct.pack(">I", len(meta)) + meta)), ("c", bytearray(b"x"))]
    df = spark.createDataFrame(files, "id string, body binary")
    assert {(r.id, r.kind, r.issue) for r in music.read_midi(df).collect()} == {
        ("a", None, "ValueError: data byte without a status"), ("b", None, "ValueError: data byte without a status"), ("c", None, "ValueError: not a MIDI file"),
    }
    assert {r.issue.split(":")[0] for r in music.read_notes(df).collect()} == {"ParseError"}


def test_marks(spark):
    xml = (
        "<score-partwise><part-list><score-part id='P1'><part-name>Guitar</part-name></score-part></part-list><part id='P1'><measure><attributes>"
        "<clef number='2'><sign>G</sign><line>2</line><clef-octave-change>-1</clef-octave-change></clef></attributes><harmony><root><root-step>C</root-step></root><kind>major</kind></harmony></measure></part></score-partwise>"
    )
    got = music.read_marks(spark.createDataFrame([("f", bytearray(xml.encode()))], "id string, body binary")).collect()
    assert [(r.kind, r.text, r.staff) for r in got] == [("part", "Guitar", None), ("clef", "G28", 2), ("harmony", "C major", 1)]


def test_wikitext_names_and_comments(spark):
    texts = [(1, "{{Filed|a}}<!--{{File|b}}-->{{ File |c}}"), (2, "{{File|open"), (3, None)]
    got = markup.read_wikitext(spark.createDataFrame(texts, "page_id long, wikitext string")).collect()
    assert {(r.page_id, r.chunk, r.issue) for r in got} == {(1, " File |c", None), (2, None, "template without an end")}


def test_transport(spark):
    from quaverlake.sources import transport

    doc = {"works": [{"id": "work:1", "n": 1.5, "x": None}, {"id": "work:1", "n": -2, "x": True}], "ab": "ab"}
    envelope = transport.pack(doc, "c")
    assert transport.unpack(envelope, "c") == doc and transport.unpack(doc, "c") == doc
    for change in ({"codec": "d"}, {"uncompressed_bytes": envelope["uncompressed_bytes"] + 1}, {"payload": "AAAA"}, {"more": 1}):
        with pytest.raises(ValueError):
            transport.unpack(envelope | change, "c")
    with pytest.raises(ValueError):
        transport.pack({"a": float("nan")}, "c")


def test_review_tables_and_catalogs(spark, tmp_path):
    from quaverlake.sources import records

    (tmp_path / "r.tsv").write_text('key\tzh\na "x\t练\nb\t\n')
    assert sorted(tuple(r) for r in records.tsv_review(spark, str(tmp_path / "r.tsv"), ["key", "zh"], "key").collect()) == [('a "x', "练"), ("b", None)]
    (tmp_path / "r.tsv").write_text("key\tzh\na\tx\na\ty\n")
    with pytest.raises(ValueError, match="keys"):
        records.tsv_review(spark, str(tmp_path / "r.tsv"), ["key", "zh"], "key")
    (tmp_path / "src").mkdir()
    write = lambda source, works: (tmp_path / "src/catalog.json").write_text(json.dumps({"source_id": source, "works": works}))
    schema = "struct<id:string,title:string,path:string>"
    write("src", [{"id": "src:1", "title": "a", "path": "x/y.pdf"}, {"id": "src:2", "title": "b", "path": None}])
    patch = spark.createDataFrame([("src:2", "B")], "id string, title string")
    assert sorted((r.id, r.title) for r in records.source_catalog(spark, str(tmp_path), "src", schema, [(patch, "id")]).collect()) == [("src:1", "a"), ("src:2", "B")]
    for source, works, message in (("other", [{"id": "src:1"}], "is of"), ("src", [{"id": "x:1"}], "out of bounds"), ("src", [{"id": "src:1", "path": "../x"}], "out of bounds")):
        write(source, works)
        with pytest.raises(ValueError, match=message):
            records.source_catalog(spark, str(tmp_path), "src", schema)
    with pytest.raises(ValueError, match="not a source"):
        records.source_catalog(spark, str(tmp_path), "..", schema)
    with pytest.raises(ValueError, match="two configured"):
        records.config_union({"a": spark.createDataFrame([("X",)], "name string"), "b": spark.createDataFrame([("x",)], "name string")}, "name", [F.col("name")])


def test_digests_and_typed_sinks(spark, tmp_path):
    from quaverlake.sources import records

    folder = tmp_path / "f"
    folder.mkdir()
    (folder / "a.txt").write_text("a")
    (folder / "b.txt").write_text("b")
    before = spark.createDataFrame(records.file_digests(spark, str(folder), "*.txt").collect())
    (folder / "a.txt").write_text("changed")
    (folder / "b.txt").unlink()
    (folder / "c.txt").write_text("c")
    got = {(r.path.rsplit("/", 1)[1], r.fault) for r in records.changed_files(before, records.file_digests(spark, str(folder), "*.txt")).collect()}
    assert got == {("a.txt", "content"), ("b.txt", "gone"), ("c.txt", "new")}

    path = str(tmp_path / "typed")
    sinks.write_typed(spark.range(2), path, "Work", 2)
    sinks.write_typed(spark.range(3), path, "Work", 2)
    assert sinks.read_table(spark, path).count() == 3
    for kind, version in (("Other", 2), ("Work", 1)):
        with pytest.raises(ValueError, match="holds"):
            sinks.write_typed(spark.range(1), path, kind, version)
    assert sinks.write_ledger(spark.createDataFrame([(1, "x", None)], "id int, a string, b string"), str(tmp_path / "ledger"), "id") == 1


def test_corpus_scans(spark, tmp_path):
    from quaverlake.sources import corpus

    path = tmp_path / "a.tar"
    xml = b"<score-partwise><part-list><score-part id='P1'><part-name>Lute</part-name></score-part></part-list></score-partwise>"
    _tar(path, [("a.mxl", xml), ("b.mxl", b"<"), ("c.json", b'{"x": 1}'), ("d.json", b"{}")])
    got = {(r.id, r.text, (r.issue or "").split(":")[0]) for r in corpus.score_scan(spark, [str(path)]).collect()}
    assert got == {("a.mxl", "Lute", ""), ("b.mxl", None, "ParseError")}
    wanted = spark.createDataFrame([("c.json",), ("e.json",)], "m string")
    assert [tuple(r) for r in corpus.candidate_scan(spark, [str(path)], wanted, "m").collect()] == [("c.json", '{"x": 1}')]
    files = spark.createDataFrame([("a", bytearray(b"%PDF-x"))], "id string, body binary")
    assert corpus.read_pages(files).first().issue
