"""Known answers of the notation operators."""

from pyspark.sql import functions as F

from quaverlake.operators import notation as N


def test_play_order(spark):
    m = [("a", 1, False, False, None), ("a", 2, True, False, None), ("a", 3, False, True, 1), ("a", 4, False, False, 2), ("a", 5, False, False, None)]
    df = spark.createDataFrame(m, "score string, measure long, opens boolean, closes boolean, ending int")
    got = [r.measure for r in N.play_order(df).orderBy("place").collect()]
    assert got == [1, 2, 3, 2, 4, 5]


def test_ties(spark):
    n = [("a", 1, "1", 60, 0, 4, False), ("a", 1, "1", 60, 4, 6, True), ("a", 1, "1", 60, 6, 8, False), ("a", 1, "1", 62, 4, 5, True)]
    df = spark.createDataFrame(n, "id string, staff int, voice string, pitch int, start long, stop long, tied boolean")
    got = sorted((r.pitch, r.start, r.stop) for r in N.merge_ties(df).collect())
    assert got == [(60, 0, 6), (60, 6, 8), (62, 4, 5)]


def test_views(spark):
    a = spark.createDataFrame([(i, k, p) for i in "xyzw" for k, p in enumerate((60, 62, 64))], "id string, ordinal int, pitch int")
    b = spark.createDataFrame(
        [("x", 0, 60), ("x", 1, 62), ("x", 2, 64), ("y", 0, 48), ("y", 5, 50), ("y", 9, 52), ("z", 0, 60), ("z", 1, 50), ("z", 2, 64), ("w", 0, 60)],
        "id string, ordinal int, pitch int",
    )
    assert {r.id: r.view for r in N.compare_views(a, b).collect()} == {"x": "exact", "y": "octave", "z": "different", "w": "different"}


def test_sounding_programs(spark):
    e = [(0, 0, 0, "program", 0, None, 24), (0, 1, 5, "on", 0, 60, None), (1, 0, 5, "program", 0, None, 40), (0, 2, 9, "on", 0, 62, None), (0, 3, 9, "on", 1, 50, None)]
    df = spark.createDataFrame(e, "track int, ordinal int, tick long, kind string, channel int, pitch int, program int").withColumn("id", F.lit("f"))
    got = sorted((r.pitch, r.program, r.unclear) for r in N.sounding_programs(df).collect())
    assert got == [(50, 0, False), (60, 24, True), (62, 40, False)]
    why = [spark.range(1).select(N.explain_programs(F.lit(a), F.lit(b))).first()[0] for a, b in ((24, 24), (24, 0), (24, 25), (24, 40))]
    assert why == ["same", "unset", "family", "different"]
