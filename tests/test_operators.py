"""Small cases of the relational operators."""

import io
import zipfile

from pyspark.sql import functions as F

from folioloom.operators import contracts as C
from folioloom.operators import layout as L
from folioloom.operators import ordered as O
from folioloom.operators import packages as P
from folioloom.sources import files as S


def test_carry_reset_and_islands(spark):
    df = spark.createDataFrame([(1, 1, "a", False), (1, 2, None, False), (1, 3, None, True), (1, 4, None, False), (1, 5, "b", False)], "k int, n int, v string, r boolean")
    got = df.select("n", O.carry_reset(F.col("v"), F.col("r"), ["k"], ["n"]).alias("c")).orderBy("n").collect()
    assert [r["c"] for r in got] == ["a", "a", None, None, "b"]
    runs = df.select("n", O.changes(F.col("v").isNull(), ["k"], ["n"]).alias("i")).orderBy("n").collect()
    assert [r["i"] for r in runs] == [1, 2, 2, 2, 3]


def test_asof(spark):
    left = spark.createDataFrame([(1, 100.0), (1, 50.0), (1, 400.0)], "k int, at double")
    right = spark.createDataFrame([(1, 100.0, 4), (1, 400.0, 5), (1, 400.0, 3)], "k int, at double, q int")
    strict = {r["at"]: r["q"] for r in O.asof_backward(left, right, ["k"], "at", "at", ["q"], inclusive=False, tie="q").collect()}
    loose = {r["at"]: r["q"] for r in O.asof_backward(left, right, ["k"], "at", "at", ["q"], tie="q").collect()}
    assert strict == {100.0: None, 50.0: None, 400.0: 4} and loose == {100.0: 4, 50.0: None, 400.0: 3}


def test_number_rows(spark):
    got = O.number_rows(spark.range(1000).select((F.col("id") * 7 % 1000).alias("x")), ["x"]).collect()
    assert all(r["row_number"] == r["x"] + 1 for r in got)


def test_prefix_and_relocation(spark):
    df = spark.createDataFrame([(1, k, k in (1, 3)) for k in range(6)], "k int, n int, b boolean")
    keep = lambda n, kept: [r["n"] for r in df.withColumn("p", O.running_prefix(F.col("b"), ["k"], ["n"], n, kept)).where("p").orderBy("n").collect()]
    assert keep(2, True) == [0, 1, 2, 3] and keep(2, False) == [0, 1, 2]
    order = df.orderBy(O.relocate(F.col("n"), F.lit(2), F.lit(4), F.lit(0))).collect()
    assert [r["n"] for r in order] == [2, 3, 0, 1, 4, 5]


def test_contracts(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (2, -1)], "id int, v int")
    found = C.row_violations(df, F.col("id"), [C.RowRule("positive", F.col("v") <= 0)])
    assert [(r["rule_id"], r["key"]) for r in found.collect()] == [("positive", "2")]
    assert C.gate(found).first()["passed"] is False
    assert C.duplicate_keys(df, ["id"]).count() == 1
    h = C.hash_gate(spark.createDataFrame([("a", "X"), ("b", "Y"), ("c", None)], "k string, h string"), spark.createDataFrame([("a", "X"), ("c", None)], "k string, h string"), "k", "h")
    assert {r["k"]: r["passed"] for r in h.collect()} == {"a": True, "b": False, "c": False}


def test_packages(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("word/document.xml", "<x/>")
        z.writestr("word/media/a.png", b"png")
    files = spark.createDataFrame([("one", bytearray(raw.getvalue())), ("bad", bytearray(b"no zip"))], "path string, content binary")
    parts = P.parts(files)
    assert {(r["path"], r["part"]) for r in parts.collect()} == {("one", "word/document.xml"), ("one", "word/media/a.png"), ("bad", None)}
    rels = spark.createDataFrame(
        [("one", "word/document.xml", "r1", "media/a.png", None), ("one", "word/document.xml", "r2", "/word/gone.xml", None), ("one", "word/document.xml", "r3", "http://x", "External")],
        "path string, owner string, id string, target string, mode string",
    )
    assert [r["id"] for r in P.broken_relationships(rels, parts).collect()] == ["r2"]


def test_closure_with_cycle(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "src string, dst string")
    got = P.closure(edges, spark.createDataFrame([("a",)], "root string"))
    assert {r["node"] for r in got.collect()} == {"a", "b", "c"}


def test_remaps(spark):
    need, used = spark.createDataFrame([(1,), (3,)], "id long"), spark.createDataFrame([(1,), (2,)], "id long")
    assert {r["id"]: r["new_id"] for r in P.remap_ids(need, used).collect()} == {1: 4, 3: 3}
    fold = spark.range(1).select(P.remap_fold(F.array(F.lit(1), F.lit(3)).cast("array<bigint>"), F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("m")).first()["m"]
    assert [tuple(x) for x in fold] == [(1, 3), (3, 4)]


def test_attach_rectangles(spark):
    box = "page int, kind string, x0 double, x1 double, top double, bottom double, color string, text string"
    rows = [
        (1, "word", 50.0, 70.0, 100.0, 110.0, None, "Q4."), (1, "word", 50.0, 70.0, 400.0, 410.0, None, "Q5"), (1, "word", 50.0, 70.0, 90.0, 95.0, None, "body"),
        (1, "rect", 51.0, 560.0, 250.0, 451.0, "P1", None), (1, "rect", 62.0, 560.0, 500.0, 587.0, "P1", None), (1, "rect", 51.0, 560.0, 20.0, 221.0, "P1", None), (1, "rect", 100.0, 560.0, 20.0, 221.0, "P1", None),
    ]
    got = {(r["number"], r["count"], r["review"]) for r in L.attach_rectangles(spark.createDataFrame(rows, box)).collect()}
    assert got == {(4, 7, None), (5, 3, None), (None, 7, "no_question")}


def test_rule_groups(spark):
    rows = [(1, 100.0, 350.0, 300.0, 300.0), (1, 350.0, 600.0, 300.2, 300.2), (1, 100.0, 300.0, 400.0, 400.0)]
    got = L.rule_groups(spark.createDataFrame(rows, "page int, x0 double, x1 double, top double, bottom double")).collect()
    assert [(r["x0"], r["x1"]) for r in got] == [(100.0, 600.0)]


def test_text_pages(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo\fthree\f")
    got = sorted((r["page"], r["line_no"], r["raw"]) for r in S.text_pages(spark, str(tmp_path / "a.txt")).collect())
    assert got == [(1, 1, "one"), (1, 2, "two"), (2, 1, "three")]
