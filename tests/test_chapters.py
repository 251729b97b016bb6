"""Small cases of chapters and the print contract."""

from pyspark.sql import functions as F

from folioloom.operators import chapters as C
from folioloom.operators import print_rules as R

HEAD = "question_type_heading"


def test_page_types(spark):
    rows = [
        (3, 1, "heading", HEAD, "MULTIPLE CHOICE QUESTION"), (3, 2, "question", None, None), (4, 1, "question", None, None), (5, 1, "question", None, None),
        (5, 2, "heading", HEAD, "LONG ANSWER QUESTION"), (5, 3, "question", None, None), (6, 1, "paragraph", None, "x"), (8, 1, "options", None, None), (9, 1, "question", None, None),
    ]
    df = spark.createDataFrame([("b", *r) for r in rows], "doc string, page int, pos int, kind string, role string, text string")
    pages = spark.createDataFrame([("b", p, "other") for p in (3, 4, 5, 6, 8, 9)], "doc string, page int, page_type string")
    got = {r["page"]: r["page_type"] for r in C.carry_page_types(df, pages).collect()}
    assert got == {3: "mcq", 4: "mcq", 5: "mixed", 6: "long_answer", 8: "mcq", 9: "other"}
    rows = [(1, 1, "heading", HEAD, "SHORT ANSWER QUESTION"), (2, 1, "heading", "chapter_heading", "C"), (2, 2, "question", None, None)]
    df = spark.createDataFrame([("b", *r) for r in rows], df.schema)
    pages = spark.createDataFrame([("b", p, "other") for p in (1, 2)], pages.schema)
    assert {r["page"]: r["page_type"] for r in C.carry_page_types(df, pages).collect()} == {1: "short_answer", 2: "other"}


def paragraphs(spark, texts):
    return spark.createDataFrame([("d", k, t) for k, t in enumerate(texts)], "doc string, idx int, text string")


def test_ranges(spark):
    p = paragraphs(spark, ["intro", "Goodwill Nature", "x", "Reconstitution", "y"])
    span = lambda *a: [(r["first"], r["last"]) for r in C.chapter_range(p, *a).collect()]
    assert span("Goodwill", "Reconstitution") == [(1, 2)] and span("Goodwill", None) == [(1, 4)] and span("none", None) == []


def test_last_rule_wins(spark):
    p = paragraphs(spark, ["Chapter X", "Chapter X"]).withColumn("is_heading", F.col("idx") == 0)
    text = lambda rules: [r["text"] for r in C.unify_headings(p, rules).orderBy("idx").collect()]
    assert text([("X", "T1", None), ("X", "T2", None)]) == ["T2", "Chapter X"]
    assert text([("X", "T1", None), ("X", "T2", None), ("Z", "T3", "X")]) == ["", "Chapter X"]


def test_scans(spark):
    p = paragraphs(spark, ["5 लाइन questions", "text", "Theory", "(a) x", "", "(b) y", "tail", "(c) z"]).withColumn("is_heading", F.col("idx").isin(0, 2))
    got = C.with_directives(p).orderBy("idx").collect()
    assert [r["directive"]["lines"] for r in got[:4]] == [5, 5, 8, 8] and got[0]["next_text"] == "text"
    assert sorted((r["run"], r["k"], r["text"]) for r in C.option_runs(p).collect()) == [(1, 1, "(a) x"), (1, 2, "(b) y"), (2, 1, "(c) z")]
    q = paragraphs(spark, ["Section A", "i", "i", "Section B", "i"]).withColumn("is_item", F.col("text") == "i")
    assert [r["number"] for r in C.section_counter(q, "^Section").orderBy("idx").collect()] == [None, 1, 2, None, 1]


def test_fonts(spark):
    fonts = lambda *x: spark.createDataFrame([(f,) for f in x], "font string")
    assert [r["font"] for r in C.missing_fonts(fonts("Nirmala UI", "Mangal", "Arial", "Dev"), fonts("nirmala ui", "kruti dev 010")).orderBy("font").collect()] == ["Mangal"]


def test_option_tables(spark):
    tables = spark.createDataFrame([(1, 100, "dxa", "fixed", 0), (2, 90, "dxa", "autofit", None)], "tbl int, width int, width_type string, layout string, indent int")
    grid = spark.createDataFrame([(t, c, 25) for t in (1, 2) for c in range(4)], "tbl int, col int, w int")
    cells = spark.createDataFrame([(t, 0, c, 25, f"({'ABCD'[c]}) x" if t == 1 else "(A) x") for t in (1, 2) for c in range(4)], "tbl int, row int, col int, w int, text string")
    rows = spark.createDataFrame([(1, 0, True), (2, 0, None)], "tbl int, row int, cant_split boolean")
    found = {(r["key"], r["rule_id"]) for r in R.option_tables(tables, grid, cells, rows).collect()}
    assert found == {("2", r) for r in ("fixed_layout", "indent", "grid_sum", "cant_split", "labels")}
    assert R.sections(spark.createDataFrame([("d", 1, 210.3, 297.0), ("d", 2, 215.9, 279.4)], "doc string, n int, width_mm double, height_mm double")).count() == 1
    marks = lambda *n: spark.createDataFrame([("d", k, v) for k, v in enumerate(n)], "doc string, pos int, number int")
    assert R.bookmark_sequence(marks(3, 5), marks(3, 4)).count() == 1 and R.bookmark_sequence(marks(3, 4), marks(3, 4)).count() == 0
