"""Literal cases of the text functions and the page parser."""

from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators.pages import blocks, parse_page, reviews


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("v")).first()["v"]


def test_sanitize(spark):
    assert value(spark, "  café\xa0 text ﻿ ", T.sanitize) == "café text"
    for bad, why in (("bad\0text", "nul"), ("bad�text", "replacement"), ("à¤¯à¤¦à¤¿", "mojibake")):
        assert value(spark, bad, T.sanitize_error) == why
    assert value(spark, "fine", T.sanitize_error) is None


def test_language_runs(spark):
    runs = lambda t, d=None: [tuple(r) for r in value(spark, t, lambda c: T.language_runs(c, d))]
    assert runs("यदि x + 1 = 3", "math") == [("यदि", "hindi"), (" x + 1 = 3", "math")]
    assert runs("5 क ख x") == [("5 ", "math"), ("क ख", "hindi"), (" x", "math")]
    assert runs("plain") == [("plain", "latin")]


def test_anchors(spark):
    q = value(spark, "Q 12) body", T.question)
    assert (q["label"], q["number"], q["body"], q["layout"]) == ("Q12.", 12, "body", "inline")
    assert value(spark, "no", T.question) is None
    options = [tuple(o) for o in value(spark, "(A) one   (b) two", T.options)]
    assert options == [("A", 0, "one"), ("B", 10, "two")]
    assert value(spark, "text (A) late", T.options) == []
    assert value(spark, "........", T.is_answer_line) and not value(spark, ".......", T.is_answer_line)


def test_measures(spark):
    lines = lambda h: spark.range(1).select(T.answer_lines(F.lit(h)).alias("v")).first()["v"]
    assert tuple(lines(59.25)) == (2, 2.25)
    assert lines(42.75) is None
    dpi = lambda x: spark.range(1).select(T.dpi_passes(F.lit(x)).alias("v")).first()["v"]
    assert dpi(299.6) and not dpi(299.4)
    m = spark.range(1).select(T.side_margins(F.lit(1), 22.0, 18.0).alias("v")).first()["v"]
    assert tuple(m) == (22.0, 18.0)


def kinds(lines, page=14):
    return [b["kind"] for b in parse_page("d", page, lines)[0]]


def test_bilingual_question():
    b, r = parse_page("d", 14, ["Q1. यदि x", "What is x?"])
    assert [(x["question_id"], x["label"], x["layout"]) for x in b] == [("q-p014-001", "Q1.", "inline")] and not r


def test_options_two_by_two():
    b, r = parse_page("d", 1, ["MULTIPLE CHOICE QUESTION", "Q1. यदि", "If", "(A) 1 (B) 2", "(C) 3 (D) 4"])
    assert [x["kind"] for x in b] == ["heading", "question", "options"] and not r
    assert (b[2]["columns"], b[2]["layout"]) == (2, "two_by_two")


def test_answer_lines_and_folio():
    b, r = parse_page("d", 1, ["Q1. यदि", "If", "........", ". . . . . . . .", "7"])
    assert (b[1]["kind"], b[1]["count"], b[1]["spacing"], b[1]["for_question"]) == ("answer_lines", 2, 30.5, "q-p001-001") and not r


def test_doubts():
    b, r = parse_page("d", 1, ["Q7. body", "(A) one", "(C) three"])
    assert {x["type"] for x in r} == {"missing_translation", "option_sequence"} and b[1]["confidence"] == "medium"
    b, r = parse_page("d", 1, ["(A)"])
    assert [(x["kind"], x["text"]) for x in b] == [("paragraph", "(A)")] and r[0]["type"] == "incomplete_options"


def test_nearest_option_of_two_is_the_later():
    b, _ = parse_page("d", 1, ["(A) a               (B) b", "          tail", "(C) c (D) d"])
    assert {i["label"]: i["text"] for i in b[0]["items"]}["B"] == "b tail"


def test_wrapped_headings():
    b, _ = parse_page("d", 33, ["CHAPTER - 2", "Sets (and", "relations)", "SHORT ANSWER QUESTION (03", "MARKS QUESTION)"])
    assert [x["role"] for x in b] == ["unit_heading", "chapter_heading", "question_type_heading"]
    assert b[1]["text"] == "Sets (and relations)" and b[2]["text"].endswith("MARKS QUESTION)")


def test_pages_in_parallel(spark):
    rows = [("d", p, k, t) for p in (1, 2) for k, t in enumerate(["Q1. यदि", "If so", "(A) x"])]
    df = spark.createDataFrame(rows, "doc string, page int, line_no int, raw string")
    assert blocks(df).groupBy("kind").count().orderBy("kind").collect()[0]["count"] == 2
    assert {r["type"] for r in reviews(df).collect()} == {"option_sequence"}
