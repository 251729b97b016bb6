"""Columns with the names that operators use inside, many secrets in a text, and phrases out of their place."""

import time

from folioloom.llm import licenses, quality, secret_scan


def test_internal_names_pass_through(spark):
    names = ["__w", "__n", "__parts", "__p", "__j", "__index", "__again", "__h"]
    rows = [(1, "Released under the MIT License. " * 3, *map(str, range(8))), (2, None, *[None] * 8)]
    df = spark.createDataFrame(rows, "doc_id int, text string, " + ", ".join(f"{n} string" for n in names))
    for out in (quality.quality_rules(df), secret_scan.secret_scan(df), licenses.license_scan(df)):
        got = {r["doc_id"]: r for r in out.collect()}
        assert [got[1][n] for n in names] == list(map(str, range(8))) and got[2]["__w"] is None


def test_many_secrets(spark):
    key = lambda k: f"{k:x}".rjust(4, "0") + "9f3ab47c11d2e8a6b5c4d3e2f1a0b9c8d7e6"
    text = " ".join(f'token = "{key(k)}"' for k in range(8000))
    begun = time.perf_counter()
    r = secret_scan.secret_scan(spark.createDataFrame([(text,)], "text string")).first()
    assert time.perf_counter() - begun < 30
    assert r["n_secrets"] == 8000 and r["redacted"] == " ".join(['token = "[SECRET]"'] * 8000)
    for s in (r["secret_spans"][0], r["secret_spans"][4321], r["secret_spans"][-1]):
        assert text[s["start"] : s["end"]].endswith("d7e6") and s["end"] - s["start"] == 40


def test_phrases_stand_at_the_match(spark):
    mit = licenses.TEMPLATES[1].text
    words = mit.split()
    torn = " ".join(words[:3] + ["x"] * 5 + words[8:])  # the rare words agree, the phrase doesn't stand there
    rows = [(1, f"a b {mit} c"), (2, f"{torn} and elsewhere permission is hereby granted free of charge"), (3, f"{mit} {mit}")]
    got = {r["id"]: r["labels"] for r in licenses.license_scan(spark.createDataFrame(rows, "id int, text string")).collect()}
    assert "mit" in got[1].split(",") and "mit" not in got[2].split(",") and "mit" in got[3].split(",")


def test_lines_end_with_line_feeds_only(spark):
    text = "word\r- one\r- two | three\n- four"
    df = quality.with_counts(spark.createDataFrame([(text,)], "text string"))
    rule = next(r for r in quality.RULES if r.name == "bullets")
    n = rule.rejects.split("regexp_count")[1].split(" > ")[0]
    assert df.selectExpr(f"regexp_count{n} AS n").first()["n"] == 1
