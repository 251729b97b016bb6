"""Jobs, sinks, PDF text, markup, legacy glyphs, layout helpers and the status stream on small cases."""

import json
import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators import layout as L
from folioloom.operators import markup as X
from folioloom.sources import files as S
from folioloom.sources import jobs as J
from folioloom.sources import pdf as D
from folioloom.streaming import state


def test_job(tmp_path):
    good = {"book_name": "b", "source": "in/s.pdf", "template": "t.docx", "source_type": "pdf", "content_page_ranges": [[3, 5], [7, 7]], "preview_source_page_numbers": [3, 7], "final_output": "out.docx"}
    (tmp_path / "job.json").write_text(json.dumps(good))
    job = J.load_job(tmp_path / "job.json")
    assert job.paths["source"] == tmp_path / "in/s.pdf" and job.boundary == "explicit"
    assert job.content_pages() == [3, 4, 5, 7] and job.expected_pages("preview") == [3, 7] and job.document("final").name == "out.docx"
    assert J.job_errors(job) == []
    bad = good | {"source_type": "odt", "content_page_ranges": [[3, 5], [5, 4]], "preview_source_page_numbers": [9, 9], "final_output": "t.docx", "book_name": ""}
    (tmp_path / "bad.json").write_text(json.dumps(bad))
    found = " ".join(J.job_errors(J.load_job(tmp_path / "bad.json")))
    for words in ("source_type is odt", "book_name is missing", "5 to 4", "page twice", "would overwrite template"):
        assert words in found
    drafts = {"draft": J.draft_manifest(tmp_path / "in/ir.json"), "queue": job.paths["source"]}
    assert drafts["draft"].name == "ir.draft.json" and J.draft_errors(job, drafts) == ["queue would overwrite source"]
    assert J.draft_review(tmp_path).parts[-2:] == ("Review", "review_queue.draft.json")


def test_profile(tmp_path):
    (tmp_path / "maths.json").write_text(json.dumps({"print_layout": {"page": {"width_mm": 210, "inside_margin_mm": 22, "outside_margin_mm": 18, "text_width_mm": 170}, "options": {"table_width": 9, "grids": {"two": [4, 5]}}}}))
    assert J.load_profile(tmp_path, "maths", {})["page"]["width_mm"] == 210
    (tmp_path / "odd.json").write_text(json.dumps({"print_layout": {"page": {"width_mm": -1}, "options": {"table_width": 9, "grids": {"two": [4, 4]}}}}))
    with pytest.raises(ValueError, match="grid two"):
        J.load_profile(tmp_path, "odd", {})
    with pytest.raises(ValueError, match="no profile name"):
        J.load_profile(tmp_path, "../maths", {})
    (tmp_path / "plain.json").write_text("{}")
    assert J.load_profile(tmp_path, "plain", {"page": {}}) == {"page": {}}


def test_sinks(tmp_path):
    J.write_json(tmp_path / "a/x.json", {"b": 1, "a": "é"})
    assert (tmp_path / "a/x.json").read_text() == '{\n  "a": "é",\n  "b": 1\n}\n' and J.manifest_scope(tmp_path / "a/x.json") is None
    J.write_package(tmp_path / "p.zip", {"b": b"2", "a": b"1"})
    with zipfile.ZipFile(tmp_path / "p.zip") as z:
        assert z.namelist() == ["a", "b"] and z.read("a") == b"1"
    with pytest.raises(FileExistsError):
        J.write_package(tmp_path / "p.zip", {})
    J.write_report(tmp_path / "r.txt", "Report", ["bad"], [], {"pages": 3})
    assert (tmp_path / "r.txt").read_text().splitlines()[:4] == ["Report", "======", "Result: FAIL", "pages: 3"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "p.zip", "r.txt"]


def test_pdf_pages(spark, tmp_path):
    assert D.split_pages("one\ftwo\f\n") == ["one", "two"] and D.split_pages("") == []
    (tmp_path / "x.pdf").write_bytes(b"no pdf")
    row = D.pdf_pages(spark, str(tmp_path / "x.pdf")).first()
    assert row["error"] and row["page"] is None
    pages = spark.createDataFrame([("d", 1, "a\nb\0", 2, "tool", None), ("d", 2, "�", 2, "tool", None), ("e", None, None, None, None, "bad")], D.PAGES)
    assert [(r["doc"], r["n_pages"], r["chars"], r["nul"], r["replaced"], r["unreadable"]) for r in D.page_inventory(pages).orderBy("doc").collect()] == [("d", 2, 5, 1, 1, 0), ("e", 0, 0, 0, 0, 1)]
    assert [(r["line_no"], r["raw"]) for r in D.page_lines(pages).where("page = 1").orderBy("line_no").collect()] == [(1, "a"), (2, "b\0")]


def test_markup(spark):
    xml = b'<w:document xmlns:w="u"><w:body><w:p><w:r><w:t>a</w:t><w:tab/></w:r></w:p><w:tbl><w:p><w:t>b</w:t></w:p></w:tbl><w:sectPr/></w:body></w:document>'
    deep = b"<a>" * 3000 + b"</a>" * 3000
    e = X.elements(spark.createDataFrame([("d", "x", bytearray(xml)), ("d", "bad", bytearray(b"<a>")), ("d", "none", None), ("d", "deep", bytearray(deep))], "path string, part string, content binary")).cache()
    assert {r["part"] for r in X.malformed(e).collect()} == {"bad", "none"} and e.where("part = 'deep'").count() == 3000
    assert [r["token"] for r in X.visible_tokens(e).orderBy("n").collect()] == ["T:a", "TAB", "T:b"]
    assert [(r["pos"], r["kind"], r["text"]) for r in X.body_members(e).where("part = 'x'").orderBy("pos").collect()] == [(1, "paragraph", "a"), (2, "table", "b")]


def test_legacy_order(spark):
    g = T.Glyphs((("k", "ा"), ("d", "क"), ("e", "म"), ("j~", "र्"), ("U", "न्")), before="f", before_text="ि", after="Z", after_code="j~", halves="U", stem="k", signs="k")
    convert = T.transliterator(g)
    rows = spark.createDataFrame([("fd",), ("fUd",), ("deZ",), ("ekZ",), ("fd fe",), (None,)], "t string")
    assert [r["v"] for r in rows.select(convert("t").alias("v")).collect()] == ["कि", "न्कि", "कर्म", "र्मा", "कि मि", None]


def test_layout_helpers(spark):
    df = spark.createDataFrame([(1, "rect", 5.0, 1.0, None, None, 10.0, 30.0), (1, "rect", None, 2.0, 1.0, 2.0, None, None)], "page int, kind string, x0 double, x1 double, top double, bottom double, y0 double, y1 double")
    box = L.normal_box(df, 100.0).collect()
    assert [(b["x0"], b["x1"], b["top"], b["bottom"]) for b in box] == [(1.0, 5.0, 70.0, 90.0)]
    ends = spark.createDataFrame([(1, 10.0, 60.0), (1, 0.0, 20.0), (2, 5.0, 900.0)], "page int, top double, bottom double")
    assert {r["page"]: (r["top"], r["bottom"], r["utilization"]) for r in L.page_extent(ends, 10.0, 110.0).collect()} == {1: (0.0, 60.0, 50.0), 2: (5.0, 900.0, 100.0)}
    use = spark.createDataFrame([(1, 80.0), (2, 55.0), (3, 74.0), (4, 90.0)], "page int, utilization double")
    source = spark.createDataFrame([(1, 90.0), (4, 95.0)], "page int, utilization double")
    assert {r["page"]: r["severity"] for r in L.utilization_rules(use, source).collect()} == {1: "error", 2: "error", 3: "warning", 4: "warning"}
    outer = spark.createDataFrame([(1, 40.0, 500.0), (2, 60.0, 500.0)], "page int, x0 double, x1 double")
    assert [r["page"] for r in L.outside_frame(outer, 18.0, 192.0).collect()] == [1]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(7, "a\nb")], "doc_id long, text string")
    assert [(r["doc"], r["raw"]) for r in S.document_lines(df).collect()] == [("7", "a"), ("7", "b")]
    S.write_once(df, str(tmp_path / "out"))
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        S.write_once(df, str(tmp_path / "out"))
    (tmp_path / "m.json").write_text('{\n "doc": "x",\n "pages": [1, 2]\n}')
    assert S.block_manifest(spark, str(tmp_path / "m.json"), "doc string, pages array<int>").first()["pages"] == [1, 2]


def test_status_stream(spark, tmp_path):
    begun = datetime(2024, 1, 1)
    log = spark.createDataFrame([("j", s, begun + timedelta(minutes=m)) for s, m in (("draft", 0), ("checked", 5), ("done", 12))], "job string, state string, at timestamp")
    head = state.status_heads(log).first()
    assert (head["head"], head["n_states"]) == ("done", 3)
    log.write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "log"))
    for name, df in (("heads", state.status_heads(stream)), ("counts", state.windowed_counts(stream))):
        q = df.writeStream.outputMode("complete").format("memory").queryName(f"t_{name}").option("checkpointLocation", str(tmp_path / name)).start()
        q.processAllAvailable()
        q.stop()
    assert spark.table("t_heads").first()["head"] == "done"
    assert spark.table("t_counts").select(F.sum("n")).first()[0] == 3
