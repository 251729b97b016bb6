"""Manifests from JSON texts to violations."""

import hashlib
import json

from folioloom.sources import manifests as S

IMAGE = {"path": "a.png", "alt_text": "a", "effective_dpi": 300, "crop_bbox_points": [0, 0, 5, 5.5]}
GOOD = {
    "schema_version": 1, "book_name": "नाम", "scope": "full", "source": {"sha256": "H", "page_count": 2},
    "pages": [
        {"source_page": 1, "page_type": "mcq", "blocks": [
            {"kind": "question", "source_ids": ["s.pdf:p001"], "question_id": "q1", "label": "Q1", "english": "what?", "english_runs": [{"text": "x", "language": "latin"}]},
            {"kind": "options", "source_ids": ["s.pdf:p001"], "columns": 2, "items": [{"label": "A", "text": "one"}, {"label": "B", "formula_image": IMAGE | {"kind": "formula_image"}}]},
            {"kind": "answer_lines", "source_ids": ["s.pdf:p001"], "count": 3, "spacing_points": 28.5, "for_question": "q1", "more": {"unknown": 1}},
        ]},
        {"source_page": 2, "blocks": [{"kind": "figure", "source_ids": ["s.pdf:p002"], "image": IMAGE}, {"kind": "table", "source_ids": ["s.pdf:p002"], "rows": [["a", "b"], ["c", "d"]]}]},
    ],
}


def run(spark, *values, expected=None):
    texts = spark.createDataFrame([("s.pdf" if k == 0 else f"s{k}.pdf", v if isinstance(v, str | None) else json.dumps(v)) for k, v in enumerate(values)], "doc string, value string")
    m = S.flatten(texts)
    sources = spark.createDataFrame([("s.pdf", "H")], "doc string, sha256 string")
    asked = None if expected is None else spark.createDataFrame(expected, "doc string, pos int, page int")
    return m, sorted((r.rule_id, r.key) for r in S.manifest_violations(m, sources, asked).collect())


def test_a_good_manifest_as_tables(spark):
    m, wrong = run(spark, GOOD)
    assert wrong == []
    book = m.books.first()
    want = json.dumps(GOOD, ensure_ascii=False, separators=(",", ":"), sort_keys=True)
    assert (book.book_name, book.n_pages, book.manifest_sha256) == ("नाम", 2, hashlib.sha256(want.encode()).hexdigest().upper())
    blocks = {(b.page, b.pos): b for b in m.blocks.collect()}
    assert len(blocks) == 5 and blocks[1, 3].spacing == 28.5 and blocks[1, 2]["items"][1].formula.bbox == [0.0, 0.0, 5.0, 5.5] and blocks[2, 2].rows == [["a", "b"], ["c", "d"]]


def test_wrong_kinds_are_named(spark):
    bad = json.loads(json.dumps(GOOD))
    bad["pages"][0]["blocks"][0] |= {"label": 5, "english_runs": "x"}
    bad["pages"][0]["blocks"][2]["count"] = 3.0
    bad["pages"][1] |= {"utilization_exempt": "no", "source_page": True}
    bad["pages"][1]["blocks"][1] = 7
    bad["source"]["page_count"] = None
    _, wrong = run(spark, bad)
    typed = sorted(k for r, k in wrong if r == "field_type")
    assert typed == sorted("s.pdf/pages" + k for k in ("[0].blocks[0].english_runs", "[0].blocks[0].label", "[0].blocks[2].count", "[1].blocks[1]", "[1].source_page", "[1].utilization_exempt"))
    assert {("page_count", "s.pdf"), ("label", "s.pdf/1/1"), ("count", "s.pdf/1/3")} <= set(wrong)


def test_torn_files_roots_and_scopes(spark):
    _, wrong = run(spark, GOOD | {"scope": "preview"}, "{", None, "[1]", '{"a":1,"a":2}', {})
    assert [x for x in wrong if not x[1].startswith("s5.pdf")] == [("json", "s1.pdf"), ("json", "s2.pdf"), ("json", "s4.pdf"), ("preview_pages", "s.pdf"), ("root_object", "s3.pdf")]
    assert {r for r, k in wrong if k == "s5.pdf"} == {"schema_version", "book_name", "scope", "source_hash", "page_count", "pages"}
    _, wrong = run(spark, GOOD | {"scope": "preview"}, expected=[("s.pdf", 1, 1), ("s.pdf", 2, 2)])
    assert wrong == []
    _, wrong = run(spark, GOOD, expected=[("s.pdf", 1, 2), ("s.pdf", 2, 1)])
    assert wrong == [("page_sequence", "s.pdf")]


def test_no_manifests(spark):
    m = S.flatten(spark.createDataFrame([], "doc string, value string"))
    assert [t.count() for t in (m.books, m.pages, m.blocks, m.errors)] == [0] * 4
