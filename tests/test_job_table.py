"""Jobs as a table: every rule of the decision table by a manifest that breaks it, and hashes of all bound files."""

import json

import pytest

from folioloom.operators.decisions import Rule, decide
from folioloom.sources import job_table as J

DOCX = {"job_id": "j", "class": 11, "subject": "s", "source": "in/a.docx", "template": "t.docx", "preview_output": "out/p.docx", "final_output": "out/f.docx", "qa_dir": "qa"}
PDF = DOCX | {
    "source": "a.PDF", "normalized_source": "work/n.docx", "content_manifest": "work/m.json", "content_policy": "reconstruct_content", "typography_policy": "mapped_pdf_fonts",
    "preview_source_pages": 2, "preview_source_page_numbers": [1, 9], "content_page_ranges": [[1, 3], [7, 9]], "expected_page_count": 6, "render_authority": "word",
    "pdf_font_map": {"hindi": "a", "latin": "b", "math": "c"},
}
FILES = [("/r/in/a.docx",), ("/r/t.docx",), ("/r/a.PDF",), ("/r/l.docx",)]

CASES = [
    (DOCX, set()), (PDF, set()), (DOCX | {"source": "/r/./x/../in/a.docx"}, set()), (DOCX | {"layout_reference": ""}, set()),
    *[(DOCX | {n: ""}, {"name_missing"}) for n in ("job_id", "class", "subject")],
    (DOCX | {"template": None}, {"template_missing"}), (DOCX | {"qa_dir": ""}, {"qa_dir_missing"}), (DOCX | {"final_output": ""}, {"final_output_missing"}),
    (DOCX | {"preview_output": ""}, {"preview_output_missing"}), (DOCX | {"source": "in/b.docx"}, {"source_file"}), (DOCX | {"template": "u.docx"}, {"template_file"}),
    (DOCX | {"approved_reference": "u.docx"}, {"approved_reference_file"}), (DOCX | {"layout_reference": "u.docx"}, {"layout_reference_file"}),
    (DOCX | {"source_type": "odt"}, {"source_type"}), (DOCX | {"source_type": "PDF"}, {"source_suffix", "pdf_content_policy", "pdf_typography_policy", "pdf_normalized_source", "pdf_content_manifest", "pdf_preview_pages", "pdf_font_roles"}),
    (DOCX | {"content_policy": "x"}, {"content_policy", "docx_content_policy"}), (DOCX | {"typography_policy": "mapped_pdf_fonts"}, {"docx_typography_policy"}),
    (DOCX | {"typography_policy": "x"}, {"typography_policy", "docx_typography_policy"}), (DOCX | {"boundary_strategy": "x"}, {"boundary_strategy"}),
    (DOCX | {"first_content_side": "left"}, {"first_content_side"}), (DOCX | {"render_authority": "x"}, {"render_authority"}),
    (DOCX | {"source_style_policy": "x"}, {"source_style_policy"}), (DOCX | {"pagination_policy": "x"}, {"pagination_policy"}),
    (DOCX | {"source_style_policy": "content_only"}, {"layout_reference_missing"}), (DOCX | {"pagination_policy": "sample_flow"}, {"layout_reference_missing"}),
    (DOCX | {"pagination_policy": "sample_flow", "layout_reference": "l.docx"}, set()),
    (DOCX | {"preview_source_pages": 0}, {"preview_source_pages"}), (DOCX | {"expected_page_count": 0}, {"expected_page_count"}),
    (DOCX | {"content_page_ranges": [[1, 2], [3]]}, {"range_shape"}), (DOCX | {"content_page_ranges": [[1, "x"]]}, {"range_shape"}), (DOCX | {"content_page_ranges": {"a": 1}}, {"field_type"}),
    (DOCX | {"content_page_ranges": [[0, 2]]}, {"range_ends"}), (DOCX | {"content_page_ranges": [[5, 4]]}, {"range_ends"}),
    (DOCX | {"content_page_ranges": [[1, 4], [4, 6]]}, {"range_overlap", "range_order"}), (DOCX | {"content_page_ranges": [[5, 6], [1, 2]]}, {"range_order"}),
    (DOCX | {"content_page_ranges": [[1, 2000000000]], "expected_page_count": 2000000000}, set()),
    (DOCX | {"content_page_ranges": [[1, 4]], "expected_page_count": 5}, {"page_count_differs"}),
    (PDF | {"expected_page_count": None}, {"word_pdf_pages"}), (PDF | {"content_page_ranges": []}, {"word_pdf_pages"}),
    (PDF | {"preview_source_page_numbers": [1, 5]}, {"preview_outside"}), (PDF | {"preview_source_page_numbers": [1, 1]}, {"preview_repeated"}),
    (DOCX | {"preview_source_page_numbers": [0], "preview_source_pages": 1}, {"preview_positive"}), (PDF | {"preview_source_pages": 3}, {"preview_length"}),
    (PDF | {"content_policy": "layout_only"}, {"pdf_content_policy"}), (PDF | {"boundary_strategy": "saved_rendered"}, {"pdf_boundary_strategy"}),
    (PDF | {"normalized_source": None}, {"pdf_normalized_source"}), (PDF | {"content_manifest": None}, {"pdf_content_manifest"}), (PDF | {"preview_source_page_numbers": []}, {"pdf_preview_pages"}),
    (PDF | {"pdf_font_map": {"hindi": "a"}}, {"pdf_font_roles"}), (PDF | {"pdf_font_map": ["hindi"]}, {"field_type", "pdf_font_roles"}),
    (DOCX | {"final_output": "out/../t.docx"}, {"output_protected"}), (PDF | {"normalized_source": "t.docx"}, {"normalized_protected"}), (PDF | {"content_manifest": "./a.PDF"}, {"manifest_protected"}),
    (DOCX | {"final_output": "out/p.docx"}, {"made_twice"}), (PDF | {"content_manifest": "work/n.docx"}, {"made_twice"}),
    (DOCX | {"template": 7}, {"field_type", "template_missing"}), ("{", {"json"}), (None, {"json"}), ("[]", {"root_object"}),
]


def jobs(spark, values):
    return spark.createDataFrame([(f"j{k}", "/r", v if isinstance(v, str | None) else json.dumps(v)) for k, v in enumerate(values)], "job string, root string, value string")


def test_every_rule(spark):
    found: dict[str, set] = {}
    for r in J.job_violations(jobs(spark, [v for v, _ in CASES]), spark.createDataFrame(FILES, "path string")).collect():
        found.setdefault(r.key.split("/")[0], set()).add(r.rule_id)
    for k, (value, want) in enumerate(CASES):
        assert found.get(f"j{k}", set()) == want, value
    ids = {r.rule_id for r in J.RULES}
    assert ids - set().union(*(w for _, w in CASES)) == {"source_missing"}
    assert {"source_missing"} <= {r.rule_id for r in J.job_violations(jobs(spark, [{}]), spark.createDataFrame(FILES, "path string")).collect()}


def test_hashes_of_all_bound_files(spark):
    facts, _ = J.job_facts(jobs(spark, [DOCX, PDF | {"approved_reference": "l.docx"}, DOCX, PDF]))
    files = spark.createDataFrame([("/r/in/a.docx", "A"), ("/r/t.docx", "T"), ("/r/a.PDF", "P"), ("/r/l.docx", "L"), ("/r/out/p.docx", "V"), ("/r/work/m.json", "M")], "path string, sha256 string")
    status = lambda **v: json.dumps({f"{k}_sha256": x for k, x in v.items()} | {"state": "x", "history": []})
    statuses = spark.createDataFrame([
        ("j0", status(preview="V", source="A", template="T", approved_preview="V", approved_source="A", approved_template="T")),
        ("j1", status(preview="V", source="P", template="old", normalized_source="N", content_manifest="M", approved_reference="L", approved_preview="V", approved_source="P", approved_template="T", approved_content_manifest="")),
        ("j2", "{"),
    ], "job string, value string")
    got = lambda stage: sorted((r.rule_id, r.key) for r in J.provenance_violations(facts, statuses, files, stage).collect() if r.key[:2] in ("j0", "j1"))
    assert got("preview") == [("changed", "j1/template"), ("lost", "j1/normalized_source")]
    assert got("approved") == [("unrecorded", "j1/content_manifest"), ("unrecorded", "j1/normalized_source")]
    gate = {r.job: (r.n_preview, r.n_approved, r.passed) for r in J.conversion_gate(facts, statuses, files).collect()}
    assert gate == {"j0": (0, 0, True), "j1": (2, 2, False), "j2": (3, 3, False), "j3": (5, 5, False)}
    with pytest.raises(ValueError):
        J.provenance_violations(facts, statuses, files, "final")


def test_no_jobs_and_nulls(spark):
    none = jobs(spark, [DOCX]).where("job = ''")
    assert J.job_violations(none, spark.createDataFrame(FILES, "path string")).count() == 0
    rows = spark.createDataFrame([("a", None, "1"), ("b", "x", None), ("c", " ", "2")], "k string, f string, n string")
    rules = [Rule("given", "f", "given"), Rule("not_x", "f", "not_in", ("x",)), Rule("least", "n", "at_least", ("2",)), Rule("same", "f", "same", ("n",), {"k": ("c",)}, "warning")]
    assert sorted((r.key, r.rule_id, r.severity) for r in decide(rows, rules, rows["k"]).collect()) == [
        ("a", "given", "error"), ("a", "least", "error"), ("b", "least", "error"), ("b", "not_x", "error"), ("c", "given", "error"), ("c", "same", "warning"),
    ]
    with pytest.raises(ValueError):
        decide(rows, [Rule("r", "f", "like")], rows["k"])
