"""Manifests and jobs are parsed once into one written table, in which no VARIANT stands."""

import json

from pyspark.sql import functions as F

from folioloom.sources import job_table as J
from folioloom.sources import manifests as S


def _spied(monkeypatch, module):
    seen, write = [], module.written
    monkeypatch.setattr(module, "written", lambda df, name: seen.append(df.schema.simpleString()) or write(df, name))
    return seen


def test_manifests_are_written_once_and_typed(spark, monkeypatch):
    seen = _spied(monkeypatch, S)
    book = {"schema_version": 2**40, "pages": [{"source_page": 1, "blocks": [{"kind": "spacer", "points": 3}, 7, {"kind": 1, "count": 2**40, "label": None, "new": {}}]}, {"blocks": {}}, "x"]}
    m = S.flatten(spark.createDataFrame([("a", json.dumps(book)), ("b", "["), ("c", "[1]"), ("d", '{"pages":[]}')], "doc string, value string"))
    assert len(seen) == 1 and "variant" not in seen[0]
    found = {(r["rule_id"], r["key"]) for r in m.errors.collect()}
    assert found == {("json", "b"), ("root_object", "c")} | {("field_type", f"a/{x}") for x in ("schema_version", "pages[0].blocks[1]", "pages[0].blocks[2].kind", "pages[0].blocks[2].count", "pages[1].blocks", "pages[2]")}
    assert {(r["doc"], r["n_pages"]) for r in m.books.collect()} == {("a", 3), ("d", 0)}
    assert sorted((r["pos"], r["page"], r["n_blocks"]) for r in m.pages.collect()) == [(1, 1, 3), (2, None, 0), (3, None, 0)]
    assert sorted((r["pos"], r["kind"], r["points"]) for r in m.blocks.collect()) == [(1, "spacer", 3.0), (2, None, None), (3, None, None)]


def test_jobs_are_written_once_and_typed(spark, monkeypatch):
    seen = _spied(monkeypatch, J)
    facts, errors = J.job_facts(spark.createDataFrame([("a", "/", '{"expected_page_count":"5"}'), ("b", "/", "["), ("c", "/", "[]")], "job string, root string, value string"))
    assert len(seen) == 1 and "variant" not in seen[0]
    assert [r["job"] for r in facts.collect()] == ["a"]
    assert {(r["rule_id"], r["key"]) for r in errors.collect()} == {("field_type", "a/expected_page_count"), ("json", "b"), ("root_object", "c")}


def test_kinds_are_told_from_the_outside(spark):
    texts = ["{}", "[]", '[{"a":1},2]', "null", "1", "1.5", '"x"', "true"]
    kinds = spark.createDataFrame([(t,) for t in texts], "t string").select("t", S.kind_of(F.parse_json("t")).alias("k")).collect()
    assert {r["t"]: r["k"] for r in kinds} == dict(zip(texts, ["OBJECT", "ARRAY", "ARRAY", "VOID", "BIGINT", "DECIMAL", "STRING", "BOOLEAN"], strict=True))


def test_a_gates_groups_are_dealt_by_the_number_of_jobs(spark, monkeypatch):
    dealt = J.dealt
    monkeypatch.setattr(J, "dealt", lambda df, keys, n: dealt(df, keys, n, rows_a_task=100))
    texts = [(f"j{i}", "/", '{"source":"a.docx"}') for i in range(200)]
    facts, _ = J.job_facts(spark.createDataFrame(texts, "job string, root string, value string"))
    gate = J.conversion_gate(facts, spark.createDataFrame([], "job string, value string"), spark.createDataFrame([], "path string, sha256 string"))
    plan = gate._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and gate.count() == 200
    assert {(r["n_preview"], r["n_approved"], r["passed"]) for r in gate.collect()} == {(3, 3, False)}
