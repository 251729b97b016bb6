"""Parts parsed into one row each: rules of a document shuffle what they find, never its elements."""

import re

import __spark_entry__ as entry
from folioloom.operators import markup as X
from folioloom.operators import structure as S

SF = "/root/testdata/sf0.001"
INNER = '<w:p><w:pPr><w:sectPr><w:pgSz w:w="11906" w:h="15840"/></w:sectPr></w:pPr></w:p>'
TEXT = f'<w:document xmlns:w="w"><w:body><w:p><w:r><w:t>a</w:t><w:t/></w:r></w:p>{INNER}<w:x><w:t>no</w:t></w:x><w:tbl><w:t>b</w:t></w:tbl><w:sectPr><w:pgMar/></w:sectPr></w:body></w:document>'


def _exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([^#,]*)", df._jdf.queryExecution().executedPlan().toString())


def _parts(spark):
    return spark.createDataFrame([("d", S.BODY, TEXT.encode()), ("t", S.BODY, b"<w"), ("n", S.BODY, None)], "path string, part string, content binary")


def test_elements_of_verdicts_are_neither_written_nor_shuffled(spark):
    assert not hasattr(S, "written")
    plan = _exchanges(entry.queries()["structural_verdicts"](spark, SF))
    assert set(plan) <= {"o_orderkey", "l_orderkey", "path"} and plan.count("path") <= 3  # what is found, and the contract's rows with it


def test_members_shuffle_no_elements(spark):
    assert _exchanges(entry.queries()["body_members"](spark, SF)) == ["l_orderkey"]
    assert _exchanges(X.body_members(X.folded(_parts(spark)))) == []


def test_folding_keeps_every_element(spark, monkeypatch):
    whole = sorted(map(tuple, X.folded(_parts(spark)).collect()), key=str)
    monkeypatch.setattr(X, "ROWS_AT_ONCE", 3)  # a part's elements come in several arrays then
    flat = X.elements(_parts(spark))
    assert flat.where("path = 'd'").count() == 16 and flat.where("n IS NULL AND error IS NOT NULL").count() == 2
    assert sorted(map(tuple, X.fold(flat).collect()), key=str) == whole
    assert [tuple(r) for r in X.body_members(flat).select("pos", "kind", "text").orderBy("pos").collect()] == [(1, "paragraph", "a"), (2, "paragraph", ""), (3, "table", "b")]


def test_folded_and_flat_give_the_same_verdict(spark):
    contract = spark.createDataFrame([("d", True, False, False), ("t", True, False, True), ("z", True, False, False)], "path string, source_locked boolean, sample_flow boolean, margins_free boolean")
    pages = spark.createDataFrame([("d", 1, 1), ("d", 2, 2)], "path string, pos int, number int")
    verdict = lambda e: sorted(map(tuple, S.structural_violations(e, e, e, contract, pages).collect()))
    got = verdict(X.folded(_parts(spark)))
    assert got == verdict(X.elements(_parts(spark)))
    assert ("a4", "error", "d/1") in got and ("page_size", "error", "d/2") in got and ("malformed_part", "error", f"n/{S.BODY}") in got and ("sections", "error", "z") in got
