"""Facts read from a part's bytes are those of its elements, and documents are judged where they are made."""

import re

import pytest

import __spark_entry__ as entry
from folioloom.operators import body_facts as B
from folioloom.operators import structure as S
from folioloom.operators.markup import folded

HEAD, END = '<w:document xmlns:w="w" xmlns:r="r"><w:body>', "</w:body></w:document>"
SIZE = '<w:pgSz w:w="11906" w:h="16838"/>'
LED = '<w:p><w:pPr><w:pBdr><w:bottom w:val="dotted"/></w:pBdr><w:tabs><w:tab w:leader="dot"/></w:tabs></w:pPr></w:p>'
BODIES = {
    "plain": f'{HEAD}<w:p><w:bookmarkStart w:name="SourcePdfPage3"/><w:r><w:t>a b</w:t><w:br w:type="page"/><w:br/><w:cr/></w:r></w:p><w:sectPr>{SIZE}<w:pgMar w:top="1"/></w:sectPr>{END}',
    "other_text": f'{HEAD}<w:p><w:bookmarkStart w:name="SourcePdfPage3"/><w:r><w:t>c</w:t><w:br w:type="page"/><w:br/><w:cr/></w:r></w:p><w:sectPr>{SIZE}<w:pgMar w:top="1"/></w:sectPr>{END}',
    "references": f"{HEAD}<w:p><w:t>&#xFFFD;&lt;</w:t><w:t>x]]&gt;</w:t><w:t> </w:t><w:t/><w:t>&quot;\\</w:t></w:p>{END}",
    "quoted": f"{HEAD}<w:p w:a='1>2'><w:t>it's > \"q\"</w:t></w:p><w:p w:a='1>3'><w:t>z</w:t></w:p>{END}",
    "comment": f"{HEAD}<w:t>a<!-- > t < -->b</w:t><w:t><![CDATA[<w:t>c</w:t>]]></w:t>{END}",
    "inner": f"{HEAD}<w:t>a<w:x>no</w:x>tail</w:t>{LED}<w:p><w:pPr><w:sectPr>{SIZE}<w:sectPr><w:pgSz w:w='x'/></w:sectPr></w:sectPr></w:pPr></w:p><w:sectPr><w:cols><w:col w:w='1'/></w:cols></w:sectPr>{END}",
    "two_bodies": f"{HEAD}<w:sectPr>{SIZE}</w:sectPr><w:body><w:sectPr><w:body/>{SIZE}</w:sectPr></w:body>{END}",
    "numbers": HEAD + "".join(f'<w:bookmarkStart w:name="SourcePdfPage{n}"/>' for n in ("007", "2147483647", "2147483648", "1" * 30, "٣", "x")) + END,
    "wide": f"{HEAD}<w:t>□ é</w:t><w:tab/>{LED}{END}",
    "torn": f"{HEAD}<w:t>a</w:t>", "bad_text": f"{HEAD}<w:t>a\x01</w:t>{END}", "raw_end": f"{HEAD}<w:t>a]]></w:t>{END}", "empty": "", "unbound": "<v:a/>", "lines": f"{HEAD}<w:t>a\r\nb\rc\n</w:t>\n{END}\n", "long": f"{HEAD}<w:t>{'x' * 5000}</w:t>{END}",
}
SETTINGS = {
    "on": '<w:s xmlns:w="w"><w:updateFields/><w:doNotAutoCompressPictures w:val="TRUE"/></w:s>', "off": '<w:s xmlns:w="w"><w:updateFields w:val="0"/><w:updateFields/></w:s>',
    "odd": '<w:s xmlns:w="w"><w:updateFields w:val="?"/><w:doNotAutoCompressPictures w:val="?"/></w:s>', "torn": "<w", "none": "<s/>",
}


def _frame(spark, part, texts):
    return spark.createDataFrame([(n, part, t.encode()) for n, t in texts.items()], "path string, part string, content binary")


def _plain(x):
    return {k: sorted(v) if k == "counts" and v else v for k, v in x.asDict(recursive=False).items()} if x is not None else None


@pytest.mark.parametrize(("part", "texts", "field"), [(S.BODY, BODIES, "doc"), (S.SETTINGS, SETTINGS, "own")])
def test_facts_are_those_of_elements(spark, part, texts, field):
    read = B.reader(B.body_facts, B.BODY_FACTS) if field == "doc" else B.reader(B.settings_facts, B.SETTINGS_FACTS)
    parts = _frame(spark, part, texts)
    want = {r.path: _plain(r[field]) for r in S._facts(folded(parts)).collect()}
    got = {r.path: _plain(r.f) for r in parts.select("path", read("content").alias("f")).collect()}
    assert got == want and (field == "own" or sum(v is not None for v in got.values()) == len(BODIES) - 5)


def test_markup_is_parsed_once():
    B._shape.cache_clear()
    text = lambda k: (HEAD + f"<w:t>{k}</w:t>" * 3 + END).encode()
    facts = [B.body_facts(text(k)) for k in range(50)]
    assert B._shape.cache_info().misses == 1 and len({f[0] for f in facts}) == 50 and {f[1:] == facts[0][1:] for f in facts} == {True}


def test_documents_are_judged_where_they_are_made(spark):
    plan = entry.queries()["structural_verdicts"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"Exchange hashpartitioning\(([^#,]*)", plan)) == {"o_orderkey", "l_orderkey"} and "Window" not in plan
    assert plan.count("ArrowEvalPython") == 1 and "MapInArrow" not in plan


def test_documents_and_their_elements_give_the_same_verdict(spark):
    whole = [(n, BODIES["plain"].encode(), t.encode(), None if n == "wide" else SETTINGS["torn" if n == "inner" else "on"].encode(), [3]) for n, t in BODIES.items()]
    docs = spark.createDataFrame(whole, "path string, expected binary, result binary, settings binary, pages array<int>")
    made = docs.selectExpr("*", "named_struct('source_locked', true, 'sample_flow', false, 'margins_free', false) AS contract")
    got = sorted(tuple(v) for r in S.document_violations(made).collect() for v in r.violations)
    parts = lambda *of: folded(docs.selectExpr("path", f"inline(array({', '.join(of)}))").where("content IS NOT NULL"))
    one = lambda part, c: f"struct('{part}' AS part, {c} AS content)"
    same, result = parts(one(S.BODY, "expected")), parts(one(S.BODY, "result"), one(S.SETTINGS, "settings"))
    want = S.structural_violations(same, result, same, made.select("path", "contract.*"), docs.selectExpr("path", "0 AS pos", "3 AS number"))
    assert got == sorted(map(tuple, want.collect())) and ("malformed_part", "error", f"inner/{S.SETTINGS}") in got
