"""Structural verdict: each rule by a document that breaks it alone."""

import pytest

from folioloom.operators import structure as S
from folioloom.operators.markup import elements

W = 'xmlns:w="w" xmlns:r="r"'
SIZE, MARGIN = '<w:pgSz w:w="11906" w:h="16838"/>', '<w:pgMar w:top="10"/>'
FINAL = f'<w:sectPr><w:headerReference w:type="default" r:id="h1"/>{SIZE}{MARGIN}</w:sectPr>'
ON = "<w:doNotAutoCompressPictures/>"
ONE = '<w:p><w:bookmarkStart w:name="SourcePdfPage3"/><w:r><w:t>one</w:t><w:br w:type="page"/></w:r></w:p>'
TWO = '<w:p><w:bookmarkStart w:name="SourcePdfPage7"/><w:r><w:t>two</w:t><w:tab/></w:r></w:p>'
DOTTED, LEADER = '<w:pBdr><w:bottom w:val="dotted"/></w:pBdr>', '<w:tabs><w:tab w:leader="dot"/></w:tabs>'


def body(*parts, final=FINAL):
    return f"<w:document {W}><w:body>{''.join(parts)}{final}</w:body></w:document>"


def line(*own):
    return f"<w:p><w:pPr>{''.join(own)}</w:pPr></w:p>"


GOOD = body(ONE, TWO)
#: name: (document, settings, expected rules, same expected document)
CASES = {
    "good": (GOOD, ON, set()),
    "tokens": (body(ONE, TWO.replace("two", "2")), ON, {"tokens"}),
    "counts": (body(ONE, TWO, "<w:p/>"), ON, {"counts"}),
    "torn": ("<w:document", ON, {"malformed_part", "tokens", "counts", "final_section", "page_breaks", "sections", "bookmarks"}),
    "no_final": (body(ONE, TWO, final=""), ON, {"counts", "final_section", "sections"}),
    "inner_only": (body(ONE, TWO, f"<w:p><w:pPr>{FINAL}</w:pPr></w:p>", final=""), ON, {"counts", "final_section"}),
    "other_margin": (body(ONE, TWO, final=FINAL.replace("10", "11")), ON, {"section_differs"}),
    "free_margin": (body(ONE, TWO, final=FINAL.replace("10", "11")), ON, set()),
    "other_header": (body(ONE, TWO, final=FINAL.replace("h1", "h2")), ON, {"section_differs"}),
    "turned_attributes": (body(ONE, TWO, final=FINAL.replace('w:type="default" r:id="h1"', 'r:id="h1" w:type="default"')), ON, set()),
    "letter": (body(ONE, TWO, final=FINAL.replace("16838", "15840")), ON, {"section_differs", "a4"}),
    "no_size": (body(ONE, TWO, final=FINAL.replace("16838", "x")), ON, {"section_differs", "page_size"}),
    "breaks": (body(ONE.replace(' w:type="page"', ""), TWO), ON, {"tokens", "page_breaks"}),
    "turned_pages": (body(ONE.replace("Page3", "Page7"), TWO.replace("Page7", "Page3")), ON, {"bookmarks"}),
    "square": (body(ONE, TWO.replace("two", "t□")), ON, {"tokens", "white_square"}),
    "no_settings": (GOOD, None, {"settings"}),
    "updates": (GOOD, ON + "<w:updateFields/>", {"updates_fields"}),
    "no_updates": (GOOD, ON + '<w:updateFields w:val="0"/>', set()),
    "compresses": (GOOD, '<w:doNotAutoCompressPictures w:val="off"/>', {"compresses_pictures"}),
    "leaders": (body(ONE, TWO, line(DOTTED, LEADER)), ON, {"counts", "leaders"}),
    "dots_apart": (body(ONE, TWO, line(DOTTED), line(LEADER)), ON, {"counts"}),
}


@pytest.fixture(scope="module")
def found(spark):
    parts = lambda rows: elements(spark.createDataFrame([(p, q, t.encode()) for p, q, t in rows if t is not None], "path string, part string, content binary"))
    wrap = lambda s: s and f"<w:settings {W}>{s}</w:settings>"
    made = [x for n, (d, s, _) in CASES.items() for x in ((n, S.BODY, d), (n, S.SETTINGS, wrap(s)))]
    same = parts([(n, S.BODY, GOOD) for n in CASES])
    contract = spark.createDataFrame([(n, True, False, n == "free_margin") for n in CASES], "path string, source_locked boolean, sample_flow boolean, margins_free boolean")
    pages = spark.createDataFrame([(n, k, p) for n in CASES for k, p in enumerate((3, 7))], "path string, pos int, number int")
    # a tab stop of a paragraph's properties is a token as well, which the verdict's tokens show
    rows = S.structural_violations(same, parts(made), same, contract, pages).collect()
    out: dict[str, set] = {}
    for r in rows:
        out.setdefault(r.key.split("/")[0], set()).add(r.rule_id)
    return out


@pytest.mark.parametrize("name", CASES)
def test_case(found, name):
    want = CASES[name][2] | ({"tokens"} if "leader=" in CASES[name][0] else set())
    assert found.get(name, set()) == want


def test_headers_are_taken_over(spark):
    inner = lambda own: f"<w:p><w:pPr><w:sectPr>{own}{SIZE}</w:sectPr></w:pPr></w:p>"
    text = body(inner('<w:headerReference r:id="a"/>'), inner(""), inner('<w:headerReference w:type="first" r:id="z"/><w:footerReference r:id="f"/>'), "<w:p/>", final=f"<w:sectPr>{SIZE}<w:cols><w:col w:w=\"1\"/></w:cols></w:sectPr>")
    rows = S.section_rows(elements(spark.createDataFrame([("d", S.BODY, text.encode())], "path string, part string, content binary")))
    assert [(r.section, r.header, r.footer, round(r.height_mm)) for r in S.page_sections(rows).orderBy("section").collect()] == [(1, "a", None, 297), (2, "a", None, 297), (3, "a", "f", 297), (4, "a", "f", 297)]
    assert [(r.tag, r.depth) for r in rows.where("last").orderBy("n").collect()] == [("sectPr", 0), ("pgSz", 1), ("cols", 1), ("col", 2)]
