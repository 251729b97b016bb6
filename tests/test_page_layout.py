"""Layout rules at their limits, page by page."""

from folioloom.operators import page_layout as P

MM = 72 / 25.4
A4 = (210 * MM, 297 * MM)


SCHEMAS = (
    "doc string, page int, kind string, x0 double, x1 double, top double, bottom double, text string",
    "doc string, page int, width double, height double, source_page int",
    "doc string, first_recto boolean, sample_flow boolean, source_locked boolean, content_only boolean, expected_pages int",
    "doc string, source_page int, page_type string, exempt boolean, bottom double, utilization double",
    "doc string, source_page int, kind string, bbox array<double>",
    "doc string, source_page int",
)


def case(boxes, want=(), pages=None, job=(True, False, True, False, None), sources=(), blocks=(), selected=()):
    return [boxes, pages or [("d", 1, *A4, 7)], [("d", *job)], sources, blocks, selected], sorted(want)


def check(spark, *cases):
    """Each case is a document of its own in one run."""
    tables = [[(f"case {k}", *(float(v) if isinstance(v, float) else v for v in row[1:])) for k, (rows, _) in enumerate(cases) for row in rows[t]] for t in range(6)]
    found = P.layout_findings(*[spark.createDataFrame(rows, schema) for rows, schema in zip(tables, SCHEMAS, strict=True)]).collect()
    for k, (_, want) in enumerate(cases):
        assert sorted((r.page or 0, r.rule, r.severity) for r in found if r.doc == f"case {k}") == want, k


def word(x0, x1, top, bottom, text="w", page=1):
    return ("d", page, "word", x0 * MM, x1 * MM, top * MM, bottom * MM, text)


FULL = [word(30, 60, 30, 35), word(30, 60, 255, 260)]


def test_good_blank_and_odd_pages(spark):
    check(
        spark,
        case(FULL, want=[]),
        case([("d", 1, "word", None, 1.0, 1.0, 1.0, "x"), word(30, 60, 280, 285), word(30, 60, 271, 273, "12")], want=[(1, "blank_page", "error"), (1, "hardly_filled", "error")]),
        case(FULL, pages=[("d", 1, 612.0, 792.0, None)], want=[(1, "not_a4", "error")]),
    )


def test_bands_and_frames(spark):
    # a right-hand page has its broad margin on the left, a left-hand one on the right
    edge = [*FULL, word(20.4, 60, 100, 105)]
    visual = [*FULL, ("d", 1, "image", 10 * MM, 150 * MM, 100 * MM, 150 * MM, None)]
    check(
        spark,
        case([word(30, 60, 25.9, 35), word(30, 60, 255, 268.1)], want=[(1, "crosses_footer", "error"), (1, "starts_too_high", "error")]),
        case([word(30, 60, 26.1, 35), word(30, 60, 255, 267.9)], want=[]),
        case(edge, want=[(1, "text_outside_frame", "error")]),
        case(edge, job=(False, False, True, False, None), want=[]),
        case(visual, want=[(1, "visual_outside_frame", "error")]),
        case([*FULL, ("d", 1, "rect", 1.0, 209 * MM, 0.0, 800.0, None)], want=[]),  # as large as the page
    )


def test_utilization_against_the_source(spark):
    u = 100 * (260 - 28) / 239

    def src(kind, gap, exempt=False):
        return [("d", 7, kind, exempt, None, u - gap)]

    low = [word(30, 60, 30, 35), word(30, 60, 200, 28 + 239 * 0.8)]
    check(
        spark,
        case(FULL, sources=src("exercise", -8.1), want=[(1, "compressed", "error")]),
        case(FULL, sources=src("exercise", -4.1), want=[(1, "below_source", "warning")]),
        case(FULL, sources=src("exercise", -3.9), want=[]),
        case(FULL, sources=src("chapter_end", -30.0)),
        case(FULL, sources=src("exercise", -30.0, True)),
        case(FULL, sources=src("mcq", 8.1), want=[(1, "mcq_dense", "warning")]),
        case(low, sources=[("d", 7, "mcq", False, None, 83.0)], want=[(1, "mcq_below_target", "warning")]),
        case([word(30, 60, 30, 28 + 239 * 0.7)], want=[(1, "low_utilization", "warning")]),
        case([word(30, 60, 30, 28 + 239 * 0.5)], job=(True, False, None, False, None), want=[]),
        case([word(30, 60, 30, 28 + 239 * 0.5)], job=(True, True, True, False, 9), want=[]),
    )


def rule(x0, x1, y):
    return ("d", 1, "line", x0, x1, y * MM - 0.25, y * MM + 0.25, None)


def test_answer_lines(spark):
    src, asks = [("d", 7, "exercise", True, None, None)], [("d", 7, "answer_lines", [0.0, 1.0, 2.0, 250 * MM])]
    left, right = 22 * MM, A4[0] - 18 * MM
    indented = [*FULL, rule(left + 27, right, 251)]
    check(
        spark,
        case(FULL, sources=src, blocks=asks, want=[(1, "no_answer_line", "error")]),
        case([*FULL, rule(left, 300.0, 240), rule(300.0, right, 240)], sources=src, blocks=asks, want=[(1, "answer_line_too_high", "error")]),
        case([*FULL, rule(left, 300.0, 251), rule(300.0, right, 251)], sources=src, blocks=asks, want=[]),
        case(indented, sources=src, blocks=asks, want=[(1, "no_answer_line", "error")]),
        case(indented, sources=src, blocks=asks, job=(True, False, True, True, None), want=[]),
    )


def test_documents_and_bookmarks(spark):
    pages = [("d", 1, *A4, None), ("d", 2, *A4, None)]
    boxes = [*FULL, *[(*b[:1], 2, *b[2:]) for b in FULL]]
    marks = spark.createDataFrame([("d", "SourcePdfPage12", 2), ("d", "SourcePdfPage9", 2), ("d", "SourcePdfPage3", 1), ("d", "Other5", 3), ("d", "SourcePdfPageX", 3)], "doc string, name string, page int")
    p = spark.createDataFrame([("d", k, 1.0, 1.0, None) for k in (1, 2, 3)] + [("e", 1, 1.0, 1.0, None)], "doc string, page int, width double, height double, source_page int")
    assert sorted((r.doc, r.page, r.source_page) for r in P.source_by_bookmark(p, marks).collect()) == [("d", 1, 3), ("d", 2, 9), ("d", 3, 9), ("e", 1, None)]
    check(
        spark,
        case(boxes, pages=pages, job=(True, False, None, False, 3), selected=[("d", 1)], want=[(0, "page_count", "error"), (0, "source_mapping", "error")]),
    )
