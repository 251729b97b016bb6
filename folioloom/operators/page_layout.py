"""Every layout rule of printed pages in one pass over their boxes.

Tables: ``boxes``(doc, page, kind, x0, x1, top, bottom, text) in points; ``pages``(doc, page, width,
height, source_page); ``jobs``(doc, first_recto, sample_flow, source_locked, content_only,
expected_pages), one row a document; ``sources``(doc, source_page, page_type, exempt,
bottom, utilization), what is known of a source page; ``blocks``(doc, source_page, kind, bbox).

Boxes meet their page's frame once and are summed by page and, for flat pieces, by their height in
steps; both sums work on one distribution by page, and a page has few boxes, so no key is hot.
Pages without boxes are blank pages.  Nulls: a box without numbers or page is left out, a page without a
known source has no source rules, a missing setting counts as false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.operators import layout as L
from folioloom.operators.ordered import asof_backward

# Margins of a right-hand page in millimetres, and limits in per cent.
INSIDE, OUTSIDE = 22.0, 18.0
TOP_MARGIN, BOTTOM_MARGIN = 2.0, 1.0
CONTENT_ONLY_INDENT = 27.0
COMPRESSED, BELOW = 8.0, 4.0
LEAST, LOW = 60.0, 75.0
MCQ_TARGET, MCQ_DENSE = 82.0, 95.0
EXEMPT = ("chapter_end", "intentional_whitespace")
KEY = ["doc", "page"]


def source_by_bookmark(pages: DataFrame, bookmarks: DataFrame) -> DataFrame:
    """pages with source_page from the latest of bookmarks(doc, name, page) at or before them, named SourcePdfPage and a number."""
    number = F.regexp_extract("name", "^SourcePdfPage(\\d+)$", 1).try_cast("int")
    marks = bookmarks.select("doc", "page", number.alias("source_page")).where("source_page IS NOT NULL AND page IS NOT NULL")
    return asof_backward(pages.drop("source_page"), marks, ["doc"], "page", "page", ["source_page"], tie="source_page")


def framed(pages: DataFrame, jobs: DataFrame) -> DataFrame:
    """pages with their job, ``recto``, and the frame's left and right edge; odd pages are on the side of the first."""
    p = pages.join(jobs, "doc")
    for name in ("first_recto", "sample_flow", "source_locked", "content_only"):
        p = p.withColumn(name, F.coalesce(name, F.lit(False)))
    recto = (F.col("page") % 2 == 1) == F.col("first_recto")
    left = F.when(recto, INSIDE).otherwise(OUTSIDE) * L.POINTS
    right = F.col("width") - F.when(recto, OUTSIDE).otherwise(INSIDE) * L.POINTS
    return p.withColumns({"recto": recto, "left": left, "right": right})


def measured(boxes: DataFrame, frames: DataFrame) -> DataFrame:
    """frames plus top, bottom, extent, utilization, and how many words and boxes lie outside the frame."""
    numbers = boxes.dropna(subset=["x0", "x1", "top", "bottom"]).select(*KEY, "kind", "x0", "x1", "top", "bottom", "text")
    b = numbers.join(frames.select(*KEY, "width", "height", "left", "right", "content_only"), KEY)
    mm = lambda v: F.lit(v * L.POINTS)
    is_word = F.col("kind") == "word"
    folio = (F.col("top") > mm(L.FOLIO_TOP)) & F.coalesce(F.trim("text").rlike("^\\d+$"), F.lit(False))
    word = is_word & (F.col("bottom") < mm(L.FOOTER_TOP)) & ~folio
    small = (F.col("x1") - F.col("x0") < F.col("width") * L.WHOLE_PAGE) & (F.col("bottom") - F.col("top") < F.col("height") * L.WHOLE_PAGE)
    middle = ((F.col("x0") + F.col("x1")) / 2).between(F.col("left") + mm(L.CENTER_INSET), F.col("right") - mm(L.CENTER_INSET))
    visual = ~is_word & small & middle & (F.col("bottom") >= mm(L.SAFE_TOP - L.TOP_SLACK)) & (F.col("top") <= mm(L.FOOTER_TOP))
    y = (F.col("top") + F.col("bottom")) / 2
    flat = F.col("kind").isin("line", "curve", "rect") & (F.col("bottom") - F.col("top") <= mm(L.ANSWER_HIGH)) & y.between(mm(L.ANSWER_TOP), mm(L.SAFE_BOTTOM))
    outside = (F.col("x0") < F.col("left") - mm(L.FRAME_SLACK_MM)) | (F.col("x1") > F.col("right") + mm(L.FRAME_SLACK_MM))
    content, start = word | visual, F.col("left") + F.when(F.col("content_only"), CONTENT_ONLY_INDENT).otherwise(0.0)
    steps = b.groupBy(*KEY, F.when(flat, F.rint(y / L.ANSWER_STEP)).alias("step")).agg(
        F.min(F.when(content, F.col("top"))).alias("top"), F.max(F.when(content, F.col("bottom"))).alias("low"),
        F.count_if(word & outside).alias("words_outside"), F.count_if(visual & outside).alias("visuals_outside"),
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max(y).alias("y"), F.first(start).alias("start"), F.first("right").alias("right"),
    )
    wide = F.col("step").isNotNull() & (F.col("x1") - F.col("x0") >= mm(L.ANSWER_LEAST_WIDTH)) & (F.abs(F.col("x0") - F.col("start")) <= mm(L.ANSWER_SIDE)) & (F.abs(F.col("x1") - F.col("right")) <= mm(L.ANSWER_SIDE))
    sums = steps.groupBy(*KEY).agg(F.min("top").alias("top"), F.max("low").alias("low"), F.max(F.when(wide, F.col("y"))).alias("extent"), F.sum("words_outside").alias("words_outside"), F.sum("visuals_outside").alias("visuals_outside"))
    found = frames.join(sums, KEY, "left").withColumn("bottom", F.greatest("low", "extent")).drop("low")
    share = 100 * F.greatest(F.lit(0.0), F.least(mm(L.SAFE_BOTTOM), F.col("bottom")) - mm(L.SAFE_TOP)) / mm(L.SAFE_BOTTOM - L.SAFE_TOP)
    return found.withColumn("utilization", F.when(F.col("bottom").isNull(), F.lit(0.0)).otherwise(share)).fillna(0, ["words_outside", "visuals_outside"])


def page_results(boxes: DataFrame, pages: DataFrame, jobs: DataFrame, sources: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row a page: its measurements, its source's, and how low its answers must reach."""
    at = F.struct("doc", "source_page").alias("page")
    space = L.answer_space(blocks.select(at, "kind", "bbox"), sources.select(at, "page_type", F.col("bottom").alias("source_bottom")))
    known = sources.select("doc", "source_page", "page_type", "exempt", F.col("bottom").alias("source_bottom"), F.col("utilization").alias("source_utilization"))
    known = known.join(space.select("page.doc", "page.source_page", "has_canvas", "requires_lines", "target"), ["doc", "source_page"])
    found = measured(boxes, framed(pages, jobs)).join(known, ["doc", "source_page"], "left")
    found = found.withColumn("page_type", F.coalesce("page_type", F.lit("other"))).fillna(False, ["exempt", "has_canvas", "requires_lines"])
    return found.withColumn("utilization_delta", F.col("utilization") - F.col("source_utilization"))


def _page_rules() -> list[tuple[str, str, Column, Column]]:
    """(rule, severity, where it is broken, the number that it tells)."""
    c, mm = F.col, L.POINTS
    filled = c("top").isNotNull() & c("bottom").isNotNull()
    bound = c("source_locked") & ~c("sample_flow")
    compared = bound & ~c("exempt") & ~c("page_type").isin(*EXEMPT)
    gap, alone, mcq = c("utilization_delta"), compared & c("utilization_delta").isNull(), compared & (c("page_type") == "mcq")
    a4 = (F.abs(c("width") - L.A4_MM[0] * mm) <= L.A4_SLACK_MM * mm) & (F.abs(c("height") - L.A4_MM[1] * mm) <= L.A4_SLACK_MM * mm)
    return [
        ("not_a4", "error", ~a4, c("width") / mm),
        ("blank_page", "error", ~filled, F.lit(0.0)),
        ("starts_too_high", "error", filled & (c("top") < (L.SAFE_TOP - TOP_MARGIN) * mm), c("top") / mm),
        ("crosses_footer", "error", filled & (c("bottom") > (L.SAFE_BOTTOM + BOTTOM_MARGIN) * mm), c("bottom") / mm),
        ("text_outside_frame", "error", filled & (c("words_outside") > 0), c("words_outside")),
        ("visual_outside_frame", "error", filled & (c("visuals_outside") > 0), c("visuals_outside")),
        ("compressed", "error", compared & (gap < -COMPRESSED), -gap),
        ("below_source", "warning", compared & (gap >= -COMPRESSED) & (gap < -BELOW), -gap),
        ("mcq_below_target", "warning", mcq & (c("source_utilization") >= MCQ_TARGET) & (c("utilization") < MCQ_TARGET), c("utilization")),
        ("mcq_dense", "warning", mcq & (c("utilization") > MCQ_DENSE) & (gap > COMPRESSED), c("utilization")),
        ("hardly_filled", "error", alone & (c("utilization") < LEAST), c("utilization")),
        ("low_utilization", "warning", alone & (c("utilization") >= LEAST) & (c("utilization") < LOW), c("utilization")),
        ("no_answer_line", "error", bound & c("requires_lines") & c("extent").isNull(), F.lit(0.0)),
        ("answer_line_too_high", "error", bound & c("requires_lines") & (c("extent") < c("target")), c("extent") / mm),
    ]


def page_findings(results: DataFrame) -> DataFrame:
    """(doc, page, source_page, severity, rule, value): the rules that the rows of :func:`page_results` break."""
    told = [F.when(broken, F.struct(F.lit(severity).alias("severity"), F.lit(rule).alias("rule"), value.cast("double").alias("value"))) for rule, severity, broken, value in _page_rules()]
    found = results.select("doc", "page", "source_page", F.explode(F.array_compact(F.array(*told))).alias("f"))
    return found.select("doc", "page", "source_page", "f.severity", "f.rule", "f.value")


def document_findings(pages: DataFrame, jobs: DataFrame, selected: DataFrame) -> DataFrame:
    """Findings of whole documents, their page null: the count expected, and that of selected(doc, source_page) pages."""
    n = pages.groupBy("doc").agg(F.count("*").alias("n"))
    mapped = selected.groupBy("doc").agg(F.count("*").alias("mapped"))
    d = jobs.where("NOT coalesce(sample_flow, false)").join(n, "doc", "left").fillna(0, ["n"]).join(mapped, "doc", "left")
    told = [F.when(F.col("expected_pages") != F.col("n"), F.lit("page_count")), F.when(F.col("mapped") != F.col("n"), F.lit("source_mapping"))]
    found = d.select("doc", F.explode(F.array_compact(F.array(*told))).alias("rule"), F.col("n").cast("double").alias("value"))
    null = F.lit(None).cast("int")
    return found.select("doc", null.alias("page"), null.alias("source_page"), F.lit("error").alias("severity"), "rule", "value")


def layout_findings(boxes: DataFrame, pages: DataFrame, jobs: DataFrame, sources: DataFrame, blocks: DataFrame, selected: DataFrame) -> DataFrame:
    found = page_findings(page_results(boxes, pages, jobs, sources, blocks))
    return found.unionByName(document_findings(pages, jobs, selected))


def layout_verdict(findings: DataFrame, jobs: DataFrame) -> DataFrame:
    """(doc, passed, n_errors, n_warnings) of every job."""
    n = findings.groupBy("doc").agg(F.count_if(F.col("severity") == "error").alias("n_errors"), F.count_if(F.col("severity") == "warning").alias("n_warnings"))
    v = jobs.select("doc").join(n, "doc", "left").fillna(0, ["n_errors", "n_warnings"])
    return v.select("doc", (F.col("n_errors") == 0).alias("passed"), "n_errors", "n_warnings")
