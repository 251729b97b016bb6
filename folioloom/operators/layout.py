"""Layout measurements and their tolerances, over boxes(page, kind, x0, x1, top, bottom, color, text)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators.ordered import asof_backward
from folioloom.profile import DEFAULT, Profile

# Millimetres and points of the default page.
A4_MM, A4_SLACK_MM = (210.0, 297.0), 0.5
FRAME_SLACK_MM = 1.5
RULE_LEAST_WIDTH = 240.0
ANSWER_COLUMNS, ANSWER_SLACK, ANSWER_WIDTH, ANSWER_HEIGHT = (51.0, 62.0), 3.0, 450.0, 60.0


def normal_box(df: DataFrame, page_height: float) -> DataFrame:
    """top and bottom from y0 and y1 where they are missing, edges in order; boxes without numbers go."""
    top = F.coalesce("top", F.lit(page_height) - F.col("y1"))
    bottom = F.coalesce("bottom", F.lit(page_height) - F.col("y0"))
    df = df.where(top.isNotNull() & bottom.isNotNull())
    df = df.dropna(subset=["x0", "x1"])
    edges = {"x0": F.least("x0", "x1"), "x1": F.greatest("x0", "x1"), "top": F.least(top, bottom), "bottom": F.greatest(top, bottom)}
    kept = [c for c in df.columns if c not in ("x0", "x1", "top", "bottom", "y0", "y1")]
    return df.select(*kept, *[v.alias(k) for k, v in edges.items()]).dropna(subset=list(edges))


def answer_rectangles(boxes: DataFrame) -> DataFrame:
    """Patterned rectangles at one of the two answer columns, wide and high enough."""
    at = F.lit(False)
    for x in ANSWER_COLUMNS:
        at = at | (F.abs(F.col("x0") - x) <= ANSWER_SLACK)
    wide, high = F.col("x1") - F.col("x0") > ANSWER_WIDTH, F.col("bottom") - F.col("top") > ANSWER_HEIGHT
    return boxes.where((F.col("kind") == "rect") & F.col("color").startswith("P") & at & wide & high)


def question_anchors(boxes: DataFrame) -> DataFrame:
    n = F.regexp_extract("text", "^Q\\s*(\\d+)\\.?$", 1)
    return boxes.where((F.col("kind") == "word") & (n != "")).select("page", "top", n.cast("int").alias("number"))


def attach_rectangles(boxes: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Each answer rectangle with the latest question above it, its line count, and why it is doubtful.

    A rectangle without a question above, off the pitch, or beside another of its question is a
    review; the rest are attached.
    """
    rects = answer_rectangles(boxes).select("page", "top", "bottom", F.col("x0"))
    found = asof_backward(rects, question_anchors(boxes), ["page"], "top", "top", ["number"], inclusive=False, tie="number")
    found = found.withColumn("fit", T.answer_lines(F.col("bottom") - F.col("top"), profile))
    rivals = F.count_if(F.col("fit").isNotNull()).over(Window.partitionBy("page", "number"))
    doubt = F.when(F.col("number").isNull(), "no_question").when(F.col("fit").isNull(), "off_pitch").when(rivals > 1, "several_rectangles")
    return found.select("page", "number", "top", F.col("fit.count").alias("count"), F.lit(profile.answer_pitch).alias("pitch"), doubt.alias("review"))


def rule_groups(rules: DataFrame, profile: Profile = DEFAULT, least_width: float = RULE_LEAST_WIDTH) -> DataFrame:
    """Horizontal rules of one height, as (page, y, x0, x1); groups that are too short go."""
    y = F.rint((F.col("top") + F.col("bottom")) / 2 / profile.rule_step)
    return rules.groupBy("page", y.alias("step")).agg(F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.max("bottom").alias("y")).where(F.col("x1") - F.col("x0") > least_width).drop("step")


def page_extent(boxes: DataFrame, frame_top: float, frame_bottom: float) -> DataFrame:
    """(page, top, bottom, utilization): the content's extent and its share of the frame, 0 to 100."""
    ends = boxes.groupBy("page").agg(F.min("top").alias("top"), F.max("bottom").alias("bottom"))
    share = 100 * (F.col("bottom") - frame_top) / (frame_bottom - frame_top)
    return ends.withColumn("utilization", F.least(F.lit(100.0), F.greatest(F.lit(0.0), share)))


def is_a4(width_mm: Column, height_mm: Column) -> Column:
    return (F.abs(width_mm - A4_MM[0]) <= A4_SLACK_MM) & (F.abs(height_mm - A4_MM[1]) <= A4_SLACK_MM)


def utilization_rules(actual: DataFrame, source: DataFrame) -> DataFrame:
    """(page, severity, message) where a page is filled less than its source; pages without one have their own floor."""
    m = actual.select("page", "utilization").join(source.select("page", F.col("utilization").alias("wanted")), "page", "left")
    gap = F.col("utilization") - F.col("wanted")
    severity = (
        F.when(gap < -8, "error").when(gap < -4, "warning").when(F.col("wanted").isNull() & (F.col("utilization") < 60), "error")
        .when(F.col("wanted").isNull() & (F.col("utilization") < 75), "warning")
    )
    return m.withColumn("severity", severity).where("severity IS NOT NULL").select("page", "severity", F.format_string("utilization is %.1f", "utilization").alias("message"))


def outside_frame(boxes: DataFrame, left_mm: float, right_mm: float) -> DataFrame:
    """Boxes that cross the frame by more than the tolerance; coordinates in points."""
    mm = lambda c: F.col(c) * 25.4 / 72
    return boxes.where((mm("x0") < left_mm - FRAME_SLACK_MM) | (mm("x1") > right_mm + FRAME_SLACK_MM))


# Millimetres of the live frame, and points above its bottom that answers may reach.
POINTS = 72 / 25.4
SAFE_TOP, SAFE_BOTTOM, FOOTER_TOP, FOLIO_TOP = 28.0, 267.0, 276.0, 270.0
CENTER_INSET, TOP_SLACK, WHOLE_PAGE, OUTER = 4.0, 2.0, 0.9, 18.0
ANSWER_BOTTOM, ANSWER_TOP, ANSWER_LEAST_WIDTH, ANSWER_SIDE, ANSWER_HIGH, ANSWER_STEP = 260.0, 55.0, 150.0, 6.0, 1.5, 1.5
WRITTEN_LIFT = 27.0


def _is_visual() -> Column:
    center, small = (F.col("x0") + F.col("x1")) / 2, (F.col("x1") - F.col("x0") < F.col("width") * WHOLE_PAGE) & (F.col("bottom") - F.col("top") < F.col("height") * WHOLE_PAGE)
    inside = center.between(F.col("left") + CENTER_INSET * POINTS, F.col("right") - CENTER_INSET * POINTS)
    high = (F.col("bottom") >= (SAFE_TOP - TOP_SLACK) * POINTS) & (F.col("top") <= FOOTER_TOP * POINTS)
    return (F.col("kind") != "word") & small & inside & high


def _is_content_word(in_frame: bool) -> Column:
    folio = (F.col("top") > FOLIO_TOP * POINTS) & F.trim("text").rlike("^\\d+$")
    keep = (F.col("kind") == "word") & (F.col("bottom") < FOOTER_TOP * POINTS) & ~F.coalesce(folio, F.lit(False))
    return keep & (F.col("x1") > F.col("left")) & (F.col("x0") < F.col("right")) if in_frame else keep


def visual_boxes(boxes: DataFrame, pages: DataFrame) -> DataFrame:
    """Boxes that are content: not as large as the page, in the middle of the frame, and between top and footer.

    Pages are (page, width, height, left, right) in points.
    """
    return boxes.join(pages.select("page", "width", "height", "left", "right"), "page").where(_is_visual()).select(*boxes.columns)


def content_words(boxes: DataFrame, pages: DataFrame, in_frame: bool = False) -> DataFrame:
    """Words above the footer that are no page number; with ``in_frame`` only those that reach into the frame."""
    return boxes.join(pages.select("page", "left", "right"), "page").where(_is_content_word(in_frame)).select(*boxes.columns)


_HEIGHT = "(top + bottom) / 2"


def _is_rule() -> Column:
    y = F.expr(_HEIGHT)
    return F.col("kind").isin("line", "curve", "rect") & (F.col("bottom") - F.col("top") <= ANSWER_HIGH * POINTS) & y.between(ANSWER_TOP * POINTS, SAFE_BOTTOM * POINTS)


def page_content(boxes: DataFrame, pages: DataFrame, in_frame: bool = False) -> DataFrame:
    """(page, top, bottom, utilization) of every page: content words, content boxes and ruled lines together.

    The lowest ruled line, made of pieces of one height, that spans the frame counts.  Boxes meet their page once, and are taken
    together by page and height of rule, then by page.
    """
    b = pages.select("page", "width", "height", "left", "right").join(boxes, "page", "left")
    y, content = F.expr(_HEIGHT), _is_content_word(in_frame) | _is_visual()
    b = b.withColumns({"content": F.coalesce(content, F.lit(False)), "step": F.when(_is_rule(), F.rint(y / ANSWER_STEP))})
    rule = F.col("step").isNotNull()
    pieces = b.groupBy("page", "step").agg(
        F.min(F.when(F.col("content"), F.col("top"))).alias("top"), F.max(F.when(F.col("content"), F.col("bottom"))).alias("low"),
        F.min(F.when(rule, F.col("x0"))).alias("x0"), F.max(F.when(rule, F.col("x1"))).alias("x1"), F.max(F.when(rule, y)).alias("y"), F.max("left").alias("left"), F.max("right").alias("right"),
    )
    near = lambda a, c: F.abs(F.col(a) - F.col(c)) <= ANSWER_SIDE * POINTS
    spans = (F.col("x1") - F.col("x0") >= ANSWER_LEAST_WIDTH * POINTS) & near("x0", "left") & near("x1", "right")
    found = pieces.groupBy("page").agg(F.min("top").alias("top"), F.greatest(F.max("low"), F.max(F.when(spans, F.col("y")))).alias("bottom"))
    share = 100 * F.greatest(F.lit(0.0), F.least(F.lit(SAFE_BOTTOM * POINTS), F.col("bottom")) - SAFE_TOP * POINTS) / ((SAFE_BOTTOM - SAFE_TOP) * POINTS)
    return found.select("page", "top", "bottom", F.when(F.col("bottom").isNull(), F.lit(0.0)).otherwise(share).alias("utilization"))


def source_measurements(boxes: DataFrame, pages: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(measurements of the selected pages within the outer margins, selected pages that the source hasn't)."""
    framed = pages.join(selected.select("page").distinct(), "page", "left_semi").select("page", "width", "height", F.lit(OUTER * POINTS).alias("left"), (F.col("width") - OUTER * POINTS).alias("right"))
    lost = selected.select("page").distinct().join(pages.select("page"), "page", "left_anti")
    return page_content(boxes.join(framed.select("page"), "page", "left_semi"), framed, in_frame=True), lost


def answer_space(blocks: DataFrame, pages: DataFrame) -> DataFrame:
    """(page, has_canvas, requires_lines, target) of pages(page, page_type, source_bottom) by their blocks(page, kind, bbox).

    Written answers reach to just above the frame's bottom; others as low as the source's own, but no lower than fixed.
    """
    box = F.when((F.size("bbox") == 4) & (F.get("bbox", F.lit(3)) > F.get("bbox", F.lit(1))), F.get("bbox", F.lit(3)))
    lines = F.col("kind") == "answer_lines"
    b = blocks.groupBy("page").agg(F.max(F.col("kind") == "answer_canvas").alias("canvas"), F.max(lines).alias("lines"), F.max(F.when(lines, box)).alias("deepest"))
    p = pages.join(b, "page", "left")
    low = F.lit(ANSWER_BOTTOM * POINTS)
    other = F.when(F.col("deepest").isNotNull(), F.least("deepest", low)).when(F.col("source_bottom").isNotNull(), F.least("source_bottom", low))
    target = F.when(F.col("page_type").isin("short_answer", "long_answer"), F.lit(SAFE_BOTTOM * POINTS - WRITTEN_LIFT)).otherwise(other)
    return p.select("page", F.coalesce("canvas", F.lit(False)).alias("has_canvas"), F.coalesce("lines", F.lit(False)).alias("requires_lines"), F.when(F.col("lines"), target).alias("target"))
