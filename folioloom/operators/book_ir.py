"""Contract of book pages and their blocks: every broken rule is a row, none an exception.

Blocks have the columns of ``BLOCK``, pages those of ``PAGE``; columns that a table lacks count
as null.  A key is doc/page/pos, or doc/page.  All rules of a table are tried in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.functions.blocks import has_text, is_positive, is_rectangle
from folioloom.operators.contracts import RowRule, all_violations, duplicate_keys, missing_references, row_violations

_IMAGE = "struct<kind:string,path:string,alt_text:string,effective_dpi:double,width_inches:double,height_inches:double,bbox:array<double>>"
_RUNS = f"array<struct<text:string,language:string,formula:{_IMAGE}>>"
BLOCK = {
    "doc": "string", "page": "int", "pos": "int", "kind": "string", "confidence": "string", "source_ids": "array<string>", "for_question": "string", "text": "string", "runs": _RUNS,
    "question_id": "string", "label": "string", "label_layout": "string", "hindi": "string", "english": "string", "hindi_runs": _RUNS, "english_runs": _RUNS,
    "items": f"array<struct<label:string,text:string,runs:{_RUNS},formula:{_IMAGE}>>", "columns": "int", "layout": "string", "image": _IMAGE, "rows": "array<array<string>>",
    "points": "double", "count": "int", "spacing": "double", "canvas_type": "string", "height_points": "double", "width_points": "double",
}
PAGE = {"doc": "string", "page": "int", "pos": "int", "page_type": "string", "utilization_exempt": "boolean", "exempt_reason": "string", "n_blocks": "long", "page_count": "int"}

# The domains of the contract.
KINDS = "heading paragraph equation question options figure formula_image table spacer answer_lines answer_canvas".split()
CONFIDENCE = ("high", "medium")
PAGE_TYPES = ("mcq", "fill_blank", "short_answer", "long_answer", "mixed", "other")
LANGUAGES = ("hindi", "latin", "math")
LAYOUTS = {"one_column": 1, "two_by_two": 2, "four_inline": 4}
CANVASES = ("blank", "graph", "venn", "coordinate_grid", "diagram")
MOST_LINES = 50


def conform(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The columns of ``fields``, null where ``df`` has none."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(kind).alias(c) for c, kind in fields.items()])


def bad_image(image: Column, nested: bool = False, dpi: bool = True, width: bool = False) -> Column:
    """Path, words, resolution, widths and box of an image; a formula in a run needs a width, not a resolution."""
    stated = lambda x: x.isNotNull() & ~is_positive(x)
    bad = ~has_text(image["path"]) | ~has_text(image["alt_text"]) | ~is_rectangle(image["bbox"]) | stated(image["width_inches"]) | stated(image["height_inches"])
    bad = bad | (~is_positive(image["effective_dpi"]) if dpi else stated(image["effective_dpi"]))
    if width:
        bad = bad | ~is_positive(image["width_inches"])
    return bad | (image["kind"].isNotNull() & (image["kind"] != "formula_image")) if nested else bad


def bad_runs(runs: Column) -> dict[str, Column]:
    """By rule: neither or both of text and formula, a language out of the domain, a bad formula image."""
    formula = lambda r: r["formula"].isNotNull()
    return {
        "run_content": F.exists(runs, lambda r: has_text(r["text"]) == formula(r)),
        "run_language": F.exists(runs, lambda r: ~formula(r) & ~F.coalesce(r["language"], F.lit("latin")).isin(*LANGUAGES)),
        "run_image": F.exists(runs, lambda r: formula(r) & bad_image(r["formula"], nested=True, dpi=False, width=True)),
    }


def block_rules(source: Column) -> list[RowRule]:
    """Rules of one block; ``source`` is the id of its own page."""
    c, kind = F.col, F.col("kind")
    words, body = kind.isin("heading", "paragraph", "equation"), (F.size("runs") > 0)
    asked, chosen, pictured = kind == "question", kind == "options", kind.isin("figure", "formula_image")
    lines, canvas = kind == "answer_lines", kind == "answer_canvas"
    whole = F.map_from_arrays(F.array(*map(F.lit, LAYOUTS)), F.array(*map(F.lit, LAYOUTS.values())))
    item_text = lambda i: has_text(i["text"]) | (F.size(i["runs"]) > 0) | i["formula"].isNotNull()
    letters = F.transform("items", lambda i: i["label"])
    columns = F.coalesce("columns", F.lit(2))
    rules = [
        RowRule("kind", ~F.coalesce(kind.isin(*KINDS), F.lit(False))),
        RowRule("confidence", ~F.coalesce("confidence", F.lit("high")).isin(*CONFIDENCE)),
        RowRule("source_ids", F.coalesce(F.size("source_ids") <= 0, F.lit(True)) | c("source_ids").isNull()),
        RowRule("own_page", (F.size("source_ids") > 0) & ~F.array_contains("source_ids", source)),
        RowRule("for_question", c("for_question").isNotNull() & ~has_text(c("for_question"))),
        RowRule("content", words & ~(has_text(c("text")) | F.coalesce(body, F.lit(False)))),
        RowRule("question_id", asked & c("question_id").isNotNull() & ~has_text(c("question_id"))),
        RowRule("label", asked & ~has_text(c("label"))),
        RowRule("label_layout", (asked & ~F.coalesce("label_layout", F.lit("inline")).isin("inline", "standalone")) | (chosen & ~F.coalesce("label_layout", F.lit("parenthesized")).isin("parenthesized", "plain"))),
        RowRule("statement", asked & ~(has_text(c("hindi")) | has_text(c("english")) | F.coalesce(F.size("hindi_runs") > 0, F.lit(False)) | F.coalesce(F.size("english_runs") > 0, F.lit(False)))),
        RowRule("items", chosen & (c("items").isNull() | (F.size("items") == 0))),
        RowRule("item_label", chosen & F.exists("items", lambda i: ~has_text(i["label"]))),
        RowRule("item_content", chosen & F.exists("items", lambda i: ~item_text(i) | (i["text"].isNotNull() & ~has_text(i["text"])))),
        RowRule("item_image", chosen & F.exists("items", lambda i: i["formula"].isNotNull() & bad_image(i["formula"], nested=True))),
        RowRule("item_unique", chosen & (F.size(F.array_distinct(letters)) < F.size(letters))),
        RowRule("columns", chosen & ~columns.isin(1, 2, 4)),
        RowRule("layout", chosen & c("layout").isNotNull() & ~F.coalesce(F.try_element_at(whole, c("layout")) == columns, F.lit(False))),
        RowRule("image", pictured & F.coalesce(bad_image(c("image")), F.lit(True))),
        RowRule("table", (kind == "table") & (c("rows").isNull() | (F.size("rows") == 0) | F.exists("rows", lambda r: (F.size(r) == 0) | (F.size(r) != F.size(F.get("rows", F.lit(0))))))),
        RowRule("points", (kind == "spacer") & ~F.coalesce(c("points") >= 0, F.lit(False))),
        RowRule("count", lines & ~F.coalesce(c("count").between(1, MOST_LINES), F.lit(False))),
        RowRule("spacing", lines & ~is_positive(F.coalesce("spacing", F.lit(16.0)))),
        RowRule("canvas_type", canvas & ~F.coalesce("canvas_type", F.lit("blank")).isin(*CANVASES)),
        RowRule("canvas_size", canvas & (~is_positive(c("height_points")) | (c("width_points").isNotNull() & ~is_positive(c("width_points"))))),
    ]
    for name, of in (("runs", words), ("hindi_runs", asked), ("english_runs", asked)):
        rules += [RowRule(rule, of & bad) for rule, bad in bad_runs(c(name)).items()]
    nested = bad_runs(F.flatten(F.transform("items", lambda i: F.coalesce(i["runs"], F.array().cast(_RUNS)))))
    return rules + [RowRule(rule, chosen & bad) for rule, bad in nested.items()]


def source_id(doc: Column, page: Column) -> Column:
    return F.format_string("%s:p%03d", doc, page)


def block_violations(blocks: DataFrame) -> DataFrame:
    """(rule_id, severity, key) of single blocks, of repeated question ids and of references to none."""
    b = conform(blocks, BLOCK)
    rows = row_violations(b, F.concat_ws("/", "doc", "page", "pos"), block_rules(source_id(F.col("doc"), F.col("page")))).distinct()
    asked = b.where("kind = 'question' AND question_id IS NOT NULL").select(F.concat_ws("/", "doc", "question_id").alias("question_id"))
    about = b.where("for_question IS NOT NULL").select(F.concat_ws("/", "doc", "for_question").alias("for_question"))
    return all_violations(rows, duplicate_keys(asked, ["question_id"], "question_unique"), missing_references(about, asked, "for_question", "question_id", "question_known"))


def page_violations(pages: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(rule_id, severity, key) of pages: domains, bounds, reasons, repeats, and their order against expected(doc, pos, page)."""
    p = conform(pages, PAGE)
    c = F.col
    rows = row_violations(p, F.concat_ws("/", "doc", "page"), [
        RowRule("page_type", c("page_type").isNotNull() & ~c("page_type").isin(*PAGE_TYPES)),
        RowRule("page_bounds", ~F.coalesce(c("page").between(1, c("page_count")), F.lit(False))),
        RowRule("exempt_reason", F.coalesce("utilization_exempt", F.lit(False)) & ~has_text(c("exempt_reason"))),
        RowRule("blocks", F.coalesce("n_blocks", F.lit(0)) < 1),
    ])
    parts = [rows, duplicate_keys(p, ["doc", "page"], "page_unique")]
    if expected is not None:
        parts.append(sequence_violations(p, expected))
    return all_violations(*parts)


def sequence_violations(pages: DataFrame, expected: DataFrame) -> DataFrame:
    """One violation for each document whose pages aren't the expected ones in order.

    Places are compared one by one, so that no book is gathered into a row.
    """
    have, want = pages.select("doc", "pos", F.col("page").alias("have")), expected.select("doc", "pos", F.col("page").alias("want"))
    off = have.join(want, ["doc", "pos"], "full_outer").where(~F.col("have").eqNullSafe(F.col("want"))).select("doc").distinct()
    return off.select(F.lit("page_sequence").alias("rule_id"), F.lit("error").alias("severity"), F.col("doc").alias("key"))


def content_page_violations(ranges: DataFrame) -> DataFrame:
    """Violations of ranges(doc, pos, first, last, page_count): each in bounds, in order, and beyond the one before."""
    from pyspark.sql import Window

    before = F.max("last").over(Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    r = ranges.withColumn("before", before)
    return row_violations(r, F.concat_ws("/", "doc", "pos"), [
        RowRule("range_bounds", ~F.coalesce((F.col("first") >= 1) & (F.col("last") <= F.col("page_count")), F.lit(False))),
        RowRule("range_order", F.col("last") < F.col("first")),
        RowRule("range_overlap", F.col("first") <= F.col("before")),
    ])


def content_pages(ranges: DataFrame) -> DataFrame:
    """(doc, pos, page): the pages of each range in order."""
    return ranges.select("doc", "pos", F.explode(F.sequence("first", "last")).alias("page"))
