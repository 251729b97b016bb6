"""Scalar rules of typed blocks and printed pages, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioloom.functions.text import mm_to_twips

# Average glyphs to a printed inch, an image's width where none is known, and units of a line break.
GLYPHS_AN_INCH, INCHES, BREAK_UNITS = 14.0, 3.0, 30
MOST_UNITS_OF_TWO, MOST_UNITS_OF_FOUR = 34.0, 14.0


def formula_units(formula: Column) -> Column:
    """Width of formula struct<width_inches,bbox> in glyphs; the box's width where none is stated."""
    width = F.coalesce(formula["width_inches"], F.when(F.size(formula["bbox"]) == 4, (F.get(formula["bbox"], F.lit(2)) - F.get(formula["bbox"], F.lit(0))) / 72.0), F.lit(INCHES))
    return F.when(width > 0, width).otherwise(F.lit(INCHES)) * GLYPHS_AN_INCH


def text_units(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    return (F.length(t) + BREAK_UNITS * (F.length(t) - F.length(F.replace(t, F.lit("\n"))))).cast("double")


def visual_units(item: Column) -> Column:
    """Width of an option struct<text,formula,runs array<struct<text,formula>>>: its formula, else its runs, else its text."""
    runs = F.aggregate(item["runs"], F.lit(0.0), lambda a, r: a + F.when(r["formula"].isNotNull(), formula_units(r["formula"])).otherwise(text_units(r["text"])))
    return F.when(item["formula"].isNotNull(), formula_units(item["formula"])).when(item["runs"].isNotNull(), runs).otherwise(text_units(item["text"]))


def option_grid(units: Column, requested: Column, most_two: float = MOST_UNITS_OF_TWO, most_four: float = MOST_UNITS_OF_FOUR) -> Column:
    """Columns for options of these widths: one where any is too wide, four only where all four fit."""
    widest, n, wanted = F.array_max(units), F.size(units), F.coalesce(requested, F.lit(2))
    four = F.when(widest > most_four, 2).otherwise(4)
    return F.when(widest > most_two, 1).when((wanted == 4) & (n == 4), four).when((wanted == 2) & (n >= 2), 2).otherwise(1)


def requested_columns(layout: Column, columns: Column) -> Column:
    low = F.lower(layout)
    return F.when(low.isin("one_column", "1_column", "stacked"), 1).when(low.isin("two_by_two", "2x2"), 2).when(low.isin("four_inline", "4_inline"), 4).otherwise(F.coalesce(columns, F.lit(2)))


def answer_line_count(count: Column, marks: Column, by_marks: dict[int, int]) -> Column:
    """The stated count, else that of the marks, else two a mark; null where neither is known."""
    known = None
    for m, n in sorted(by_marks.items()):
        known = F.when(marks == m, F.lit(n)) if known is None else known.when(marks == m, F.lit(n))
    return F.coalesce(count, *([known] if known is not None else []), F.when(marks > 0, marks * 2)).cast("int")


def answer_line_pitch(spacing: Column, mode: Column, default: float, generous: float) -> Column:
    return F.coalesce(spacing, F.when(mode == "generous", F.lit(generous)), F.lit(default))


def heading_style(role: Column, level: Column) -> Column:
    """(style, kind) by role, then by level."""
    low = F.lower(F.coalesce(role, F.lit("")))
    pair = lambda style, kind: F.struct(F.lit(style).alias("style"), F.lit(kind).alias("kind"))
    return (
        F.when(low.isin("unit", "unit_heading"), pair("Book Unit", "unit"))
        .when(low.isin("question_type", "question_type_heading", "section_heading"), pair("Book Question Type", "question_type"))
        .when(F.coalesce(level, F.lit(1)) == 1, pair("Book Chapter", "chapter"))
        .otherwise(pair("Book Question Type", "question_type"))
    )


def page_context(index: Column, first_side: Column, section: Column, inside_mm: float, outside_mm: float, top_mm: float, width_mm: float = 210.0, height_mm: float = 297.0, content_only: bool = False) -> Column:
    """(left, right, top) indents in twips beside the margins of section struct<width,height,left,right,top>; null where the page isn't the profile's.

    The first page is on ``first_side``; sides alternate, and the inner margin changes with them.
    """
    twips = lambda mm: mm_to_twips(F.lit(mm))
    fits = (F.abs(section["width"] - twips(width_mm)) <= twips(0.5)) & (F.abs(section["height"] - twips(height_mm)) <= twips(0.5))
    recto = (index % 2 == 0) == (first_side == "recto")
    top = F.greatest(F.lit(0), twips(top_mm) - section["top"])
    left = F.when(recto, twips(inside_mm)).otherwise(twips(outside_mm)) - section["left"]
    right = F.when(recto, twips(outside_mm)).otherwise(twips(inside_mm)) - section["right"]
    zero = F.lit(0).cast("long")
    return F.when(fits, F.struct((zero if content_only else left).alias("left"), (zero if content_only else right).alias("right"), top.cast("long").alias("top")))


def block_text(block: Column) -> Column:
    """Searchable text of block struct<text,label,hindi,english,runs,items>: its fields in this order, one space between."""
    own = F.array(block["text"], block["label"], block["hindi"], block["english"])
    runs = F.transform(F.coalesce(block["runs"], F.array().cast("array<struct<text:string>>")), lambda r: r["text"])
    items = F.flatten(F.transform(F.coalesce(block["items"], F.array().cast("array<struct<label:string,text:string>>")), lambda i: F.array(i["label"], i["text"])))
    return F.array_join(F.filter(F.concat(own, runs, items), lambda t: t.isNotNull()), " ")


def is_positive(x: Column) -> Column:
    """A finite number above zero."""
    return F.coalesce((x > 0) & ~F.isnan(x.cast("double")) & (x < float("inf")), F.lit(False))


def has_text(t: Column) -> Column:
    return F.coalesce(F.regexp_like(t, F.lit("(?U)\\S")), F.lit(False))


def is_rectangle(box: Column) -> Column:
    """Four numbers of a positive rectangle; none at all is allowed."""
    at = lambda k: F.get(box, F.lit(k))
    return box.isNull() | F.coalesce((F.size(box) == 4) & (at(0) >= 0) & (at(1) >= 0) & (at(2) > at(0)) & (at(3) > at(1)), F.lit(False))
