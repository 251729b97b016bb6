"""Chapters of a book: types carried over pages, ranges, headings, counters and scans.

Paragraphs are (doc, idx, text), blocks (doc, page, pos, kind, role, text); a book is ordered
by one window, books are independent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators.ordered import carry, carry_reset, island
from folioloom.profile import DEFAULT, Profile


def carry_page_types(blocks: DataFrame, pages: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """(doc, page, page_type): a type heading holds over consecutive pages until a unit, a chapter or a gap.

    Options without a type are multiple choice. A page that shows several types is mixed; one
    that shows none keeps its own of ``pages``.
    """
    order = ["page", "pos"]
    by_doc = Window.partitionBy("doc").orderBy(*order)
    named = F.when(F.col("role") == "question_type_heading", T.heading_type(F.col("text"), profile))
    gap = F.col("page") - F.coalesce(F.lag("page").over(by_doc), F.col("page")) > 1
    b = blocks.withColumn("named", named).withColumn("forget", F.coalesce(F.col("role").isin("unit_heading", "chapter_heading"), F.lit(False)) | gap)
    b = b.withColumn("carried", carry_reset(F.col("named"), F.col("forget"), ["doc"], order))
    shown = F.when(F.col("kind") == "heading", F.col("named")).otherwise(F.coalesce("carried", F.when(F.col("kind") == "options", F.lit("mcq"))))
    types = b.select("doc", "page", shown.alias("t")).where("t IS NOT NULL").groupBy("doc", "page", "t").count()
    seen = types.groupBy("doc", "page").agg(F.when(F.count("*") > 1, "mixed").otherwise(F.min("t")).alias("seen"))
    return pages.join(seen, ["doc", "page"], "left").select("doc", "page", F.coalesce("seen", "page_type").alias("page_type"))


def chapter_range(paragraphs: DataFrame, start: str, end: str | None) -> DataFrame:
    """(doc, first, last): from the first match of ``start`` to before the first ``end`` after it.

    Without an end, or where it never matches, the last paragraph closes the range; a document
    without a start has none.
    """
    p = paragraphs.select("doc", "idx", F.col("text").rlike(start).alias("starts"), (F.col("text").rlike(end) if end else F.lit(False)).alias("ends"))
    first = F.min(F.when(F.col("starts"), F.col("idx"))).over(Window.partitionBy("doc"))
    p = p.withColumn("first", first).where("first IS NOT NULL")
    ends = F.min(F.when(F.col("ends") & (F.col("idx") > F.col("first")), F.col("idx") - 1))
    return p.groupBy("doc", "first").agg(F.coalesce(ends, F.max("idx")).alias("last"))


def unify_headings(paragraphs: DataFrame, rules: list[tuple[str, str, str | None]]) -> DataFrame:
    """paragraphs with ``text`` by the last rule that matches the original; rules are (match, text, clear).

    A rule's clear pattern empties a heading that its match pattern fails.
    """
    out = None
    for match, text, clear in reversed(rules):
        hit = F.col("text").rlike(match)
        out = F.when(hit, F.lit(text)) if out is None else out.when(hit, F.lit(text))
        if clear:
            out = out.when(F.col("text").rlike(clear), F.lit(""))
    return paragraphs if out is None else paragraphs.withColumn("text", F.when(F.col("is_heading"), out.otherwise(F.col("text"))).otherwise(F.col("text")))


def answer_directive(heading: Column) -> Column:
    """(lines, is_mcq) that a heading asks for: a number of lines, else by the kind of question."""
    low = F.lower(heading)
    n = F.coalesce(F.nullif(F.regexp_extract(heading, "(\\d+)\\s*लाइन", 1), F.lit("")), F.nullif(F.regexp_extract(low, "(\\d+)\\s*line", 1), F.lit(""))).cast("int")
    mcq = low.rlike("multiple choice|mcq|बहुविकल्पीय")
    kind = F.when(mcq, 0).when(low.rlike("numerical|संख्यात्मक"), 10).when(low.rlike("theor|सैद्धांतिक"), 8).otherwise(0)
    return F.struct(F.coalesce(n, kind).alias("lines"), (mcq & n.isNull()).alias("is_mcq"))


def with_directives(paragraphs: DataFrame) -> DataFrame:
    """paragraphs plus the directive of the last heading above, and the next paragraph's text."""
    held = carry(F.when(F.col("is_heading"), answer_directive(F.col("text"))), ["doc"], ["idx"])
    return paragraphs.withColumn("directive", held).withColumn("next_text", F.lead("text").over(Window.partitionBy("doc").orderBy("idx")))


def option_runs(paragraphs: DataFrame, most: int = 4) -> DataFrame:
    """Runs of lines that begin with (a) to (d), at most ``most`` of each run: (doc, run, k, text)."""
    p = paragraphs.withColumn("opt", F.col("text").rlike("(?i)^\\s*\\([a-d]\\)")).where("trim(text) <> ''")
    w = Window.partitionBy("doc").orderBy("idx")
    starts = F.col("opt") & ~F.coalesce(F.lag("opt").over(w), F.lit(False))
    p = p.withColumn("starts", starts).withColumn("run", island(F.col("starts"), ["doc"], ["idx"])).where("opt")
    k = F.row_number().over(Window.partitionBy("doc", "run").orderBy("idx"))
    return p.withColumn("k", k).where(F.col("k") <= most).select("doc", "run", "k", "text")


def section_counter(paragraphs: DataFrame, section: str) -> DataFrame:
    """Numbered list items counted from 1 in each section; a section line begins anew."""
    p = paragraphs.withColumn("part", island(F.col("text").rlike(section), ["doc"], ["idx"]))
    n = F.sum(F.col("is_item").cast("int")).over(Window.partitionBy("doc", "part").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    return p.withColumn("number", F.when(F.col("is_item"), n)).drop("part")


def missing_fonts(required: DataFrame, installed: DataFrame, generic: tuple[str, ...] = ("arial", "times new roman", "calibri", "cambria math", "symbol")) -> DataFrame:
    """Required fonts that aren't generic, installed, or held by or holding an installed name of over four letters.

    Unlike a rule that passes where nothing can be listed, an empty ``installed`` leaves all missing.
    """
    low = installed.agg(F.collect_set(F.lower("font")).alias("have"))
    r = required.select("font", F.lower("font").alias("low")).where(~F.lower("font").isin(*generic)).join(F.broadcast(low), F.lit(True), "left")
    near = F.exists("have", lambda h: (h == F.col("low")) | ((F.length(h) > 4) & (F.contains(h, F.col("low")) | F.contains(F.col("low"), h))))
    return r.where(~F.coalesce(near, F.lit(False))).select("font").distinct()


def paragraph_texts(runs: DataFrame, convert: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc, par, text) of runs(doc, par, n, text, font): those in a legacy font converted, all joined in order and trimmed."""
    text = F.coalesce("text", F.lit(""))
    if convert is not None:
        text = F.when(T.is_legacy_font(F.col("font")), convert(text)).otherwise(text)
    parts = F.transform(F.sort_array(F.collect_list(F.struct("n", "t"))), lambda s: s["t"])
    return runs.withColumn("t", text).groupBy("doc", "par").agg(F.trim(F.array_join(parts, "")).alias("text"))


def contents(paragraphs: DataFrame, heading: str, never: str, longest: int = 250) -> DataFrame:
    """(doc, idx, entry, anchor, text) of a table of contents: headings that aren't long, links or of the words in ``never``."""
    p = paragraphs.where(F.col("text").rlike(heading) & (F.length("text") < longest) & ~F.col("text").rlike(never) & ~F.coalesce("is_link", F.lit(False)))
    entry = F.row_number().over(Window.partitionBy("doc").orderBy("idx"))
    return p.select("doc", "idx", entry.alias("entry"), F.concat(F.lit("ch_"), entry.cast("string")).alias("anchor"), "text")


def chapter_members(members: DataFrame, ranges: DataFrame) -> DataFrame:
    """members(doc, idx, kind, ...) inside their document's range(s); a table belongs where the paragraph before it does."""
    own = F.last(F.when(F.col("kind") == "paragraph", F.col("idx")), ignorenulls=True).over(Window.partitionBy("doc").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    return members.withColumn("__at", own).join(ranges, "doc").where(F.col("__at").between(F.col("first"), F.col("last"))).drop("__at")
