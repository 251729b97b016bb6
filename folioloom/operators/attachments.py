"""What belongs to a question: answer lines, figures, groups, and the rows that a request selects.

Blocks are (doc, page, pos, kind, question_id, label, for_question, path); a page is a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.operators.ordered import carry, island

PAGE = ["doc", "page"]
# Kinds that stay with a question, and those that give room to answer it.
FOLLOWERS = ("options", "equation", "figure", "answer_lines", "answer_canvas")
KEPT = ("paragraph", "options", "equation", "formula_image", "figure", "answer_lines", "answer_canvas")
ANSWERS, PICTURES = ("answer_lines", "answer_canvas"), ("figure", "formula_image")


def _window():
    return Window.partitionBy(*PAGE).orderBy("pos")


def label_number(label: Column) -> Column:
    return F.regexp_extract(F.trim(label), "(?i)^Q\\s*(\\d+)\\.?$", 1).try_cast("int")


def labels_agree(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """(doc, page, agree): whether the questions' label numbers are the anchors' numbers, one after the other.

    The k-th label meets the k-th anchor; a label that is no number agrees with none.
    """
    asked = blocks.where("kind = 'question'").select(*PAGE, F.row_number().over(_window()).alias("k"), label_number(F.col("label")).alias("label"))
    seen = anchors.select(*PAGE, F.row_number().over(Window.partitionBy(*PAGE).orderBy("top")).alias("k"), "number")
    both = asked.withColumn("l", F.lit(True)).join(seen.withColumn("r", F.lit(True)), [*PAGE, "k"], "full_outer")
    same = F.coalesce(F.col("l") & F.col("r") & (F.col("label") == F.col("number")), F.lit(False))
    return both.groupBy(*PAGE).agg(F.min(same.cast("int")).alias("m")).select(*PAGE, (F.col("m") == 1).alias("agree"))


def attach_answer_lines(blocks: DataFrame, spaces: DataFrame) -> DataFrame:
    """blocks with an answer_lines block after the last block of each question that spaces(doc, page, number, count) name.

    A question that has answer lines already, or a number that several questions have, gets none.
    """
    b = blocks.withColumn("turn", island(F.col("kind") == "question", PAGE, ["pos"]))
    has = F.max((F.col("kind") == "answer_lines").cast("int")).over(Window.partitionBy(*PAGE, "turn"))
    b = b.withColumn("has", has)
    asked = b.where("kind = 'question' AND has = 0").select(*PAGE, "turn", "question_id", label_number(F.col("label")).alias("number"))
    once = asked.withColumn("n", F.count("*").over(Window.partitionBy(*PAGE, "number"))).where("n = 1 AND number IS NOT NULL").drop("n")
    rows = b.select(*PAGE, "turn", F.lit(0).alias("late"), "pos", "kind", "question_id", "for_question", F.lit(None).cast("int").alias("count"))
    room = spaces.join(once, [*PAGE, "number"]).select(
        *PAGE, "turn", F.lit(1).alias("late"), F.lit(0).alias("pos"), F.lit("answer_lines").alias("kind"), F.lit(None).cast("string").alias("question_id"), F.col("question_id").alias("for_question"), "count"
    )
    order = F.row_number().over(Window.partitionBy(*PAGE).orderBy("turn", "late", "pos"))
    return rows.unionByName(room.select(*rows.columns)).withColumn("place", order).drop("turn", "late", "pos").withColumnRenamed("place", "pos")


def insert_attachments(blocks: DataFrame, attachments: DataFrame) -> DataFrame:
    """blocks with attachments(doc, page, ordinal, kind, path, question_id) after what already belongs to their question.

    Pictures come before the room to answer.  One that is there already isn't put in again;
    one whose question isn't on the page is left out (see :func:`lost_attachments`).
    """
    names = ["kind", "path", "for_question"]
    wanted = attachments.withColumnRenamed("question_id", "for_question").dropDuplicates([*PAGE, *names])
    wanted = wanted.join(blocks.select(*PAGE, *names).where("for_question IS NOT NULL"), [*PAGE, *names], "left_anti")
    held = carry(F.col("question_id"), PAGE, ["pos"])
    b = blocks.withColumn("owner", F.when(F.col("kind") == "question", F.col("question_id")).otherwise(held))
    up_to = Window.partitionBy(*PAGE, "owner").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    own = (F.col("kind") == "question") | F.coalesce(F.col("for_question") == F.col("owner"), F.lit(False))
    b = b.withColumn("broken", F.sum((~own).cast("int")).over(up_to)).withColumn("answers", F.sum(F.col("kind").isin(*ANSWERS).cast("int")).over(up_to))
    ends = b.where("owner IS NOT NULL AND broken = 0").groupBy(*PAGE, "owner").agg(F.max("pos").alias("end"), F.max(F.when(F.col("answers") == 0, F.col("pos"))).alias("before"))
    placed = wanted.join(ends.withColumnRenamed("owner", "for_question"), [*PAGE, "for_question"])
    at = F.when(F.col("kind").isin(*PICTURES), F.col("before")).otherwise(F.col("end"))
    rows = blocks.select(*PAGE, F.col("pos").alias("at"), F.lit(0).alias("late"), "kind", "path", "question_id", "for_question")
    late = F.when(F.col("kind").isin(*PICTURES), F.lit(0)).otherwise(F.lit(1)) * 1_000_000 + F.col("ordinal") + 1
    more = placed.select(*PAGE, at.alias("at"), late.cast("int").alias("late"), "kind", "path", F.lit(None).cast("string").alias("question_id"), "for_question")
    return rows.unionByName(more).withColumn("pos", F.row_number().over(Window.partitionBy(*PAGE).orderBy("at", "late"))).drop("at", "late")


def lost_attachments(blocks: DataFrame, attachments: DataFrame) -> DataFrame:
    """Attachments whose question isn't on their page."""
    return attachments.join(blocks.where("kind = 'question'").select(*PAGE, "question_id"), [*PAGE, "question_id"], "left_anti")


def question_groups(blocks: DataFrame) -> DataFrame:
    """blocks with ``grp``: a question and the followers that are its own, everything else alone.

    A block that breaks the row of followers also ends the group for those after it.
    """
    b = blocks.withColumn("turn", island(F.col("kind") == "question", PAGE, ["pos"]))
    by_turn = Window.partitionBy(*PAGE, "turn")
    owner = F.max(F.when(F.col("kind") == "question", F.coalesce("question_id", F.lit("")))).over(by_turn)
    joins = F.col("kind").isin(*FOLLOWERS) & (F.col("for_question").isNull() | (F.col("for_question") == owner))
    inside = (F.col("turn") > 0) & ((F.col("kind") == "question") | F.coalesce(joins, F.lit(False)))
    b = b.withColumn("inside", inside)
    broken = F.sum((~F.col("inside")).cast("int")).over(by_turn.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    b = b.withColumn("alone", (broken > 0)).withColumn("starts", F.col("alone") | (F.col("kind") == "question") | (F.col("turn") == 0))
    return b.withColumn("grp", island(F.col("starts"), PAGE, ["pos"])).drop("turn", "inside", "alone", "starts")


def keep_transitions(blocks: DataFrame) -> DataFrame:
    """blocks with ``keep``: whether the block before stays on one page with this one."""
    w = _window()
    kind, role, asked = (F.lag(c).over(w) for c in ("kind", "role", "question_id"))
    own = F.col("for_question").isNull() | (F.col("for_question") == asked)
    keep = (kind == "heading") | ((kind == "paragraph") & role.isin("section_heading", "question_type_heading")) | ((kind == "question") & F.col("kind").isin(*KEPT) & own)
    return blocks.withColumn("keep", F.coalesce(keep, F.lit(False)))


def select_pages(rows: DataFrame, requested: DataFrame) -> DataFrame:
    """Rows of the pages in requested(pos, page), in the requested order as ``place``; a page that is asked twice counts once."""
    first = requested.groupBy("page").agg(F.min("pos").alias("place"))
    return rows.join(first, "page")


def selection_errors(rows: DataFrame, requested: DataFrame) -> DataFrame:
    """(rule_id, severity, key) of requested pages that aren't there, or are asked for twice."""
    key = lambda df, rule: df.select(F.lit(rule).alias("rule_id"), F.lit("error").alias("severity"), F.col("page").cast("string").alias("key"))
    lost = requested.select("page").distinct().join(rows.select("page"), "page", "left_anti")
    twice = requested.groupBy("page").count().where("count > 1")
    return key(lost, "missing_page").unionByName(key(twice, "duplicate_page"))


def composition(rows: DataFrame, requested: DataFrame | None, keep: Column) -> DataFrame:
    """The requested pages where a selection is given, else the rows that ``keep`` names."""
    return rows.where(keep) if requested is None else select_pages(rows, requested).drop("place")


def insertion_point(paragraphs: DataFrame, pattern: str, fallback: int | None = None) -> DataFrame:
    """(doc, idx): the first paragraph that matches, else ``fallback``."""
    return paragraphs.groupBy("doc").agg(F.coalesce(F.min(F.when(F.col("text").rlike(pattern), F.col("idx"))), F.lit(fallback)).alias("idx"))


def page_results(measured: DataFrame, meta: DataFrame, source: DataFrame) -> DataFrame:
    """measured(page, source_page, ...) with its page's metadata and source measurement; defaults where there are none.

    Of repeated metadata of a page the last one (by ``pos``) counts.
    """
    last = meta.groupBy("source_page").agg(F.max_by(F.struct("page_type", "exempt"), "pos").alias("m")).select("source_page", "m.*")
    out = measured.join(last, "source_page", "left").join(source.select("source_page", F.col("utilization").alias("source_utilization")), "source_page", "left")
    return out.withColumn("page_type", F.coalesce("page_type", F.lit("other"))).withColumn("exempt", F.coalesce("exempt", F.lit(False)))


def override(rows: DataFrame, changes: DataFrame, keys: list[str], column: str, forget: str | None = None) -> DataFrame:
    """rows with ``column`` from changes(*keys, new) where it has one; ``forget`` becomes null there, as it told of the old value."""
    out = rows.join(changes.select(*keys, F.col("new").alias("__new")), keys, "left")
    if forget:
        out = out.withColumn(forget, F.when(F.col("__new").isNull(), F.col(forget)))
    return out.withColumn(column, F.coalesce("__new", column)).drop("__new")
