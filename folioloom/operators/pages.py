"""Page parser: ordered lines of a page become typed blocks, and doubts become reviews.

Everything is declared over whole tables.  A line's kind follows from the line and its
neighbour.  Lines that nothing before them can reach past (headings, questions, ruled lines)
begin an epoch; what an epoch holds depends on its own lines alone, so one grouping by epoch
gives all blocks.  A fold is kept only for what truly depends on history: which option a line
without an anchor goes on with.  Pages are shuffled once.

Nothing is guessed: a doubtful block is of medium confidence and has a review.  Blank and null
lines are no content; a page without lines has no blocks; lines of one number stand in the order of their text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.operators.ordered import carry_reset, island
from folioloom.profile import DEFAULT, Profile

BLOCKS = (
    "doc string, page int, pos int, kind string, role string, question_id string, for_question string, label string, layout string, "
    "hindi string, english string, text string, columns int, items array<struct<label:string,text:string>>, count int, spacing double, confidence string"
)
REVIEWS = "doc string, page int, review_id string, type string, for_question string, blocking boolean, description string"
PAGE = ["doc", "page"]
LETTERS = ["A", "B", "C", "D"]


def _by_page():
    return Window.partitionBy(*PAGE).orderBy("line_no")


def content_lines(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """lines(doc, page, line_no, raw) numbered anew, with their clean ``text``; a printed page number at the end is none of them."""
    kept = lines.select("doc", F.col("page").cast("int").alias("page"), "line_no", "raw", T.sanitize(F.col("raw")).alias("text")).where("text <> ''")
    kept = kept.withColumn("line_no", F.row_number().over(Window.partitionBy(*PAGE).orderBy("line_no", "raw")))
    last = F.lead("text").over(_by_page()).isNull()
    return kept.withColumn("folio", last & F.col("text").rlike(profile.printed_page)).where("NOT folio").drop("folio")


def unwrapped(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Join headings that the source has broken over two lines.

    Of a run of lines that each want the next one, every second is that next one.
    """
    w = _by_page()
    text, after = F.col("text"), F.col("after")
    count = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark)))
    seen = lines.select("*", F.lead("text").over(w).alias("after"), F.lead("raw").over(w).alias("after_raw"), F.lag("text").over(w).alias("prior"))
    open_ = count("(") > count(")")
    title = open_ & T.question(after, profile).isNull() & (F.size(T.options(F.col("after_raw"), profile)) == 0)
    typed = T.is_type_heading(text, profile) & ((open_ & after.rlike(profile.marks_wrap)) | ((F.lower(after) == "question") & text.rlike("(?i)\\bmarks?$")))
    wants = after.isNotNull() & F.when(T.is_unit_heading(F.col("prior"), profile), title).otherwise(~T.is_unit_heading(text, profile) & typed)
    seen = seen.withColumn("wants", F.coalesce(wants, F.lit(False))).withColumn("n", F.row_number().over(w))
    since = F.col("n") - F.coalesce(F.max(F.when(~F.col("wants"), F.col("n"))).over(w), F.lit(0))
    seen = seen.withColumn("joins", F.col("wants") & (since % 2 == 1))
    seen = seen.withColumn("taken", F.coalesce(F.lag("joins").over(w), F.lit(False))).where("NOT taken")
    both = F.when(F.col("joins"), F.concat_ws(" ", "text", "after")).otherwise(text)
    raw = F.when(F.col("joins"), F.concat_ws(" ", F.rtrim("raw"), F.ltrim("after_raw"))).otherwise(F.col("raw"))
    return seen.select(*PAGE, "line_no", raw.alias("raw"), both.alias("text"))


def classified(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Kind, role, question, options and column of each line, its epoch, and the question that it is about."""
    w, keys, order = _by_page(), PAGE, ["line_no"]
    text = F.col("text")
    found = lines.select("*", T.question(text, profile).alias("q"), T.options(F.col("raw"), profile).alias("opts"), F.lag("text").over(w).alias("prior"))
    titled = T.is_unit_heading(F.col("prior"), profile) & F.col("q").isNull()
    role = F.when(T.is_unit_heading(text, profile), "unit_heading").when(T.is_type_heading(text, profile), "question_type_heading").when(titled, "chapter_heading")
    found = found.withColumn("role", role)
    kind = (
        F.when(F.col("role").isNotNull(), "heading").when(F.col("q").isNotNull(), "question")
        .when(F.size("opts") > 0, "options").when(T.is_answer_line(text, profile), "ruled").otherwise("other")
    )
    column = F.length("raw") - F.length(F.regexp_replace("raw", "^\\s+", ""))
    found = found.withColumn("kind", kind).withColumn("column", column)
    ruled_on = (F.col("kind") == "ruled") & F.coalesce(F.lag("kind").over(w) == "ruled", F.lit(False))
    found = found.withColumn("starts", F.col("kind").isin("heading", "question", "ruled") & ~ruled_on)
    found = found.withColumn("asked", island(F.col("kind") == "question", keys, order))
    named = F.when(F.col("kind") == "question", T.stable_id(F.col("page"), F.col("asked")))
    return found.select(
        *PAGE, "line_no", "kind", "role", "text", "q", "opts", "column", island(F.col("starts"), keys, order).alias("epoch"),
        carry_reset(named, F.col("kind") == "heading", keys, order).alias("about"),
    )


_PIECE = "array<struct<n:int,set:int,slot:int,label:string,text:string,wide:int>>"
_SLOT = "array<struct<label:string,column:int>>"


def option_pieces(rows: Column) -> Column:
    """(n, set, slot, label, text, wide) of each piece of text of the option sets among an epoch's lines.

    A set is open until a line that can't go on with it, or an option whose letter it has.  A
    line without an anchor goes on with the option of the nearest column, of two the later one,
    while letters are missing or the line is short.
    """
    none = lambda kind: F.array().cast(kind)
    start = F.struct(
        F.lit(0).alias("set"), F.lit(False).alias("open"), none("array<string>").alias("labels"), none(_SLOT).alias("slots"), F.lit(0).alias("widest"), none(_PIECE).alias("out")
    )

    def step(a: Column, x: Column) -> Column:
        letters = F.transform(x["opts"], lambda o: o["label"])
        fresh = ~a["open"] | F.arrays_overlap(a["labels"], letters)
        number = (a["set"] + fresh.cast("int")).cast("int")
        slots = F.when(fresh, none(_SLOT)).otherwise(a["slots"])
        pieces = F.transform(
            x["opts"],
            lambda o, i: F.struct(
                x["n"].alias("n"), number.alias("set"), (F.size(slots) + i).cast("int").alias("slot"), o["label"].alias("label"), o["text"].alias("text"), F.size(x["opts"]).alias("wide")
            ),
        )
        anchored = F.struct(
            number.alias("set"), F.lit(True).alias("open"), F.array_union(F.when(fresh, none("array<string>")).otherwise(a["labels"]), letters).alias("labels"),
            F.concat(slots, F.transform(x["opts"], lambda o: F.struct(o["label"].alias("label"), o["column"].alias("column")))).alias("slots"),
            F.greatest(F.when(fresh, F.lit(0)).otherwise(a["widest"]), F.size(x["opts"])).alias("widest"), F.concat(a["out"], pieces).alias("out"),
        )
        short = (F.length(x["text"]) <= 48) & (F.size(F.split(x["text"], "\\s+")) <= 8)
        goes_on = a["open"] & ((F.size(a["labels"]) < 4) | ((a["widest"] == 1) & ~F.array_contains(a["labels"], "D")) | short)
        nearest = F.array_min(F.transform(a["slots"], lambda s, i: F.struct(F.abs(s["column"] - x["column"]).alias("gap"), (-i).alias("back"), s["label"].alias("label"))))
        piece = F.struct(
            x["n"].alias("n"), a["set"].alias("set"), (-nearest["back"]).cast("int").alias("slot"), nearest["label"].alias("label"), x["text"].alias("text"), F.lit(0).alias("wide")
        )
        more = F.struct(
            a["set"].alias("set"), F.lit(True).alias("open"), a["labels"].alias("labels"), a["slots"].alias("slots"), a["widest"].alias("widest"), F.concat(a["out"], F.array(piece)).alias("out")
        )
        shut = F.struct(
            a["set"].alias("set"), F.lit(False).alias("open"), none("array<string>").alias("labels"), none(_SLOT).alias("slots"), F.lit(0).alias("widest"), a["out"].alias("out")
        )
        return F.when(x["kind"] == "options", anchored).when(goes_on, more).otherwise(shut)

    return F.aggregate(rows, start, step, lambda a: a["out"])


_FIELDS = {
    "n": "int", "slot": "int", "kind": "string", "role": "string", "question_id": "string", "for_question": "string", "label": "string", "layout": "string", "hindi": "string",
    "english": "string", "text": "string", "columns": "int", "items": "array<struct<label:string,text:string>>", "count": "int", "spacing": "double", "confidence": "string",
    "review": "string", "description": "string",
}


def _block(n: Column, kind: str, confidence: Column | str = "high", **values) -> Column:
    given = {"n": n, "slot": 0, "kind": kind, "confidence": confidence} | values
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(*[as_column(given.get(name)).cast(kind_).alias(name) for name, kind_ in _FIELDS.items()])


def _question_block(head: Column, body: Column, about: Column) -> Column:
    """A question with its statements, or a paragraph of its label where it has none."""
    own = F.filter(F.concat(F.array(head["q"]["body"]), F.transform(body, lambda x: x["text"])), lambda t: t != "")
    side = lambda hindi: F.nullif(F.array_join(F.filter(own, lambda t: t.rlike(T.DEVANAGARI) == F.lit(hindi)), " "), F.lit(""))
    hindi, english, label = side(True), side(False), head["q"]["label"]
    whole = hindi.isNotNull() & english.isNotNull()
    asked = _block(
        head["n"], "question", F.when(whole, "high").otherwise("medium"), question_id=about, label=label, layout=head["q"]["layout"], hindi=hindi, english=english, for_question=F.when(whole, F.lit(None)).otherwise(about),
        review=F.when(~whole, "missing_translation"), description=F.when(~whole, F.concat(label, F.lit(" has a statement in one language."))),
    )
    orphan = _block(head["n"], "paragraph", "medium", text=label, for_question=about, review="orphan_question_label", description=F.concat(label, F.lit(" has no statement.")))
    return F.when(F.size(own) == 0, orphan).otherwise(asked)


def _set_blocks(pieces: Column, number: Column, about: Column, profile: Profile) -> Column:
    """The block of one option set, or a paragraph for each option where one has no text."""
    own = F.filter(pieces, lambda p: p["set"] == number)
    slots = F.transform(
        F.sequence(F.lit(0), F.array_max(F.transform(own, lambda p: p["slot"]))),
        lambda k: F.struct(
            F.get(F.filter(own, lambda p: p["slot"] == k), F.lit(0))["label"].alias("label"),
            F.array_join(F.transform(F.filter(own, lambda p: (p["slot"] == k) & (p["text"] != "")), lambda p: p["text"]), " ").alias("text"),
        ),
    )
    n = F.array_min(F.transform(own, lambda p: p["n"]))
    distinct = F.size(F.array_distinct(F.transform(slots, lambda s: s["label"]))) == F.size(slots)
    items = F.when(distinct, F.sort_array(slots)).otherwise(slots)
    labels = F.transform(items, lambda s: s["label"])
    odd = labels != F.array(*map(F.lit, LETTERS))
    columns = T.option_columns(F.array_max(F.transform(own, lambda p: p["wide"])))
    layout = F.element_at(F.create_map(*[F.lit(x) for pair in profile.layouts for x in pair]), columns)
    whole = F.array(
        _block(
            n, "options", F.when(odd, "medium").otherwise("high"), columns=columns, layout=layout, items=items, for_question=about, review=F.when(odd, "option_sequence"),
            description=F.when(odd, F.concat(F.lit("Options are "), F.array_join(labels, ", "), F.lit(", not A to D once each."))),
        )
    )
    torn = F.transform(
        items,
        lambda s, i: _block(
            n, "paragraph", "medium", slot=i, text=F.trim(F.concat(F.lit("("), s["label"], F.lit(") "), s["text"])), for_question=about,
            review=F.when(i == F.size(items) - 1, "incomplete_options"), description=F.when(i == F.size(items) - 1, "An option has no text."),
        ),
    )
    return F.when(F.exists(slots, lambda s: s["text"] == ""), torn).otherwise(whole)


def parsed(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Blocks in order with the review that each gives rise to, if any; ``about`` is the question it belongs to."""
    rows = classified(unwrapped(content_lines(lines, profile), profile), profile)
    line = F.struct(F.col("line_no").cast("int").alias("n"), "kind", "role", "text", "q", "opts", "column")
    epochs = rows.groupBy(*PAGE, "epoch").agg(F.sort_array(F.collect_list(line)).alias("ls"), F.max("about").alias("about"))
    # an epoch's lines before its first options, and from there on
    first = F.get(F.filter(F.transform("ls", lambda x, i: F.when(x["kind"] == "options", i)), lambda i: i.isNotNull()), F.lit(0))
    epochs = epochs.withColumn("cut", F.coalesce(first, F.size("ls")))
    epochs = epochs.withColumn("early", F.slice("ls", 1, F.col("cut"))).withColumn("late", F.expr("slice(ls, cut + 1, size(ls))"))
    epochs = epochs.withColumn("pieces", option_pieces(F.col("late")))
    head, about = F.get("ls", F.lit(0)), F.col("about")
    others = lambda rows: F.filter(rows, lambda x: x["kind"] == "other")
    paragraph = lambda x: _block(x["n"], "paragraph", text=x["text"])
    ruled = F.size(F.filter("ls", lambda x: x["kind"] == "ruled"))
    opened = (
        F.when(head["kind"] == "heading", F.array(_block(head["n"], "heading", role=head["role"], text=head["text"])))
        .when(head["kind"] == "question", F.array(_question_block(head, others(F.col("early")), about)))
        .when(head["kind"] == "ruled", F.array(_block(head["n"], "answer_lines", count=ruled, spacing=profile.text_pitch, for_question=about)))
    )
    early = F.transform(F.when(head["kind"] == "question", F.array().cast(epochs.schema["early"].dataType)).otherwise(others(F.col("early"))), paragraph)
    used = F.transform("pieces", lambda p: p["n"])
    late = F.transform(F.filter(others(F.col("late")), lambda x: ~F.array_contains(used, x["n"])), paragraph)
    numbers = F.array_distinct(F.transform("pieces", lambda p: p["set"]))
    sets = F.flatten(F.transform(numbers, lambda k: _set_blocks(F.col("pieces"), k, about, profile)))
    nothing = F.array().cast(f"array<struct<{','.join(f'{n}:{k}' for n, k in _FIELDS.items())}>>")
    found = epochs.select(*PAGE, F.explode(F.concat(*[F.coalesce(x, nothing) for x in (opened, early, late, sets)])).alias("b"))
    pos = F.row_number().over(Window.partitionBy(*PAGE).orderBy("b.n", "b.slot"))
    return found.select(*PAGE, pos.alias("pos"), "b.*")


def blocks(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Blocks of lines(doc, page, line_no, raw)."""
    names = [c.split()[0] for c in BLOCKS.replace(", ", "\n").split("\n")]
    mine = F.when(F.col("kind").isin("options", "answer_lines"), F.col("for_question"))
    return parsed(lines, profile).withColumn("for_question", mine).select(*names)


def reviews(lines: DataFrame, profile: Profile = DEFAULT) -> DataFrame:
    """Doubts of lines(doc, page, line_no, raw), numbered in the order of their blocks."""
    doubts = parsed(lines, profile).where("review IS NOT NULL")
    n = F.row_number().over(Window.partitionBy(*PAGE).orderBy("pos"))
    named = T.review_id(F.col("page"), F.col("review"), n)
    return doubts.select(*PAGE, named.alias("review_id"), F.col("review").alias("type"), "for_question", F.lit(True).alias("blocking"), "description")


def parse_page(doc: str, page: int, raw_lines: list[str], profile: Profile = DEFAULT) -> tuple[list[dict], list[dict]]:
    """(blocks, reviews) of one page that is at hand, in the session that is running."""
    spark = SparkSession.builder.getOrCreate()
    lines = spark.createDataFrame([(doc, page, k, raw) for k, raw in enumerate(raw_lines)], "doc string, page int, line_no int, raw string")
    found = blocks(lines, profile).orderBy("pos").collect()
    return [r.asDict(recursive=True) for r in found], [r.asDict() for r in reviews(lines, profile).orderBy("review_id").collect()]
