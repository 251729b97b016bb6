"""Queries of the book contract, attachments, chapters, merges, layout and markup, each through its operator.

Rows are made from the tables by the same SQL for both sides; the oracle then works on the
numbers that they were made from.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import attachments as A
from folioloom.operators import book_ir as R
from folioloom.operators import chapters as H
from folioloom.operators import layout as L
from folioloom.operators import markup as X
from folioloom.operators import merges as M
from folioloom.operators import packages as K
from folioloom.operators import print_rules as P
from folioloom.plans.catalogue import lines_by_order, made, query, table

_SEED = """
SELECT concat('b', l_orderkey % 997) AS doc, CAST(l_orderkey AS INT) AS page, l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS INT) AS q,
       CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS pos
FROM {lineitem}
"""
_DUCK = _SEED.format(lineitem="lineitem")
_PAD = "lpad(CAST(page AS STRING), greatest(3, length(CAST(page AS STRING))), '0')"


def _by_order(spark, sf_dir, sql):
    return spark.sql(sql, lineitem=lines_by_order(spark, sf_dir, "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"))


def _seed(spark, sf_dir):
    return _by_order(spark, sf_dir, _SEED)


def _case(key, *values):
    """The value of each remainder; none beyond."""
    out = None
    for k, v in enumerate(values):
        v = v if hasattr(v, "alias") else F.lit(v)
        out = F.when(key == k, v) if out is None else out.when(key == k, v)
    return out


# --- the contract of blocks and pages -------------------------------------------------------------


def _blocks(spark, sf_dir):
    part, supp, q = F.col("part"), F.col("supp"), F.col("q")
    none = F.lit(None)
    image = lambda **v: F.struct(*[(F.lit(v.get(n)) if not hasattr(v.get(n), "alias") else v[n]).alias(n) for n in ("kind", "path", "alt_text", "effective_dpi", "width_inches", "height_inches", "bbox")]).cast(R._IMAGE)
    run = lambda text=None, language=None, formula=none: F.struct(F.lit(text).alias("text"), F.lit(language).alias("language"), formula.cast(R._IMAGE).alias("formula"))
    box = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    item = lambda label, text=None, runs=none, formula=none: F.struct(F.lit(label).alias("label"), F.lit(text).alias("text"), runs.cast(R._RUNS).alias("runs"), formula.cast(R._IMAGE).alias("formula"))
    own = R.source_id(F.col("doc"), F.col("page"))
    cells = lambda *rows: F.array(*[F.array(*map(F.lit, r)).cast("array<string>") for r in rows])
    return _seed(spark, sf_dir).select(
        "doc", "page", "pos",
        _case(part % 9, "heading", "question", "options", "figure", "table", "answer_lines", "answer_canvas", "spacer", "banner").alias("kind"),
        _case(supp % 5, "low", "medium", none, "high", "high").alias("confidence"),
        F.when(q % 11 == 0, F.array().cast("array<string>")).when(q % 7 == 0, F.array(F.lit("b:p000"))).otherwise(F.array(F.lit("x"), own)).alias("source_ids"),
        _case(part % 13, " ", "nope", "q1").alias("for_question"),
        _case(q % 4, " ", none, "words", "words").alias("text"),
        _case(q % 3, none, F.array(run("a", "latin")), F.array(run("a", "greek"), run())).alias("runs"),
        F.when(supp % 3 == 1, " ").when(supp % 3 == 2, F.concat(F.lit("q"), (supp % 4).cast("string"))).alias("question_id"),
        F.when(q % 5 == 0, "").otherwise("Q1.").alias("label"),
        _case(supp % 7, "weird", "standalone", "plain").alias("label_layout"),
        F.when(q % 6 == 0, "हिंदी").alias("hindi"), F.when(q % 6 == 1, "x").alias("english"),
        F.when(q % 6 == 2, F.array(run("a", "hindi"))).when(q % 6 == 3, F.array(run(formula=image(path="p", alt_text="f")))).alias("hindi_runs"),
        _case(part % 5, none, F.array(item("A", "one"), item("B", "two")), F.array(item("A", "one"), item("A", " ")), F.array(item("", formula=image(path="p"))), F.array(item("A", runs=F.array(run("a"))))).alias("items"),
        _case(supp % 4, 3, 4, 2).alias("columns"),
        _case(q % 6, "four_inline", "odd").alias("layout"),
        _case(q % 4, none, image(path="a", alt_text="b", effective_dpi=300.0, bbox=box(0, 0, 1, 1)), image(path=" ", alt_text="b", effective_dpi=300.0), image(path="a", alt_text="b", bbox=box(1, 1, 0, 2))).alias("image"),
        _case(q % 4, none, cells("ab", "cd"), cells("ab", "c"), cells("a", "")).alias("rows"),
        F.when(q % 2 == 0, -1.0).otherwise(3.0).alias("points"), (q + supp % 3 * 10).cast("int").alias("count"), F.when(supp % 5 == 0, 0.0).alias("spacing"),
        F.when(q % 3 == 0, "moon").otherwise("graph").alias("canvas_type"), F.when(supp % 4 != 0, 10.0).alias("height_points"), F.when(supp % 4 == 1, -1.0).alias("width_points"),
    )


_IR_RULES = {
    "kind": "part % 9 = 8", "confidence": "supp % 5 = 0", "source_ids": "q % 11 = 0", "own_page": "q % 11 <> 0 AND q % 7 = 0", "for_question": "part % 13 = 0",
    "content": "part % 9 = 0 AND q % 4 IN (0, 1) AND q % 3 = 0", "question_id": "part % 9 = 1 AND supp % 3 = 1", "label": "part % 9 = 1 AND q % 5 = 0",
    "label_layout": "(part % 9 = 1 AND supp % 7 IN (0, 2)) OR (part % 9 = 2 AND supp % 7 IN (0, 1))", "statement": "part % 9 = 1 AND q % 6 > 3", "items": "part % 9 = 2 AND part % 5 = 0",
    "item_label": "part % 9 = 2 AND part % 5 = 3", "item_content": "part % 9 = 2 AND part % 5 = 2", "item_image": "part % 9 = 2 AND part % 5 = 3", "item_unique": "part % 9 = 2 AND part % 5 = 2",
    "columns": "part % 9 = 2 AND supp % 4 = 0", "layout": "part % 9 = 2 AND ((q % 6 = 0 AND supp % 4 <> 1) OR q % 6 = 1)", "image": "part % 9 = 3 AND q % 4 <> 1", "table": "part % 9 = 4 AND q % 4 <> 1",
    "points": "part % 9 = 7 AND q % 2 = 0", "count": "part % 9 = 5 AND q + supp % 3 * 10 > 50", "spacing": "part % 9 = 5 AND supp % 5 = 0", "canvas_type": "part % 9 = 6 AND q % 3 = 0",
    "canvas_size": "part % 9 = 6 AND supp % 4 IN (0, 1)", "run_content": "part % 9 = 0 AND q % 3 = 2", "run_language": "part % 9 = 0 AND q % 3 = 2", "run_image": "part % 9 = 1 AND q % 6 = 3",
}


@query(
    "ir_violations",
    f"WITH s AS ({_DUCK}), a AS (SELECT doc || '/' || CASE WHEN supp % 3 = 1 THEN ' ' ELSE 'q' || (supp % 4) END AS k FROM s WHERE part % 9 = 1 AND supp % 3 > 0)\n"
    + "\nUNION ALL ".join(f"SELECT '{rule}' AS rule_id, 'error' AS severity, concat_ws('/', doc, page, pos) AS key FROM s WHERE {test}" for rule, test in _IR_RULES.items())
    + """
UNION ALL SELECT 'question_unique', 'error', k FROM a GROUP BY k HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'question_known', 'error', k FROM (SELECT doc || '/' || CASE part % 13 WHEN 0 THEN ' ' WHEN 1 THEN 'nope' ELSE 'q1' END AS k FROM s WHERE part % 13 < 3) WHERE k NOT IN (SELECT k FROM a)
""",
)
def ir_violations(spark, sf_dir):
    """Every broken rule of nested blocks."""
    return R.block_violations(_blocks(spark, sf_dir))


@query(
    "page_violations",
    """
WITH p AS (SELECT concat('b', o_custkey % 200) AS doc, o_orderkey, CAST(o_orderkey % 90 AS INT) AS page, o_custkey AS c, CAST(row_number() OVER (PARTITION BY o_custkey % 200 ORDER BY o_orderkey) AS INT) AS pos FROM orders),
w AS (SELECT doc, pos, CASE WHEN c % 200 < 150 THEN page ELSE pos END AS page FROM p)
SELECT 'page_type' AS rule_id, 'error' AS severity, concat_ws('/', doc, page) AS key FROM p WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'page_bounds', 'error', concat_ws('/', doc, page) FROM p WHERE page < 1 OR page > 80
UNION ALL SELECT 'exempt_reason', 'error', concat_ws('/', doc, page) FROM p WHERE o_orderkey % 5 = 0 AND o_orderkey % 2 = 0
UNION ALL SELECT 'blocks', 'error', concat_ws('/', doc, page) FROM p WHERE o_orderkey % 11 = 0
UNION ALL SELECT 'page_unique', 'error', concat_ws('/', doc, page) FROM p GROUP BY doc, page HAVING count(*) > 1
UNION ALL SELECT DISTINCT 'page_sequence', 'error', p.doc FROM p JOIN w USING (doc, pos) WHERE p.page <> w.page
""",
)
def page_violations(spark, sf_dir):
    """Domains, bounds, reasons, repeats and order of pages."""
    p = made(spark, sf_dir, """
SELECT concat('b', o_custkey % 200) AS doc, CAST(o_orderkey % 90 AS INT) AS page, CAST(row_number() OVER (PARTITION BY o_custkey % 200 ORDER BY o_orderkey) AS INT) AS pos, o_custkey AS c,
       CASE WHEN o_orderkey % 7 = 0 THEN 'essay' WHEN o_orderkey % 7 = 1 THEN 'mcq' END AS page_type, o_orderkey % 5 = 0 AS utilization_exempt, CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'why' END AS exempt_reason,
       CASE WHEN o_orderkey % 11 > 0 THEN 1 END AS n_blocks, 80 AS page_count FROM {orders}""", "orders")  # fmt: skip
    wanted = p.select("doc", "pos", F.when(F.col("c") % 200 < 150, F.col("page")).otherwise(F.col("pos")).alias("page"))
    return R.page_violations(p.drop("c"), wanted)


@query(
    "content_page_rules",
    """
WITH r AS (SELECT concat('c', o_custkey) AS doc, CAST(row_number() OVER w AS INT) AS pos, CAST(row_number() OVER w * 10 + o_orderkey % 7 AS INT) AS first, CAST(row_number() OVER w * 10 + o_orderkey % 13 AS INT) AS last FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
b AS (SELECT *, max(last) OVER (PARTITION BY doc ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM r)
SELECT 'range_bounds' AS rule_id, 'error' AS severity, concat_ws('/', doc, pos) AS key FROM b WHERE NOT (first >= 1 AND last <= 150)
UNION ALL SELECT 'range_order', 'error', concat_ws('/', doc, pos) FROM b WHERE last < first
UNION ALL SELECT 'range_overlap', 'error', concat_ws('/', doc, pos) FROM b WHERE first <= before
""",
)
def content_page_rules(spark, sf_dir):
    """Ranges of content pages: in bounds, in order, apart."""
    return R.content_page_violations(made(spark, sf_dir, """
SELECT concat('c', o_custkey) AS doc, CAST(row_number() OVER w AS INT) AS pos, CAST(row_number() OVER w * 10 + o_orderkey % 7 AS INT) AS first, CAST(row_number() OVER w * 10 + o_orderkey % 13 AS INT) AS last, 150 AS page_count
FROM {orders} WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)""", "orders"))  # fmt: skip


# --- what belongs to a question ---------------------------------------------------------------------

# Blocks of one page for each order; a question's label number is its place among the page's questions, or off by one in some pages.
_QUESTIONS = """
SELECT doc, page, pos, part, supp, q, CASE part % 6 WHEN 0 THEN 'question' WHEN 1 THEN 'options' WHEN 2 THEN 'figure' WHEN 3 THEN 'answer_lines' WHEN 4 THEN 'paragraph' ELSE 'heading' END AS kind,
       sum(CASE WHEN part % 6 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY page ORDER BY pos) AS turn FROM ({seed}) AS s
"""
_ASKED = """
SELECT doc, page, pos, kind, part, supp, CAST(turn AS INT) AS turn, CASE WHEN kind = 'question' THEN concat('q', turn) END AS question_id, CASE WHEN kind = 'question' THEN concat('Q', turn, '.') END AS label,
       CASE WHEN kind NOT IN ('question', 'heading') THEN CASE supp % 3 WHEN 0 THEN NULL WHEN 1 THEN concat('q', turn) ELSE 'q1' END END AS for_question, concat('p', supp % 2) AS path,
       CASE WHEN kind = 'paragraph' AND supp % 2 = 0 THEN 'section_heading' END AS role FROM ({questions}) AS t
"""
_DUCK_ASKED = _ASKED.format(questions=_QUESTIONS.format(seed=_DUCK))


def _asked(spark, sf_dir):
    return _by_order(spark, sf_dir, _ASKED.format(questions=_QUESTIONS.format(seed=_SEED)))


@query(
    "label_agreement",
    f"""
WITH b AS ({_DUCK_ASKED}), n AS (SELECT doc, page, count(*) AS n FROM b WHERE kind = 'question' GROUP BY doc, page)
SELECT page, page % 4 > 0 AND (page % 4 <> 2 OR n = 1) AS agree FROM n
""",
)
def label_agreement(spark, sf_dir):
    """Pages whose parsed labels are their anchors in order (W10): one anchor too many, the last two swapped, or right."""
    b = _asked(spark, sf_dir)
    asked = b.where("kind = 'question'")
    anchors = asked.select("doc", "page", F.when(F.col("page") % 4 == 2, -F.col("turn")).otherwise(F.col("turn")).cast("double").alias("top"), F.col("turn").alias("number"))
    more = asked.where("page % 4 = 0 AND turn = 1").select("doc", "page", F.lit(999.0).alias("top"), F.lit(999).alias("number"))
    return A.labels_agree(b, anchors.unionByName(more)).select("page", "agree")


@query(
    "answer_line_attach",
    f"""
WITH b AS ({_DUCK_ASKED}), h AS (SELECT doc, page, turn, bool_or(kind = 'answer_lines') AS has FROM b GROUP BY doc, page, turn),
r AS (
  SELECT page, turn, 0 AS late, pos, kind, for_question, NULL AS n FROM b
  UNION ALL SELECT b.page, b.turn, 1, 0, 'answer_lines', b.question_id, b.turn + 2 FROM b JOIN h USING (doc, page, turn) WHERE b.kind = 'question' AND NOT h.has AND b.turn % 2 = 1)
SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY turn, late, pos) AS INT) AS pos, kind, for_question, CAST(n AS INT) AS n_lines FROM r
""",
)
def answer_line_attach(spark, sf_dir):
    """Answer lines after the last block of their question."""
    b = _asked(spark, sf_dir)
    spaces = b.where("kind = 'question' AND turn % 2 = 1").select("doc", "page", F.col("turn").alias("number"), (F.col("turn") + 2).alias("count"))
    return A.attach_answer_lines(b.select("doc", "page", "pos", "kind", "question_id", "label", "for_question"), spaces).select("page", "pos", "kind", "for_question", F.col("count").alias("n_lines"))


@query(
    "attachment_insert",
    f"""
WITH b AS ({_DUCK_ASKED}),
w AS (SELECT doc, page, 'q' || turn AS fq, turn, 'figure' AS kind, 'p' || (page % 2) AS path, 0 AS late FROM b WHERE kind = 'question'
      UNION ALL SELECT doc, page, 'q' || turn, turn, 'answer_canvas', 'c', 1 FROM b WHERE kind = 'question' AND turn = 1),
n AS (SELECT w.* FROM w WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc = w.doc AND b.page = w.page AND b.kind = w.kind AND b.path = w.path AND b.for_question = w.fq)),
o AS (SELECT *, kind = 'question' OR coalesce(for_question = 'q' || turn, false) AS own FROM b WHERE turn > 0),
u AS (SELECT *, count_if(NOT own) OVER x AS broken, count_if(kind IN ('answer_lines', 'answer_canvas')) OVER x AS answers FROM o WINDOW x AS (PARTITION BY doc, page, turn ORDER BY pos)),
e AS (SELECT doc, page, turn, max(pos) AS fin, max(CASE WHEN answers = 0 THEN pos END) AS before FROM u WHERE broken = 0 GROUP BY doc, page, turn),
r AS (SELECT doc, page, pos AS spot, 0 AS late, kind, path, for_question FROM b
      UNION ALL SELECT n.doc, n.page, CASE WHEN n.kind = 'figure' THEN before ELSE fin END, 1 + n.late, n.kind, n.path, n.fq FROM n JOIN e ON e.doc = n.doc AND e.page = n.page AND e.turn = n.turn)
SELECT page, CAST(row_number() OVER (PARTITION BY doc, page ORDER BY spot, late) AS INT) AS pos, kind, path, for_question FROM r
""",
)
def attachment_insert(spark, sf_dir):
    """Figures before, canvases after the room to answer of their question, none of them twice."""
    b = _asked(spark, sf_dir)
    asked = b.where("kind = 'question'").select("doc", "page", "question_id", "turn")
    figures = asked.select("doc", "page", F.lit(0).alias("ordinal"), F.lit("figure").alias("kind"), F.concat(F.lit("p"), (F.col("page") % 2).cast("string")).alias("path"), "question_id")
    canvas = asked.where("turn = 1").select("doc", "page", F.lit(1).alias("ordinal"), F.lit("answer_canvas").alias("kind"), F.lit("c").alias("path"), "question_id")
    out = A.insert_attachments(b.select("doc", "page", "pos", "kind", "question_id", "for_question", "path"), figures.unionByName(canvas))
    return out.select("page", "pos", "kind", "path", "for_question")


@query(
    "question_groups",
    f"""
WITH b AS ({_DUCK_ASKED}),
j AS (SELECT *, turn > 0 AND (kind = 'question' OR (kind IN ('options', 'figure', 'answer_lines') AND (for_question IS NULL OR for_question = 'q' || turn))) AS inside FROM b),
k AS (SELECT *, count_if(NOT inside) OVER (PARTITION BY page, turn ORDER BY pos) > 0 AS alone FROM j)
SELECT page, pos, CAST(count_if(alone OR kind = 'question' OR turn = 0) OVER (PARTITION BY page ORDER BY pos) AS BIGINT) AS grp FROM k
""",
)
def question_groups(spark, sf_dir):
    """Questions with the blocks that follow them."""
    return A.question_groups(_asked(spark, sf_dir)).select("page", "pos", "grp")


@query(
    "keep_transitions",
    f"""
WITH b AS ({_DUCK_ASKED}), l AS (SELECT *, lag(kind) OVER w AS k, lag(role) OVER w AS r, lag(question_id) OVER w AS asked FROM b WINDOW w AS (PARTITION BY page ORDER BY pos))
SELECT page, pos, coalesce(k = 'heading' OR (k = 'paragraph' AND r = 'section_heading') OR (k = 'question' AND kind IN ('paragraph', 'options', 'figure', 'answer_lines') AND (for_question IS NULL OR for_question = asked)), false) AS keep FROM l
""",
)
def keep_transitions(spark, sf_dir):
    """Blocks that stay on the page of the one before."""
    return A.keep_transitions(_asked(spark, sf_dir)).select("page", "pos", "keep")


_PICKED = [14, 3, 19, 98, 7, 3, 99999999]


@query(
    "requested_pages",
    f"""
WITH r AS (SELECT min(pos) AS place, id FROM (VALUES {', '.join(f'({k}, {i})' for k, i in enumerate(_PICKED))}) AS v(pos, id) GROUP BY id)
SELECT CAST(place AS BIGINT) AS place, l_orderkey AS page, l_partkey FROM lineitem JOIN r ON id = l_orderkey
""",
)
def requested_pages(spark, sf_dir):
    """Pages in the order that they are asked for."""
    wanted = spark.createDataFrame([(k, i) for k, i in enumerate(_PICKED)], "pos long, page long")
    return A.select_pages(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), "l_partkey"), wanted).select("place", "page", "l_partkey")


@query(
    "requested_page_errors",
    f"""
WITH v(pos, id) AS (VALUES {', '.join(f'({k}, {i})' for k, i in enumerate(_PICKED))})
SELECT DISTINCT 'missing_page' AS rule_id, 'error' AS severity, CAST(id AS VARCHAR) AS key FROM v WHERE id NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'duplicate_page', 'error', CAST(id AS VARCHAR) FROM v GROUP BY id HAVING count(*) > 1
""",
)
def requested_page_errors(spark, sf_dir):
    wanted = spark.createDataFrame([(k, i) for k, i in enumerate(_PICKED)], "pos long, page long")
    return A.selection_errors(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page")), wanted)


@query(
    "page_results",
    """
WITH m AS (SELECT l_orderkey AS p, arg_max(CASE WHEN l_partkey % 3 = 0 THEN 'mcq' ELSE 'mixed' END, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey)) AS t FROM lineitem WHERE l_orderkey % 5 > 0 GROUP BY 1),
s AS (SELECT o_orderkey AS p, o_totalprice AS u FROM orders WHERE o_orderkey % 3 = 0)
SELECT o_orderkey AS page, coalesce(t, 'other') AS page_type, false AS exempt, u AS source_utilization FROM orders LEFT JOIN m ON m.p = o_orderkey LEFT JOIN s ON s.p = o_orderkey
""",
)
def page_results(spark, sf_dir):
    """Pages with what is known of them, and defaults."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    meta = li.where("l_orderkey % 5 > 0").select(F.col("l_orderkey").alias("source_page"), F.when(F.col("l_partkey") % 3 == 0, "mcq").otherwise("mixed").alias("page_type"), F.lit(False).alias("exempt"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("pos"))
    source = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("source_page"), F.col("o_totalprice").alias("utilization"))
    return A.page_results(o.select(F.col("o_orderkey").alias("page"), F.col("o_orderkey").alias("source_page")), meta, source).select("page", "page_type", "exempt", "source_utilization")


@query(
    "text_overrides",
    "SELECT p_partkey, CASE WHEN p_partkey % 50 = 7 THEN 'changed ' || p_size ELSE p_name END AS name, CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE p_type END AS runs FROM part",
)
def text_overrides(spark, sf_dir):
    """Overridden texts, whose old runs go."""
    p = table(spark, sf_dir, "part")
    changes = p.where("p_partkey % 50 = 7").select("p_partkey", F.concat(F.lit("changed "), F.col("p_size").cast("string")).alias("new"))
    return A.override(p.select("p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("runs")), changes, ["p_partkey"], "name", forget="runs")


@query(
    "insertion_points",
    "SELECT o_custkey AS doc, coalesce(min(CASE WHEN regexp_matches(o_orderpriority, 'URGENT$') THEN o_orderkey END), 181) AS idx FROM orders GROUP BY o_custkey",
)
def insertion_points(spark, sf_dir):
    """Where a chapter goes in, with a fallback."""
    return A.insertion_point(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("idx"), F.col("o_orderpriority").alias("text")), "URGENT$", 181)


# --- chapters -----------------------------------------------------------------------------------------

# Paragraphs of a customer's book: one for each order.
_PARAGRAPHS = """
SELECT concat('c', o_custkey) AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS idx, o_orderkey AS k,
       CASE o_orderkey % 8 WHEN 0 THEN concat('Chapter ', o_custkey) WHEN 1 THEN 'Section B' WHEN 2 THEN '(a) first' WHEN 3 THEN '(b) second' WHEN 4 THEN 'Theory, 12 lines' WHEN 5 THEN 'numerical problems' WHEN 6 THEN 'MCQ part' ELSE 'plain text' END AS text,
       o_orderkey % 8 IN (0, 1, 4, 5, 6) AS is_heading, o_orderkey % 8 IN (2, 7) AS is_item, CASE WHEN o_orderkey % 3 = 0 THEN 'table' ELSE 'paragraph' END AS kind
FROM {orders}
"""
_BOOK = _PARAGRAPHS.format(orders="orders")


def _paragraphs(spark, sf_dir):
    return made(spark, sf_dir, _PARAGRAPHS, "orders")


@query(
    "chapter_range_rows",
    f"""
WITH p AS ({_BOOK}), s AS (SELECT doc, min(idx) AS first FROM p WHERE text LIKE 'Chapter%' GROUP BY doc),
e AS (SELECT p.doc, min(idx) - 1 AS fin FROM p JOIN s USING (doc) WHERE idx > first AND text = 'Section B' GROUP BY p.doc), m AS (SELECT doc, max(idx) AS fin FROM p GROUP BY doc)
SELECT s.doc, first, coalesce(e.fin, m.fin) AS last FROM s JOIN m USING (doc) LEFT JOIN e USING (doc)
""",
)
def chapter_range_rows(spark, sf_dir):
    """From a chapter's start to before the next section."""
    return H.chapter_range(_paragraphs(spark, sf_dir), "^Chapter", "^Section B$")


@query(
    "chapter_member_rows",
    f"""
WITH p AS ({_BOOK}), s AS (SELECT doc, min(idx) AS first FROM p WHERE text LIKE 'Chapter%' GROUP BY doc),
e AS (SELECT p.doc, min(idx) - 1 AS fin FROM p JOIN s USING (doc) WHERE idx > first AND text = 'Section B' GROUP BY p.doc),
a AS (SELECT doc, idx, kind, last_value(CASE WHEN kind = 'paragraph' THEN idx END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY idx) AS spot FROM p)
SELECT a.doc, a.idx, a.kind FROM a JOIN s USING (doc) LEFT JOIN e USING (doc) WHERE spot BETWEEN first AND coalesce(fin, 1000000)
""",
)
def chapter_member_rows(spark, sf_dir):
    """Paragraphs and tables of a chapter."""
    p = _paragraphs(spark, sf_dir)
    return H.chapter_members(p.select("doc", "idx", "kind"), H.chapter_range(p, "^Chapter", "^Section B$")).select("doc", "idx", "kind")


_UNIFY = [("^Chapter", "CHAPTER", None), ("part$", "Multiple choice", "^num"), ("[aeiou]r", "vowel r", None)]


@query(
    "unified_headings",
    f"""
WITH p AS ({_BOOK})
SELECT doc, idx, CASE WHEN NOT is_heading THEN text WHEN regexp_matches(text, '[aeiou]r') THEN 'vowel r' WHEN regexp_matches(text, 'part$') THEN 'Multiple choice' WHEN regexp_matches(text, '^num') THEN '' WHEN regexp_matches(text, '^Chapter') THEN 'CHAPTER' ELSE text END AS text FROM p
""",
)
def unified_headings(spark, sf_dir):
    """Headings by the last rule that matches."""
    return H.unify_headings(_paragraphs(spark, sf_dir), _UNIFY).select("doc", "idx", "text")


@query(
    "line_directives",
    f"""
WITH p AS ({_BOOK}), d AS (SELECT *, CASE WHEN is_heading THEN CASE text WHEN 'Theory, 12 lines' THEN 12 WHEN 'numerical problems' THEN 10 ELSE 0 END END AS n, CASE WHEN is_heading THEN text = 'MCQ part' END AS m FROM p)
SELECT doc, idx, CAST(last_value(n IGNORE NULLS) OVER w AS INT) AS lines, last_value(m IGNORE NULLS) OVER w AS is_mcq, lead(text) OVER (PARTITION BY doc ORDER BY idx) AS next_text FROM d WINDOW w AS (PARTITION BY doc ORDER BY idx)
""",
)
def line_directives(spark, sf_dir):
    """Answer lines that the heading above asks for, and the line that follows."""
    return H.with_directives(_paragraphs(spark, sf_dir)).select("doc", "idx", "directive.lines", "directive.is_mcq", "next_text")


@query(
    "option_runs",
    f"""
WITH p AS ({_BOOK}), o AS (SELECT *, starts_with(text, '(') AS opt FROM p), s AS (SELECT *, opt AND NOT coalesce(lag(opt) OVER w, false) AS starts FROM o WINDOW w AS (PARTITION BY doc ORDER BY idx)),
r AS (SELECT *, count_if(starts) OVER (PARTITION BY doc ORDER BY idx) AS run FROM s), n AS (SELECT *, row_number() OVER (PARTITION BY doc, run ORDER BY idx) AS place FROM r WHERE opt)
SELECT doc, CAST(run AS BIGINT) AS run, CAST(place AS INT) AS k, text FROM n WHERE place <= 4
""",
)
def option_runs(spark, sf_dir):
    """Runs of option lines, four of each at most."""
    return H.option_runs(_paragraphs(spark, sf_dir))


@query(
    "section_numbers",
    f"""
WITH p AS ({_BOOK}), s AS (SELECT *, count_if(text = 'Section B') OVER (PARTITION BY doc ORDER BY idx) AS part FROM p)
SELECT doc, idx, CAST(CASE WHEN is_item THEN count_if(is_item) OVER (PARTITION BY doc, part ORDER BY idx) END AS BIGINT) AS number FROM s
""",
)
def section_numbers(spark, sf_dir):
    """Items counted anew in each section."""
    return H.section_counter(_paragraphs(spark, sf_dir), "^Section B$").select("doc", "idx", "number")


@query(
    "contents_entries",
    f"""
WITH p AS ({_BOOK}) SELECT doc, CAST(row_number() OVER (PARTITION BY doc ORDER BY idx) AS INT) AS entry, 'ch_' || row_number() OVER (PARTITION BY doc ORDER BY idx) AS anchor, text
FROM p WHERE regexp_matches(text, '^(Chapter|Theory|num)') AND NOT regexp_matches(text, 'lines') AND k % 5 > 0
""",
)
def contents_entries(spark, sf_dir):
    """Entries of a table of contents."""
    p = _paragraphs(spark, sf_dir).withColumn("is_link", F.col("k") % 5 == 0)
    return H.contents(p, "^(Chapter|Theory|num)", "lines").select("doc", "entry", "anchor", "text")


@query(
    "carried_page_types",
    f"""
WITH s AS ({_DUCK}), b AS (
  SELECT doc, page, pos, CASE part % 8 WHEN 0 THEN 'short_answer' WHEN 1 THEN 'long_answer' END AS named, part % 8 = 2 AS unit, CASE WHEN part % 8 < 3 THEN 'heading' WHEN part % 8 = 3 THEN 'options' ELSE 'paragraph' END AS kind FROM s),
g AS (SELECT *, unit OR page - coalesce(lag(page) OVER w, page) > 1 AS forget FROM b WINDOW w AS (PARTITION BY doc ORDER BY page, pos)),
c AS (SELECT *, nullif(last_value(coalesce(named, CASE WHEN forget THEN '-' END) IGNORE NULLS) OVER (PARTITION BY doc ORDER BY page, pos), '-') AS carried FROM g),
t AS (SELECT DISTINCT doc, page, CASE WHEN kind = 'heading' THEN named ELSE coalesce(carried, CASE WHEN kind = 'options' THEN 'mcq' END) END AS t FROM c),
n AS (SELECT doc, page, CASE WHEN count(t) > 1 THEN 'mixed' ELSE min(t) END AS seen FROM t GROUP BY doc, page)
SELECT doc, page, coalesce(seen, 'other') AS page_type FROM n
""",
)
def carried_page_types(spark, sf_dir):
    """Types of pages carried on from their headings."""
    k = F.col("part") % 8
    s = _seed(spark, sf_dir)
    text = _case(k, "SHORT ANSWER QUESTION", "long answer question", "UNIT 1")
    blocks = s.select("doc", "page", "pos", F.when(k < 3, "heading").when(k == 3, "options").otherwise("paragraph").alias("kind"), _case(k, "question_type_heading", "question_type_heading", "unit_heading").alias("role"), text.alias("text"))
    return H.carry_page_types(blocks, s.select("doc", "page", F.lit("other").alias("page_type")).distinct())


@query(
    "missing_fonts",
    """
WITH r AS (SELECT DISTINCT p_name AS font FROM part UNION SELECT 'Arial'), i AS (SELECT DISTINCT lower(split_part(p_name, ' ', 1)) AS h FROM part WHERE p_size < 9)
SELECT font FROM r WHERE lower(font) <> 'arial' AND NOT EXISTS (SELECT 1 FROM i WHERE h = lower(font) OR (length(h) > 4 AND (contains(h, lower(font)) OR contains(lower(font), h))))
""",
)
def missing_fonts(spark, sf_dir):
    """Fonts that no installed one is like."""
    p = table(spark, sf_dir, "part")
    required = p.select(F.col("p_name").alias("font")).distinct().union(spark.createDataFrame([("Arial",)], "font string"))
    return H.missing_fonts(required, p.where("p_size < 9").select(F.split_part("p_name", F.lit(" "), F.lit(1)).alias("font")))


# --- merges of packages ---------------------------------------------------------------------------------


@query(
    "style_merge",
    """
WITH s AS (SELECT concat('d', p_size) AS doc, replace(p_name, ' ', '-') || (p_partkey % 3) AS id, min(p_partkey) AS own FROM part GROUP BY 1, 2),
d AS (SELECT doc, id, CASE WHEN own % 2 = 0 THEN own ELSE own + 1 END AS there FROM s WHERE own % 5 < 3 UNION ALL SELECT doc, 'src_' || replace(id, '-', '_'), 0 FROM s WHERE own % 7 = 0),
j AS (SELECT s.*, there, there IS NOT NULL AND there <> own AS differs FROM s LEFT JOIN d USING (doc, id))
SELECT doc, id, CASE WHEN NOT differs THEN id WHEN own % 7 = 0 THEN 'src_' || replace(id, '-', '_') || '_2' ELSE 'src_' || replace(id, '-', '_') END AS new_id, differs OR there IS NULL AS copied FROM j
""",
)
def style_merge(spark, sf_dir):
    """Styles of many packages brought into theirs."""
    p = table(spark, sf_dir, "part")
    name = F.concat(F.replace("p_name", F.lit(" "), F.lit("-")), (F.col("p_partkey") % 3).cast("string"))
    s = p.groupBy(F.concat(F.lit("d"), F.col("p_size").cast("string")).alias("doc"), name.alias("id")).agg(F.min("p_partkey").alias("digest"))
    own = F.col("digest")
    held = s.where(own % 5 < 3).select("doc", "id", F.when(own % 2 == 0, own).otherwise(own + 1).alias("digest"))
    more = s.where(own % 7 == 0).select("doc", F.concat(F.lit("src_"), F.replace("id", F.lit("-"), F.lit("_"))).alias("id"), F.lit(0).cast("long").alias("digest"))
    return M.style_merge(s.select("doc", "id"), s, held.unionByName(more))


@query(
    "part_names",
    """
WITH p AS (SELECT concat('d', o_custkey) AS doc, 'word/media/i' || (o_orderkey % 4) || '.png' AS part, max(o_orderkey) AS digest FROM orders GROUP BY 1, 2),
d AS (SELECT doc, part, CASE WHEN digest % 3 = 0 THEN digest ELSE -1 END AS there FROM p WHERE digest % 5 > 0 UNION ALL SELECT doc, replace(part, '.png', '_src1.png'), -2 FROM p WHERE digest % 2 = 0)
SELECT doc, part, CASE WHEN there IS NULL OR there = digest THEN part WHEN digest % 2 = 0 THEN replace(part, '.png', '_src2.png') ELSE replace(part, '.png', '_src1.png') END AS new_part, there IS NULL OR there <> digest AS copied
FROM p LEFT JOIN d USING (doc, part)
""",
)
def part_names(spark, sf_dir):
    """Parts that are there alike, renamed or new."""
    o = table(spark, sf_dir, "orders")
    part = F.concat(F.lit("word/media/i"), (F.col("o_orderkey") % 4).cast("string"), F.lit(".png"))
    p = o.groupBy(F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("doc"), part.alias("part")).agg(F.max("o_orderkey").alias("digest"))
    d = F.col("digest")
    there = p.where(d % 5 > 0).select("doc", "part", F.when(d % 3 == 0, d).otherwise(F.lit(-1)).alias("digest"))
    more = p.where(d % 2 == 0).select("doc", F.replace("part", F.lit(".png"), F.lit("_src1.png")).alias("part"), F.lit(-2).cast("long").alias("digest"))
    return M.part_names(p, there.unionByName(more))


@query(
    "relationship_ids",
    """
WITH r AS (SELECT DISTINCT concat('d', o_custkey) AS doc, 'rId' || lpad(CAST(o_orderkey % 50 AS VARCHAR), 2, '0') AS id FROM orders WHERE o_orderkey % 3 > 0),
t AS (SELECT doc, id FROM r WHERE id >= 'rId10'), n AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY id) AS k FROM t)
SELECT doc, id, 'rIdSrc' || CASE WHEN k = 1 THEN 1 ELSE k + 1 END AS new_id, 'image' AS type, 'media/' || id AS target, 'Internal' AS mode FROM n
""",
)
def relationship_ids(spark, sf_dir):
    """Free ids for the relationships that a body refers to, where one is taken."""
    o = table(spark, sf_dir, "orders")
    doc = F.concat(F.lit("d"), F.col("o_custkey").cast("string"))
    used = o.where("o_orderkey % 3 > 0").select(doc.alias("doc"), F.concat(F.lit("rId"), F.lpad((F.col("o_orderkey") % 50).cast("string"), 2, "0")).alias("id"))
    rels = used.distinct().where("id >= 'rId10'").select("doc", "id", F.lit("image").alias("type"), F.concat(F.lit("media/"), "id").alias("target"), F.lit("Internal").alias("mode"))
    return M.relationship_ids(used, rels, used.select("doc").distinct().select("doc", F.lit("rIdSrc2").alias("id")))


@query(
    "font_merge",
    """
WITH s AS (SELECT concat('d', p_size) AS doc, p_name AS name, min(p_partkey) AS k FROM part GROUP BY 1, 2)
SELECT doc, name, CASE WHEN k % 4 > 0 AND k % 3 > 0 THEN 'new ' || k ELSE 'old ' || k END AS definition, CASE WHEN k % 5 > 0 THEN CASE WHEN k % 4 > 0 AND k % 3 > 0 THEN 'replaced' ELSE 'kept' END ELSE 'added' END AS action
FROM s WHERE k % 5 > 0 OR (k % 4 > 0 AND k % 3 > 0)
""",
)
def font_merge(spark, sf_dir):
    """Font tables with the required fonts put in."""
    s = table(spark, sf_dir, "part").groupBy(F.concat(F.lit("d"), F.col("p_size").cast("string")).alias("doc"), F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("k"))
    k = F.col("k")
    as_ = lambda df, word: df.select("doc", "name", F.concat(F.lit(word), k.cast("string")).alias("definition"))
    required = s.where(k % 4 > 0).select("doc", "name").unionByName(s.select("doc", F.concat(F.lit("+"), "name").alias("name")))
    return M.font_merge(required, as_(s.where(k % 3 > 0), "new "), as_(s.where(k % 5 > 0), "old "))


@query(
    "content_types",
    """
WITH p AS (SELECT DISTINCT concat('d', o_custkey) AS doc, o_orderkey % 6 AS e FROM orders), n AS (SELECT DISTINCT doc FROM p)
SELECT doc, 'override' AS kind, '/new/x' || e || '.PNG' AS key, 'type' || e AS type FROM p WHERE e % 2 = 0 AND e <> 4 UNION ALL SELECT doc, 'default', 'png', 'image/png' FROM n
""",
)
def content_types(spark, sf_dir):
    """Content types that copied parts still need."""
    p = table(spark, sf_dir, "orders").select(F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("doc"), (F.col("o_orderkey") % 6).cast("string").alias("e")).distinct()
    name = lambda top: F.concat(F.lit(f"/{top}/x"), "e", F.lit(".PNG"))
    over = p.where("e % 2 = 0").select("doc", F.lit("override").alias("kind"), name("old").alias("key"), F.concat(F.lit("type"), "e").alias("type"))
    source = over.unionByName(p.select("doc").distinct().select("doc", F.lit("default").alias("kind"), F.lit("Png").alias("key"), F.lit("image/png").alias("type")))
    there = p.where("e = 4").select("doc", F.lit("override").alias("kind"), name("new").alias("key"))
    return M.content_types(p.select("doc", name("old").alias("part"), name("new").alias("new_part")), source, there)


@query(
    "regression_differences",
    """
WITH t AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n, l_partkey AS k FROM lineitem)
SELECT DISTINCT 'tokens' AS rule_id, 'error' AS severity, CAST(doc AS VARCHAR) AS key FROM t WHERE k % 40 = 0
UNION ALL SELECT 'counts', 'error', doc || '/lines' FROM (SELECT doc, count(*) AS e, count_if(k % 60 > 0) AS a FROM t GROUP BY doc) WHERE e <> a
UNION ALL SELECT 'recurring_part', 'error', concat_ws('/', o_orderkey, 'word/header1.xml') FROM orders WHERE o_orderkey % 30 IN (0, 1)
""",
)
def regression_differences(spark, sf_dir):
    """A candidate against what was approved: tokens, counts, headers and footers."""
    t = made(spark, sf_dir, "SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n, l_partkey AS token FROM {lineitem}", "lineitem")
    k = F.col("token")
    count = lambda df: df.groupBy("doc").agg(F.count("*").alias("n")).select("doc", F.lit("lines").alias("feature"), "n")
    counted = t.groupBy("doc").agg(F.count_if(k % 60 > 0).alias("n")).select("doc", F.lit("lines").alias("feature"), "n")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.explode(F.array(F.lit("word/header1.xml"), F.lit("word/document.xml"))).alias("part"), F.col("o_orderkey").alias("digest"))
    changed = o.where("doc % 30 <> 1").withColumn("digest", F.when(F.col("doc") % 30 == 0, -1).otherwise(F.col("digest")))
    return M.regression((t, t.withColumn("token", F.when(k % 40 == 0, -1).otherwise(k))), (count(t), counted), (o, changed))


@query(
    "render_gate",
    """
SELECT 'renderer' AS rule_id, 'error' AS severity, 'd' || o_orderkey AS key FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0
UNION ALL SELECT 'passed', 'error', 'd' || o_orderkey FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'document_hash', 'error', 'd' || o_orderkey FROM orders WHERE o_orderkey % 13 = 0
UNION ALL SELECT 'pdf_hash', 'error', 'd' || o_orderkey FROM orders WHERE o_orderkey % 17 = 0
""",
)
def render_gate(spark, sf_dir):
    """Renders that aren't authoritative, failed, or of other files (Q11)."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    doc, pdf = F.concat(F.lit("d"), k.cast("string")), F.concat(F.lit("p"), k.cast("string"))
    m = o.select(
        doc.alias("doc"), F.when(k % 7 == 0, "other").otherwise("microsoft_word").alias("renderer"), (k % 11 > 0).alias("authoritative"), (F.col("o_orderstatus") != "P").alias("passed"),
        F.when(k % 13 == 0, F.lit(None)).otherwise(k.cast("string")).alias("document_sha256"), pdf.alias("render_pdf"), k.cast("string").alias("render_pdf_sha256"),
    )
    files = o.select(doc.alias("path"), k.cast("string").alias("sha256")).union(o.where("o_orderkey % 17 > 0").select(pdf, k.cast("string")))
    return M.render_manifest_violations(m, files)


@query(
    "visual_review_gate",
    """
SELECT 'passed' AS rule_id, 'error' AS severity, 'd' || o_orderkey || '/final' AS key FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'hash_bound', 'error', 'd' || o_orderkey || '/final' FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT 'document_hash', 'error', 'd' || o_orderkey || '/final' FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 19 = 0
UNION ALL SELECT 'pdf_hash', 'error', 'd' || o_orderkey || '/final' FROM orders WHERE o_orderkey % 19 = 0
UNION ALL SELECT 'page_count', 'error', 'd' || o_orderkey || '/final' FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 19 = 0
""",
)
def visual_review_gate(spark, sf_dir):
    """Reviews that have not passed or tell of another render (Q10)."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    base = [F.concat(F.lit("d"), k.cast("string")).alias("doc"), F.lit("final").alias("stage")]
    text = k.cast("string")
    r = o.select(*base, (F.col("o_orderstatus") != "P").alias("passed"), (k % 7 > 0).alias("hash_bound"), F.when(k % 11 > 0, text).alias("document_sha256"), text.alias("render_pdf_sha256"), (k % 13).alias("page_count"))
    m = o.where("o_orderkey % 19 > 0").select(*base, text.alias("document_sha256"), text.alias("render_pdf_sha256"), F.when(k % 13 == 0, 1).otherwise(k % 13).alias("page_count"))
    return M.review_violations(r, m)


@query(
    "broken_relationships",
    """
WITH r AS (SELECT o_custkey AS path, o_orderkey AS id, o_orderkey % 9 AS t, CASE WHEN o_orderkey % 4 = 0 THEN 'External' WHEN o_orderkey % 4 = 1 THEN 'Internal' END AS mode FROM orders)
SELECT path, id FROM r WHERE mode IS DISTINCT FROM 'External' AND (t = 8 OR path % 10 = t)
""",
)
def broken_relationships(spark, sf_dir):
    """Relationships whose part isn't there."""
    o = table(spark, sf_dir, "orders")
    r = o.select(F.col("o_custkey").alias("path"), F.lit("word/document.xml").alias("owner"), F.col("o_orderkey").alias("id"), F.concat(F.lit("../word/m"), (F.col("o_orderkey") % 9).cast("string")).alias("target"), F.when(F.col("o_orderkey") % 4 == 0, "External").when(F.col("o_orderkey") % 4 == 1, "Internal").alias("mode"))
    parts = o.select(F.col("o_custkey").alias("path")).distinct().select("path", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("m")).where("path % 10 <> m")
    return K.broken_relationships(r, parts.select("path", F.concat(F.lit("word/m"), F.col("m").cast("string")).alias("part"))).select("path", "id")


# --- layout ---------------------------------------------------------------------------------------------

# Boxes of a page for each order, in points of A4.
_BOXES = """
SELECT CAST(l_orderkey AS INT) AS page, CASE l_partkey % 4 WHEN 0 THEN 'word' WHEN 1 THEN 'rect' WHEN 2 THEN 'line' ELSE 'image' END AS kind,
       CAST(l_suppkey % 400 AS DOUBLE) AS x0, CAST(l_suppkey % 400 + l_quantity * 11 AS DOUBLE) AS x1, CAST(l_partkey % 820 AS DOUBLE) AS top,
       CAST(l_partkey % 820 + CASE WHEN l_partkey % 4 = 2 THEN 1 ELSE l_quantity END AS DOUBLE) AS bottom, 'P1' AS color, CASE WHEN l_partkey % 3 = 0 THEN CAST(l_suppkey AS STRING) ELSE 'word' END AS text
FROM {lineitem}
"""
_BOX = _BOXES.format(lineitem="lineitem")
_PT = 72 / 25.4
_KEPT = f"""
b AS ({_BOX}),
kept AS (
  SELECT page, top, bottom FROM b WHERE kind = 'word' AND bottom < {276.0 * _PT!r} AND NOT (top > {270.0 * _PT!r} AND regexp_full_match(text, '\\d+'))
  UNION ALL SELECT page, top, bottom FROM b WHERE kind <> 'word' AND x1 - x0 < {595.0 * 0.9!r} AND bottom - top < {842.0 * 0.9!r} AND (x0 + x1) / 2 BETWEEN {51.0 + 4.0 * _PT!r} AND {545.0 - 4.0 * _PT!r} AND bottom >= {26.0 * _PT!r} AND top <= {276.0 * _PT!r}),
rules AS (SELECT page, min(x0) AS a, max(x1) AS z, max((top + bottom) / 2) AS y FROM b WHERE kind IN ('line', 'rect') AND bottom - top <= {1.5 * _PT!r} AND (top + bottom) / 2 BETWEEN {55.0 * _PT!r} AND {267.0 * _PT!r} GROUP BY page, round_even((top + bottom) / 2 / 1.5, 0)),
ext AS (SELECT page, max(y) AS y FROM rules WHERE z - a >= {150.0 * _PT!r} AND abs(a - 51) <= {6.0 * _PT!r} AND abs(z - 545) <= {6.0 * _PT!r} GROUP BY page)
"""


def _frames(boxes):
    return boxes.select("page").distinct().select("page", F.lit(595.0).alias("width"), F.lit(842.0).alias("height"), F.lit(51.0).alias("left"), F.lit(545.0).alias("right"))


@query(
    "page_content",
    f"""
WITH {_KEPT},
e AS (SELECT page, min(top) AS top, max(bottom) AS low FROM kept GROUP BY page), p AS (SELECT DISTINCT page FROM b)
SELECT page, top, greatest(low, y) AS bottom, CASE WHEN greatest(low, y) IS NULL THEN 0 ELSE round(100 * greatest(0, least({267.0 * _PT!r}, greatest(low, y)) - {28.0 * _PT!r}) / {239.0 * _PT!r}, 6) END AS utilization
FROM p LEFT JOIN e USING (page) LEFT JOIN ext USING (page)
""",
)
def page_content(spark, sf_dir):
    """Extent and utilization of pages: words, boxes and ruled lines that are content."""
    boxes = _by_order(spark, sf_dir, _BOXES)
    return L.page_content(boxes, _frames(boxes)).withColumn("utilization", F.round("utilization", 6))


@query(
    "source_measurements",
    f"""
WITH b AS ({_BOX}), s AS (SELECT * FROM b WHERE page % 3 = 0),
kept AS (
  SELECT page, top, bottom FROM s WHERE kind = 'word' AND bottom < {276.0 * _PT!r} AND NOT (top > {270.0 * _PT!r} AND regexp_full_match(text, '\\d+')) AND x1 > {18 * _PT!r} AND x0 < {595.0 - 18 * _PT!r}
  UNION ALL SELECT page, top, bottom FROM s WHERE kind <> 'word' AND x1 - x0 < {595.0 * 0.9!r} AND bottom - top < {842.0 * 0.9!r} AND (x0 + x1) / 2 BETWEEN {18 * _PT + 4.0 * _PT!r} AND {595.0 - 18 * _PT - 4.0 * _PT!r} AND bottom >= {26.0 * _PT!r} AND top <= {276.0 * _PT!r})
SELECT page, min(top) AS top FROM kept GROUP BY page UNION ALL SELECT DISTINCT page, NULL FROM s WHERE page NOT IN (SELECT page FROM kept)
""",
)
def source_measurements(spark, sf_dir):
    """Where the content of selected source pages begins (Q3)."""
    boxes = _by_order(spark, sf_dir, _BOXES)
    pages = _frames(boxes)
    return L.source_measurements(boxes, pages, pages.where("page % 3 = 0"))[0].select("page", "top")


@query(
    "answer_targets",
    f"""
WITH s AS ({_DUCK}), b AS (SELECT page, bool_or(part % 5 = 0) AS canvas, bool_or(part % 5 = 1) AS lines, max(CASE WHEN part % 5 = 1 AND supp % 3 = 0 AND q > 10 THEN q * 20.0 END) AS deep FROM s GROUP BY page)
SELECT page, canvas AS has_canvas, lines AS requires_lines,
       round(CASE WHEN lines THEN CASE WHEN page % 4 = 0 THEN {267.0 * _PT - 27.0!r} WHEN deep IS NOT NULL THEN least(deep, {260.0 * _PT!r}) WHEN page % 3 > 0 THEN least(page % 1000, {260.0 * _PT!r}) END END, 6) AS target FROM b
""",
)
def answer_targets(spark, sf_dir):
    """How low answers must reach on a page (Q4)."""
    s = _seed(spark, sf_dir)
    k, q = F.col("part") % 5, F.col("q")
    box = F.when(F.col("supp") % 3 == 0, F.array(F.lit(0.0), F.lit(200.0), F.lit(9.0), q * 20.0))
    blocks = s.select("page", _case(k, "answer_canvas", "answer_lines", "question", "question", "question").alias("kind"), box.alias("bbox"))
    pages = s.select("page").distinct().select("page", F.when(F.col("page") % 4 == 0, "short_answer").otherwise("mcq").alias("page_type"), F.when(F.col("page") % 3 > 0, (F.col("page") % 1000).cast("double")).alias("source_bottom"))
    return L.answer_space(blocks, pages).withColumn("target", F.round("target", 6))


@query(
    "rule_groups",
    """
WITH r AS (SELECT o_custkey AS page, o_orderkey % 300 AS x0, o_orderkey % 300 + 120 AS x1, CAST(o_orderkey % 40 AS DOUBLE) AS top FROM orders),
g AS (SELECT page, round_even((top + top + 1) / 2 / 1.5, 0) AS step, min(x0) AS x0, max(x1) AS x1, max(top + 1) AS y FROM r GROUP BY 1, 2)
SELECT page, CAST(x0 AS DOUBLE) AS x0, CAST(x1 AS DOUBLE) AS x1, y FROM g WHERE x1 - x0 > 240
""",
)
def rule_groups(spark, sf_dir):
    """Rules of one height as one."""
    k = F.col("o_orderkey")
    r = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), (k % 300).cast("double").alias("x0"), (k % 300 + 120).cast("double").alias("x1"), (k % 40).cast("double").alias("top"), (k % 40 + 1).cast("double").alias("bottom"))
    return L.rule_groups(r).select("page", "x0", "x1", "y")


@query(
    "attached_rectangles",
    """
WITH b AS (SELECT o_custkey AS page, o_orderkey AS k, CAST(o_orderkey % 700 AS DOUBLE) AS top, o_orderkey % 3 = 0 AS word FROM orders),
a AS (SELECT page, top, min(k % 40) AS number FROM b WHERE word GROUP BY page, top),
r AS (SELECT page, top, CASE k % 4 WHEN 0 THEN 85.5 WHEN 1 THEN 100.0 ELSE 114.0 END AS h FROM b WHERE NOT word),
j AS (SELECT r.*, a.number FROM r ASOF LEFT JOIN a ON r.page = a.page AND r.top > a.top),
f AS (SELECT *, CASE WHEN round_even(h / 28.5, 0) > 0 AND abs(h - round_even(h / 28.5, 0) * 28.5) <= 2.25 THEN round_even(h / 28.5, 0) END AS n FROM j)
SELECT page, CAST(number AS INT) AS number, top, CAST(n AS INT) AS n_lines, CASE WHEN number IS NULL THEN 'no_question' WHEN n IS NULL THEN 'off_pitch' WHEN count(n) OVER (PARTITION BY page, number) > 1 THEN 'several_rectangles' END AS review FROM f
""",
)
def attached_rectangles(spark, sf_dir):
    """Answer rectangles with the question above them."""
    k, word = F.col("o_orderkey"), F.col("o_orderkey") % 3 == 0
    top = (k % 700).cast("double")
    height = F.when(k % 4 == 0, 85.5).when(k % 4 == 1, 100.0).otherwise(114.0)
    boxes = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("page"), F.when(word, "word").otherwise("rect").alias("kind"), F.lit(52.0).alias("x0"), F.lit(540.0).alias("x1"), top.alias("top"),
        F.when(word, top + 9).otherwise(top + height).alias("bottom"), F.lit("P3").alias("color"), F.when(word, F.concat(F.lit("Q"), (k % 40).cast("string"), F.lit("."))).alias("text"),
    )
    return L.attach_rectangles(boxes).select("page", "number", "top", F.col("count").alias("n_lines"), "review")


@query(
    "option_table_rules",
    """
WITH t AS (SELECT o_orderkey AS tbl FROM orders)
SELECT 'fixed_layout' AS rule_id, 'error' AS severity, CAST(tbl AS VARCHAR) AS key FROM t WHERE tbl % 5 = 0
UNION ALL SELECT 'width_type', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 7 = 0
UNION ALL SELECT 'indent', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 11 = 0
UNION ALL SELECT 'grid_sum', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 13 = 0
UNION ALL SELECT 'cant_split', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 17 = 0
UNION ALL SELECT 'labels', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 19 = 0
UNION ALL SELECT 'cell_width', 'error', CAST(tbl AS VARCHAR) FROM t WHERE tbl % 13 = 0
""",
)
def option_table_rules(spark, sf_dir):
    """Geometry and letters of option tables."""
    t = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tbl"))
    k = F.col("tbl")
    tables = t.select("tbl", F.lit(1000).alias("width"), F.when(k % 7 == 0, "auto").otherwise("dxa").alias("width_type"), F.when(k % 5 > 0, "fixed").alias("layout"), F.when(k % 11 > 0, 0).alias("indent"))
    cols = t.select("tbl", F.explode(F.array(F.lit(0), F.lit(1))).alias("col"))
    grid = cols.select("tbl", "col", F.when((k % 13 == 0) & (F.col("col") == 1), 400).otherwise(500).alias("w"))
    cells = cols.select("tbl", "col", F.explode(F.array(F.lit(0), F.lit(1))).alias("row"))
    letter = F.element_at(F.array(*map(F.lit, "ABCD")), F.col("row") * 2 + F.col("col") + 1)
    letter = F.when((k % 19 == 0) & (letter == "D"), "C").otherwise(letter)
    cells = cells.select("tbl", "row", "col", F.lit(500).alias("w"), F.concat(F.lit("("), letter, F.lit(") text")).alias("text"))
    rows = t.select("tbl", F.lit(0).alias("row"), (k % 17 > 0).alias("cant_split"))
    return P.option_tables(tables, grid, cells, rows)


@query(
    "bookmark_rules",
    """
WITH b AS (SELECT o_custkey AS doc, o_orderkey AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos FROM orders)
SELECT 'bookmarks' AS rule_id, 'error' AS severity, CAST(doc AS VARCHAR) AS key FROM b GROUP BY doc HAVING bool_or(n % 50 = 0)
UNION ALL SELECT 'a4', 'error', concat_ws('/', doc, pos) FROM b WHERE n % 9 = 0
""",
)
def bookmark_rules(spark, sf_dir):
    """Bookmarks in order and sections of A4."""
    b = made(spark, sf_dir, "SELECT o_custkey AS doc, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_orderkey AS number FROM {orders}", "orders")
    found = b.withColumn("number", F.when(F.col("number") % 50 == 0, -1).otherwise(F.col("number")))
    sections = b.select("doc", F.col("pos").alias("n"), F.when(F.col("number") % 9 == 0, 211.0).otherwise(210.4).alias("width_mm"), F.lit(297.0).alias("height_mm"))
    return P.bookmark_sequence(found, b).unionByName(P.sections(sections))


# --- markup ---------------------------------------------------------------------------------------------

# A small document for each order, an element for each line.
_XML = """
SELECT l_orderkey AS path, l_partkey AS part, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n, l_suppkey AS supp,
       CASE l_partkey % 7 WHEN 0 THEN concat('<w:p><w:pPr><w:pStyle w:val="S', l_suppkey % 3, '"/></w:pPr><w:r><w:t>a', l_suppkey, '</w:t></w:r></w:p>') WHEN 1 THEN '<w:p><w:r><w:tab/><w:t>b</w:t></w:r></w:p>'
         WHEN 2 THEN '<w:tbl><w:tr><w:tc><w:p><w:r><w:t>c</w:t></w:r></w:p></w:tc></w:tr></w:tbl>' WHEN 3 THEN '<w:p><w:r><w:br w:type="page"/></w:r></w:p>' WHEN 4 THEN '<w:p><w:r><w:br/><w:cr/></w:r></w:p>'
         WHEN 5 THEN '<w:p><w:ins><w:r><w:rPr><w:rFonts w:ascii="F1" w:cs="+theme"/><w:sz w:val="23"/></w:rPr><w:lastRenderedPageBreak/></w:r></w:ins></w:p>' ELSE '<w:sectPr/>' END AS xml
FROM {lineitem}
"""
_XML_DUCK = _XML.format(lineitem="lineitem")


def _xml_parts(spark, sf_dir):
    rows = _by_order(spark, sf_dir, _XML)
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "xml"))), lambda s: s["xml"]), "")
    docs = rows.groupBy("path").agg(body.alias("body"))
    close = F.when(F.col("path") % 10 == 0, "</w:body>").otherwise("</w:body></w:document>")
    return docs.select("path", F.lit("word/document.xml").alias("part"), F.concat(F.lit('<w:document xmlns:w="urn:w"><w:body>'), "body", close).cast("binary").alias("content")).withColumn("path", F.col("path").cast("string"))


@query("malformed_parts", "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS path FROM lineitem WHERE l_orderkey % 10 = 0")
def malformed_parts(spark, sf_dir):
    """Parts that can't be parsed."""
    return X.malformed(X.elements(_xml_parts(spark, sf_dir))).select("path")


@query(
    "visible_tokens",
    f"""
WITH x AS ({_XML_DUCK}), t AS (SELECT path, n, unnest(CASE part % 7 WHEN 0 THEN ['T:a' || supp] WHEN 1 THEN ['TAB', 'T:b'] WHEN 2 THEN ['T:c'] WHEN 3 THEN ['BR:page'] WHEN 4 THEN ['BR:textWrapping', 'CR'] ELSE [] END) AS token, unnest([1, 2]) AS k FROM x WHERE path % 10 > 0)
SELECT CAST(path AS VARCHAR) AS path, sha256(string_agg(token, '|' ORDER BY n, k)) AS tokens_sha256 FROM t WHERE token IS NOT NULL GROUP BY path
""",
)
def visible_tokens(spark, sf_dir):
    """What a reader sees of each document, in order."""
    t = X.visible_tokens(X.elements(_xml_parts(spark, sf_dir)))
    all_ = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "token"))), lambda s: s["token"]), "|")
    return t.groupBy("path").agg(F.sha2(all_, 256).alias("tokens_sha256"))


@query(
    "feature_inventory",
    f"""
WITH x AS ({_XML_DUCK}), k AS (SELECT *, part % 7 AS f FROM x WHERE path % 10 > 0)
SELECT CAST(path AS VARCHAR) AS path, CAST(count_if(f < 6) AS BIGINT) AS paragraphs, CAST(count_if(f < 6) AS BIGINT) AS runs, CAST(count_if(f < 3) AS BIGINT) AS text_nodes, CAST(count_if(f = 2) AS BIGINT) AS tables,
       CAST(count_if(f = 5) AS BIGINT) AS saved_breaks, CAST(count_if(f = 3) AS BIGINT) AS explicit_breaks, CAST(count_if(f = 6) AS BIGINT) AS sections, CAST(sum(CASE f WHEN 0 THEN length('a' || supp) WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END) AS BIGINT) AS visible_characters,
       coalesce(string_agg(DISTINCT CASE WHEN f = 0 THEN 'S' || (supp % 3) END, ',' ORDER BY CASE WHEN f = 0 THEN 'S' || (supp % 3) END), '') AS styles, CASE WHEN bool_or(f = 5) THEN 'F1' ELSE '' END AS fonts,
       CASE WHEN bool_or(f = 5) THEN '11.5' ELSE '' END AS sizes, CASE WHEN bool_or(f = 5) THEN 'tracked_insertions' ELSE '' END AS reviewed, false AS update_fields
FROM k GROUP BY path
""",
)
def feature_inventory(spark, sf_dir):
    """Counts and distinct values of each document's features."""
    i = X.inventory(X.elements(_xml_parts(spark, sf_dir)).where("n IS NOT NULL"))
    joined = lambda c: F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c)
    return i.select("path", "paragraphs", "runs", "text_nodes", "tables", "saved_breaks", "explicit_breaks", "sections", "visible_characters", joined("styles"), joined("fonts"), joined("sizes"), joined("reviewed"), "update_fields")


@query(
    "boundary_inventory",
    f"WITH x AS ({_XML_DUCK}) SELECT CAST(path AS VARCHAR) AS path, CAST(count_if(part % 7 = 5) AS BIGINT) AS saved, CAST(count_if(part % 7 = 3) AS BIGINT) AS explicit, CAST(count_if(part % 7 = 6) AS BIGINT) AS sections FROM x WHERE path % 10 > 0 GROUP BY path",
)
def boundary_inventory(spark, sf_dir):
    """Page breaks of each kind."""
    return X.boundaries(X.elements(_xml_parts(spark, sf_dir)).where("n IS NOT NULL"))


@query("denied_features", f"WITH x AS ({_XML_DUCK}) SELECT DISTINCT 'denied_feature' AS rule_id, 'error' AS severity, path || '/word/document.xml/ins' AS key FROM x WHERE path % 10 > 0 AND part % 7 = 5")
def denied_features(spark, sf_dir):
    """Features that stop a merge."""
    return X.denied_features(X.elements(_xml_parts(spark, sf_dir)))


@query(
    "body_members",
    f"""
WITH x AS ({_XML_DUCK})
SELECT CAST(path AS VARCHAR) AS path, CAST(row_number() OVER (PARTITION BY path ORDER BY n) AS INT) AS pos, CASE WHEN part % 7 = 2 THEN 'table' ELSE 'paragraph' END AS kind, CASE part % 7 WHEN 0 THEN 'a' || supp WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE '' END AS text
FROM x WHERE path % 10 > 0 AND part % 7 < 6
""",
)
def body_members(spark, sf_dir):
    """Paragraphs and tables of a body in order."""
    return X.body_members(X.folded(_xml_parts(spark, sf_dir))).select("path", "pos", "kind", "text")


@query(
    "canonical_markup",
    """SELECT p_partkey, '<a x="' || p_size || '" y="' || p_brand || '"><b></b>' || CASE WHEN p_size % 2 = 0 THEN '<c></c>' ELSE '' END || '</a>' AS xml FROM part""",
)
def canonical_markup(spark, sf_dir):
    """Markup in canonical form."""
    xml = F.concat(F.lit("<a  y='"), "p_brand", F.lit("' x='"), F.col("p_size").cast("string"), F.lit("'><b/>"), F.when(F.col("p_size") % 2 == 0, "<c ></c>").otherwise(""), F.lit("</a>"))
    return table(spark, sf_dir, "part").select("p_partkey", X.canonical_xml(xml).alias("xml"))
