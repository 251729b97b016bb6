"""Queries of the page parser, over pages whose lines are made from order lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import pages as P
from folioloom.plans.catalogue import lines_by_order, query

# What line an order line stands for, by its part: each order is a page.
_LINES = """
SELECT 'orders' AS doc, CAST(l_orderkey AS INT) AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS line_no,
       CASE l_partkey % 14
         WHEN 0 THEN concat('CHAPTER ', l_linenumber) WHEN 1 THEN 'SHORT ANSWER QUESTION' WHEN 2 THEN concat('Q', l_linenumber, '. What is ', l_suppkey, '?')
         WHEN 3 THEN concat('Q', l_linenumber, ') यदि x = ', l_suppkey) WHEN 4 THEN concat('Q', l_linenumber, '.') WHEN 5 THEN '(A) one (B) two'
         WHEN 6 THEN '(C) three (D) four' WHEN 7 THEN concat('(A) ', l_suppkey) WHEN 8 THEN '(A)        (B) half' WHEN 9 THEN '..........'
         WHEN 10 THEN concat('यदि y = ', l_suppkey) WHEN 11 THEN concat('       tail ', l_suppkey)
         WHEN 12 THEN concat('  a longer line that says what is to be found here and goes on for more than eight words ', l_suppkey)
         ELSE CAST(l_linenumber AS STRING) END AS raw
FROM {lineitem}
"""

_PARSER = f"""
WITH RECURSIVE raw AS ({_LINES.format(lineitem="lineitem")}),
t AS (SELECT page, line_no, raw, trim(regexp_replace(raw, '[ \\t]+', ' ', 'g')) AS text FROM raw),
x AS (SELECT *, lead(text) OVER (PARTITION BY page ORDER BY line_no) IS NULL AND regexp_full_match(text, '\\d{{1,4}}') AS folio FROM t),
c AS (
  SELECT page, text, line_no, row_number() OVER w AS rn, length(raw) - length(ltrim(raw)) AS col, length(raw) AS width, raw,
         regexp_matches(text, '^CHAPTER') AS unit, text = 'SHORT ANSWER QUESTION' AS typ, regexp_extract(text, '^Q(\\d+)[.)] ?(.*)$', ['n', 'body']) AS q,
         regexp_extract_all(raw, '\\(([A-D])\\)', 1) AS letters, regexp_full_match(text, '[.]{{8,}}') AS dots
  FROM x WHERE NOT folio WINDOW w AS (PARTITION BY page ORDER BY line_no)),
k AS (
  SELECT *, coalesce(lag(unit) OVER w, false) AS titled,
         CASE WHEN unit THEN 'unit_heading' WHEN typ THEN 'question_type_heading' WHEN coalesce(lag(unit) OVER w, false) AND q.n = '' THEN 'chapter_heading' END AS role,
         list_transform(letters, lambda s: instr(raw, '(' || s || ')') - 1) AS cols
  FROM c WINDOW w AS (PARTITION BY page ORDER BY rn)),
l AS (
  SELECT *, CASE WHEN role IS NOT NULL THEN 'heading' WHEN q.n <> '' THEN 'question' WHEN len(letters) > 0 THEN 'options' WHEN dots THEN 'ruled' ELSE 'other' END AS kind,
         list_transform(letters, lambda s, i: trim(substr(raw, cols[i] + 4, CASE WHEN i < len(cols) THEN cols[i + 1] - cols[i] - 3 ELSE 999 END))) AS texts
  FROM k),
s AS (
  SELECT page, 0 AS rn, CAST(0 AS BIGINT) AS ord, CAST(NULL AS BIGINT) AS active, false AS asked, false AS open, CAST([] AS VARCHAR[]) AS labels, CAST([] AS BIGINT[]) AS places,
         CAST([] AS VARCHAR[]) AS names, 0 AS widest, 0 AS sets, 0 AS runs, false AS goes_on, CAST(NULL AS BIGINT) AS slot, CAST('' AS VARCHAR) AS kind, CAST(0 AS BIGINT) AS base
  FROM l GROUP BY page
  UNION ALL
  SELECT u.page, l.rn, u.ord2, CASE WHEN l.kind = 'heading' THEN NULL WHEN l.kind = 'question' THEN u.ord2 ELSE u.active END, l.kind = 'question' OR (u.asked AND l.kind = 'other'),
         l.kind = 'options' OR u.cont, CASE WHEN u.fresh THEN l.letters WHEN l.kind = 'options' THEN list_distinct(list_concat(u.labels, l.letters)) WHEN u.cont THEN u.labels ELSE [] END,
         CASE WHEN u.fresh THEN l.cols WHEN l.kind = 'options' THEN list_concat(u.places, l.cols) WHEN u.cont THEN u.places ELSE [] END,
         CASE WHEN u.fresh THEN l.letters WHEN l.kind = 'options' THEN list_concat(u.names, l.letters) WHEN u.cont THEN u.names ELSE [] END,
         CAST(CASE WHEN u.fresh THEN len(l.letters) WHEN l.kind = 'options' THEN greatest(u.widest, len(l.letters)) WHEN u.cont THEN u.widest ELSE 0 END AS INT),
         CASE WHEN u.fresh THEN u.sets + 1 ELSE u.sets END, CASE WHEN l.kind = 'ruled' AND u.kind <> 'ruled' THEN u.runs + 1 ELSE u.runs END, u.cont,
         CASE WHEN u.cont THEN -(list_sort(list_transform(u.places, lambda p, i: {{'d': abs(p - l.col), 'i': -i}}))[1].i) END, l.kind, CASE WHEN u.fresh THEN 0 ELSE len(u.names) END
  FROM (SELECT s.*, s.ord + CASE WHEN n.kind = 'question' THEN 1 ELSE 0 END AS ord2,
               n.kind = 'options' AND (NOT s.open OR list_has_any(s.labels, n.letters)) AS fresh,
               n.kind = 'other' AND s.open AND (len(s.labels) < 4 OR (s.widest = 1 AND NOT list_contains(s.labels, 'D')) OR (length(n.text) <= 48 AND len(string_split(n.text, ' ')) <= 8)) AS cont
        FROM s JOIN l n ON n.page = s.page AND n.rn = s.rn + 1) u JOIN l ON l.page = u.page AND l.rn = u.rn + 1),
f AS (
  SELECT l.*, s.ord, s.active, s.asked, s.goes_on, s.slot, s.sets, s.runs, s.widest, s.base, CASE WHEN s.active IS NOT NULL THEN printf('q-p%03d-%03d', l.page, s.active) END AS about
  FROM l JOIN s ON s.page = l.page AND s.rn = l.rn),
body AS (
  SELECT page, ord, min(line_no) AS n, max(CASE WHEN kind = 'question' THEN CAST(TRY_CAST(q.n AS INT) AS VARCHAR) END) AS num, max(CASE WHEN kind = 'question' THEN q.body END) AS own, max(about) AS about,
         string_agg(own_text, ' ' ORDER BY rn) FILTER (own_text <> '' AND regexp_matches(own_text, '[ऀ-ॿ]')) AS hindi,
         string_agg(own_text, ' ' ORDER BY rn) FILTER (own_text <> '' AND NOT regexp_matches(own_text, '[ऀ-ॿ]')) AS english
  FROM (SELECT *, CASE WHEN kind = 'question' THEN q.body ELSE text END AS own_text FROM f WHERE asked) GROUP BY page, ord),
piece AS (
  SELECT page, sets, rn, line_no, base + i AS slot, letters[i] AS label, texts[i] AS text, about, widest FROM (SELECT *, unnest(range(1, len(letters) + 1)) AS i FROM f WHERE kind = 'options')
  UNION ALL SELECT page, sets, rn, line_no, slot, NULL, text, about, widest FROM f WHERE goes_on),
slots AS (
  SELECT page, sets, slot, min(line_no) AS n, max(label) AS label, coalesce(string_agg(text, ' ' ORDER BY rn) FILTER (text <> ''), '') AS text, max(about) AS about, max(widest) AS widest FROM piece GROUP BY page, sets, slot),
opt AS (
  SELECT page, sets, min(n) AS n, max(about) AS about, max(widest) AS widest, bool_or(text = '') AS torn, count(DISTINCT label) = count(*) AS once,
         list({{'label': label, 'text': text}} ORDER BY label) AS sorted, list({{'label': label, 'text': text}} ORDER BY slot) AS listed FROM slots GROUP BY page, sets),
o AS (SELECT *, CASE WHEN once THEN sorted ELSE listed END AS items FROM opt),
b AS (
  SELECT page, line_no AS n, 0 AS slot, 'heading' AS kind, role, NULL AS question_id, NULL AS for_question, NULL AS label, NULL AS layout, 'high' AS confidence, text AS content, NULL AS columns, NULL AS lines, NULL AS review FROM f WHERE kind = 'heading'
  UNION ALL SELECT page, n, 0, 'question', NULL, about, NULL, 'Q' || num || '.', CASE WHEN own = '' THEN 'standalone' ELSE 'inline' END,
         CASE WHEN hindi IS NULL OR english IS NULL THEN 'medium' ELSE 'high' END, concat_ws('|', hindi, english), NULL, NULL, CASE WHEN hindi IS NULL OR english IS NULL THEN 'missing_translation' END
    FROM body WHERE hindi IS NOT NULL OR english IS NOT NULL
  UNION ALL SELECT page, n, 0, 'paragraph', NULL, NULL, NULL, NULL, NULL, 'medium', 'Q' || num || '.', NULL, NULL, 'orphan_question_label' FROM body WHERE hindi IS NULL AND english IS NULL
  UNION ALL SELECT page, min(line_no), 0, 'answer_lines', NULL, NULL, max(about), NULL, NULL, 'high', '', NULL, count(*), NULL FROM f WHERE kind = 'ruled' GROUP BY page, runs
  UNION ALL SELECT page, line_no, 0, 'paragraph', NULL, NULL, NULL, NULL, NULL, 'high', text, NULL, NULL, NULL FROM f WHERE kind = 'other' AND NOT asked AND NOT goes_on
  UNION ALL SELECT page, n, 0, 'options', NULL, NULL, about, NULL, CASE WHEN widest >= 4 THEN 'four_inline' WHEN widest >= 2 THEN 'two_by_two' ELSE 'one_column' END,
         CASE WHEN list_transform(items, lambda i: i.label) = ['A', 'B', 'C', 'D'] THEN 'high' ELSE 'medium' END, array_to_string(list_transform(items, lambda i: i.label || ':' || i.text), ';'),
         CASE WHEN widest >= 4 THEN 4 WHEN widest >= 2 THEN 2 ELSE 1 END, NULL, CASE WHEN list_transform(items, lambda i: i.label) = ['A', 'B', 'C', 'D'] THEN NULL ELSE 'option_sequence' END FROM o WHERE NOT torn
  UNION ALL SELECT page, n, i - 1, 'paragraph', NULL, NULL, NULL, NULL, NULL, 'medium', trim('(' || items[i].label || ') ' || items[i].text), NULL, NULL, CASE WHEN i = len(items) THEN 'incomplete_options' END
    FROM (SELECT *, unnest(range(1, len(items) + 1)) AS i FROM o WHERE torn)),
p AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY n, slot) AS pos FROM b)
"""


def _pages(spark, sf_dir):
    return spark.sql(_LINES, lineitem=lines_by_order(spark, sf_dir, "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))


@query(
    "page_blocks",
    _PARSER
    + """SELECT page, CAST(pos AS INT) AS pos, kind, role, question_id, for_question, label, layout, confidence, content, CAST(columns AS INT) AS n_columns, CAST(lines AS INT) AS n_lines FROM p""",
)
def page_blocks(spark, sf_dir):
    """Typed blocks of every page."""
    b = P.blocks(_pages(spark, sf_dir))
    items = F.array_join(F.transform("items", lambda i: F.concat_ws(":", i["label"], i["text"])), ";")
    content = F.coalesce("text", items, F.concat_ws("|", "hindi", "english"))
    return b.select(
        "page", "pos", "kind", "role", "question_id", "for_question", "label", "layout", "confidence", content.alias("content"),
        F.col("columns").alias("n_columns"), F.col("count").alias("n_lines"),
    )


@query(
    "page_reviews",
    _PARSER
    + """SELECT page, printf('review-p%03d-%s-%03d', page, replace(review, '_', '-'), row_number() OVER (PARTITION BY page ORDER BY pos)) AS review_id, review AS type FROM p WHERE review IS NOT NULL""",
)
def page_reviews(spark, sf_dir):
    """What the parser leaves to a reviewer, numbered in each page."""
    return P.reviews(_pages(spark, sf_dir)).select("page", "review_id", "type")
