"""Queries of the layout rules, over printed pages made from orders and their lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import page_layout as P
from folioloom.plans.catalogue import made, query

_PT = 72 / 25.4
# A document a customer; a page an order, with a box for each line, ruled lines that span the frame, and its own kind of page.
_PAGES = f"""SELECT concat('d', o_custkey) AS doc, o_orderkey AS k, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS INT) AS page,
  CASE WHEN o_orderkey % 31 = 0 THEN CAST(612.0 AS DOUBLE) ELSE CAST({210 * _PT!r} AS DOUBLE) END AS width, CAST({297 * _PT!r} AS DOUBLE) AS height,
  CASE WHEN o_orderkey % 6 > 0 THEN CAST(o_orderkey % 1000 AS INT) END AS source_page FROM orders"""
_JOBS = """SELECT DISTINCT concat('d', o_custkey) AS doc, o_custkey % 2 = 0 AS first_recto, o_custkey % 5 = 0 AS sample_flow, CASE WHEN o_custkey % 7 > 0 THEN true END AS source_locked,
  o_custkey % 3 = 0 AS content_only, CAST(o_custkey % 40 AS INT) AS expected_pages FROM orders"""
_BOXES = """SELECT p.doc, p.page, CASE l_partkey % 4 WHEN 0 THEN 'word' WHEN 1 THEN 'rect' WHEN 2 THEN 'line' ELSE 'image' END AS kind,
  CAST(CASE WHEN l_partkey % 4 = 2 AND l_suppkey % 3 > 0 THEN 51 + l_suppkey % 30 ELSE 30 + l_suppkey % 400 END AS DOUBLE) AS x0,
  CAST(CASE WHEN l_partkey % 4 = 2 AND l_suppkey % 3 > 0 THEN 540 ELSE 40 + l_suppkey % 400 + l_quantity * 4 END AS DOUBLE) AS x1,
  CAST(60 + l_partkey * 7 % 740 AS DOUBLE) AS top, CAST(60 + l_partkey * 7 % 740 + CASE WHEN l_partkey % 4 = 2 THEN 1 ELSE l_quantity END AS DOUBLE) AS bottom,
  CASE WHEN l_partkey % 3 = 0 THEN CAST(l_suppkey AS STRING) ELSE 'word' END AS text
  FROM lineitem JOIN p ON l_orderkey = p.k"""
_SOURCES = """SELECT DISTINCT doc, source_page, CASE source_page % 5 WHEN 0 THEN 'mcq' WHEN 1 THEN 'short_answer' WHEN 2 THEN 'chapter_end' WHEN 3 THEN 'mcq' ELSE 'exercise' END AS page_type,
  source_page % 11 = 0 AS exempt, CASE WHEN source_page % 4 > 0 THEN CAST(source_page * 3 % 700 + 100 AS DOUBLE) END AS bottom,
  CASE WHEN source_page % 4 > 0 THEN CAST(source_page * 13 % 101 AS DOUBLE) END AS utilization FROM p WHERE source_page IS NOT NULL AND source_page % 9 > 0"""
_BLOCKS = """SELECT doc, source_page, CASE WHEN k % 3 = 0 THEN 'answer_lines' ELSE 'question' END AS kind, CASE WHEN k % 2 = 0 THEN array(0.0, 10.0, 9.0, CAST(k % 700 AS DOUBLE)) END AS bbox FROM p WHERE source_page IS NOT NULL"""


def _inputs(spark, sf_dir):
    p = made(spark, sf_dir, _PAGES.replace("FROM orders", "FROM {orders}"), "orders")
    jobs = made(spark, sf_dir, _JOBS.replace("FROM orders", "FROM {orders}"), "orders")
    boxes = spark.sql(_BOXES.replace("lineitem JOIN p ON", "{l} JOIN {p} p ON"), l=spark.read.parquet(f"{sf_dir}/lineitem.parquet"), p=p)
    rest = [spark.sql(sql.replace("FROM p", "FROM {p}"), p=p) for sql in (_SOURCES, _BLOCKS)]
    return boxes, p.drop("k"), jobs, *rest


_MM = {name: f"{v * _PT!r}" for name, v in {"safe_top": 28.0, "safe_bottom": 267.0, "footer": 276.0, "folio": 270.0, "inset": 4.0, "slack": 1.5, "side": 6.0, "wide": 150.0, "answer_top": 55.0, "high": 1.5}.items()}
_RESULTS = f"""
p AS ({_PAGES}), j AS ({_JOBS}), b AS ({_BOXES}), s AS ({_SOURCES}), k AS ({_BLOCKS.replace("array(", "list_value(")}),
f AS (SELECT p.*, first_recto, sample_flow, coalesce(source_locked, false) AS locked, content_only, expected_pages, (page % 2 = 1) = first_recto AS recto,
        CASE WHEN (page % 2 = 1) = first_recto THEN {22.0 * _PT!r} ELSE {18.0 * _PT!r} END AS l, width - CASE WHEN (page % 2 = 1) = first_recto THEN {18.0 * _PT!r} ELSE {22.0 * _PT!r} END AS r FROM p JOIN j USING (doc)),
x AS (SELECT b.*, f.l, f.r, f.content_only, kind = 'word' AND bottom < {_MM["footer"]} AND NOT (top > {_MM["folio"]} AND regexp_full_match(text, '\\d+')) AS word,
        kind <> 'word' AND x1 - x0 < width * 0.9 AND bottom - top < height * 0.9 AND (x0 + x1) / 2 BETWEEN f.l + {_MM["inset"]} AND f.r - {_MM["inset"]} AND bottom >= {26.0 * _PT!r} AND top <= {_MM["footer"]} AS visual,
        x0 < f.l - {_MM["slack"]} OR x1 > f.r + {_MM["slack"]} AS outside, kind IN ('line', 'rect', 'curve') AND bottom - top <= {_MM["high"]} AND (top + bottom) / 2 BETWEEN {_MM["answer_top"]} AND {_MM["safe_bottom"]} AS flat
      FROM b JOIN f USING (doc, page)),
e AS (SELECT doc, page, min(top) FILTER (word OR visual) AS top, max(bottom) FILTER (word OR visual) AS low, count(*) FILTER (word AND outside) AS wo, count(*) FILTER (visual AND outside) AS vo FROM x GROUP BY doc, page),
g AS (SELECT doc, page, min(x0) AS x0, max(x1) AS x1, max((top + bottom) / 2) AS y, any_value(l + CASE WHEN content_only THEN 27 ELSE 0 END) AS l, any_value(r) AS r FROM x WHERE flat GROUP BY doc, page, round_even((top + bottom) / 2 / 1.5, 0)),
t AS (SELECT doc, page, max(y) AS extent FROM g WHERE x1 - x0 >= {_MM["wide"]} AND abs(x0 - l) <= {_MM["side"]} AND abs(x1 - r) <= {_MM["side"]} GROUP BY doc, page),
a AS (SELECT doc, source_page, bool_or(kind = 'answer_lines') AS asks, max(CASE WHEN kind = 'answer_lines' AND bbox[4] > bbox[2] THEN bbox[4] END) AS deep FROM k GROUP BY doc, source_page),
m AS (SELECT f.*, e.top, greatest(e.low, t.extent) AS bottom, t.extent, coalesce(wo, 0) AS wo, coalesce(vo, 0) AS vo, coalesce(s.page_type, 'other') AS page_type, coalesce(s.exempt, false) OR s.page_type = 'chapter_end' AS spared,
        s.utilization AS su, s.doc IS NOT NULL AND coalesce(asks, false) AS asks,
        CASE WHEN s.page_type = 'short_answer' THEN {267.0 * _PT - 27.0!r} WHEN deep IS NOT NULL THEN least(deep, {260.0 * _PT!r}) ELSE least(s.bottom, {260.0 * _PT!r}) END AS target
      FROM f LEFT JOIN e USING (doc, page) LEFT JOIN t USING (doc, page) LEFT JOIN s ON s.doc = f.doc AND s.source_page = f.source_page LEFT JOIN a ON a.doc = f.doc AND a.source_page = f.source_page),
u AS (SELECT *, CASE WHEN bottom IS NULL THEN 0 ELSE 100 * greatest(0, least({_MM["safe_bottom"]}, bottom) - {_MM["safe_top"]}) / {239.0 * _PT!r} END AS use FROM m),
v AS (SELECT *, use - su AS gap, locked AND NOT sample_flow AS bound, locked AND NOT sample_flow AND NOT coalesce(spared, false) AS cmp FROM u)
"""
_RULES = f"""
SELECT doc, page, source_page, 'error' AS severity, 'not_a4' AS rule, width / {_PT!r} AS value FROM v WHERE width = 612
UNION ALL SELECT doc, page, source_page, 'error', 'blank_page', 0 FROM v WHERE top IS NULL OR bottom IS NULL
UNION ALL SELECT doc, page, source_page, 'error', 'starts_too_high', top / {_PT!r} FROM v WHERE top < {26.0 * _PT!r}
UNION ALL SELECT doc, page, source_page, 'error', 'crosses_footer', bottom / {_PT!r} FROM v WHERE top IS NOT NULL AND bottom > {268.0 * _PT!r}
UNION ALL SELECT doc, page, source_page, 'error', 'text_outside_frame', wo FROM v WHERE top IS NOT NULL AND wo > 0
UNION ALL SELECT doc, page, source_page, 'error', 'visual_outside_frame', vo FROM v WHERE top IS NOT NULL AND vo > 0
UNION ALL SELECT doc, page, source_page, 'error', 'compressed', -gap FROM v WHERE cmp AND gap < -8
UNION ALL SELECT doc, page, source_page, 'warning', 'below_source', -gap FROM v WHERE cmp AND gap >= -8 AND gap < -4
UNION ALL SELECT doc, page, source_page, 'warning', 'mcq_below_target', use FROM v WHERE cmp AND page_type = 'mcq' AND su >= 82 AND use < 82
UNION ALL SELECT doc, page, source_page, 'warning', 'mcq_dense', use FROM v WHERE cmp AND page_type = 'mcq' AND use > 95 AND gap > 8
UNION ALL SELECT doc, page, source_page, 'error', 'hardly_filled', use FROM v WHERE cmp AND gap IS NULL AND use < 60
UNION ALL SELECT doc, page, source_page, 'warning', 'low_utilization', use FROM v WHERE cmp AND gap IS NULL AND use >= 60 AND use < 75
UNION ALL SELECT doc, page, source_page, 'error', 'no_answer_line', 0 FROM v WHERE bound AND asks AND extent IS NULL
UNION ALL SELECT doc, page, source_page, 'error', 'answer_line_too_high', extent / {_PT!r} FROM v WHERE bound AND asks AND extent < target
UNION ALL SELECT doc, NULL, NULL, 'error', 'page_count', count(*) FROM v WHERE NOT sample_flow GROUP BY doc HAVING count(*) <> any_value(expected_pages)
UNION ALL SELECT doc, NULL, NULL, 'error', 'source_mapping', count(*) FROM v WHERE NOT sample_flow GROUP BY doc HAVING count(*) <> count(source_page) AND count(source_page) > 0
"""


@query("layout_findings", f"WITH {_RESULTS}, w AS ({_RULES}) SELECT doc, CAST(page AS INT) AS page, CAST(source_page AS INT) AS source_page, severity, rule, round(CAST(value AS DOUBLE), 6) AS value FROM w")
def layout_findings(spark, sf_dir):
    """Every broken layout rule of every page and document (Q5)."""
    boxes, pages, jobs, sources, blocks = _inputs(spark, sf_dir)
    found = P.layout_findings(boxes, pages, jobs, sources, blocks, pages.where("source_page IS NOT NULL"))
    return found.withColumn("value", F.round("value", 6))


@query("layout_verdicts", f"WITH {_RESULTS}, w AS ({_RULES}) SELECT j.doc, count(*) FILTER (severity = 'error') = 0 AS passed, count(*) FILTER (severity = 'error') AS n_errors, count(*) FILTER (severity = 'warning') AS n_warnings FROM j LEFT JOIN w USING (doc) GROUP BY j.doc")
def layout_verdicts(spark, sf_dir):
    """Whether each document's layout passes (Q5)."""
    boxes, pages, jobs, sources, blocks = _inputs(spark, sf_dir)
    return P.layout_verdict(P.layout_findings(boxes, pages, jobs, sources, blocks, pages.where("source_page IS NOT NULL")), jobs)
