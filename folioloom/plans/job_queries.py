"""Queries of jobs, over manifests made from orders: a job an order, a range of pages and a preview page a line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.ordered import dealt
from folioloom.plans.catalogue import made, query, table
from folioloom.sources import job_table as J

#: Jobs that one task parses, whatever the number of jobs.
JOBS_A_TASK = 50_000

_JOBS = """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey % 400 AS a, l_partkey % 400 + CAST(l_quantity AS INT) % 40 - 1 AS b, l_suppkey % 400 AS p FROM {lineitem}),
r AS (SELECT k, count(*) AS n, sort_array(collect_list(struct(n, a, b, p))) AS s FROM l GROUP BY k),
j AS (SELECT o.*, r.n, r.s, CASE WHEN o_orderstatus = 'O' THEN 'pdf' ELSE 'docx' END AS kind FROM {orders} o LEFT JOIN r ON k = o_orderkey)
SELECT 'j' || o_orderkey AS job, '/jobs/' || o_orderkey AS root, CASE WHEN o_custkey % 40 = 0 THEN '[' ELSE
  '{{"job_id":"j","class":11,"subject":"' || CASE WHEN o_custkey % 41 = 0 THEN ' ' ELSE 's' END || '","template":"/in/t.docx","qa_dir":"qa","preview_output":"p.docx","source":"../../in/x/../' || o_custkey || '.' || kind || '"'
  || ',"final_output":"' || CASE WHEN o_custkey % 43 = 0 THEN '../../in/./t.docx' WHEN o_custkey % 43 = 1 THEN './p.docx' ELSE 'f.docx' END || '"'
  || CASE WHEN o_orderpriority LIKE '1%' THEN ',"render_authority":"word"' WHEN o_orderpriority LIKE '2%' THEN ',"render_authority":"press"' WHEN o_orderpriority LIKE '3%' THEN ',"pagination_policy":"sample_flow"' ELSE '' END
  || CASE WHEN kind = 'docx' THEN '' ELSE ',"content_policy":"reconstruct_content","typography_policy":"mapped_pdf_fonts","normalized_source":"n.docx","content_manifest":"m.json","pdf_font_map":{{"hindi":"a","latin":"b"' || CASE WHEN o_custkey % 3 = 0 THEN '' ELSE ',"math":"c"' END || '}}' END
  || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',"expected_page_count":' || (o_custkey % 200) END
  || CASE WHEN n IS NULL THEN '' ELSE ',"content_page_ranges":[' || array_join(transform(s, x -> '[' || x.a || ',' || x.b || ']'), ',') || '],"preview_source_page_numbers":[' || array_join(transform(s, x -> x.p), ',') || ']' END
  || CASE WHEN o_orderstatus = 'F' THEN '' ELSE ',"preview_source_pages":' || coalesce(n, 0) END || '}}' END AS value
FROM j
"""

_FILES = "SELECT explode(array('/in/' || c_custkey || '.pdf', '/in/' || c_custkey || '.docx')) AS path, upper(sha2(c_name, 256)) AS sha256 FROM {customer} WHERE c_acctbal > 0 UNION ALL SELECT '/in/t.docx', 'T'"


def _tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    n = table(spark, sf_dir, "orders").count()
    jobs = dealt(made(spark, sf_dir, _JOBS, "orders", "lineitem"), ["job"], n, JOBS_A_TASK)  # few bytes, much work a row
    return jobs, made(spark, sf_dir, _FILES, "customer")


@query(
    "job_violations",
    """
WITH l AS (SELECT l_orderkey AS k, l_partkey % 400 AS a, l_partkey % 400 + CAST(l_quantity AS INT) % 40 - 1 AS b, l_suppkey % 400 AS p,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey % 400, l_partkey % 400 + CAST(l_quantity AS INT) % 40 - 1, l_suppkey % 400) AS n FROM lineitem),
o AS (SELECT o_orderkey AS k, 'j' || o_orderkey AS key, o_custkey AS c, o_orderstatus AS s, left(o_orderpriority, 1) AS u FROM orders WHERE o_custkey % 40 > 0),
g AS (SELECT * FROM l WHERE a >= 1 AND b >= a),
t AS (SELECT k, sum(b - a + 1) AS pages FROM g GROUP BY k),
w AS (SELECT k, count(*) AS lines, count(DISTINCT p) AS kinds, min(p) AS least FROM l GROUP BY k),
j AS (SELECT o.*, t.pages, coalesce(w.lines, 0) AS lines, w.kinds, w.least, CASE WHEN s = 'P' THEN NULL ELSE c % 200 END AS expected, CASE WHEN s = 'F' THEN 7 ELSE coalesce(w.lines, 0) END AS asked
  FROM o LEFT JOIN t ON t.k = o.k LEFT JOIN w ON w.k = o.k),
r AS (
  SELECT 'json' AS rule_id, 'j' || o_orderkey AS key FROM orders WHERE o_custkey % 40 = 0
  UNION ALL SELECT 'name_missing', key FROM j WHERE c % 41 = 0
  UNION ALL SELECT 'source_file', key FROM j WHERE c NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
  UNION ALL SELECT 'render_authority', key FROM j WHERE u = '2'
  UNION ALL SELECT 'layout_reference_missing', key FROM j WHERE u = '3'
  UNION ALL SELECT 'preview_source_pages', key FROM j WHERE asked < 1
  UNION ALL SELECT 'expected_page_count', key FROM j WHERE expected < 1
  UNION ALL SELECT DISTINCT 'range_ends', key FROM j JOIN l USING (k) WHERE a < 1 OR b < a
  UNION ALL SELECT DISTINCT 'range_overlap', key FROM j JOIN g x USING (k) JOIN g y USING (k) WHERE x.n < y.n AND x.a <= y.b AND y.a <= x.b
  UNION ALL SELECT DISTINCT 'range_order', key FROM j JOIN (SELECT k, a, lag(b) OVER (PARTITION BY k ORDER BY n) AS last FROM g) USING (k) WHERE a <= last
  UNION ALL SELECT 'page_count_differs', key FROM j WHERE pages <> expected
  UNION ALL SELECT 'word_pdf_pages', key FROM j WHERE s = 'O' AND u = '1' AND (pages IS NULL OR expected IS NULL)
  UNION ALL SELECT DISTINCT 'preview_outside', key FROM j JOIN l USING (k) WHERE pages IS NOT NULL AND NOT EXISTS (SELECT 1 FROM g WHERE g.k = l.k AND l.p BETWEEN g.a AND g.b)
  UNION ALL SELECT 'preview_repeated', key FROM j WHERE kinds < lines
  UNION ALL SELECT 'preview_positive', key FROM j WHERE least < 1
  UNION ALL SELECT 'preview_length', key FROM j WHERE lines > 0 AND lines <> asked
  UNION ALL SELECT 'pdf_preview_pages', key FROM j WHERE s = 'O' AND lines = 0
  UNION ALL SELECT 'pdf_font_roles', key FROM j WHERE s = 'O' AND c % 3 = 0
  UNION ALL SELECT 'output_protected', key FROM j WHERE c % 43 = 0
  UNION ALL SELECT 'made_twice', key FROM j WHERE c % 43 = 1)
SELECT rule_id, 'error' AS severity, key FROM r
""",
)
def job_violations(spark, sf_dir):
    """Everything that is wrong with jobs, from their JSON texts and a listing of files on."""
    return J.job_violations(*_tables(spark, sf_dir))


_STATUS = """
SELECT 'j' || o_orderkey AS job, CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN '' ELSE
  '{{"state":"s","preview_sha256":"V","template_sha256":"' || CASE WHEN o_custkey % 7 = 0 THEN 'old' ELSE 'T' END || '","source_sha256":"' || upper(sha2(c_name, 256)) || '","content_manifest_sha256":"M","normalized_source_sha256":"N"'
  || CASE WHEN o_orderstatus = 'P' THEN '' ELSE ',"approved_preview_sha256":"V","approved_template_sha256":"T","approved_source_sha256":"' || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE upper(sha2(c_name, 256)) END || '","approved_content_manifest_sha256":"M","approved_normalized_source_sha256":"N"' END
  || '}}' END AS value
FROM {orders} JOIN {customer} ON o_custkey = c_custkey
"""

_MADE = """
SELECT '/jobs/' || o_orderkey || '/p.docx' AS path, 'V' AS sha256 FROM {orders} WHERE o_totalprice > 20000
UNION ALL SELECT '/jobs/' || o_orderkey || '/n.docx', 'N' FROM {orders}
UNION ALL SELECT '/jobs/' || o_orderkey || '/m.json', CASE WHEN o_custkey % 13 = 0 THEN 'edited' ELSE 'M' END FROM {orders}
"""


@query(
    "conversion_gate",
    """
WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_totalprice AS price, coalesce(c_acctbal > 0, false) AS there, NOT (o_orderstatus = 'P' AND o_custkey % 2 = 0) AS noted, c_custkey IS NOT NULL AS known
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_custkey % 40 > 0),
b AS (
  SELECT k, 'preview' AS stage, noted AND known AS recorded, price > 20000 AS good FROM o UNION ALL SELECT k, 'preview', noted AND known, there FROM o UNION ALL SELECT k, 'preview', noted AND known, c % 7 > 0 FROM o
  UNION ALL SELECT k, 'preview', noted AND known, true FROM o WHERE s = 'O' UNION ALL SELECT k, 'preview', noted AND known, c % 13 > 0 FROM o WHERE s = 'O'
  UNION ALL SELECT k, 'approved', s <> 'P' AND known, price > 20000 FROM o UNION ALL SELECT k, 'approved', s <> 'P' AND known AND c % 11 > 0, there FROM o UNION ALL SELECT k, 'approved', s <> 'P' AND known, true FROM o
  UNION ALL SELECT k, 'approved', s <> 'P' AND known, true FROM o WHERE s = 'O' UNION ALL SELECT k, 'approved', s <> 'P' AND known, c % 13 > 0 FROM o WHERE s = 'O')
SELECT 'j' || k AS job, count(*) FILTER (stage = 'preview' AND NOT (recorded AND good)) AS n_preview, count(*) FILTER (stage = 'approved' AND NOT (recorded AND good)) AS n_approved, bool_and(recorded AND good) AS passed FROM b GROUP BY k
""",
)
def conversion_gate(spark, sf_dir):
    """Whether each job's preview and approval still hold for every file that they are bound to."""
    jobs, files = _tables(spark, sf_dir)
    facts, _ = J.job_facts(jobs)
    return J.conversion_gate(facts, made(spark, sf_dir, _STATUS, "orders", "customer"), files.unionByName(made(spark, sf_dir, _MADE, "orders")))
