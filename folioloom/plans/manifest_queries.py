"""Queries of manifests, over JSON texts made from orders and their lines: a book a customer, a page an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.plans.catalogue import query, table
from folioloom.sources import manifests as S


def _books(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    l, c = table(spark, sf_dir, "lineitem"), F.col
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey AS book", "o_orderkey AS k", "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page")
    p, s = c("l_partkey"), c("l_suppkey")
    doc = F.concat(F.lit("b"), c("book").cast("string"))
    own = F.format_string("%s:p%03d", doc, c("page"))
    block = F.concat(
        F.lit('{"source_ids":["'), F.when(p % 17 == 0, "other").otherwise(own), F.lit('"],'),
        F.when(p % 4 == 0, F.concat(F.lit('"kind":"paragraph","text":"'), F.when(s % 10 == 0, " ").otherwise("words"), F.lit('"')))
        .when(p % 4 == 1, F.concat(F.lit('"kind":"question","hindi":"x","label":'), F.when(s % 13 == 0, "5").otherwise('"Q1"')))
        .when(p % 4 == 2, F.concat(F.lit('"kind":"answer_lines","spacing_points":28.5,"count":'), (p % 60).cast("string")))
        .otherwise(F.concat(F.lit('"kind":"spacer","points":'), F.when(s % 11 == 0, '"wide"').otherwise((s % 9 - 1).cast("string")))),
        F.lit("}"),
    )
    lines = l.join(o, l["l_orderkey"] == o["k"]).groupBy("book", "k", "page").agg(F.array_join(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", block.alias("b"))))["b"], ",").alias("blocks"))
    pages = o.join(lines, ["book", "k", "page"], "left")
    page = F.concat(
        F.lit('{"source_page":'), c("page").cast("string"), F.lit(',"page_type":"'), F.when(c("k") % 19 == 0, "odd").otherwise("mcq"), F.lit('"'),
        F.when(c("k") % 23 == 0, ',"utilization_exempt":true').when(c("k") % 23 == 1, ',"utilization_exempt":"no"').otherwise(""), F.lit(',"blocks":['), F.coalesce("blocks", F.lit("")), F.lit("]}"),
    )
    books = pages.groupBy("book").agg(F.array_join(F.sort_array(F.collect_list(F.struct("page", page.alias("p"))))["p"], ",").alias("pages"), F.count("*").alias("n"))
    b = c("book")
    value = F.when(b % 31 == 0, "{").otherwise(F.concat(
        F.lit('{"pages":['), c("pages"), F.lit('],"schema_version":'), F.when(b % 29 == 0, "2").otherwise("1"), F.lit(',"book_name":"'), F.when(b % 37 == 0, " ").otherwise("n"),
        F.lit('","scope":"full","source":{"page_count":'), c("n").cast("string"), F.lit(',"sha256":"h'), b.cast("string"), F.lit('"}}'),
    ))
    return books.select(doc.alias("doc"), value.alias("value")), books.select(doc.alias("doc"), F.concat(F.when(b % 41 == 0, "x").otherwise("h"), b.cast("string")).alias("sha256"))


@query(
    "manifest_violations",
    """
WITH o AS (SELECT o_custkey AS c, 'b' || o_custkey AS doc, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page FROM orders),
g AS (SELECT * FROM o WHERE c % 31 > 0),
b AS (SELECT g.*, l_partkey AS p, l_suppkey AS s, row_number() OVER (PARTITION BY k ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos FROM g JOIN lineitem ON l_orderkey = k),
r AS (
  SELECT DISTINCT 'json' AS rule_id, doc AS key FROM o WHERE c % 31 = 0
  UNION ALL SELECT DISTINCT 'schema_version', doc FROM g WHERE c % 29 = 0
  UNION ALL SELECT DISTINCT 'book_name', doc FROM g WHERE c % 37 = 0
  UNION ALL SELECT DISTINCT 'source_hash', doc FROM g WHERE c % 41 = 0
  UNION ALL SELECT 'page_type', doc || '/' || page FROM g WHERE k % 19 = 0
  UNION ALL SELECT 'exempt_reason', doc || '/' || page FROM g WHERE k % 23 = 0
  UNION ALL SELECT 'field_type', doc || '/pages[' || (page - 1) || '].utilization_exempt' FROM g WHERE k % 23 = 1
  UNION ALL SELECT 'blocks', doc || '/' || page FROM g WHERE k NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL SELECT 'own_page', doc || '/' || page || '/' || pos FROM b WHERE p % 17 = 0
  UNION ALL SELECT 'content', doc || '/' || page || '/' || pos FROM b WHERE p % 4 = 0 AND s % 10 = 0
  UNION ALL SELECT 'label', doc || '/' || page || '/' || pos FROM b WHERE p % 4 = 1 AND s % 13 = 0
  UNION ALL SELECT 'field_type', doc || '/pages[' || (page - 1) || '].blocks[' || (pos - 1) || '].label' FROM b WHERE p % 4 = 1 AND s % 13 = 0
  UNION ALL SELECT 'count', doc || '/' || page || '/' || pos FROM b WHERE p % 4 = 2 AND NOT p % 60 BETWEEN 1 AND 50
  UNION ALL SELECT 'points', doc || '/' || page || '/' || pos FROM b WHERE p % 4 = 3 AND (s % 11 = 0 OR s % 9 = 0)
  UNION ALL SELECT 'field_type', doc || '/pages[' || (page - 1) || '].blocks[' || (pos - 1) || '].points' FROM b WHERE p % 4 = 3 AND s % 11 = 0)
SELECT rule_id, 'error' AS severity, key FROM r
""",
)
def manifest_violations(spark, sf_dir):
    """Every broken rule of manifests, from their JSON texts on."""
    texts, sources = _books(spark, sf_dir)
    return S.manifest_violations(S.flatten(texts), sources).select("rule_id", "severity", "key")
