"""Queries over PDF files that are made, byte for byte, from the rows of orders and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators import layout as L
from folioloom.operators.ordered import dealt
from folioloom.plans.catalogue import oracle_of, query, table
from folioloom.sources import pdf_geometry as G
from folioloom.tables import written

_HEAD = "%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n3 0 obj << /Type /Font /FontDescriptor << /MissingWidth 500 /Descent -200 >> >> endobj\n"
_TURNED = "8 0 obj << /Subtype /Form /Matrix [0 1 -1 0 0 0] /Length 15 >> stream\n0 0 20 10 re f \nendstream endobj\n"


def _file(kids: list[str], streams: list, size: str):
    """A file of pages (their own entries as text) and their streams (Columns), as a Column of bytes."""
    first = 10
    tree = f"2 0 obj << /Type /Pages /Count {len(kids)} /MediaBox [0 0 {size}] /Resources << /Font << /F1 3 0 R >> /XObject << /Fm 8 0 R >> >> /Kids [{' '.join(f'{first + k} 0 R' for k in range(len(kids)))}] >> endobj\n"
    pages = "".join(f"{first + k} 0 obj << /Type /Page {own} /Contents {first + len(kids) + k} 0 R >> endobj\n" for k, own in enumerate(kids))
    drawn = [x for k, s in enumerate(streams) for x in (F.lit(f"{first + len(kids) + k} 0 obj << >> stream\n"), s, F.lit("\nendstream endobj\n"))]
    return F.concat(F.lit(_HEAD + _TURNED + tree + pages), *drawn, F.lit("trailer << /Root 1 0 R >>\n%%EOF")).cast("binary")


#: Rows that a task makes files of: reading a file takes longer than its few bytes say.
LINES_A_TASK = 30_000


def order_files(spark, sf_dir: str) -> DataFrame:
    """A file of two pages an order, the second upside down: rectangles, lines, words and a form, by its lines; one in fifty is broken."""
    i = lambda c: F.col(c).cast("long").cast("string")
    part, n, y = F.col("l_partkey"), F.col("l_linenumber"), (F.col("l_suppkey") % 400).cast("string")
    x = (n * 10).cast("string")
    shown = (
        F.when(part % 4 == 0, F.concat(F.lit("q /Pattern cs /P"), (F.col("l_suppkey") % 7).cast("string"), F.lit(" scn "), x, F.lit(" "), y, F.lit(" "), i("l_quantity"), F.lit(" "), (part % 90 + 1).cast("string"), F.lit(" re f Q")))
        .when(part % 4 == 1, F.concat(F.lit("q 2 0 0 2 "), i("l_linenumber"), F.lit(" 5 cm "), x, F.lit(" "), y, F.lit(" m "), x, F.lit(" "), i("l_quantity"), F.lit(" l S Q")))
        .when(part % 4 == 2, F.concat(F.lit("BT /F1 10 Tf 1 0 0 1 100 "), y, F.lit(" Tm (L"), i("l_partkey"), F.lit(") Tj ET")))
        .otherwise(F.concat(F.lit("q 1 0 0 1 "), x, F.lit(" "), y, F.lit(" cm /Fm Do Q")))
    )
    all_ = table(spark, sf_dir, "lineitem")
    lines = dealt(all_.select("l_orderkey", (n % 2).alias("side"), shown.alias("shown")), ["l_orderkey"], all_.count(), LINES_A_TASK)
    side = lambda k: F.array_join(F.sort_array(F.collect_list(F.when(F.col("side") == k, F.col("shown")))), "\n")
    files = lines.groupBy("l_orderkey").agg(side(1).alias("odd"), side(0).alias("even"))
    whole = _file(["", "/Rotate 180"], [F.col("odd"), F.col("even")], "600 800")
    return files.select(F.concat(F.lit("o"), i("l_orderkey")).alias("path"), F.when(F.col("l_orderkey") % 50 == 0, F.lit("torn").cast("binary")).otherwise(whole).alias("content"))


@query(
    "pdf_boxes",
    """
WITH l AS (SELECT l_orderkey AS k, 'o' || l_orderkey AS doc, CASE WHEN l_linenumber % 2 = 1 THEN 1 ELSE 2 END AS page, l_partkey AS p, l_linenumber AS n, l_suppkey AS s, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
g AS (
  SELECT k, doc, page, 'rect' AS kind, 10 * n AS x0, 10 * n + q AS x1, s % 400 AS y0, s % 400 + p % 90 + 1 AS y1, 'P' || (s % 7) AS color, NULL AS text FROM l WHERE p % 4 = 0
  UNION ALL SELECT k, doc, page, 'line', n + 20 * n, n + 20 * n, 5 + 2 * least(s % 400, q), 5 + 2 * greatest(s % 400, q), NULL, NULL FROM l WHERE p % 4 = 1
  UNION ALL SELECT k, doc, page, 'word', 100, 100 + 5 * (1 + length(CAST(p AS VARCHAR))), s % 400 - 2, s % 400 + 8, NULL, 'L' || p FROM l WHERE p % 4 = 2
  UNION ALL SELECT k, doc, page, 'rect', 10 * n - 10, 10 * n, s % 400, s % 400 + 20, NULL, NULL FROM l WHERE p % 4 = 3),
b AS (
  SELECT k, doc, page, kind, CASE page WHEN 1 THEN x0 ELSE 600 - x1 END AS x0, CASE page WHEN 1 THEN x1 ELSE 600 - x0 END AS x1,
         CASE page WHEN 1 THEN 800 - y1 ELSE y0 END AS top, CASE page WHEN 1 THEN 800 - y0 ELSE y1 END AS bottom, color, text FROM g WHERE k % 50 > 0
  UNION ALL SELECT DISTINCT k, doc, v.page, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM l, (VALUES (1), (2)) AS v(page) WHERE k % 50 > 0 AND NOT EXISTS (SELECT 1 FROM l x WHERE x.k = l.k AND x.page = v.page))
SELECT doc, CAST(page AS INT) AS page, kind, CAST(x0 AS DOUBLE) AS x0, CAST(x1 AS DOUBLE) AS x1, CAST(top AS DOUBLE) AS top, CAST(bottom AS DOUBLE) AS bottom, color, text, CAST(NULL AS VARCHAR) AS error FROM b
UNION ALL SELECT DISTINCT doc, CAST(NULL AS INT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'ValueError: not a PDF' FROM l WHERE k % 50 = 0
""",
)
def pdf_boxes(spark, sf_dir):
    """Every box of every page, read from the files' bytes."""
    return G.pdf_boxes(order_files(spark, sf_dir)).select("doc", "page", "kind", "x0", "x1", "top", "bottom", "color", "text", "error")


@query("pdf_answer_rectangles", oracle_of("attached_rectangles"))
def pdf_answer_rectangles(spark, sf_dir):
    """Answer rectangles and the questions above them, from the bytes of a file a customer."""
    k = F.col("o_orderkey")
    top, num = k % 700, lambda c: c.cast("string")
    high = F.when(k % 4 == 0, F.lit(855)).when(k % 4 == 1, F.lit(1000)).otherwise(F.lit(1140))
    tenths = lambda c: F.concat((c / F.lit(10)).cast("decimal(12,1)").cast("string"))
    word = F.concat(F.lit("BT /F1 9 Tf 1 0 0 1 52 "), tenths(9000 - 10 * top - 72), F.lit(" Tm (Q"), num(k % 40), F.lit(".) Tj ET"))
    rect = F.concat(F.lit("q /Pattern cs /P3 scn 52 "), tenths(9000 - 10 * top - high), F.lit(" 488 "), tenths(high), F.lit(" re f Q"))
    orders = table(spark, sf_dir, "orders")
    drawn = dealt(orders, ["o_custkey"], orders.count(), LINES_A_TASK).groupBy("o_custkey").agg(F.array_join(F.collect_list(F.when(k % 3 == 0, word).otherwise(rect)), "\n").alias("drawn"))
    files = drawn.select(num(F.col("o_custkey")).alias("path"), _file([""], [F.col("drawn")], "595 900").alias("content"))
    boxes = G.pdf_boxes(files).where("kind IS NOT NULL").withColumn("page", F.col("doc").cast("long")).withColumn("top", F.round("top", 6)).withColumn("bottom", F.round("bottom", 6))
    return L.attach_rectangles(boxes).select("page", "number", "top", F.col("count").alias("n_lines"), "review")


@query(
    "pdf_inventory",
    """
WITH l AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT 'o' || k AS doc, CASE WHEN k % 50 > 0 THEN 2 END AS n_pages, CASE WHEN k % 50 > 0 THEN '600.0x800.0' ELSE '' END AS sizes, CASE WHEN k % 50 = 0 THEN sha256('torn') END AS sha256_of_torn,
       CASE WHEN k % 50 = 0 THEN 'ValueError: not a PDF' END AS error, k % 50 > 0 AND k % 3 = 0 AS disagrees
FROM l
""",
)
def pdf_inventory(spark, sf_dir):
    """Pages, sizes and digests of files, and whether another reader's count of pages agrees."""
    files = order_files(spark, sf_dir)
    found = written(G.inventory(G.page_contents(files, streams=False)), "inventory")
    order = F.substring("doc", 2, 20).cast("long")
    other = found.select("doc", F.when(order % 3 == 0, 3).otherwise(2).alias("n_pages"))
    wrong = G.count_errors(found, other).select("doc", F.lit(True).alias("disagrees"))
    torn = F.when(F.col("error").isNotNull(), F.col("sha256")).alias("sha256_of_torn")
    return found.join(wrong, "doc", "left").select("doc", "n_pages", F.array_join("sizes", ",").alias("sizes"), torn, "error", F.coalesce("disagrees", F.lit(False)).alias("disagrees"))
