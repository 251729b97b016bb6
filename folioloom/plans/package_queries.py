"""Queries of whole packages: what is copied along, under which names."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.operators import merges as M
from folioloom.operators.ordered import dealt
from folioloom.plans.catalogue import query, table
from folioloom.tables import written

# A package a customer; its parts are its orders, each of which leads to two more and some back to earlier ones, so that
# there are cycles. Names repeat by remainders, and the target has some of them.
_PARTS = """SELECT concat('d', o_custkey) AS doc, o_orderkey AS k, concat('word/p', o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '.xml' ELSE '' END) AS part,
  CAST(o_orderkey AS STRING) AS digest, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS m FROM {orders}"""
_EDGES = """SELECT a.doc, a.part AS owner, concat('rId', b.n % 2 + 1) AS id, b.part, 'Internal' AS mode FROM p a JOIN p b ON a.doc = b.doc AND floor(b.n / 2) = a.n
  UNION ALL SELECT a.doc, a.part, 'rId5', b.part, 'Internal' FROM p a JOIN p b ON a.doc = b.doc AND b.n = a.n - a.k % 3 WHERE a.k % 4 = 0
  UNION ALL SELECT doc, part, 'rId3', 'word/lost', 'Internal' FROM p WHERE k % 7 = 0
  UNION ALL SELECT doc, part, 'rId4', 'http://x', 'External' FROM p WHERE k % 5 = 0"""
_THERE = """SELECT doc, part, CASE WHEN k % 5 = 0 THEN digest ELSE 'other' END AS digest FROM p WHERE k % 2 = 0
  UNION ALL SELECT doc, replace(part, '.xml', '_src1.xml'), 'old' FROM p WHERE k % 6 = 0"""

# The rows of _EDGES without a join: a part stands in its own place, and asks who stands in the places that it is tied to.
_TIES = """SELECT doc, CASE WHEN id = 'rId5' THEN part ELSE there END AS owner, id, CASE WHEN id = 'rId5' THEN there ELSE part END AS part, 'Internal' AS mode
  FROM (SELECT *, max(CASE WHEN id IS NULL THEN part END) OVER (PARTITION BY doc, place) AS there
        FROM (SELECT doc, part, inline(array(struct(CAST(NULL AS STRING) AS id, n AS place), struct(concat('rId', n % 2 + 1) AS id, CAST(floor(n / 2) AS INT) AS place),
                                             struct(CASE WHEN k % 4 = 0 THEN 'rId5' END AS id, CASE WHEN k % 4 = 0 THEN n - k % 3 END AS place))) FROM {dealt}) WHERE place IS NOT NULL)
  WHERE id IS NOT NULL AND there IS NOT NULL
  UNION ALL SELECT doc, part, 'rId3', 'word/lost', 'Internal' FROM {p} WHERE k % 7 = 0
  UNION ALL SELECT doc, part, 'rId4', 'http://x', 'External' FROM {p} WHERE k % 5 = 0"""


def _tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    n_rows = orders.count()
    p = written(spark.sql(_PARTS, orders=dealt(orders, ["o_custkey"], n_rows)), "packages")
    rels = spark.sql(_TIES, p=p, dealt=dealt(p.select("doc", "part", "k", "n"), ["doc"], n_rows))
    there = spark.sql(f"WITH p AS (SELECT * FROM {{p}}) {_THERE}", p=p)
    return p.select("doc", "part", "digest"), rels, p.where("n = 1").select("doc", "part"), there


_NAMES = f"""
WITH RECURSIVE p AS ({_PARTS.format(orders="orders")}), e AS ({_EDGES}),
c AS (SELECT doc, part, 1 AS round FROM p WHERE n = 1
      UNION SELECT c.doc, e.part, c.round + 1 FROM c JOIN e ON e.doc = c.doc AND e.owner = c.part JOIN p ON p.doc = e.doc AND p.part = e.part WHERE c.round < 60),
r AS (SELECT doc, part, min(round) AS round FROM c GROUP BY doc, part),
named AS (
  SELECT r.doc, r.part, r.round, CASE WHEN k % 2 = 1 OR k % 5 = 0 THEN r.part WHEN k % 6 = 0 THEN replace(r.part, '.xml', '_src2.xml') ELSE r.part || '_src1' END AS new_part, NOT (k % 2 = 0 AND k % 5 = 0) AS copied
  FROM r JOIN p ON p.doc = r.doc AND p.part = r.part)
"""


@query("part_closure_names", _NAMES + "SELECT doc, part, new_part, copied, CAST(round AS INT) AS round FROM named")
def part_closure_names(spark, sf_dir):
    """Every part that comes along and its name, over cyclic packages with clashes in every round."""
    return M.part_closure(*_tables(spark, sf_dir))[0]


@query(
    "part_closure_links",
    _NAMES
    + """SELECT e.doc, a.new_part AS owner, e.id, b.new_part AS part FROM e JOIN named a ON a.doc = e.doc AND a.part = e.owner JOIN named b ON b.doc = e.doc AND b.part = e.part WHERE e.mode = 'Internal'
UNION ALL SELECT e.doc, e.owner, 'missing', e.part FROM e JOIN named a ON a.doc = e.doc AND a.part = e.owner WHERE e.part = 'word/lost'""",
)
def part_closure_links(spark, sf_dir):
    """Relationships of the copied parts under their new names, and targets that are no part."""
    _, links, missing = M.part_closure(*_tables(spark, sf_dir))
    return links.unionByName(missing.select("doc", "owner", F.lit("missing").alias("id"), "part"))
