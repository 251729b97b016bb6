"""A closure over large cycles is taken between components, and its pairs are those of a plain search."""

import random

from pyspark.sql import functions as F

from folioloom.operators import packages


def _plain(edges, roots):
    after = {}
    for a, b in edges:
        if a is not None and b is not None:
            after.setdefault(a, set()).add(b)
    found = set()
    for root in roots:
        seen, todo = {root}, [root]
        while todo:
            new = after.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        found |= {(root, n) for n in seen}
    return found


def test_components_give_the_pairs_of_a_search(spark, monkeypatch):
    monkeypatch.setattr(packages, "BLOCK_SIDE", 7)
    rng = random.Random(3)
    ring = [(k, (k + 1) % 40) for k in range(40)]
    tail = [(100 - k, 99 - k) for k in range(12)] + [(60, 100), (88, 3), (5, 200), (200, 201), (201, 202), (202, 200)]
    loose = [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(45)]
    edges = [*ring, *tail, *loose, (7, 7), (None, 3), (3, None)]
    roots = [*range(0, 40, 3), 60, 95, 201, 999, *range(300, 340, 2)]
    e = spark.createDataFrame(edges, "src long, dst long")
    r = spark.createDataFrame([(x,) for x in roots + roots[:3]], "root long")
    got = [(x["root"], x["node"]) for x in packages.closure_by_components(e, r).collect()]
    assert len(got) == len(set(got)) and set(got) == _plain(edges, roots)


def test_a_large_cycle_is_one_node_of_the_closure(spark, monkeypatch):
    """The pairs that rounds work on don't grow with the square of a cycle."""
    seen = []
    whole = packages.closure_by_doubling
    monkeypatch.setattr(packages, "closure_by_doubling", lambda edges, roots: seen.append((edges.count(), roots.distinct().count())) or whole(edges, roots))
    ids = spark.range(30).select(F.col("id").alias("src"), ((F.col("id") * 7 + 3) % 30).alias("dst"))
    near = spark.range(30).select(F.col("id").alias("src"), F.pmod(F.col("id") + 1, F.lit(30)).alias("dst"))
    assert packages.closure_by_components(ids.unionByName(near), spark.range(30).withColumnRenamed("id", "root")).count() == 900
    assert seen == [(0, 1)]
