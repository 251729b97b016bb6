"""Closures with names against a plain walk, and closures by doubling against one by one."""

import random

from folioloom.operators import merges as M
from folioloom.operators import packages as K


def test_doubling_is_the_closure(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(30)] + [(30, 0), (5, 5), (None, 3), (3, None)] + [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(20)]
    edges = spark.createDataFrame(pairs, "src int, dst int")
    roots = spark.createDataFrame([(0,), (17,), (44,), (99,), (0,)], "root int")
    got = sorted(tuple(r) for r in K.closure_by_doubling(edges, roots, depth=True).collect())
    step = {}
    for a, b in pairs:
        if a is not None and b is not None:
            step.setdefault(a, set()).add(b)
    want = []
    for root in (0, 17, 44, 99):
        far, layer = {root: 0}, [root]
        while layer:
            layer = [b for a in layer for b in step.get(a, ()) if b not in far and not far.update({b: far[a] + 1})]
        want += [(root, n, d) for n, d in far.items()]
    assert got == sorted(want)
    assert K.closure_by_doubling(edges.limit(0), roots).count() == 4


def test_part_closure(spark):
    parts = [("d", p, p) for p in ("a.xml", "b.png", "c.png", "c_src1.png", "e")] + [("z", "a.xml", "1")]
    rels = [("d", "a.xml", "r1", "b.png", None), ("d", "b.png", "r1", "c.png", "Internal"), ("d", "c.png", "r1", "a.xml", "Internal"), ("d", "c.png", "r2", "c_src1.png", "Internal"), ("d", "b.png", "r2", "gone", "Internal"), ("d", "b.png", "r3", "http://x", "External"), ("d", "e", "r1", "a.xml", "Internal")]
    there = [("d", "a.xml", "a.xml"), ("d", "c.png", "other"), ("d", "b_src1.png", "x"), ("d", "b.png", "other")]
    tables = [
        spark.createDataFrame(parts, "doc string, part string, digest string"),
        spark.createDataFrame(rels, "doc string, owner string, id string, part string, mode string"),
        spark.createDataFrame([("d", "a.xml"), ("d", "a.xml"), ("z", "lost"), ("z", None)], "doc string, part string"),
        spark.createDataFrame(there, "doc string, part string, digest string"),
    ]
    names, links, missing = M.part_closure(*tables)
    assert sorted(tuple(r) for r in names.select("part", "new_part", "copied", "round").collect()) == [
        ("a.xml", "a.xml", False, 1),
        ("b.png", "b_src2.png", True, 2),
        ("c.png", "c_src1.png", True, 3),
        ("c_src1.png", "c_src1_src1.png", True, 4),  # its own name was taken a round before
    ]
    assert sorted(tuple(r) for r in links.select("owner", "id", "part").collect()) == [("a.xml", "r1", "b_src2.png"), ("b_src2.png", "r1", "c_src1.png"), ("c_src1.png", "r1", "a.xml"), ("c_src1.png", "r2", "c_src1_src1.png")]
    assert sorted((r.doc, r.part, r.owner) for r in missing.collect()) == [("d", "gone", "b.png"), ("z", "lost", None)]
    none = M.part_closure(tables[0], tables[1], tables[2].limit(0), tables[3])
    assert [t.count() for t in none] == [0, 0, 0]
