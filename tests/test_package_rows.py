"""Packages that are followed as one row, and larger ones in rounds, against a walk round by round."""

import random
import re

import pytest
from test_round_names import NAMES, _walk

from folioloom.operators import merges as M
from folioloom.plans import catalogue
from folioloom.plans import package_queries as Q

SF = "/root/testdata/sf0.001"
TYPES = ("doc string, part string, digest string", "doc string, owner string, id string, part string, mode string", "doc string, part string", "doc string, part string, digest string")
COLUMNS = ("doc", "part", "new_part", "copied", "round")


def _tables(spark, rows):
    return [spark.createDataFrame(r, t) for r, t in zip(rows, TYPES, strict=True)]


def _names(tables):
    return sorted(tuple(r) for r in M.part_closure(*tables)[0].select(*COLUMNS).collect())


@pytest.mark.parametrize("most", [0, 25, 250])
def test_every_size_gives_the_walk(spark, monkeypatch, most):
    rng, rows, want, sizes = random.Random(3), ([], [], [], []), [], []
    for d in range(60):
        parts = {p: rng.choice("xyz") for p in rng.sample(NAMES, rng.randint(1, len(NAMES)))}
        leads = {p: rng.sample(NAMES, rng.randint(0, 2)) for p in parts}
        roots, there = rng.sample(NAMES, 2), {p: rng.choice("xyz") for p in rng.sample([*NAMES, "a_src3.xml"], rng.randint(0, 6))}
        want += [(f"d{d}", p, *x) for p, x in _walk(parts, leads, roots, there).items()]
        new = (parts.items(), [(p, f"r{i}", t, None) for p, ts in leads.items() for i, t in enumerate(ts)], [(r,) for r in roots], there.items())
        sizes.append(sum(map(len, new)))
        for table, more in zip(rows, new, strict=True):
            table += [(f"d{d}", *x) for x in more]
    kinds, plain = [], M.written
    monkeypatch.setattr(M, "PACKAGE_ROWS", most)
    monkeypatch.setattr(M, "written", lambda df, name: kinds.append(name) or plain(df, name))
    assert _names(_tables(spark, rows)) == sorted(want)
    assert min(sizes) < 25 < max(sizes) < 250 and ("round" in kinds) == (most < 250)


def test_odd_rows_are_the_same_in_both_ways(spark, monkeypatch):
    parts = [("d", "a", "1"), ("d", "b", "2"), ("d", "b", "3"), ("d", "c", None), ("d", None, "4"), (None, "a", "5"), ("e", "a", "6")]
    rels = [("d", "a", "r1", "b", None), ("d", "b", "r2", "c", None), ("d", None, "r3", "c", None), ("d", "a", "r4", None, None), (None, "a", "r5", "a", None), ("e", "a", "r6", "gone", None), ("f", "x", "r7", "y", None)]
    roots = [("d", "a"), ("d", "a"), ("d", None), (None, "a"), ("e", "a"), ("g", "h")]
    there = [("d", "b", "2"), ("d", "c", None), ("e", "a", "7"), ("e", "a", "8"), ("e", None, "9"), (None, "a", "1")]
    tables, ways = _tables(spark, [parts, rels, [r for r in roots if r[1]], there]), []
    for most in (0, 250):
        monkeypatch.setattr(M, "PACKAGE_ROWS", most)
        found = M._found(tables[0], tables[1].where("part IS NOT NULL"), *tables[2:])
        ways.append(sorted(map(str, found.select("doc", "part", "digest", "round", "held", "there").collect())))
    assert ways[0] == ways[1] and len(ways[0]) == 6


def test_depth_adds_no_written_table(spark, monkeypatch):
    counts, plain = [], M.written
    for deep in (3, 40):
        kinds = []
        monkeypatch.setattr(M, "written", lambda df, name, kinds=kinds: kinds.append(name) or plain(df, name))
        parts = [("d", f"p{i}", "x") for i in range(deep)]
        rels = [("d", f"p{i}", "r", f"p{i + 1}", None) for i in range(deep - 1)] + [("d", f"p{deep - 1}", "r", "p0", None)]
        assert _names(_tables(spark, [parts, rels, [("d", "p0")], [("d", "z", "x")]])) == sorted(("d", f"p{i}", f"p{i}", True, i + 1) for i in range(deep))
        counts.append(len(kinds))
    assert counts[0] == counts[1]


def test_relationships_are_made_in_one_shuffle(spark):
    rels = Q._tables(spark, SF)[1]
    p = catalogue.made(spark, SF, Q._PARTS, "orders")
    want = spark.sql(f"WITH p AS (SELECT * FROM {{p}}) {Q._EDGES}", p=p)
    columns = ["doc", "owner", "id", "part", "mode"]
    assert sorted(map(tuple, rels.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))
    plan = rels._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and len(re.findall(r"Exchange \w+\(doc", plan)) == plan.count("Exchange ") == 1
