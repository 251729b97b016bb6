"""The hash tree against a plain recursion, at block sizes that force several rounds."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from folioloom.llm import merkle


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def paths(nodes):
    """[(siblings before and after, level by level)] and the root of one tree."""
    own, level = [(k, []) for k in range(len(nodes))], list(nodes)
    at = list(range(len(nodes)))
    while len(level) > 1:
        for k, (_, path) in enumerate(own):
            r = at[k] // 3 * 3
            path.append(("".join(level[r : at[k]]), "".join(level[at[k] + 1 : r + 3])))
            at[k] //= 3
        level = [sha("".join(level[r : r + 3])) for r in range(0, len(level), 3)]
    return [p for _, p in own], level[0]


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text) -> sorted (doc_id, leaf, subroot, root, path)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0], plain_leaf(*r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        subs[s] = paths([h for _, h in groups[s]])
    tops, root = paths([subs[s][1] for s in order])
    out = []
    for s, top in zip(order, tops, strict=True):
        for (doc, h), p in zip(groups[s], subs[s][0], strict=True):
            out.append((str(doc), h, subs[s][1], root, p + top))
    return sorted(out)


RNG = random.Random(5)
SOURCES = [None, "", "a", "é", "Z", "hot", "hot", "hot", "hot"]
ROWS = [(k, RNG.choice(SOURCES), RNG.choice(["en", None]), RNG.randint(0, 9), RNG.choice(["", None, "a\nb", "é" * 40])) for k in range(120)]
ROWS += [ROWS[3], ROWS[3], (None, "hot", None, None, None), (None, None, "en", 1, "x"), (-7, "hot", "en", 2, "y\n")]
SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("depth", [2, 6])
def test_against_plain_recursion(spark, depth):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = merkle.manifest(docs, depth=depth).collect()
    assert sorted((str(r.doc_id), r.leaf, r.subroot, r.root, [tuple(x) for x in r.path]) for r in got) == brute(ROWS)


def test_one_leaf_and_no_rows(spark):
    one = merkle.manifest(spark.createDataFrame(ROWS[:1], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root and one.path == []
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tampering_is_seen(spark):
    rows = merkle.verified(merkle.manifest(spark.createDataFrame(ROWS, SCHEMA)), F.col("leaf"))
    assert rows.where("NOT verified").isEmpty()
    changed = merkle.leaf_of(*[F.upper("text") if c == "text" else F.col(c) for c in merkle.LEAF])
    found = merkle.verified(merkle.manifest(spark.createDataFrame(ROWS, SCHEMA)), changed).collect()
    assert all(r.verified == (r.text is None or r.text.upper() == r.text) for r in found)


def test_columns_of_clashing_names_pass_through(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 AS __g", "2 AS __pos", "3 AS leaf", "4 AS extra")
    got = merkle.manifest(docs)
    assert set(got.columns) == {*SCHEMA.replace(",", "").split()[::2], "__g", "__pos", "extra", "leaf", "subroot", "root", "path"}
    rows = got.collect()
    assert {(r["__g"], r["__pos"], r["extra"]) for r in rows} == {(1, 2, 4)}
    assert sorted(r.leaf for r in rows) == sorted(x[1] for x in brute(ROWS))
