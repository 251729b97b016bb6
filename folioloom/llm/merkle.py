"""Merkle manifest of a table: one hash tree per group, and one over the groups' roots (native).

Nodes stand in blocks of a fixed size that is a power of the fan-out; a block is one row with
an ordered array of digests, and ``transform``, ``slice`` and ``aggregate`` collapse its levels
in the row.  Roots of full blocks are the nodes of the next round, so the rounds follow the
logarithm of the largest group to the base of the block size, and each is a table written in
the shared folder.  Going back down, a block learns the path above it by one join per round, and a
row's own part of its path is made in the row: paths are never shuffled row by row.  No group
meets in one task, however large: positions come from ranges and blocks have a bounded size.

Defined cases: null groups come first, null ids come first in their group, and rows of one id
are ordered by their leaf, so repeated rows get equal leaves and neighbouring places.  A null
value is ``-`` in a leaf and differs from the empty text.  An empty table has no rows and no root.
Further columns of the table pass through :func:`manifest` unchanged; a column with the name of
an added one is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioloom.llm import store
from folioloom.llm.names import put_back, set_apart

LEAF = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT, DEPTH = 3, 6
ADDED = ("leaf", "subroot", "root", "path")
PATH = "array<struct<before:string,after:string>>"


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as part of a leaf: ``-`` for null, else its UTF-8 length, a colon and the value."""
    s = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_of(*values: Column) -> Column:
    return sha256(F.concat(*[field(v) for v in values]))


def group_key(value: Column) -> Column:
    """A string that is never null and sorts as the values do, null first."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("-"))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda h, step: sha256(F.concat(step["before"], h, step["after"])))


def siblings(path: Column) -> Column:
    """All digests of a path in order, as one string."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


@dataclass(frozen=True)
class Forest:
    """``rounds``: tables of blocks (__g, __n, __block, __nodes, __levels); ``roots``: (__g, __root)."""

    rounds: tuple[DataFrame, ...]
    roots: DataFrame
    size: int


def _placed(nodes: DataFrame, order: list[str]) -> DataFrame:
    """nodes plus __pos (from 0 inside its group) and __n (size of the group), dealt by range and written."""
    ranged = nodes.repartitionByRange("__g", *order).sortWithinPartitions("__g", *order)
    ranged = store.materialize(ranged.withColumn("__at", F.monotonically_increasing_id()), "ordered")
    ranged = ranged.withColumn("__part", F.shiftright("__at", 33))
    spans = ranged.groupBy("__g", "__part").agg(F.min("__at").alias("__first"), F.count("*").alias("__rows"))
    w = Window.partitionBy("__g")
    before = F.coalesce(F.sum("__rows").over(w.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    spans = spans.select("__g", "__part", (before - F.col("__first")).alias("__shift"), F.sum("__rows").over(w).alias("__n"))
    placed = ranged.join(spans, ["__g", "__part"])
    return placed.withColumn("__pos", F.col("__at") + F.col("__shift")).drop("__at", "__part", "__shift")


def _collapse(level: Column, fanout: int) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / F.lit(fanout)).cast("int"))
    return F.transform(runs, lambda i: sha256(F.array_join(F.slice(level, i * fanout + 1, fanout), "")))


def _steps(fanout: int, depth: int) -> Column:
    """Levels above the nodes inside one block: as many as the whole group has, ``depth`` at most."""
    return sum((F.col("__n") > fanout**k).cast("int") for k in range(depth))


def _blocks(placed: DataFrame, fanout: int, depth: int) -> DataFrame:
    block = F.floor(F.col("__pos") / F.lit(fanout**depth)).cast("long")
    rows = placed.groupBy("__g", "__n", block.alias("__block")).agg(F.sort_array(F.collect_list(F.struct("__pos", "__h", "__row"))).alias("__nodes"))
    turns = F.slice(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), _steps(fanout, depth))
    first = F.array(F.transform("__nodes", lambda x: x["__h"]))
    levels = F.aggregate(turns, first, lambda had, _: F.concat(had, F.array(_collapse(F.element_at(had, -1), fanout))))
    return store.materialize(rows.withColumn("__levels", levels), "blocks")


def _root() -> Column:
    return F.element_at(F.element_at("__levels", -1), 1)


def grow(nodes: DataFrame, order: list[str], fanout: int = FANOUT, depth: int = DEPTH) -> Forest:
    """Trees of ``nodes`` (__g: group, __h: digest, __row: what comes along), ordered inside their group."""
    size, rounds = fanout**depth, []
    placed = _placed(nodes, order)
    while True:
        blocks = _blocks(placed.select("__g", "__n", "__pos", "__h", "__row"), fanout, depth)
        rounds.append(blocks)
        if blocks.where(F.col("__n") > size).isEmpty():
            break
        above = F.ceil(F.col("__n") / F.lit(size)).cast("long")
        placed = blocks.where(F.col("__n") > size).select(
            "__g", above.alias("__n"), F.col("__block").alias("__pos"), _root().alias("__h"), F.lit(None).cast("int").alias("__row")
        )
    roots = None
    for blocks in rounds:
        done = blocks.where(F.col("__n") <= size).select("__g", _root().alias("__root"))
        roots = done if roots is None else roots.unionByName(done)
    return Forest(tuple(rounds), roots, size)


def _members(blocks: DataFrame, fanout: int, depth: int) -> DataFrame:
    """One row a node: __g, __pos, __h, __row and its whole path, from a block table with ``__up``."""
    turns = F.slice(F.sequence(F.lit(0), F.lit(depth - 1)), F.lit(1), _steps(fanout, depth))
    power = F.array(*[F.lit(fanout**k) for k in range(depth)])

    def step(j: Column, s: Column) -> Column:
        level = F.get(F.col("__levels"), s)
        at = F.floor(j / F.get(power, s)).cast("int")
        before = F.slice(level, at - at % fanout + 1, at % fanout)
        after = F.slice(level, at + 2, fanout - 1 - at % fanout)
        return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))

    with_path = F.transform(
        "__nodes",
        lambda x, j: F.struct(x["__pos"].alias("__pos"), x["__h"].alias("__h"), x["__row"].alias("__row"), F.transform(turns, lambda s: step(j, s)).alias("__own")),
    )
    one = blocks.select("__g", "__up", *[c for c in ("__root",) if c in blocks.columns], F.explode(with_path).alias("__x"))
    path = F.concat("__x.__own", "__up").cast(PATH)
    return one.select("__g", *[c for c in ("__root",) if c in blocks.columns], "__x.__pos", "__x.__h", "__x.__row", path.alias("__path"))


def descend(forest: Forest, top: DataFrame | None = None, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """One row a node of the lowest level with its path: inside its tree, then ``top``'s (__g, __up, __root)."""
    none = F.array().cast(PATH)
    above = None
    for blocks in reversed(forest.rounds):
        single = blocks.where(F.col("__n") <= forest.size)
        if top is not None:
            single = single.join(top, "__g")
        else:
            single = single.withColumns({"__up": none, "__root": _root()})
        if above is None:
            joined = single
        else:
            split = blocks.where(F.col("__n") > forest.size)
            up = above.select("__g", F.col("__pos").alias("__block"), F.col("__path").alias("__up"), "__root")
            joined = single.unionByName(split.join(up, ["__g", "__block"]))
        above = _members(joined, fanout, depth)
    return above


def manifest(documents: DataFrame, columns: tuple[str, ...] = LEAF, group: str = "source", order: str = "doc_id", fanout: int = FANOUT, depth: int = DEPTH, carry: list[str] | None = None) -> DataFrame:
    """One row a document: the columns ``carry`` (all of them if not given), leaf, subroot, root and path.

    ``path`` lists, level by level up to the root, the digests before and after the node in its
    run of ``fanout``; :func:`fold` of it gives the root again.
    """
    documents, names = set_apart(documents)
    leaf = leaf_of(*[F.col(f"`{c}`") for c in columns])
    own = [c for c in (carry if carry is not None else documents.columns) if c.lower() not in ADDED]
    row = F.struct(*[F.col(f"`{c}`") for c in own]) if own else F.lit(None).cast("int")
    nodes = documents.select(group_key(F.col(f"`{group}`")).alias("__g"), F.col(f"`{order}`").alias("__k"), leaf.alias("__h"), row.alias("__row"))
    trees = grow(nodes, ["__k", "__h"], fanout, depth)
    roots = trees.roots.select(F.lit("").alias("__g"), F.col("__g").alias("__k"), F.col("__root").alias("__h"), F.struct(F.col("__g").alias("source"), F.col("__root").alias("subroot")).alias("__row"))
    sources = descend(grow(roots, ["__k"], fanout, depth), None, fanout, depth)
    top = sources.select(F.col("__row.source").alias("__g"), F.col("__path").alias("__up"), F.struct(F.col("__row.subroot").alias("sub"), F.col("__root").alias("all")).alias("__root"))
    members = descend(trees, store.materialize(top, "subroots"), fanout, depth)
    kept = ["__row.*"] if own else []
    out = members.select(*kept, F.col("__h").alias("leaf"), F.col("__root.sub").alias("subroot"), F.col("__root.all").alias("root"), F.col("__path").alias("path"))
    return put_back(out, names)


def verified(rows: DataFrame, leaf: Column, names: tuple[str, str] = ("folded_root", "verified")) -> DataFrame:
    """rows of :func:`manifest` plus the root that ``leaf`` gives on their path, and whether it is theirs."""
    return rows.withColumn(names[0], fold(leaf, F.col("path"))).withColumn(names[1], F.col(names[0]) == F.col("root"))


def op13_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*LEAF)
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(changed, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    docs = docs.withColumn("seen", leaf_of(*[text if c == "text" else F.col(c) for c in LEAF]))
    rows = manifest(docs, carry=["doc_id", "seen"]).withColumn("proof_sha256", sha256(siblings(F.col("path"))))
    return verified(rows, F.col("seen")).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


#: The table of a byte's CRC-32 and the sum of a decimal, as DuckDB expressions.
CRC_TABLE = """crc_bytes AS (
  SELECT list(c ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c
    FROM range(256) AS r(i)))"""
CRC_OF = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length({s}) + 1), lambda k: CAST(ascii(substr({s}, k, 1)) AS BIGINT))),
    lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1])), 4294967295)"""


def _field(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"


def _steps_sql(own: str, tree: str) -> str:
    return f"""SELECT o.rid, l.lv, coalesce(string_agg(t.h, '' ORDER BY t.p) FILTER (t.p < o.p // l.w), '') || '|'
      || coalesce(string_agg(t.h, '' ORDER BY t.p) FILTER (t.p > o.p // l.w), '') AS step
    FROM {own} o JOIN (SELECT s, lv, CAST(pow(3, lv) AS BIGINT) AS w FROM {tree} GROUP BY s, lv HAVING count(*) > 1) l ON l.s = o.s
    JOIN {tree} t ON t.s = o.s AND t.lv = l.lv AND t.p // 3 = o.p // l.w // 3 GROUP BY o.rid, l.lv"""


OP13_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT row_number() OVER () AS rid, *, CASE WHEN {CRC_OF.format(s="CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen_text
      FROM documents, crc_bytes),
e AS (SELECT rid, doc_id, coalesce('=' || source, '-') AS s, sha256({' || '.join(_field(c) for c in LEAF)}) AS h,
             sha256({' || '.join(_field(c) for c in (*LEAF[:-1], "seen_text"))}) AS seen FROM d),
a AS (SELECT rid, doc_id, s, h, seen, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS p FROM e),
tree(s, lv, p, h) AS (
  SELECT s, 0, p, h FROM a
  UNION ALL
  SELECT s, lv + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)) FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM tree) WHERE n > 1 GROUP BY s, lv, p // 3),
sub AS (SELECT s AS src, max_by(h, lv) AS h FROM tree GROUP BY s),
b AS (SELECT src AS rid, '' AS s, h, row_number() OVER (ORDER BY src) - 1 AS p FROM sub),
tops(s, lv, p, h) AS (
  SELECT s, 0, p, h FROM b
  UNION ALL
  SELECT s, lv + 1, p // 3, sha256(string_agg(h, '' ORDER BY p)) FROM (SELECT *, count(*) OVER (PARTITION BY s) AS n FROM tops) WHERE n > 1 GROUP BY s, lv, p // 3),
low AS ({_steps_sql("a", "tree")}),
high AS ({_steps_sql("b", "tops")}),
lows AS (SELECT rid, list(step ORDER BY lv) AS ls FROM low GROUP BY rid),
highs AS (SELECT rid, list(step ORDER BY lv) AS ls FROM high GROUP BY rid),
r AS (SELECT a.doc_id, a.h AS leaf, a.seen, sub.h AS subroot, (SELECT max_by(h, lv) FROM tops) AS root,
             list_concat(coalesce(lows.ls, CAST([] AS VARCHAR[])), coalesce(highs.ls, CAST([] AS VARCHAR[]))) AS ls
      FROM a JOIN sub ON sub.src = a.s LEFT JOIN lows ON lows.rid = a.rid LEFT JOIN highs ON highs.rid = a.s),
f AS (SELECT *, list_reduce(list_prepend(seen, ls), lambda x, y: sha256(split_part(y, '|', 1) || x || split_part(y, '|', 2))) AS folded_root FROM r)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(ls, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM f
"""
