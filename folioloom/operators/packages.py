"""Packages: parts in zip containers, relationships, closures, and merges of ids."""

from __future__ import annotations

import hashlib
import io
import posixpath
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioloom.operators.ordered import number_rows
from folioloom.tables import written


def parts(files: DataFrame) -> DataFrame:
    """(path, part, size, sha256, content) of every part; files are (path, content) of zip packages.

    An unreadable package gives one row whose part is null, so that it can't stop a batch.
    """

    def work(batches):
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for name in sorted(z.namelist()):
                            data = z.read(name)
                            rows.append((path, name, len(data), hashlib.sha256(data).hexdigest().upper(), data))
                except zipfile.BadZipFile:
                    rows.append((path, None, None, None, None))
            yield pd.DataFrame(rows, columns=["path", "part", "size", "sha256", "content"])

    return files.select("path", "content").mapInPandas(work, "path string, part string, size bigint, sha256 string, content binary")


@F.pandas_udf(StringType())
def resolve(owner: pd.Series, target: pd.Series) -> pd.Series:
    """A relationship's target as a part name: from the root if it begins with /, else beside its owner."""

    def one(o, t):
        if t is None:
            return None
        return posixpath.normpath(t.lstrip("/") if t.startswith("/") else posixpath.join(posixpath.dirname(o or ""), t))

    return pd.Series([one(o, t) for o, t in zip(owner, target, strict=True)])


def broken_relationships(rels: DataFrame, package_parts: DataFrame) -> DataFrame:
    """Internal relationships whose target isn't a part; rels are (path, owner, id, target, mode)."""
    inner = rels.where("coalesce(mode, 'Internal') <> 'External'").withColumn("part", resolve("owner", "target"))
    return inner.join(package_parts.select("path", "part"), ["path", "part"], "left_anti")


def closure(edges: DataFrame, roots: DataFrame, rounds: int | None = None, depth: bool = False) -> DataFrame:
    """(root, node), and if asked the fewest steps to it: every node that can be reached, the root included.

    Cycles end by the anti join with what is known.  Rounds go on until nothing is new; where
    ``rounds`` bounds them and nodes are left, it raises, so no closure is ever returned in part.
    """
    step = edges.select(F.col("src").alias("node"), F.col("dst").alias("next")).where("node IS NOT NULL AND next IS NOT NULL").distinct()
    step = written(step, "edges")
    known = written(roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).distinct(), "closure")
    fresh, k = known, 0
    while True:
        k += 1
        found = fresh.join(step, "node").select("root", F.col("next").alias("node")).distinct().join(known, ["root", "node"], "left_anti")
        fresh = written(found.withColumn("depth", F.lit(k)), "frontier")
        if fresh.isEmpty():
            return known if depth else known.drop("depth")
        if rounds is not None and k > rounds:
            raise ValueError(f"closure: nodes over {rounds} steps from their root")
        known = known.unionByName(fresh)
        if k % 16 == 0:  # a plan of few tables, however deep the graph
            known = written(known, "closure")


def remap_ids(required: DataFrame, used: DataFrame) -> DataFrame:
    """(id, new_id): ids that collide with used ones move, in order, beyond the greatest of both."""
    top = used.unionByName(required).agg(F.max("id").alias("top"))
    hit = number_rows(required.join(used.distinct(), "id", "left_semi"), ["id"], "k")
    moved = hit.join(F.broadcast(top), F.lit(True)).select("id", (F.col("top") + F.col("k")).alias("moved"))
    return required.join(moved, "id", "left").select("id", F.coalesce("moved", "id").cast("long").alias("new_id"))


def remap_fold(required: Column, used: Column) -> Column:
    """As the sequential rule has it: each collision takes the least free id above all taken so far."""
    start = F.struct(used.alias("taken"), F.array().cast("array<struct<id:bigint,new_id:bigint>>").alias("map"))

    def step(acc: Column, i: Column) -> Column:
        new = F.when(F.array_contains(acc["taken"], i), F.array_max(acc["taken"]) + 1).otherwise(i)
        return F.struct(F.concat(acc["taken"], F.array(new)).alias("taken"), F.concat(acc["map"], F.array(F.struct(i.alias("id"), new.alias("new_id")))).alias("map"))

    return F.aggregate(F.sort_array(required), start, step, lambda a: a["map"])


def closure_by_doubling(edges: DataFrame, roots: DataFrame, depth: bool = False) -> DataFrame:
    """As :func:`closure`, in rounds that follow the logarithm of the longest shortest path.

    All pairs within L steps are known with their fewest steps; a pair at L + 1 to 2 L steps has a
    node just L steps from its beginning, so the next round joins the pairs of exactly L steps with
    all.  It works on the closure of every node, so it is for roots that are a fair part of the
    nodes; for few roots of a large graph :func:`closure` does less.  Null ends are ignored.
    """
    step = edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()
    pairs = written(step.withColumn("depth", F.lit(1)), "steps")
    reach, length = pairs, 1
    while True:
        left = reach.where(F.col("depth") == length).select("src", F.col("dst").alias("mid"))
        right = reach.select(F.col("src").alias("mid"), "dst", F.col("depth").alias("more"))
        found = left.join(right, "mid").where("src <> dst").groupBy("src", "dst").agg((F.min("more") + length).alias("depth"))
        new = written(found.join(reach.select("src", "dst"), ["src", "dst"], "left_anti"), "steps")
        if new.isEmpty():
            break
        reach, length = reach.unionByName(new), 2 * length
    own = roots.select("root").distinct()
    far = own.join(reach, own["root"] == reach["src"]).select("root", F.col("dst").alias("node"), "depth")
    whole = own.select("root", F.col("root").alias("node"), F.lit(0).alias("depth")).unionByName(far)
    return whole if depth else whole.drop("depth")


#: Steps of a walk in one written round; roots and nodes that meet in one block of an expansion.
STEPS_AT_ONCE, BLOCK_SIDE = 4, 1000


def _settled(start: DataFrame, step, name: str) -> DataFrame:
    """``start`` after ``step`` changes nothing more; a step only adds rows, or raises labels."""
    now = written(start, name)
    while True:
        then = now
        for _ in range(STEPS_AT_ONCE):
            then = step(then)
        then = written(then, name)
        if then.join(now, now.columns, "left_anti").isEmpty():
            return then
        now = then


def strong_groups(step: DataFrame) -> DataFrame:
    """(node, rep) of nodes of step(src, dst) that surely reach each other: those of one ``rep``.

    A node's color is the greatest node that reaches it.  What reaches a color's own node inside the color is one
    strongly connected component, whole.  Components that no color stands for are left as single nodes.
    """
    nodes = step.select(F.col("src").alias("node")).union(step.select("dst")).distinct()

    def raised(labels: DataFrame) -> DataFrame:
        pushed = labels.join(step, labels["node"] == step["src"]).select(F.col("dst").alias("node"), "rep")
        return labels.unionByName(pushed).groupBy("node").agg(F.max("rep").alias("rep"))

    colors = _settled(nodes.withColumn("rep", F.col("node")), raised, "colors")
    ends = step.join(colors.select(F.col("node").alias("src"), F.col("rep").alias("a")), "src").join(colors.select(F.col("node").alias("dst"), F.col("rep").alias("b")), "dst")
    back = written(ends.where("a = b").select(F.col("dst").alias("node"), F.col("src").alias("prior")), "back")
    widened = lambda held: held.unionByName(held.join(back, "node").select(F.col("prior").alias("node"), "rep")).distinct()
    return _settled(colors.where("node = rep"), widened, "groups")


def closure_by_components(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """As :func:`closure`, for graphs with large cycles: nodes that reach each other are one node while the closure is taken.

    What is left of the graph has few edges, so no round joins all pairs with all.  Pairs of roots and nodes are made at the end,
    in blocks of bounded size, as the result itself may grow with the square of the nodes.  Null ends are ignored.
    """
    step = written(edges.select("src", "dst").where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct(), "steps")
    groups = strong_groups(step)
    named = lambda df, c, to: df.join(groups.select(F.col("node").alias(c), F.col("rep").alias("__rep")), c, "left").withColumn(to, F.coalesce("__rep", c)).drop("__rep")
    few = named(named(step, "src", "a"), "dst", "b").where("a <> b").select(F.col("a").alias("src"), F.col("b").alias("dst")).distinct()
    own = written(named(roots.select("root").distinct(), "root", "from"), "roots")
    reach = closure_by_doubling(few, own.select(F.col("from").alias("root"))).select(F.col("root").alias("from"), F.col("node").alias("rep"))
    nodes = step.select(F.col("src").alias("node")).union(step.select("dst")).union(own.select("root")).distinct()
    members = named(nodes, "node", "rep")
    led = written(own.join(reach, "from").select("root", "rep"), "led")
    size = lambda df, n: df.groupBy("rep").agg(F.ceil(F.count("*") / BLOCK_SIDE).cast("int").alias(n))
    blocks = size(led, "n_roots").join(size(members, "n_nodes"), "rep")
    dealt = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = led.join(blocks, "rep").select("root", "rep", dealt("root", "n_roots").alias("i"), every("n_nodes").alias("j"))
    right = members.join(blocks, "rep").select("node", "rep", every("n_roots").alias("i"), dealt("node", "n_nodes").alias("j"))
    keys, spark = ["rep", "i", "j"], edges.sparkSession
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # few rows in, many out
    return left.repartition(parts, *keys).join(right.repartition(parts, *keys), keys).select("root", "node")
