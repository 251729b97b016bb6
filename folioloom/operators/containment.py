"""Which texts hold which anchors: all anchors of a block are looked for in one pass over a text.

The automaton follows the text letter by letter: a node is a beginning of some anchor, and where no
anchor goes on with the next letter it falls back to the longest end of what was read that
begins one.  A text costs its length, however many anchors there are.

An anchor is held where it stands anywhere, inside words too.  Null and empty anchors are held by
no text, a null text holds none, and repeated anchors and texts each count.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType

from folioloom.tables import written

#: Letters of anchors in one automaton; a node takes some 300 bytes.
BLOCK_LETTERS = 200_000


class Automaton:
    def __init__(self, anchors):
        """``anchors``: different texts, none of them empty."""
        self.go: list[dict[str, int]] = [{}]
        self.ends: list[tuple[int, ...]] = [()]
        self.back = [0]
        for k, anchor in enumerate(anchors):
            node = 0
            for letter in anchor:
                if letter not in self.go[node]:
                    self.go[node][letter] = len(self.go)
                    self.go.append({})
                    self.ends.append(())
                    self.back.append(0)
                node = self.go[node][letter]
            self.ends[node] += (k,)
        todo = deque(self.go[0].values())
        while todo:
            node = todo.popleft()
            for letter, child in self.go[node].items():
                at = self.back[node]
                while at and letter not in self.go[at]:
                    at = self.back[at]
                to = self.go[at].get(letter, 0)
                self.back[child] = to
                self.ends[child] += self.ends[to]
                todo.append(child)

    def held(self, text: str) -> set[int]:
        """Numbers of the anchors that stand in ``text``."""
        go, back, ends, node, found = self.go, self.back, self.ends, 0, set()
        for letter in text:
            while (to := go[node].get(letter)) is None and node:
                node = back[node]
            node = to or 0
            if ends[node]:
                found.update(ends[node])
        return found


@F.pandas_udf(ArrayType(BooleanType()))
def _holds(text, anchors):
    import pandas as pd

    def one(t, wanted):
        if wanted is None:
            return None
        different = list({a for a in wanted if a})
        there = {different[k] for k in Automaton(different).held(t or "")}
        return [a in there for a in wanted]

    return pd.Series([one(t, a) for t, a in zip(text, anchors, strict=True)])


def holds(text: Column, anchors: Column) -> Column:
    """For each of a row's own anchors whether its text holds it."""
    return _holds(text, anchors)


def containment(texts: DataFrame, anchors: DataFrame, key: str, anchor: str, doc: str, text: str, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """(key, doc) for every anchor and text that holds it.

    Anchors are dealt into blocks by their hash, as many as their letters ask for; each block is
    broadcast by itself and looked for in all texts, and what it finds is written before the next.
    """
    spark = texts.sparkSession
    named = anchors.select(F.col(key).alias("key"), F.col(anchor).alias("anchor")).where("length(anchor) > 0")
    letters = named.agg(F.sum(F.length("anchor"))).first()[0] or 0
    n = max(1, -(-letters // block_letters))
    named = written(named.withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(n))), "anchors") if n > 1 else named.withColumn("block", F.lit(0))
    rows = texts.select(F.col(doc).alias("doc"), F.col(text).alias("text")).where("text IS NOT NULL")
    fields = {"key": anchors.schema[key].dataType.simpleString(), "doc": texts.schema[doc].dataType.simpleString()}
    found = None
    for k in range(n):
        wanted = named.where(F.col("block") == k).select("key", "anchor").toArrow().to_pydict()
        names: dict[str, list] = {}
        for a, i in zip(wanted["anchor"], wanted["key"], strict=True):
            names.setdefault(a, []).append(i)
        held = _found(rows, spark.sparkContext.broadcast(names), fields)
        held = written(held, "held") if n > 1 else held
        found = held if found is None else found.unionByName(held)
    return found.select(F.col("key").alias(key), F.col("doc").alias(doc))


def _found(rows: DataFrame, names, fields: dict[str, str]) -> DataFrame:
    schema = ", ".join(f"{c} {t}" for c, t in fields.items())
    types = rows.sparkSession.createDataFrame([], schema).schema

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        anchors = list(names.value)
        keys, automaton = [names.value[a] for a in anchors], Automaton(anchors)
        for batch in batches:
            pairs = [(i, d) for d, t in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist(), strict=True) for k in automaton.held(t) for i in keys[k]]
            yield pa.RecordBatch.from_pydict({f.name: pa.array([p[x] for p in pairs], to_arrow_type(f.dataType)) for x, f in enumerate(types)})

    return rows.mapInArrow(work, schema)


def numbering_review(checks: DataFrame, texts: DataFrame) -> DataFrame:
    """(doc, check_no, rule, value): checks(doc, check_no, anchor, label, options) that texts(doc, text) don't bear out.

    An anchor must be there; a label and options only where they are given.  A document without
    checks has no review (``review_missing``); checks of a document without text find nothing.
    All checks of a document go over its text once.
    """
    asked = checks.select("doc", "check_no", F.filter(F.concat(
        F.array(F.struct(F.lit("anchor_absent").alias("rule"), F.coalesce("anchor", F.lit("")).alias("value"))),
        F.array(F.struct(F.lit("label_absent").alias("rule"), F.coalesce("label", F.lit("")).alias("value"))),
        F.transform(F.coalesce("options", F.array().cast("array<string>")), lambda o: F.struct(F.lit("option_absent").alias("rule"), F.coalesce(o, F.lit("")).alias("value"))),
    ), lambda x: (x["rule"] != "label_absent") | (x["value"] != "")).alias("asked"))
    one = asked.select("doc", "check_no", F.explode("asked").alias("a")).select("doc", F.struct("check_no", "a.rule", "a.value").alias("a"))
    sets = one.groupBy("doc").agg(F.collect_list("a").alias("asked"))
    read = sets.join(texts.select("doc", "text"), "doc", "left").withColumn("there", holds(F.col("text"), F.col("asked.value")))
    # an empty option stands in every text
    lost = F.filter(F.transform("asked", lambda a, k: F.when(~(F.get(F.col("there"), k) | ((a["rule"] == "option_absent") & (a["value"] == ""))), a)), lambda a: a.isNotNull())
    wrong = read.select("doc", F.explode(lost).alias("a")).select("doc", "a.*")
    none = texts.select("doc").distinct().join(checks.select("doc"), "doc", "left_anti")
    return wrong.unionByName(none.select("doc", F.lit(None).cast("int").alias("check_no"), F.lit("review_missing").alias("rule"), F.lit("").alias("value")))
