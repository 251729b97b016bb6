"""Markup parts as tables of elements; inventories, tokens and gates are then plain aggregates.

A part that can't be parsed is one row with ``n`` null and ``error`` set, never a failed job.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioloom.operators.contracts import RowRule, row_violations

#: Elements handed on at once.
ROWS_AT_ONCE = 10_000
FOLDED = "path string, part string, elements array<struct<n int, parent int, depth int, tag string, text string, attrs map<string,string>>>, error string"

# Elements that are counted, and those that need a review or stop a merge.
COUNTED = {
    "paragraphs": "p", "runs": "r", "text_nodes": "t", "tables": "tbl", "num_properties": "numPr", "equations": "oMath", "equation_paragraphs": "oMathPara", "drawings": "drawing",
    "pictures": "pict", "sections": "sectPr", "saved_breaks": "lastRenderedPageBreak", "hyperlinks": "hyperlink", "bookmarks": "bookmarkStart", "fields": "fldSimple", "table_rows": "tr", "table_cells": "tc",
}
REVIEWED = {
    "altChunk": "altChunk", "object": "embedded_object", "footnoteReference": "footnotes", "endnoteReference": "endnotes", "commentReference": "comments",
    "dataBinding": "data_bound_content_control", "ins": "tracked_insertions", "del": "tracked_deletions",
}
STYLES, FONTS = ("pStyle", "rStyle", "tblStyle"), ("ascii", "hAnsi", "eastAsia", "cs")


@lru_cache(4096)
def _local(name: str) -> str:
    return name.rsplit("}", 1)[-1]


def _tree(content: bytes) -> list[tuple]:
    """(n, parent, depth, tag, text, attrs) of every element in document order."""
    out, todo = [], [(ET.parse(io.BytesIO(content)).getroot(), None, 0)]
    while todo:
        e, parent, depth = todo.pop()
        n, attrs = len(out), e.items()
        out.append((n, parent, depth, _local(e.tag), e.text, list({_local(k): v for k, v in attrs}.items()) if attrs else attrs))
        if len(e):
            todo += [(kid, n, depth + 1) for kid in e[::-1]]
    return out


def _parsed(parts: DataFrame, most: int | None) -> DataFrame:
    """Parts with arrays of at most ``most`` elements, or of all."""

    def work(batches):
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path, part, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                try:
                    tree = _tree(content or b"")
                except ET.ParseError as error:
                    rows.append((path, part, None, str(error)))
                    continue
                for k in range(0, len(tree), most or len(tree)):
                    rows.append((path, part, tree[k : k + (most or len(tree))], None))
                    held += len(rows[-1][2])
                    if held >= ROWS_AT_ONCE:
                        yield _batch(rows)
                        rows, held = [], 0
        yield _batch(rows)

    return parts.select("path", "part", "content").mapInArrow(work, FOLDED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    attrs = pa.map_(pa.string(), pa.string())
    element = pa.struct([("n", pa.int32()), ("parent", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("text", pa.string()), ("attrs", attrs)])
    types = (pa.string(), pa.string(), pa.list_(element), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], ["path", "part", "elements", "error"])


def folded(parts: DataFrame) -> DataFrame:
    """A row a part, its elements as one array in document order; rules of a document then need no shuffle of elements."""
    return _parsed(parts, None)


def elements(parts: DataFrame) -> DataFrame:
    """Every element of parts(path, part, content) in document order, by local names."""
    rows = _parsed(parts, ROWS_AT_ONCE).select("path", "part", F.explode_outer("elements").alias("e"), "error")
    return rows.select("path", "part", "e.*", "error")


def fold(elements: DataFrame) -> DataFrame:
    """The rows of :func:`folded` from those of :func:`elements`, which must be whole; rows that are folded already stay."""
    if "elements" in elements.columns:
        return elements
    one = F.when(F.col("n").isNotNull(), F.struct("n", "parent", "depth", "tag", "text", "attrs"))
    rows = elements.groupBy("path", "part").agg(F.array_sort(F.collect_list(one), lambda a, b: a["n"] - b["n"]).alias("elements"), F.max("error").alias("error"))
    return rows.withColumn("elements", F.when(F.size("elements") > 0, F.col("elements")))


def let(value: Column, f) -> Column:
    """``f`` of a value that is taken once, however often f's inner functions look at it."""
    return F.get(F.transform(F.array(value), f), 0)


def bodies(elements: Column) -> Column:
    """Numbers of the elements that are bodies: nearly always one."""
    return F.transform(F.filter(elements, lambda x: x["tag"] == "body"), lambda x: x["n"])


def innermost(bodies: Column, at: Column) -> Column:
    """The last of ``bodies`` that begins at or before an element."""
    return F.array_max(F.filter(bodies, lambda b: b <= at))


@F.pandas_udf(StringType())
def canonical_xml(text: pd.Series) -> pd.Series:
    """Canonical form, by which equal markup is told; null where it can't be parsed."""

    def one(t: str) -> str | None:
        try:
            return ET.canonicalize(t)
        except ET.ParseError:
            return None

    return text.map(one, na_action="ignore")


def malformed(elements: DataFrame) -> DataFrame:
    return elements.where("error IS NOT NULL").select("path", "part", "error")


def _value(default: str | None = None) -> Column:
    return F.coalesce(F.col("attrs")["val"], F.lit(default)) if default else F.col("attrs")["val"]


def token(tag: Column, text: Column, attrs: Column) -> Column:
    """What a reader sees of an element: its text, a tab, a break or a carriage return; else null."""
    return (
        F.when(tag == "t", F.concat(F.lit("T:"), F.coalesce(text, F.lit("")))).when(tag == "tab", "TAB")
        .when(tag == "br", F.concat(F.lit("BR:"), F.coalesce(attrs["type"], F.lit("textWrapping")))).when(tag == "cr", "CR")
    )


def visible_tokens(elements: DataFrame) -> DataFrame:
    """(path, part, n, token): text, tabs, breaks and carriage returns in document order."""
    return elements.select("path", "part", "n", token(F.col("tag"), F.col("text"), F.col("attrs")).alias("token")).where("token IS NOT NULL")


def inventory(elements: DataFrame) -> DataFrame:
    """One row a part: counts of its features, and its distinct styles, fonts, sizes and numberings in order."""
    tag, c = F.col("tag"), F.col
    counts = [F.count_if(tag == t).alias(name) for name, t in COUNTED.items()]
    fonts = F.when(tag == "rFonts", F.filter(F.array(*[c("attrs")[a] for a in FONTS]), lambda f: f.isNotNull() & ~f.startswith("+")))
    picked = lambda when, value: F.sort_array(F.collect_set(F.when(when, value)))
    rows = elements.withColumn("fonts", fonts)
    base = rows.groupBy("path", "part").agg(
        *counts, F.count_if((tag == "br") & (c("attrs")["type"] == "page")).alias("explicit_breaks"), F.coalesce(F.sum(F.when(tag == "t", F.length("text"))), F.lit(0)).alias("visible_characters"),
        picked(tag.isin(*STYLES), _value()).alias("styles"), picked(tag.isin("sz", "szCs"), _value().try_cast("double") / 2).alias("sizes"), picked(tag == "numId", _value().try_cast("int")).alias("numberings"),
        picked(tag.isin(*REVIEWED), tag).alias("reviewed"), F.max((tag == "updateFields").cast("int")).alias("update_fields"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("fonts")))).alias("fonts"),
    )
    names = F.create_map(*[F.lit(x) for pair in REVIEWED.items() for x in pair])
    return base.withColumn("reviewed", F.sort_array(F.transform("reviewed", lambda t: names[t]))).withColumn("update_fields", F.col("update_fields") == 1)


def feature(tag: Column) -> Column:
    """Name of a counted element; else null."""
    return F.create_map(*[F.lit(x) for name, t in COUNTED.items() for x in (t, name)])[tag]


def boundaries(elements: DataFrame) -> DataFrame:
    """(path, saved, explicit, sections): page breaks of each kind."""
    tag = F.col("tag")
    page = (tag == "br") & F.coalesce(F.col("attrs")["type"] == "page", F.lit(False))
    return elements.groupBy("path").agg(F.count_if(tag == "lastRenderedPageBreak").alias("saved"), F.count_if(page).alias("explicit"), F.count_if(tag == "sectPr").alias("sections"))


def denied_features(elements: DataFrame, denied: tuple[str, ...] = tuple(REVIEWED)) -> DataFrame:
    """(rule_id, severity, key): one row for each part and denied element that it has."""
    hits = elements.where(F.col("tag").isin(*denied)).select("path", "part", "tag").distinct()
    return row_violations(hits, F.concat_ws("/", "path", "part", "tag"), [RowRule("denied_feature", F.lit(True))])


def body_members(elements: DataFrame) -> DataFrame:
    """(path, part, pos, kind, text): the body's paragraphs and tables in order, with all their text.

    An element belongs to the last member that begins before it, as members don't nest.  Elements may be folded.
    """
    e = F.col("elements")
    in_body = lambda b: lambda x: F.array_contains(b, x["parent"]) & (x["parent"] == innermost(b, x["n"]))
    heads = let(bodies(e), lambda b: F.transform(F.filter(e, in_body(b)), lambda x: F.struct(x["n"].alias("n"), x["tag"].alias("tag"))))
    rows = fold(elements).where("elements IS NOT NULL")

    def member(heads: Column, own: Column, k: Column) -> Column:
        end = F.coalesce(F.get(heads, k + 1)["n"], F.size(e))
        texts = F.filter(F.slice(e, own["n"] + 1, end - own["n"]), lambda x: x["tag"] == "t")
        text = F.array_join(F.transform(texts, lambda x: F.coalesce(x["text"], F.lit(""))), "")
        return F.when(own["tag"].isin("p", "tbl"), F.struct(F.when(own["tag"] == "p", "paragraph").otherwise("table").alias("kind"), text.alias("text")))

    members = F.filter(let(heads, lambda h: F.transform(h, lambda own, k: member(h, own, k))), lambda m: m.isNotNull())
    rows = rows.select("path", "part", F.posexplode(members).alias("k", "m"))
    return rows.select("path", "part", (F.col("k") + 1).alias("pos"), "m.kind", "m.text")
