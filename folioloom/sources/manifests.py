"""Block manifests of books as tables: read as text, parsed once as VARIANT, flattened to books, pages and blocks.

A value whose JSON kind isn't the field's is null in the table and a row of ``errors`` that names its
path (``pages[2].blocks[0].label``), so a bad field never hides the rest of a file.  Text that
is no JSON, or whose root is no object, gives one error and no further rows; keys that occur twice in an object
make it no JSON.  Whole numbers serve where numbers are asked for, booleans don't.  Unknown fields are left out.  An empty
table of manifests gives empty tables.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from folioloom.functions.blocks import has_text
from folioloom.operators.book_ir import BLOCK, PAGE, block_violations, page_violations
from folioloom.operators.contracts import RowRule, all_violations, row_violations
from folioloom.tables import written

# Names in manifests where they aren't the tables' own, and the types of nested values under those names.
IMAGE = "struct<kind:string,path:string,alt_text:string,effective_dpi:double,width_inches:double,height_inches:double,crop_bbox_points:array<double>>"
RUNS = f"array<struct<text:string,language:string,formula_image:{IMAGE}>>"
NAMES = {"spacing": "spacing_points"}
NESTED = {"runs": RUNS, "hindi_runs": RUNS, "english_runs": RUNS, "image": IMAGE, "items": f"array<struct<label:string,text:string,runs:{RUNS},formula_image:{IMAGE}>>"}
PAGE_FIELDS = {"page": ("source_page", "int"), "page_type": ("page_type", "string"), "utilization_exempt": ("utilization_exempt", "boolean"), "exempt_reason": ("utilization_exempt_reason", "string")}
SCOPES = ("preview", "full")
_KINDS = {"string": ("STRING",), "boolean": ("BOOLEAN",), "int": ("BIGINT",), "double": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "array": ("ARRAY",), "struct": ("OBJECT",), "map": ("OBJECT",), "variant": ()}


@dataclass(frozen=True)
class Manifests:
    """books(doc, schema_version, book_name, scope, source_sha256, page_count, n_pages, manifest_sha256), pages, blocks, errors(rule_id, severity, key)."""

    books: DataFrame
    pages: DataFrame
    blocks: DataFrame
    errors: DataFrame


@F.pandas_udf(StringType())
def manifest_digest(text: pd.Series) -> pd.Series:
    """Upper-case SHA-256 of a manifest's compact JSON with sorted keys; null where the text is no JSON.

    VARIANT holds 1.0 as 1, which this digest must tell apart, so the text itself is read.
    """

    def one(t):
        try:
            plain = json.dumps(json.loads(t), ensure_ascii=False, separators=(",", ":"), sort_keys=True)
            return hashlib.sha256(plain.encode("utf-8", "surrogatepass")).hexdigest().upper()
        except (TypeError, ValueError):
            return None

    return text.map(one)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """(doc, value): JSON files as text, one a row."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), "value")


def kind_of(value: Column) -> Column:
    """STRING, BIGINT, OBJECT ...; VOID for a JSON null, null where there is nothing.

    Objects and arrays are told by their outermost value alone: the schema of one takes a walk of all that it holds.
    """
    outer = lambda kind: F.try_variant_get(value, "$", kind).isNotNull()
    inner = F.substring_index(F.substring_index(F.schema_of_variant(value), "<", 1), "(", 1)
    return F.when(outer("struct<>"), "OBJECT").when(outer("array<struct<>>"), "ARRAY").otherwise(inner)


def typed(rows: DataFrame, v: str, fields: dict[str, tuple[str, str]], path: Column) -> DataFrame:
    """rows with a column a field, null where something of another kind stands, and ``wrong``: the paths of such fields.

    An object is read twice, whatever the number of fields: once as a struct of them, once for the kinds of those it has.
    Only a field below another (``a.b``) is looked up by itself.
    """
    below = {c: f for c, f in fields.items() if "." in f[0]}
    raw = {c: f"__raw_{c}" for c in below}
    rows = rows.withColumns({raw[c]: F.try_variant_get(v, f"$.{name}", "variant") for c, (name, _) in below.items()})
    top = {name: k for c, (name, k) in fields.items() if c not in below}
    good = F.create_map(*[x for name, k in fields.values() for x in (F.lit(name), F.array(*map(F.lit, _KINDS[k.split("<")[0]])))])
    own = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    rows = rows.withColumns({"__held": F.try_variant_get(v, "$", f"struct<{','.join(f'`{n}`:{k}' for n, k in top.items())}>"), "__own": F.filter(own, lambda e: F.array_contains(F.array(*map(F.lit, top)), e["key"]))})
    named = F.transform(F.coalesce("__own", F.array().cast("array<struct<key:string,value:variant>>")), lambda e: F.struct(e["key"].alias("name"), kind_of(e["value"]).alias("kind")))
    if below:
        named = F.concat(named, F.array(*[F.struct(F.lit(name).alias("name"), kind_of(F.col(raw[c])).alias("kind")) for c, (name, _) in below.items()]))
    rows = rows.withColumn("__kinds", F.filter(named, lambda k: k["kind"] != "VOID"))
    fits = lambda k: F.array_contains(good[k["name"]], k["kind"])
    rows = rows.withColumn("__fit", F.transform(F.filter("__kinds", fits), lambda k: k["name"]))
    value = {c: F.try_variant_get(raw[c], "$", k) if c in below else F.col("__held")[name] for c, (name, k) in fields.items()}
    # a whole number may be out of its type's range; the columns stand in one projection with lambdas, as one without becomes a method that the JVM doesn't compile
    beyond = [F.when(F.array_contains("__fit", name) & value[c].isNull(), F.lit(name)) for c, (name, k) in fields.items() if k == "int"]
    wrong = F.concat(F.transform(F.filter("__kinds", lambda k: ~fits(k)), lambda k: k["name"]), F.array_compact(F.array(*beyond, F.lit(None).cast("string"))))
    wrong = F.transform(wrong, lambda name: F.concat(path, F.lit("" if v == "v" else "."), name))
    rows = rows.withColumns({c: F.when(F.array_contains("__fit", name), value[c]) for c, (name, _) in fields.items()} | {"wrong": wrong})
    return rows.drop(*raw.values(), "__held", "__own", "__kinds", "__fit")


def flatten(manifests: DataFrame) -> Manifests:
    """Tables of manifests(doc, value).

    Texts are parsed once and taken apart in one pass into a written table of a row a block, with what its page and book hold beside it;
    a page without blocks, or a book without pages, has one row.  No VARIANT is written, as its shredding costs more than the parse.
    """
    parsed = manifests.select("doc", F.try_parse_json("value").alias("v"), manifest_digest("value").alias("manifest_sha256")).withColumn("root", kind_of(F.col("v")))
    root = {"schema_version": ("schema_version", "int"), "book_name": ("book_name", "string"), "scope": ("scope", "string"), "source_sha256": ("source.sha256", "string"), "page_count": ("source.page_count", "int"), "listed": ("pages", "array<variant>")}
    books = typed(parsed, "v", root, F.lit("")).withColumns({"n_pages": F.coalesce(F.size("listed"), F.lit(0)), "wrong_book": F.col("wrong")})
    own = ["doc", "root", "schema_version", "book_name", "scope", "source_sha256", "page_count", "n_pages", "manifest_sha256", "wrong_book"]
    each = books.select(*own, F.posexplode_outer("listed").alias("at", "p"))
    where = F.concat(F.lit("pages["), F.col("at").cast("string"), F.lit("]"))
    odd = lambda v: ~F.coalesce(kind_of(F.col(v)) == "OBJECT", F.lit(False))
    pages = typed(each, "p", PAGE_FIELDS | {"listed": ("blocks", "array<variant>")}, where)
    pages = pages.withColumns({"n_blocks": F.coalesce(F.size("listed"), F.lit(0)).cast("long"), "wrong_page": F.when(odd("p"), F.array(where)).otherwise(F.col("wrong"))})
    inner = pages.select(*own, "at", *PAGE_FIELDS, "n_blocks", "wrong_page", F.posexplode_outer("listed").alias("k", "b"))
    there = F.concat(F.lit("pages["), F.col("at").cast("string"), F.lit("].blocks["), F.col("k").cast("string"), F.lit("]"))
    fields = {c: (NAMES.get(c, c), NESTED.get(c, t)) for c, t in BLOCK.items() if c not in ("doc", "page", "pos")}
    rows = typed(inner, "b", fields, there).withColumn("wrong", F.when(odd("b"), F.array(there)).otherwise(F.col("wrong"))).drop("b")
    rows = written(rows.select(*[F.col(c).cast(BLOCK[c]).alias(c) if c in fields else F.col(c) for c in rows.columns]), "manifests")
    parsed = rows.where("coalesce(at, 0) = 0 AND coalesce(k, 0) = 0")
    books = parsed.where("root = 'OBJECT'").withColumn("wrong", F.col("wrong_book"))
    pages = rows.where("at IS NOT NULL AND coalesce(k, 0) = 0").withColumns({"pos": F.col("at") + 1, "wrong": F.col("wrong_page")})
    blocks = rows.where("k IS NOT NULL").withColumn("pos", F.col("k") + 1)
    torn = parsed.where("root IS NULL OR root <> 'OBJECT'").select(F.when(F.col("root").isNull(), "json").otherwise("root_object").alias("rule_id"), F.lit("error").alias("severity"), F.col("doc").alias("key"))
    errors = torn
    for table in (books, pages, blocks):
        errors = errors.unionByName(table.select(F.lit("field_type").alias("rule_id"), F.lit("error").alias("severity"), F.explode(F.transform("wrong", lambda w: F.concat_ws("/", "doc", w))).alias("key")))
    return Manifests(
        books.select("doc", "schema_version", "book_name", "scope", "source_sha256", "page_count", "n_pages", "manifest_sha256"),
        pages.select(*[F.col(c).cast(t).alias(c) for c, t in PAGE.items()]),
        blocks.select(*[F.col(c).cast(t).alias(c) for c, t in BLOCK.items()]),
        errors,
    )


def manifest_violations(m: Manifests, sources: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(rule_id, severity, key) of whole manifests: their roots against sources(doc, sha256), their pages and their blocks.

    ``expected``(doc, pos, page) are the pages asked for; a preview without any is a violation.
    """
    asked = None if expected is None else expected.select("doc").distinct().withColumn("asked", F.lit(True))
    b = m.books.join(sources.select("doc", F.col("sha256").alias("file_sha256")), "doc", "left")
    b = b.withColumn("asked", F.lit(False)) if asked is None else b.join(asked, "doc", "left")
    roots = row_violations(b, F.col("doc"), [
        RowRule("schema_version", ~F.coalesce(F.col("schema_version") == 1, F.lit(False))),
        RowRule("book_name", ~has_text(F.col("book_name"))),
        RowRule("scope", ~F.coalesce(F.col("scope").isin(*SCOPES), F.lit(False))),
        RowRule("source_hash", ~F.coalesce(F.col("source_sha256") == F.col("file_sha256"), F.lit(False))),
        RowRule("page_count", ~F.coalesce(F.col("page_count") >= 1, F.lit(False))),
        RowRule("pages", F.col("n_pages") == 0),
        RowRule("preview_pages", F.coalesce(F.col("scope") == "preview", F.lit(False)) & ~F.coalesce("asked", F.lit(False))),
    ])
    return all_violations(m.errors, roots, page_violations(m.pages, expected), block_violations(m.blocks))
