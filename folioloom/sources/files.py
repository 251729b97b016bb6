"""Readers of text pages, packages and block manifests, and sinks that never overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.operators.packages import parts


def text_pages(spark: SparkSession, path: str) -> DataFrame:
    """lines(doc, page, line_no, raw) of text files; a form feed ends a page, a last empty page is none."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc"), F.col("value"))
    pages = files.select("doc", F.posexplode(F.split(F.regexp_replace("value", "\\f\\s*$", ""), "\\f")).alias("k", "body"))
    lines = pages.select("doc", (F.col("k") + 1).alias("page"), F.posexplode(F.split("body", "\\r\\n|[\\n\\r]")).alias("n", "raw"))
    return lines.select("doc", "page", (F.col("n") + 1).alias("line_no"), "raw")


def document_lines(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row's text as one page; its id as document."""
    return documents.select(F.col(id_col).cast("string").alias("doc"), F.lit(0).alias("page"), F.posexplode(F.split(text, "\n")).alias("line_no", "raw"))


def packages(spark: SparkSession, path: str) -> DataFrame:
    """Parts of zip packages: (path, part, size, sha256, content)."""
    return parts(spark.read.format("binaryFile").load(path).select("path", "content"))


def block_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_once(df: DataFrame, path: str, kind: str = "json") -> None:
    """Refuses to overwrite; files appear when the job commits."""
    df.write.mode("errorifexists").format(kind).save(path)
