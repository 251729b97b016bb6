"""Text and boxes of PDF pages by whichever public reader is installed, one file a task row.

Readers are asked for only where they are used.  A file that can't be read gives one row with
its error, so it can't stop a batch; whether the readers' page counts agree is a column.
"""

from __future__ import annotations

import os
import shutil
import subprocess
import tempfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGES = "doc string, page int, body string, n_pages int, backend string, error string"


def split_pages(text: str) -> list[str]:
    """Pages end with a form feed; what is empty after the last one is no page."""
    pages = text.split("\f")
    return pages[:-1] if pages and not pages[-1].strip() else pages


def text_tool(named: str | None = None) -> str | None:
    """The first text tool that exists: the named one, that of the environment, that of the path."""
    for tool in (named, os.environ.get("PDFTOTEXT"), shutil.which("pdftotext")):
        if tool and os.path.exists(tool):
            return tool
    return None


def _by_tool(content: bytes, tool: str) -> list[str]:
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(content)
        f.flush()
        done = subprocess.run([tool, "-layout", "-enc", "UTF-8", f.name, "-"], capture_output=True, check=True, timeout=300)
    return split_pages(done.stdout.decode("utf-8"))


def _by_library(content: bytes) -> list[str]:
    import io

    import pypdf

    reader = pypdf.PdfReader(io.BytesIO(content))
    if reader.is_encrypted:
        raise ValueError("encrypted")
    return [page.extract_text(extraction_mode="layout") or "" for page in reader.pages]


def read_pages(content: bytes, tool: str | None = None) -> tuple[list[str], str]:
    """(text of each page, name of the reader)."""
    tool = text_tool(tool)
    return (_by_tool(content, tool), "tool") if tool else (_by_library(content), "library")


def pdf_pages(spark: SparkSession, path: str, tool: str | None = None) -> DataFrame:
    def work(batches):
        names = [c.split()[0] for c in PAGES.split(", ")]
        for pdf in batches:
            rows = []
            for doc, content in zip(pdf["path"], pdf["content"], strict=True):
                try:
                    pages, backend = read_pages(content, tool)
                    rows += [(doc, k + 1, t, len(pages), backend, None) for k, t in enumerate(pages)]
                except Exception as error:
                    rows.append((doc, None, None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(work, PAGES)


def page_lines(pages: DataFrame) -> DataFrame:
    """lines(doc, page, line_no, raw) of pages(doc, page, body)."""
    rows = pages.where("error IS NULL").select("doc", "page", F.posexplode(F.split("body", "\\r\\n|[\\n\\r]")).alias("n", "raw"))
    return rows.select("doc", "page", (F.col("n") + 1).alias("line_no"), "raw")


def page_inventory(pages: DataFrame, text: Column | None = None) -> DataFrame:
    """One row a document: pages, characters, NUL and replacement characters, unreadable pages."""
    t = F.col("body") if text is None else text
    held = lambda mark: F.coalesce(F.length(t) - F.length(F.replace(t, F.lit(mark))), F.lit(0))
    return pages.groupBy("doc").agg(
        F.count("page").alias("n_pages"), F.coalesce(F.sum(F.length(t)), F.lit(0)).alias("chars"), F.sum(held("\0")).alias("nul"), F.sum(held("�")).alias("replaced"), F.count("error").alias("unreadable")
    )
