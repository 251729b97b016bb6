"""Every query of the library with the SQL that gives the same rows."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import functions as F

from folioloom.operators.ordered import dealt

_QUERIES: dict = {}
_SQL: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query function under ``name``, with its SQL where SQL can express it."""

    def keep(f):
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return keep


def oracle_of(name: str) -> str:
    """The SQL of a query that is registered already."""
    return _SQL[name]


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def made(spark, sf_dir: str, sql: str, *names: str):
    """Rows of ``sql``, whose tables stand in it as {name}."""
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in names})


def lines_by_order(spark, sf_dir: str, *columns: str):
    """Order lines with an INT key, dealt by it: rows that are made of an order's lines need no other shuffle."""
    lines = table(spark, sf_dir, "lineitem")
    return dealt(lines.select(F.col("l_orderkey").cast("int").alias("l_orderkey"), *columns), ["l_orderkey"], lines.count())


def queries() -> dict:
    for module in ("queries", "page_queries", "text_queries", "book_queries", "pdf_queries", "package_queries", "layout_queries", "status_queries", "manifest_queries", "job_queries", "structure_queries"):  # they register on import
        import_module(f"folioloom.plans.{module}")
    return dict(_QUERIES)


def oracle_sql() -> dict:
    queries()
    return dict(_SQL)
