"""Internal columns beside a table's own: names that begin with two underscores are the operators'."""

from __future__ import annotations

from pyspark.sql import DataFrame


def set_apart(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """(df, its names put back) with columns that begin with ``__`` under names that no operator uses."""
    given = {c: f"kept {k} {c}" for k, c in enumerate(df.columns) if c.startswith("__")}
    return df.withColumnsRenamed(given), {v: k for k, v in given.items()}


def put_back(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)
