"""Intermediate tables in the shared folder that ``spark.checkpoint.dir`` names.

A written table cuts lineage and survives a lost executor.  ``release`` deletes what a
session has written once the results that read it are stored.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only where none is set and the master is local."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="folioloom-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/folioloom/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Rows that a written step hands to Python at once: its batches are then small on both sides.
ROWS_AT_ONCE = 2000


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and return the reader of it."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with arrow_rows(spark, ROWS_AT_ONCE):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, n: int):
    """Hand Python at most ``n`` rows at once in the jobs started inside: long texts make large batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, str(min(n, int(old)) if int(old) > 0 else n))
    try:
        yield
    finally:
        spark.conf.set(key, old)


def drop(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this session."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, []):
        drop(spark, path)
