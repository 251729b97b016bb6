"""Written tables that cut lineage, in the shared folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; where none is set and the master is local, one that goes with this process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    base = tempfile.mkdtemp(prefix="folioloom-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet and return the reader of it."""
    path = f"{shared_dir(df.sparkSession)}/folioloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
