"""folioloom: document analytics on Spark DataFrames."""

from __future__ import annotations

import os
from pathlib import Path

HOME = str(Path(__file__).resolve().parent.parent)


def importable(spark):
    """Let Python workers import this package from where the driver has it; returns the session."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, paths)])
    return spark
