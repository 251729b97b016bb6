"""Head and history of a status log as an unbounded input (an addition to the batch operator)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def status_heads(log: DataFrame, key: str = "job", state: str = "state", at: str = "at") -> DataFrame:
    """Latest state and number of transitions by key; the aggregate's state is one row a key."""
    return log.groupBy(key).agg(F.max_by(state, at).alias("head"), F.max(at).alias("updated_at"), F.count("*").alias("n_states"))


def windowed_counts(log: DataFrame, at: str = "at", state: str = "state", size: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Transitions by window; a window closes when the watermark has passed it."""
    return log.withWatermark(at, late).groupBy(F.window(at, size), state).agg(F.count("*").alias("n"))
