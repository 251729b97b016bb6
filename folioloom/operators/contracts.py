"""Table contracts: rules that give violation rows, and gates over them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowRule:
    """A row violates the rule where ``violated`` is true; null doesn't violate."""

    rule_id: str
    violated: Column
    severity: str = "error"


def row_violations(df: DataFrame, key: Column, rules: list[RowRule]) -> DataFrame:
    """(rule_id, severity, key): one scan for all rules, one row for each violation."""
    hits = F.array(*[F.when(r.violated, F.struct(F.lit(r.rule_id).alias("rule_id"), F.lit(r.severity).alias("severity"))) for r in rules])
    return df.select(key.cast("string").alias("key"), F.explode(hits).alias("v")).where("v IS NOT NULL").select("v.rule_id", "v.severity", "key")


def duplicate_keys(df: DataFrame, keys: list[str], rule_id: str = "unique") -> DataFrame:
    found = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return found.select(F.lit(rule_id).alias("rule_id"), F.lit("error").alias("severity"), F.concat_ws("/", *keys).alias("key"))


def missing_references(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule_id: str = "reference") -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(child_key))
    lost = child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti").select(child_key).distinct()
    return lost.select(F.lit(rule_id).alias("rule_id"), F.lit("error").alias("severity"), F.col(child_key).cast("string").alias("key"))


def all_violations(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def gate(violations: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether the stage may proceed."""
    return violations.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("passed", F.col("errors") == 0)


def hash_gate(expected: DataFrame, actual: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, passed): a missing or null digest on either side fails."""
    e, a = expected.select(key, F.col(digest).alias("e")), actual.select(key, F.col(digest).alias("a"))
    return e.join(a, key, "left").select(key, F.coalesce(F.col("e") == F.col("a"), F.lit(False)).alias("passed"))


def count_diff(expected: DataFrame, actual: DataFrame, key: str, value: str) -> DataFrame:
    """Rows of either side whose values differ; null where a side has none."""
    e, a = expected.select(key, F.col(value).alias("expected")), actual.select(key, F.col(value).alias("actual"))
    return e.join(a, key, "full_outer").where(~F.col("expected").eqNullSafe(F.col("actual")))
