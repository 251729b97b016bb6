"""Training-data pipeline over ``documents``: five stages, each on all that its predecessor kept.

1. toxicity: documents predicted toxic go.
2. simhash_dedup: of documents that link by similar shingles (5 words, 0.8), the one with the least id stays.
3. decontamination: documents that leak a benchmark item go.
4. secret_scan: secrets in the text become ``[SECRET]``; every document stays.
5. bpe: token ids of the text, and whether they decode to it again.

All but the last return the columns of ``documents``.  Each stage is written as Parquet and
read again as the next one's input.  SQL can't express the stages, so ``ORACLE_SQL`` is None
and tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom import importable
from folioloom.llm import bpe, decontaminate, secret_scan, simhash, store, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ORACLE_SQL = None


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = toxicity.fit_from(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(*COLUMNS), model, spans=False)
    return scored.where("predicted = 0").select(*COLUMNS)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is told by its id and a hash of its text; of repeated rows one stays, null ids come last."""
    importable(spark)
    key = ["z", "k", "th"]
    told = F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).alias("k"), F.xxhash64("text").alias("th"))
    keyed = docs.select(*COLUMNS).withColumn("key", told)
    found = simhash.similar_documents(keyed.select("key", "text"), "key")
    first = found.where("key = component_id").select("key.*").distinct()
    return keyed.select(*COLUMNS, "key.*").join(first, key, "left_semi").dropDuplicates(key).select(*COLUMNS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    flagged = decontaminate.flag(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return flagged.where("size(leaks) = 0").select(*COLUMNS)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    scanned = secret_scan.secret_scan(docs.select(*COLUMNS))
    text = F.col("redacted")
    n = F.when(F.col("n_secrets") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return scanned.select("doc_id", text.alias("text"), "lang", "source", n.alias("n_chars"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    out = bpe.encode_checked(docs.select(*COLUMNS), bpe.default_path())
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "decodes")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", simhash_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store.materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
