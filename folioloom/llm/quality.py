"""Quality rules as a short-circuit cascade, ordered by rejection per cost (native).

Every rule is a boolean Column that is true where a document is rejected.  A sample of the
corpus gives each rule's cost (seconds a row) and its selectivity (share rejected); the
cascade then tries the rule with the most rejections per second first, and a CASE expression
stops at the first rejection.  The order changes the cost only, never the verdict.  Rates count
by powers of two, and rules of one power stand as declared, so that the order is a steady one.

Defined cases: a null or empty text has no words, so it fails the base rule; repeated rows,
null ids and further columns pass through unchanged; an empty table gives an empty result
and keeps the rules in their declared order.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioloom.llm.names import put_back, set_apart

SPACE = "[\\x20\\x09-\\x0D]+"
WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``rejects`` is an expression over the columns of :func:`with_counts`."""

    name: str
    rejects: str


#: Thresholds leave ordinary prose alone; each is a share in per cent of the counted unit.
RULES = (
    Rule("symbols", "100 * n_symbols > 10 * word_chars"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("shouting", "100 * regexp_count(text, '!!') > 20 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("bullets", "100 * regexp_count(text, '(?md)^[ \\\\t]*[|*-]') > 90 * n_lines"),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _repeat_words(w: Column, n: Column) -> Column:
    """Words that lie in a 3-word window found twice or more, the first one included."""
    windows = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(windows)


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    All of it stays in the row: no shuffle and no generated rows.  Windows are compared by a
    64-bit hash, sorted with their places only in documents where some hash occurs twice.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    taken = df.columns
    base = df.select(*[F.col(f"`{c}`") for c in taken], words_of(F.col(text)).alias("__w"))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(WORD_CHAR)))
    base = base.select("*", F.size("__w").alias("__n"), lines.alias("__lines"))
    base = base.select("*", _repeat_words(F.col("__w"), F.col("__n")).alias("__h"))
    pairs = F.sort_array(F.transform(F.col("__h"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    base = base.select("*", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), pairs).alias("__s"))
    again = F.filter(
        F.transform(F.col("__s"), lambda s, k: F.when((s["h"] == F.get(F.col("__s"), k - 1)["h"]) | (s["h"] == F.get(F.col("__s"), k + 1)["h"]), s["i"])),
        lambda i: i.isNotNull(),
    )
    base = base.select("*", F.sort_array(again).alias("__r"))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("e"))
    covered = F.aggregate("__r", start, lambda a, i: F.struct((a["n"] + i + 3 - F.greatest(i, a["e"])).alias("n"), (i + 3).alias("e")), lambda a: a["n"])
    return base.select(
        *[F.col(f"`{c}`") for c in taken],
        F.col("__n").cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


#: Times that each rule runs over the sampled rows, so that its own work outweighs that of a job.
TIMES = 30


def order_rules(documents: DataFrame, rules=RULES, sample_rows: int = 2000, fraction: float | None = None, seed: int = 7) -> list[Rule]:
    """Rules by rejections per second, measured on about ``sample_rows`` rows drawn from all of the table, or on a ``fraction`` of it.

    Every rule runs ``TIMES`` times over the same rows, the faster of two runs counts, and the
    time of a constant rule is taken off.  Rows are drawn where they are; none is shuffled.
    """
    if fraction is None:
        fraction = min(1.0, sample_rows / max(1, documents.count()))
    sample = with_counts(documents.sample(fraction=fraction, seed=seed)).persist()
    try:
        n = sample.count()
        if not n:
            return list(rules)
        again = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(TIMES))))

        def measure(rejects: str) -> tuple[float, int]:
            best, hits = float("inf"), 0
            for _ in range(2):
                begun = time.perf_counter()
                hits = again.agg(F.count_if(F.expr(rejects))).first()[0]
                best = min(best, time.perf_counter() - begun)
            return best, hits

        idle, _ = measure("__again < 0")
        rated = []
        for k, rule in enumerate(rules):
            cost, hits = measure(rule.rejects)
            rate = hits / max(cost - idle, 0.02)
            rated.append((-round(math.log2(1 + rate)), k, rule))
        return [rule for _, _, rule in sorted(rated, key=lambda r: r[:2])]
    finally:
        sample.unpersist()


def cascade(counted: DataFrame, rules) -> DataFrame:
    """Add ``rejected_by``: the first rule in order that rejects the row, else null."""
    verdict = F.when(F.expr(BASE_FAILED), F.lit("base"))
    for rule in rules:
        verdict = verdict.when(F.expr(rule.rejects), F.lit(rule.name))
    return counted.withColumn("rejected_by", verdict)


def quality_rules(documents: DataFrame, rules=RULES, sample_rows: int = 2000) -> DataFrame:
    """documents plus the counts, ``base_failed``, ``rejected_by`` and ``kept``.

    Columns of ``documents`` that share a name with an added one are replaced.
    """
    added = {"n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "rejected_by", "base_failed", "kept"}
    documents, names = set_apart(documents.drop(*[c for c in documents.columns if c.lower() in added]))
    out = cascade(with_counts(documents), order_rules(documents, rules, sample_rows))
    return put_back(out.withColumn("base_failed", F.expr(BASE_FAILED)).withColumn("kept", F.col("rejected_by").isNull()), names)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win),
cov AS (
  SELECT rid, count(DISTINCT i + o) AS n
  FROM (SELECT rid, i FROM rep WHERE c > 1), (VALUES (0), (1), (2)) AS v(o) GROUP BY rid),
m AS (
  SELECT doc_id, text, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(regexp_extract_all(text, '!!')) AS BIGINT) AS n_shout,
         CAST(len(regexp_extract_all(text, '(?m)^[ \t]*[|*-]')) AS BIGINT) AS n_bullets
  FROM d LEFT JOIN cov USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
            OR 100 * n_shout > 20 * n_words OR word_chars > 20 * n_words OR 100 * n_bullets > 90 * n_lines) AS kept
FROM f
"""
