"""Queries of the status log, over the events of users."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioloom.plans.catalogue import query, table
from folioloom.streaming import status_log as S

LEGAL = {"initialized": ["signup", "view"], "signup": ["view", "click"], "view": ["click", "purchase", "error"], "click": ["view", "purchase", "error"], "purchase": ["view", "error"], "error": ["view", "signup"]}
_PAIRS = ", ".join(f"('{a}', '{b}')" for a, to in LEGAL.items() for b in to)
_DECIDED = f"""
WITH RECURSIVE legal(a, b) AS (VALUES {_PAIRS}),
e AS (SELECT user_id AS job, ts AS at, event_id AS event, event_type AS state, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
w AS (
  SELECT e.*, 'initialized' AS before, state IN (SELECT b FROM legal WHERE a = 'initialized') AS ok FROM e WHERE k = 1
  UNION ALL
  SELECT e.*, n.head, EXISTS (SELECT 1 FROM legal WHERE a = n.head AND b = e.state) FROM (SELECT job, k, CASE WHEN ok THEN state ELSE before END AS head FROM w) n JOIN e ON e.job = n.job AND e.k = n.k + 1)
"""


def _decided(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").alias("job"), F.col("ts").alias("at"), F.col("event_id").alias("event"), F.col("event_type").alias("state"))
    return S.transitions(log, LEGAL)


@query("status_transitions", _DECIDED + "SELECT job, event, state, before, CASE WHEN ok THEN 'accepted' ELSE 'illegal' END AS verdict FROM w")
def status_transitions(spark, sf_dir):
    """Every event of every log with the head that it met and whether it could follow."""
    return _decided(spark, sf_dir).select("job", "event", "state", "before", "verdict")


@query("status_heads", _DECIDED + "SELECT job, arg_max(state, k) FILTER (ok) AS head, count(*) FILTER (ok) AS n_accepted, count(*) FILTER (NOT ok) AS n_refused FROM w GROUP BY job")
def status_heads(spark, sf_dir):
    """Each log's head after its legal transitions."""
    return S.heads(_decided(spark, sf_dir)).select("job", "head", "n_accepted", "n_refused")
