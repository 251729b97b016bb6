"""A status log whose transitions must be legal, as a batch and as a stream.

Logs are log(job, at, event, state): a job takes its events in order of (at, event), beginning in
``initial``; an event whose state may not follow the job's head leaves it as it is.  ``legal`` maps
a state to those that may follow it; None lets everything follow.

Verdicts: ``accepted``; ``illegal``; ``repeated``, where job, at and event were there before; and in a
stream ``late``, for events before one that the job has already seen.  Null jobs, times or states are
``invalid`` and change nothing.  An empty log gives no rows.

In the batch a job with very many events is no group: the log is dealt by ranges of (job, at, event),
each range tells for every state where it would lead, these few answers are followed in order,
and each range then decides its events from the state it really begins in.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from folioloom.tables import written

INITIAL = "initialized"
LOG = ["job", "at", "event", "state"]


def _follows(legal: dict | None, head: str, state: str) -> bool:
    return legal is None or state in legal.get(head, ())


def _states(legal: dict | None, initial: str) -> list[str]:
    return sorted({initial, *(legal or {}), *(t for to in (legal or {}).values() for t in to)})


def transitions(log: DataFrame, legal: dict | None = None, initial: str = INITIAL) -> DataFrame:
    """The log's rows plus ``before`` (the head that an event met) and ``verdict``."""
    kinds = {c: log.schema[c].dataType.simpleString() for c in LOG}
    order = ["job", "at", "event"]
    whole = F.col("job").isNotNull() & F.col("at").isNotNull() & F.col("event").isNotNull() & F.col("state").isNotNull()
    ranged = written(log.where(whole).select(*LOG).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "log")
    domain = _states(legal, initial)
    ascending = [(c, "ascending") for c in ("at", "event")]

    def leads(key, table):
        table = table.sort_by(ascending)
        heads = {s: s for s in domain}
        last = None
        for at, event, state in zip(*[table.column(c).to_pylist() for c in ("at", "event", "state")], strict=True):
            if (at, event) == last:
                continue
            last = (at, event)
            if legal is None:
                heads = dict.fromkeys(heads, state)
            else:
                heads = {s: state if _follows(legal, h, state) else h for s, h in heads.items()}
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "job": pa.array([key[1].as_py()], table.schema.field("job").type), "ends": pa.array([[heads[s] for s in domain]], pa.list_(pa.string()))})

    answers = ranged.groupBy("part", "job").applyInArrow(leads, f"part int, job {kinds['job']}, ends array<string>")

    def follow(key, table):
        table = table.sort_by("part")
        head, starts = initial, []
        for ends in table.column("ends").to_pylist():
            starts.append(head)
            head = ends[domain.index(head)] if head in domain else ends[0]
        return pa.table({"part": table.column("part"), "job": table.column("job"), "start": pa.array(starts, pa.string())})

    starts = answers.groupBy("job").applyInArrow(follow, f"part int, job {kinds['job']}, start string")

    def decide(key, table):
        table = table.sort_by(ascending)
        head, last, before, verdict = table.column("start")[0].as_py(), None, [], []
        for at, event, state in zip(*[table.column(c).to_pylist() for c in ("at", "event", "state")], strict=True):
            before.append(head)
            if (at, event) == last:
                verdict.append("repeated")
                continue
            last = (at, event)
            verdict.append("accepted" if _follows(legal, head, state) else "illegal")
            head = state if verdict[-1] == "accepted" else head
        return table.select(LOG).append_column("before", pa.array(before, pa.string())).append_column("verdict", pa.array(verdict, pa.string()))

    schema = ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", before string, verdict string"
    decided = ranged.join(starts, ["part", "job"]).groupBy("part", "job").applyInArrow(decide, schema)
    invalid = log.where(~whole).select(*LOG, F.lit(None).cast("string").alias("before"), F.lit("invalid").alias("verdict"))
    return decided.unionByName(invalid)


def transition_stream(log: DataFrame, legal: dict | None = None, initial: str = INITIAL) -> DataFrame:
    """As :func:`transitions` over a stream; its state is one row a job, so it can run without end.

    What has been decided stays: an event that comes after a later one of its job is ``late``.
    """
    kinds = {c: log.schema[c].dataType.simpleString() for c in LOG}
    out = ", ".join(f"{c} {t}" for c, t in kinds.items()) + ", before string, verdict string"
    held = f"head string, at {kinds['at']}, event {kinds['event']}"

    def step(key, batches, state: GroupState):
        head, at, event = state.get if state.exists else (initial, None, None)
        last = (pd.Timestamp(at), event) if at is not None else None
        rows = pd.concat(list(batches)).sort_values(["at", "event"], kind="stable")
        before, verdict = [], []
        for row in rows.itertuples(index=False):
            before.append(head)
            if pd.isna(row.job) or pd.isna(row.at) or pd.isna(row.event) or pd.isna(row.state):
                verdict.append("invalid")
                continue
            this = (row.at, row.event)
            if last is not None and this <= last:
                verdict.append("repeated" if this == last else "late")
                continue
            last = this
            verdict.append("accepted" if _follows(legal, head, row.state) else "illegal")
            head = row.state if verdict[-1] == "accepted" else head
        if last is not None:
            state.update((head, last[0].to_pydatetime(), last[1]))
        yield rows[LOG].assign(before=before, verdict=verdict)

    return log.select(*LOG).groupBy("job").applyInPandasWithState(step, out, held, "append", GroupStateTimeout.NoTimeout)


def heads(decided: DataFrame) -> DataFrame:
    """(job, head, updated_at, n_accepted, n_refused) of transitions, of a batch or gathered from a stream."""
    ok, at = F.col("verdict") == "accepted", F.struct("at", "event")
    told = decided.where("verdict <> 'invalid'").groupBy("job")
    return told.agg(F.max_by(F.when(ok, F.col("state")), F.when(ok, at)).alias("head"), F.max(F.when(ok, F.col("at"))).alias("updated_at"), F.count_if(ok).alias("n_accepted"), F.count_if(~ok).alias("n_refused"))


def head_values(decided: DataFrame, values: DataFrame) -> DataFrame:
    """(job, name, value): attributes of jobs, of values(job, at, event, name, value) the last accepted; a null value counts."""
    ok = decided.where("verdict = 'accepted'").select("job", "at", "event")
    return values.join(ok, ["job", "at", "event"], "left_semi").groupBy("job", "name").agg(F.max_by(F.struct("value"), F.struct("at", "event"))["value"].alias("value"))
