"""Status logs as batch and as stream, with a restart between."""

import datetime as dt
import random

from folioloom.streaming import status_log as S

LEGAL = {"initialized": ["a"], "a": ["b", "c"], "b": ["c"], "c": ["a"]}
T0 = dt.datetime(2024, 1, 1)
RNG = random.Random(8)
LOG = "job string, at timestamp, event bigint, state string"
ROWS = [(RNG.choice(["hot", "hot", "x", "y"]), T0 + dt.timedelta(minutes=RNG.randint(0, 400)), k, RNG.choice("abc")) for k in range(300)]


def plain(rows, legal=LEGAL):
    out, head, last = [], {}, {}
    for job, at, event, state in sorted(rows):
        h = head.setdefault(job, "initialized")
        verdict = "repeated" if last.get(job) == (at, event) else "accepted" if legal is None or state in legal.get(h, ()) else "illegal"
        last[job] = (at, event)
        head[job] = state if verdict == "accepted" else h
        out.append((job, at, event, state, h, verdict))
    return sorted(out), {j: h for j, h in head.items() if h != "initialized"}


def test_batch(spark):
    rows = [*ROWS, ROWS[5], ROWS[9]]
    log = spark.createDataFrame([*rows, ("hot", None, 1, "a"), (None, T0, 2, "a")], LOG)
    for legal in (LEGAL, None):
        got = S.transitions(log, legal)
        want, heads = plain(rows, legal)
        assert sorted(tuple(r) for r in got.where("verdict <> 'invalid'").collect()) == want
        assert got.where("verdict = 'invalid'").count() == 2
        assert {r.job: r["head"] for r in S.heads(got).collect()} == heads
    assert S.transitions(log.limit(0), LEGAL).count() == 0


def test_stream_goes_on_after_a_restart(spark, tmp_path):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    rows = sorted(ROWS, key=lambda r: (r[1], r[2]))
    first, second = rows[:150], [*rows[149:], rows[-1], rows[20], (None, T0, 1, "a")]  # one repeated at each end, one late, one invalid

    def go():
        stream = S.transition_stream(spark.readStream.schema(LOG).parquet(str(tmp_path / "in")), LEGAL)
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()

    try:
        for part in (first, second):
            spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            go()
        got = spark.read.parquet(str(tmp_path / "out"))
        seen = got.where("verdict IN ('accepted', 'illegal')")
        assert sorted(tuple(r) for r in seen.collect()) == plain(rows)[0]
        verdicts = {r.verdict: r["count"] for r in got.groupBy("verdict").count().collect()}
        assert verdicts["repeated"] + verdicts["late"] == 3 and verdicts["late"] >= 1 and verdicts["invalid"] == 1
        batch = S.heads(S.transitions(spark.createDataFrame(rows, LOG), LEGAL))
        assert {r.job: (r["head"], r.updated_at, r.n_accepted) for r in S.heads(got).collect()} == {r.job: (r["head"], r.updated_at, r.n_accepted) for r in batch.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_values_of_heads(spark):
    log = spark.createDataFrame([("j", T0, 1, "a"), ("j", T0, 2, "a"), ("j", T0, 3, "b")], LOG)
    values = spark.createDataFrame([("j", T0, 1, "pages", "3"), ("j", T0, 2, "pages", "9"), ("j", T0, 3, "hash", None), ("j", T0, 1, "hash", "h")], "job string, at timestamp, event bigint, name string, value string")
    assert {r.name: r.value for r in S.head_values(S.transitions(log, LEGAL), values).collect()} == {"pages": "3", "hash": None}
