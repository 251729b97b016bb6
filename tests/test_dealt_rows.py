"""Rows are dealt by their number, so that a task's share doesn't grow with a table, and are shuffled once."""

import re

from folioloom.operators import attachments as A
from folioloom.operators import ordered
from folioloom.plans import book_queries, catalogue

SF = "/root/testdata/sf0.001"


def _exchanges(df):
    return re.findall(r"Exchange \w+\(([^)]*)", df._jdf.queryExecution().executedPlan().toString())


def test_tasks_follow_the_rows(spark):
    rows = spark.range(1000)
    for n, tasks in ((10, 4), (40, 4), (41, 5), (400, 40)):
        assert ordered.dealt(rows, ["id"], n, rows_a_task=10).rdd.getNumPartitions() == tasks


def test_tables_made_of_order_lines_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(catalogue, "dealt", lambda df, keys, n: ordered.dealt(df, keys, n, rows_a_task=100))
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    blocks = book_queries._asked(spark, SF)
    assert blocks.rdd.getNumPartitions() == -(-n // 100)
    for made in (A.question_groups(blocks), A.keep_transitions(blocks)):
        assert len(_exchanges(made)) == 1 and _exchanges(made)[0].startswith("l_orderkey")
