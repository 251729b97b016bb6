"""Boxes meet their page once, and words, boxes and ruled lines are taken together."""

import re

from pyspark.sql import functions as F

from folioloom.operators import layout


def test_boxes_meet_their_page_once(spark):
    boxes = spark.createDataFrame([(1, "word", 60.0, 90.0, 100.0, 110.0, "a")], "page int, kind string, x0 double, x1 double, top double, bottom double, text string")
    pages = spark.createDataFrame([(1, 595.0, 842.0, 51.0, 545.0), (2, 595.0, 842.0, 51.0, 545.0)], "page int, width double, height double, left double, right double")
    found = layout.page_content(boxes, pages)
    assert found.orderBy("page").select("page", "top", "bottom").collect() == [(1, 100.0, 110.0), (2, None, None)]
    assert len(re.findall(r"Join", found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])) == 1
    low = spark.createDataFrame([(1, "line", 51.0, 300.0, 500.0, 500.0, None), (1, "line", 300.0, 545.0, 500.2, 500.2, None)], boxes.schema)
    assert layout.page_content(boxes.unionByName(low), pages).where("page = 1").select(F.round("bottom", 1)).first()[0] == 500.2
