"""Print contract: option tables, sections and bookmarks, as violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioloom.operators.contracts import RowRule, row_violations
from folioloom.operators.layout import is_a4


def option_tables(tables: DataFrame, grid: DataFrame, cells: DataFrame, rows: DataFrame) -> DataFrame:
    """Violations of tables(tbl, width, width_type, layout, indent), grid(tbl, col, w), cells(tbl, row, col, w, text), rows(tbl, row, cant_split)."""
    sums = grid.groupBy("tbl").agg(F.sum("w").alias("grid_sum"))
    splits = rows.groupBy("tbl").agg(F.count_if(~F.coalesce("cant_split", F.lit(False))).alias("splits"))
    label = F.upper(F.regexp_extract("text", "^\\s*\\(\\s*([A-Za-z])\\s*\\)", 1))
    labels = cells.where("text IS NOT NULL").groupBy("tbl").agg(F.array_join(F.array_sort(F.collect_list(F.nullif(label, F.lit("")))), "").alias("labels"))
    uneven = cells.join(grid.withColumnRenamed("w", "grid_w"), ["tbl", "col"], "left").groupBy("tbl").agg(F.count_if(~F.col("w").eqNullSafe(F.col("grid_w"))).alias("uneven"))
    t = tables
    for part in (sums, splits, labels, uneven):
        t = t.join(part, "tbl", "left")
    return row_violations(t, F.col("tbl"), [
        RowRule("fixed_layout", ~F.col("layout").eqNullSafe("fixed")),
        RowRule("width_type", ~F.col("width_type").eqNullSafe("dxa")),
        RowRule("indent", F.col("indent").isNull()),
        RowRule("grid_sum", ~F.col("grid_sum").eqNullSafe(F.col("width"))),
        RowRule("cant_split", F.coalesce("splits", F.lit(1)) > 0),
        RowRule("labels", ~F.col("labels").eqNullSafe("ABCD")),
        RowRule("cell_width", F.coalesce("uneven", F.lit(1)) > 0),
    ])


def sections(found: DataFrame) -> DataFrame:
    """Violations of sections(doc, n, width_mm, height_mm)."""
    return row_violations(found, F.concat_ws("/", "doc", "n"), [RowRule("a4", ~F.coalesce(is_a4(F.col("width_mm"), F.col("height_mm")), F.lit(False)))])


def bookmark_sequence(found: DataFrame, expected: DataFrame) -> DataFrame:
    """One violation for each document whose bookmark numbers aren't the expected ones in order."""
    numbers = lambda df, name: df.groupBy("doc").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "number"))), lambda s: s["number"]).alias(name))
    both = numbers(expected, "want").join(numbers(found, "have"), "doc", "left")
    return row_violations(both, F.col("doc"), [RowRule("bookmarks", ~F.col("want").eqNullSafe(F.col("have")))])
