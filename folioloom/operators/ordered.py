"""Ordered operators: islands, carried values, as-of and positional joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def window(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def island(start: Column, keys: list[str], order: list[str]) -> Column:
    """Number of starts so far: rows between two starts share it."""
    return F.sum(F.coalesce(start.cast("int"), F.lit(0))).over(window(keys, order).rowsBetween(*_UP_TO_HERE))


def consecutive(value: Column, keys: list[str], order: list[str]) -> Column:
    """Island of rows whose value grows by one from row to row."""
    return value - F.row_number().over(window(keys, order))


def changes(value: Column, keys: list[str], order: list[str]) -> Column:
    """Island of rows with equal neighbouring values."""
    before = F.lag(value).over(window(keys, order))
    return island(~value.eqNullSafe(before) | F.row_number().over(window(keys, order)).eqNullSafe(1), keys, order)


def carry(value: Column, keys: list[str], order: list[str]) -> Column:
    """The last value that isn't null, this row included."""
    return F.last(value, ignorenulls=True).over(window(keys, order).rowsBetween(*_UP_TO_HERE))


def carry_reset(value: Column, reset: Column, keys: list[str], order: list[str], marker: str = "\0") -> Column:
    """As :func:`carry`, but a row where ``reset`` holds forgets what came before."""
    held = carry(F.coalesce(value, F.when(reset, F.lit(marker))), keys, order)
    return F.nullif(held, F.lit(marker))


def asof_backward(left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, take: list[str], inclusive: bool = True, tie: str | None = None) -> DataFrame:
    """left with the columns ``take`` of the latest right row at or before it (before it, if not inclusive).

    Both sides are one ordered stream, so the cost is a sort by key and place, not a product.
    Of right rows at one place the one with the least ``tie`` counts.
    """
    payload = F.struct(*[F.col(c) for c in take])
    if tie:
        w = Window.partitionBy(*keys, right_at).orderBy(tie)
        right = right.withColumn("__n", F.row_number().over(w)).where("__n = 1")
    names = left.columns
    l_rows = left.select(*keys, F.col(at).alias("__at"), F.lit(1).alias("__side"), F.struct(*names).alias("__row"), F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("__hit"))
    r_rows = right.select(*keys, F.col(right_at).alias("__at"), F.lit(0 if inclusive else 2).alias("__side"), F.lit(None).cast(l_rows.schema["__row"].dataType).alias("__row"), payload.alias("__hit"))
    both = l_rows.unionByName(r_rows)
    w = Window.partitionBy(*keys).orderBy("__at", "__side").rowsBetween(*_UP_TO_HERE)
    found = both.withColumn("__hit", F.last("__hit", ignorenulls=True).over(w)).where("__row IS NOT NULL")
    return found.select("__row.*", *[F.col("__hit")[c].alias(c) for c in take])


def running_prefix(is_break: Column, keys: list[str], order: list[str], n: int, keep_break: bool = True) -> Column:
    """True for the rows up to the n-th break, that one included or not."""
    before = F.coalesce(F.sum(is_break.cast("int")).over(window(keys, order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (before < n) if keep_break else (before + is_break.cast("int") < n)


def relocate(pos: Column, first: Column, last: Column, before: Column) -> Column:
    """Order key that moves rows in [first, last) to just before ``before``; unmoved if either is null."""
    moved = (pos >= first) & (pos < last)
    return F.when(moved & before.isNotNull(), F.struct(before.alias("a"), F.lit(0).alias("b"), pos.alias("c"))).otherwise(F.struct(pos.alias("a"), F.lit(1).alias("b"), pos.alias("c")))


def number_rows(df: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """df with global row numbers from 1 by ``order``, never sorted in one task.

    Rows are dealt by range and numbered inside their range; the number of rows before each
    range is a running sum over one row a range.
    """
    ranged = df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    inside = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__range").orderBy(*order)))
    sizes = inside.groupBy("__range").agg(F.count("*").alias("__size"))
    before = F.coalesce(F.sum("__size").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = sizes.select("__range", before.alias("__before"))
    return inside.join(F.broadcast(first), "__range").withColumn(name, (F.col("__before") + F.col("__n")).cast("long")).select(*df.columns, name)


#: Rows that one task takes where rows are dealt by their number.
ROWS_A_TASK = 250_000


def dealt(df: DataFrame, keys: list[str], n_rows: int, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """df dealt by ``keys`` to as many tasks as ``n_rows`` ask for, so that a task's share doesn't grow with the table.

    Windows and groups of these keys, and of more with them, need no other shuffle.
    """
    spark = df.sparkSession
    least = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(least, -(-n_rows // rows_a_task)), *keys)
