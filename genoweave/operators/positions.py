"""Exact row positions inside groups, also where one group holds most of the rows.

The rows are range-partitioned by group and order, written to the shared folder and numbered within
each partition and group; each partition starts from the sum of the earlier ones. No task sees more than
its own range, whatever the groups are. Rows of one group for all are numbered as they are written, so they
move once, however wide they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.session import written

def sort_column(spec: str) -> Column:
    """'name' or 'name desc' as a sort expression."""
    name, _, direction = spec.partition(" ")
    return F.col(name).desc() if direction == "desc" else F.col(name).asc()


def running_position(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    weight: str | None = None,
    dense: bool = False,
) -> DataFrame:
    """Adds the number of rows (or the sum of `weight`) before each row of its group.

    `order` has to be total: rows that tie in it must be interchangeable. With `dense`
    rows that tie share a position and the distinct positions before them are counted.
    """
    if not keys and weight is None and not dense:
        return _row_position(df, order, name)
    amount = F.lit(1) if weight is None else F.col(weight)
    sorts = [sort_column(spec) for spec in order]

    def before(*partition: str) -> Column:
        window = Window.partitionBy(*partition).orderBy(*sorts)
        if dense:
            return F.dense_rank().over(window).cast("long") - 1
        if weight is None:
            return F.row_number().over(window).cast("long") - 1
        earlier = window.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(amount).over(earlier), F.lit(0)).cast("long")

    columns = df.columns
    ranges = [F.col(key) for key in keys] + sorts
    ranged = written(
        df.repartitionByRange(*ranges).withColumn("_segment", F.spark_partition_id())
    )
    numbered = ranged.withColumn(name, before(*keys, "_segment"))
    if dense:
        # Ties lie in one segment, so a segment's last position tells its distinct ones.
        sized = numbered.groupBy(*keys, "_segment").agg((F.max(name) + 1).alias("_amount"))
    else:
        sized = ranged.groupBy(*keys, "_segment").agg(F.sum(amount).alias("_amount"))
    # One row per segment and group that meet: few, also where this runs in one task.
    earlier = (
        Window.partitionBy(*keys)
        .orderBy("_segment")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sized.select(
        *[F.col(key).alias(f"_key{i}") for i, key in enumerate(keys)],
        F.col("_segment").alias("_of"),
        F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = [F.col(key).eqNullSafe(F.col(f"_key{i}")) for i, key in enumerate(keys)]
    condition = reduce(Column.__and__, same, F.col("_segment") == F.col("_of"))
    return numbered.join(offsets, condition).select(*columns, (F.col(name) + F.col("_offset")).cast("long").alias(name))


def _row_position(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """The number of rows before each row of the whole table."""
    sorts = [sort_column(spec) for spec in order]
    ranged = df.repartitionByRange(*sorts).sortWithinPartitions(*sorts)
    # A row's id counts the rows before it in its partition in its lower 33 bits.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(ranged.withColumns({"_segment": F.spark_partition_id(), "_place": place}))
    before = Window.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_segment").agg(F.count("*").alias("_amount"))
    starts = sizes.select(F.col("_segment"), F.coalesce(F.sum("_amount").over(before), F.lit(0)).alias("_start"))
    # One row per range partition, so that the rows themselves stay where they are.
    placed = rows.join(F.broadcast(starts), "_segment")
    return placed.select(*df.columns, (F.col("_place") + F.col("_start")).cast("long").alias(name))


def row_numbers(df: DataFrame, keys: list[str], order: list[str], name: str = "row") -> DataFrame:
    """1, 2, 3 ... inside each group."""
    return running_position(df, keys, order, name).withColumn(name, F.col(name) + 1)
