"""Updates in place, folder by folder.

A table in folders (one per chromosome, say) is updated by rewriting only those folders that the
updates touch. The new rows are made and checked in a staging folder first; only then are the touched folders replaced,
so an update that fails on the way changes nothing, and other folders keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.operators.joins import keyed_update
from genoweave.session import remove_written, scratch_path


def _folders(df: DataFrame, partition: str) -> list:
    """The values of `partition`: as many as the table has folders at most."""
    return [r[0] for r in df.select(partition).distinct().orderBy(partition).collect()]


def update_folders(spark: SparkSession, path: str, values: DataFrame, keys: list[str], column: str, partition: str) -> list:
    """Extends `column` of the Parquet table at `path` by the text of `values` with the same keys (see `keyed_update`).

    `values` has `partition` as well, and one row per key. The table's rows keep their number, or nothing is
    replaced. Returns the folders that were rewritten.
    """
    table = spark.read.parquet(path)
    return rewrite_folders(spark, path, lambda rows: keyed_update(rows, values.drop(partition), keys, column).select(*table.columns), values, partition)


def rewrite_folders(spark: SparkSession, path: str, change, touched: DataFrame, partition: str, same_rows: bool = True) -> list:
    """Replaces the rows of the folders that `touched` names by `change(rows)`.

    The folders of the changed rows have to be among the touched ones. With `same_rows` a folder keeps its number of rows.
    """
    table = spark.read.parquet(path)
    # Folder names are read as numbers where they look like ones.
    kind = table.schema[partition].dataType
    named = _folders(touched.select(F.col(partition).cast(kind).alias(partition)), partition)
    there = set(_folders(table, partition))
    folders = [f for f in named if f in there]
    if not folders:
        return []
    old = table.filter(F.col(partition).isin(folders))
    staging = scratch_path(spark, "staging")
    change(old).write.partitionBy(partition).parquet(staging)
    new = spark.read.schema(table.schema).parquet(staging)
    before, after = (dict(df.groupBy(partition).count().collect()) for df in (old, new))
    if set(after) - set(folders):
        raise ValueError(f"changed rows belong to other folders: {sorted(set(after) - set(folders), key=str)}")
    if same_rows and before != after:
        raise ValueError("a folder would not keep its number of rows")
    if set(after) != set(folders):
        raise ValueError("a folder would lose all its rows")
    # A write with dynamic partition overwrite replaces the folders it has rows of, at its commit.
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    remove_written(spark, [staging])
    return folders
