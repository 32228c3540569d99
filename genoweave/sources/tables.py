"""Catalog tables: guards, copies, lookups and provenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from genoweave.sources.schemas import PROVENANCE


def need_table(spark: SparkSession, name: str) -> DataFrame:
    """The table, or an error that names it."""
    if not spark.catalog.tableExists(name):
        raise LookupError(f"no table {name}")
    return spark.table(name)


def save_table(
    df: DataFrame, name: str, overwrite: bool = False, path: str | None = None
) -> DataFrame:
    """Writes a new table; an existing one only with `overwrite`. A `path` keeps the files
    outside the warehouse folder."""
    writer = df.write.mode("overwrite" if overwrite else "errorifexists")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def empty_copy(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A table with the columns of `df` and no rows."""
    return save_table(df.limit(0), name, path=path)


def append_to(df: DataFrame, name: str) -> None:
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def tables_like(spark: SparkSession, pattern: str) -> list[str]:
    """Names by pattern, with * for any text."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def provenance(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Where each loaded table came from."""
    return spark.createDataFrame(rows, PROVENANCE)


def union_tables(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; a column one of them lacks is empty there."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def write_by_chromosome(df: DataFrame, path: str, column: str = "chrom") -> None:
    """One folder per chromosome; reading `path` gives their union, pruned by filters.

    Rows are gathered by chromosome first, so tasks do not each write a file per folder;
    a chromosome with many rows is split over several tasks.
    """
    df.hint("rebalance", column).write.partitionBy(column).parquet(path)
