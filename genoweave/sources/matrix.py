"""Whitespace-separated matrices, their rejected lines, and line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.functions.text import words


def _first_line(spark: SparkSession, path: str, marker: str) -> list[str]:
    line = spark.read.text(path).filter(F.trim("value").startswith(marker)).first()
    if line is None:
        raise ValueError(f"no line of {path} starts with {marker}")
    return line["value"].split()


def _token_lines(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Every line that is no header, as tokens. The header may be repeated anywhere, but it
    has to stay the same; that is checked while the lines are read."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    tokens = lines.select("value", words(F.col("value")).alias("tokens"))
    repeated = F.col("tokens")[0].startswith(header[0])
    other = repeated & (F.col("tokens") != F.lit(header))
    wrong = F.raise_error(F.lit("read files with different columns apart and union them"))
    return tokens.filter(F.when(other, wrong.cast("boolean")).otherwise(~repeated))


def read_matrix(spark: SparkSession, path: str, key: str = "idnum") -> DataFrame:
    """(key, patient, gt) from a file with one column per patient, in any width.

    Lines with more or fewer tokens than the header are left out.
    """
    header = _first_line(spark, path, key)
    rows = _token_lines(spark, path, header).filter(F.size("tokens") == len(header))
    patients = F.lit([name.lower() for name in header[1:]])
    calls = F.slice("tokens", 2, len(header) - 1)
    long = rows.select(F.col("tokens")[0].alias(key), F.posexplode(calls).alias("_at", "gt"))
    return long.select(key, F.element_at(patients, F.col("_at") + 1).alias("patient"), "gt")


def read_table(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A narrow whitespace-separated table, all text, lower-case column names."""
    header = _first_line(spark, path, key)
    rows = _token_lines(spark, path, header).filter(F.size("tokens") == len(header))
    return rows.select(*[F.col("tokens")[i].alias(c.lower()) for i, c in enumerate(header)])


def rejected_lines(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The lines the two readers leave out, with their token count."""
    header = _first_line(spark, path, key)
    rows = _token_lines(spark, path, header).filter(F.size("tokens") != len(header))
    return rows.select("value", F.size("tokens").alias("tokens"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, value) over all files of a path in name order, counted from 1.

    Lines are counted per file block; a block starts at the sum of the blocks before it.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    sizes = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    # One row per file block, so a single task numbers the blocks of any input.
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("file").alias("_file"), F.col("block").alias("_block"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
    )
    same = (F.col("file") == F.col("_file")) & (F.col("block") == F.col("_block"))
    number = (F.col("start") + F.col("at") - F.col("first") + 1).cast("long")
    return lines.join(starts, same).select(number.alias("line"), "value")


def paste(left: DataFrame, right: DataFrame, key: str = "line") -> DataFrame:
    """Column-wise paste of two numbered tables; the longer side's rest stays, beside nothing."""
    return left.join(right, key, "full_outer")
