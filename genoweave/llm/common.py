"""What several operators share: input columns, written intermediates, partition numbers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.session import remove_written, scratch_path


def documents(docs: DataFrame) -> DataFrame:
    """`doc_id` and `text` alone, a null text as the empty one; other columns cannot clash."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )


def keep_in(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again, for rows that several steps need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Written intermediates of one operator that nothing needs once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        remove_written(self.spark, self.paths)
        self.paths = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts an Arrow batch where the strings of `column` reach `most` bytes, so that Python
    holds few long texts at a time; a longer single text is a slice of its own."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, size = 0, 0
    for end, length in enumerate(lengths):
        if size and size + length > most:
            yield batch.slice(begin, end - begin)
            begin, size = end, 0
        size += length
    if begin < len(lengths):
        yield batch.slice(begin)
