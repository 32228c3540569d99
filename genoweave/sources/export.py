"""The matrix as files that can be handed over: header first, patients in order, parts numbered.

Lines are range-partitioned by slice, header before patients, and patient, and written as they lie. The
parts of a slice therefore hold, in the order of their names, the header and then all patients in order, and
`cat` over them is the whole export. A slice of very many lines is many parts; no task holds a slice.
A manifest beside the slices names the parts with their rows and first lines' places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.operators.positions import sort_column

MANIFEST = "_manifest"


def write_ordered_lines(header: DataFrame, lines: DataFrame, path: str, order: list[str], slice_name: str = "slice", line: str = "line") -> DataFrame:
    """Writes `header` (slice, line) and `lines` (slice, `order`, line) below `path`; returns the manifest.

    A folder per slice. `order` has to be total inside a slice for an order that is the same in every run;
    nulls come first. A slice without a header starts with its first line.
    """
    keys = [f"_order{k}" for k in range(len(order))]
    first = header.select(F.col(slice_name).alias("slice"), F.lit(0).alias("_kind"), F.col(line).alias("value"))
    rest = lines.select(F.col(slice_name).alias("slice"), F.lit(1).alias("_kind"), *[F.col(s.split()[0]).alias(k) for k, s in zip(keys, order)],
                        F.col(line).alias("value"))
    sorts = [sort_column(" ".join([k, *s.split()[1:]])) for k, s in zip(keys, order)]
    ranges = [F.col("slice"), F.col("_kind"), *sorts]
    whole = rest.unionByName(first, allowMissingColumns=True)
    ordered = whole.repartitionByRange(*ranges).sortWithinPartitions(*ranges)
    ordered.select("slice", "value").write.partitionBy("slice").text(path)
    found = manifest(lines.sparkSession, path)
    found.write.parquet(f"{path.rstrip('/')}/{MANIFEST}")
    return read_manifest(lines.sparkSession, path)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """(value, slice) with the files' metadata; the slice is taken from the folder, so an export may be empty."""
    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").text(path)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/slice=([^/]*)/[^/]*$", 1)
    return lines.select("value", folder.try_cast("long").alias("slice"), "_metadata")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(slice, part, file, rows, first): parts from 0 in order, and the place of each part's first line from 1."""
    rows = _stored(spark, path).groupBy("slice", F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"))
    # One row per part.
    order = Window.partitionBy("slice").orderBy("file")
    before = F.coalesce(F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select("slice", (F.row_number().over(order) - 1).alias("part"), "file", "rows", (before + 1).cast("long").alias("first"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("slice long, part int, file string, rows long, first long").parquet(f"{path.rstrip('/')}/{MANIFEST}")


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(slice, line, value): the lines of an export with their places from 1, read in parallel.

    A place is the part's first one, and the lines before it in earlier blocks of the part and in its own block.
    """
    file, block = F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")
    lines = _stored(spark, path).select("slice", "value", file, block, F.monotonically_increasing_id().alias("at"))
    sizes = lines.groupBy("slice", "file", "block").agg(F.count("*").alias("n"), F.min("at").alias("least"))
    # One row per file block.
    before = Window.partitionBy("slice", "file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("slice", "file", "block", "least", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = starts.join(read_manifest(spark, path).select("slice", "file", "first"), ["slice", "file"])
    place = F.col("first") + F.col("start") + F.col("at") - F.col("least")
    return lines.join(starts, ["slice", "file", "block"]).select("slice", place.cast("long").alias("line"), "value")


def check_export(spark: SparkSession, path: str) -> DataFrame:
    """Parts whose rows are not those of the manifest: none, if the export arrived whole."""
    now = manifest(spark, path).select("slice", "file", F.col("rows").alias("found"))
    then = read_manifest(spark, path).select("slice", "file", "rows")
    both = then.join(now, ["slice", "file"], "full_outer")
    return both.filter(~F.col("rows").eqNullSafe(F.col("found")))

