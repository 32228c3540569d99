"""Tab-separated and comma-separated files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from genoweave.functions.text import list_text
from genoweave.sources import schemas

# Fixed value: the text that stands for a missing value.
NULL_MARKER = "\\N"


def read_tsv(
    spark: SparkSession, path: str | list[str], schema: str, header: bool = False,
    keep_null_marker: bool = False, drop_malformed: bool = False,
) -> DataFrame:
    """A tab-separated file, plain or gzip, with a given schema.

    A line with another number of fields fails the query, and so does a field of another type in a
    column that the query uses; `drop_malformed` leaves such lines out, and `rejected_tsv_lines` has
    those with a wrong number. A header has to name the schema's columns in their order, apart from
    case and a hash in front.

    `keep_null_marker` leaves the NULL marker as text. Gzip files are read by one task
    each, so spread the rows with `repartition` before heavy work on few large ones.
    """
    fields = StructType.fromDDL(schema).fields
    flags = [f.name for f in fields if isinstance(f.dataType, BooleanType)]
    raw = StructType([StructField(f.name, StringType() if f.name in flags else f.dataType) for f in fields])
    names = [f.name for f in fields]
    if header:
        line = spark.read.text(path).first()
        found = line["value"].split("\t") if line else names
        if [x.lstrip("#").lower() for x in found] != [x.lower() for x in names]:
            raise ValueError(f"the header is {found}, not {names}")
        # Every file's own header is checked against these while it is read.
        raw = StructType([StructField(x, f.dataType) for x, f in zip(found, raw)])
    reader = spark.read.schema(raw).option("sep", "\t").option("header", header)
    reader = reader.option("quote", "").option("enforceSchema", not header).option("columnPruning", False)
    reader = reader.option("mode", "DROPMALFORMED" if drop_malformed else "FAILFAST")
    if keep_null_marker:
        # An empty field is still a missing value.
        reader = reader.option("nullValue", "")
    else:
        reader = reader.option("nullValue", NULL_MARKER)
    # The files write flags as 1/0 or t/f, which only a cast understands.
    return reader.csv(path).toDF(*names).withColumns({f: F.col(f).try_cast("boolean") for f in flags})


def rejected_tsv_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Lines whose number of fields is not the schema's, with that number."""
    fields = F.size(F.split("value", "\t", -1))
    lines = spark.read.text(path).filter(F.col("value") != "").withColumn("tokens", fields)
    return lines.filter(F.col("tokens") != len(StructType.fromDDL(schema)))


def read_variation(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.VARIATION)


def read_genename(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.GENENAME)


def read_coding_snp(spark: SparkSession, path: str) -> DataFrame:
    return read_tsv(spark, path, schemas.CODING_SNP)


def read_drug_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    return read_tsv(spark, path, schemas.drug_table(table))


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    reader = spark.read.schema(schema).option("header", header).option("escape", '"')
    return reader.csv(path)


def write_tsv(df: DataFrame, path: str, header: bool = False, compression: str | None = None) -> None:
    writer = df.write.option("sep", "\t").option("header", header).option("quote", "")
    writer = writer.option("nullValue", NULL_MARKER).option("emptyValue", "")
    writer.csv(path, compression=compression)


def write_csv(df: DataFrame, path: str, header: bool = True, max_rows_per_file: int = 0) -> None:
    """Arrays are written as "['a', 'b']"."""
    arrays = [name for name, kind in df.dtypes if kind == "array<string>"]
    text = df.withColumns({name: list_text(F.col(name)) for name in arrays}) if arrays else df
    writer = text.write.option("header", header).option("escape", '"')
    writer.option("maxRecordsPerFile", max_rows_per_file).csv(path)


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """A matrix of ready lines, one folder per slice if there are slices."""
    if "slice" in df.columns:
        lines = df.select("slice", F.col(column).alias("value")).hint("rebalance", "slice")
        lines.write.partitionBy("slice").text(path)
    else:
        df.select(F.col(column).alias("value")).write.text(path)
