"""Variant call files as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The leading columns of a variant call file.
FIXED_COLUMNS = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]
META = "##"
COLUMN_LINE = "#CHROM"


def vcf_columns(spark: SparkSession, path: str) -> list[str]:
    """The names in the first column line."""
    line = spark.read.text(path).filter(F.col("value").startswith(COLUMN_LINE)).first()
    if line is None:
        raise ValueError(f"no column line in {path}")
    return line["value"].split("\t")


def _data_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Data lines as fields. Every file has to have the same columns; that is checked while
    the lines are read, without a pass of its own. A line is cut once: filters on its fields stay
    above the `explode_outer`, while below a projection each of them would cut it again."""
    value = F.col("value")
    other = value.startswith(COLUMN_LINE) & (value != "\t".join(columns))
    wrong = F.raise_error(F.lit("read files with different columns apart and union them"))
    data = F.when(other, wrong.cast("boolean")).otherwise(~value.startswith("#"))
    cut = F.array(F.split("value", "\t", -1))
    return spark.read.text(path).filter(data).select("value", F.explode_outer(cut).alias("tokens"))


def _fixed(columns: list[str]) -> list[str]:
    return [c for c in columns[: len(FIXED_COLUMNS)] if c in FIXED_COLUMNS]


def _plain(name: str) -> str:
    return name.lstrip("#").lower()


def sample_names(columns: list[str]) -> list[str]:
    return [name.lower() for name in columns[len(_fixed(columns)) :]]


def read_vcf_sites(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """One row per site: the fixed columns and all calls as one array, in sample order.

    Files without an INFO column are read as well. Lines with a wrong number of fields are
    left out. Join sites with their annotation in this form, before `explode_calls`: the
    join then moves one compact row per site and not one per call. Pass the `columns` if
    they are known: looking for them reads the files up to the column line.
    """
    columns = columns or vcf_columns(spark, path)
    fixed = _fixed(columns)
    rows = _data_lines(spark, path, columns).filter(F.size("tokens") == len(columns))
    site = [F.col("tokens")[i].alias(_plain(c)) for i, c in enumerate(fixed)]
    calls = F.slice("tokens", len(fixed) + 1, len(columns) - len(fixed)).alias("calls")
    return rows.select(*site, calls)


def explode_calls(sites: DataFrame, samples: list[str]) -> DataFrame:
    """One row per site and sample, with patient and gt in place of the array.

    The samples stay data: the plan does not grow with their number.
    """
    others = [c for c in sites.columns if c != "calls"]
    long = sites.select(*others, F.posexplode("calls").alias("_at", "gt"))
    return long.select(*others, F.element_at(F.lit(samples), F.col("_at") + 1).alias("patient"), "gt")


def read_vcf(spark: SparkSession, path: str) -> DataFrame:
    """One row per site and sample: the fixed columns, patient and gt."""
    columns = vcf_columns(spark, path)
    return explode_calls(read_vcf_sites(spark, path, columns), sample_names(columns))


def rejected_vcf_lines(spark: SparkSession, path: str) -> DataFrame:
    columns = vcf_columns(spark, path)
    rows = _data_lines(spark, path, columns).filter(F.size("tokens") != len(columns))
    return rows.select("value", F.size("tokens").alias("tokens"))


def read_vcf_meta(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of every meta line."""
    lines = spark.read.text(path).filter(F.col("value").startswith(META))
    key, value = (F.regexp_extract("value", "^##([^=]*)=(.*)$", n) for n in (1, 2))
    return lines.select(key.alias("key"), value.alias("value"))


def info_value(info: str, key: str):
    """One field of the INFO column, NULL if it is absent."""
    found = F.regexp_extract(F.col(info), f"(?:^|;){key}=([^;]*)", 1)
    return F.nullif(found, F.lit(""))
