"""The schema of a delimited file, found in the file.

Every field of every line is put into a class (missing, whole number, number, flag, text), and lines, columns
and classes are counted. Counts merge, so tasks send one row per column and class and not one per field, and
the plan is the same for two columns and for three thousand. A column has the narrowest type
that all its classes fit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from genoweave.sources.delimited import NULL_MARKER

MISSING, WHOLE, NUMBER, FLAG, TEXT = "missing", "whole", "number", "flag", "text"


def value_class(text: Column, marker: str = NULL_MARKER) -> Column:
    """The narrowest class of a field. Whole numbers fit 64 bits; flags are true and false in any case."""
    whole = text.rlike(r"^[+-]?[0-9]+$") & text.try_cast("bigint").isNotNull()
    number = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$")
    return (
        F.when(text.isNull() | (text == "") | (text == marker), MISSING)
        .when(whole, WHOLE)
        .when(number, NUMBER)
        .when(F.lower(text).isin("true", "false"), FLAG)
        .otherwise(TEXT)
    )


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.text(path).filter("value <> ''")


def _header(spark: SparkSession, path: str | list[str], separator: str) -> tuple[str, list[str]]:
    line = _lines(spark, path).first()
    if line is None:
        raise ValueError(f"no header in {path}")
    return line["value"], line["value"].split(separator)


def _fields(value: Column, separator: str) -> Column:
    return F.split(value, rf"\Q{separator}\E", -1)


def class_counts(spark: SparkSession, path: str | list[str], separator: str = "\t", header: bool = True, marker: str = NULL_MARKER) -> DataFrame:
    """(at, class, n): how many fields of each column, counted from 0, are of each class. Lines equal to the header do not count."""
    lines = _lines(spark, path)
    if header:
        lines = lines.filter(F.col("value") != _header(spark, path, separator)[0])
    fields = lines.select(F.posexplode(_fields(F.col("value"), separator)).alias("at", "field"))
    return fields.groupBy("at", value_class(F.col("field"), marker).alias("class")).agg(F.count("*").alias("n"))


def column_type(classes: set[str]) -> str:
    """The type of a column with fields of these classes; a column without any value is text."""
    found = classes - {MISSING}
    if found == {WHOLE}:
        return "bigint"
    if found and found <= {WHOLE, NUMBER}:
        return "double"
    return "boolean" if found == {FLAG} else "string"


@dataclass
class Inferred:
    """A file's schema. `missing`: fields without a value per column; `lines`: fields of the first column."""

    names: list[str]
    types: list[str]
    missing: list[int]
    lines: int

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{n}` {t}" for n, t in zip(self.names, self.types))


def infer_schema(
    spark: SparkSession, path: str | list[str], separator: str = "\t", names: list[str] | None = None, marker: str = NULL_MARKER,
) -> Inferred:
    """Names come from the first line, or are given for files without a header. A line with more or
    fewer fields fails here, before anything is loaded under wrong names."""
    given = names or _header(spark, path, separator)[1]
    if len(set(given)) < len(given):
        raise ValueError(f"columns with one name: {sorted({n for n in given if given.count(n) > 1})}")
    classes: list[dict[str, int]] = [{} for _ in given]
    # At most five rows per column, and those of columns that only overlong lines have.
    for row in class_counts(spark, path, separator, names is None, marker).orderBy("at").collect():
        if row["at"] >= len(given):
            raise ValueError(f"{row['n']} lines have more than {len(given)} fields")
        classes[row["at"]][row["class"]] = row["n"]
    totals = [sum(c.values()) for c in classes]
    if len(set(totals)) > 1:
        raise ValueError(f"{totals[0] - min(totals)} lines have fewer than {len(given)} fields")
    return Inferred(given, [column_type(set(c)) for c in classes], [c.get(MISSING, 0) for c in classes], totals[0] if totals else 0)


def read_inferred(
    spark: SparkSession, path: str | list[str], separator: str = "\t", names: list[str] | None = None, marker: str = NULL_MARKER,
    inferred: Inferred | None = None,
) -> DataFrame:
    """The file as a table of the types found in it; the marker and empty fields are NULL.

    Every file may have the header as its first line, or anywhere else. A field that does not fit fails
    the query, also where `inferred` comes from another file.
    """
    found = inferred or infer_schema(spark, path, separator, names, marker)
    lines = _lines(spark, path)
    if names is None:
        lines = lines.filter(F.col("value") != separator.join(found.names))
    wrong = F.raise_error(F.concat(F.lit(f"not {len(found.names)} fields: "), F.substring("value", 1, 200)))
    tokens = lines.select("value", _fields(F.col("value"), separator).alias("tokens"))
    tokens = tokens.select(F.when(F.size("tokens") == len(found.names), F.col("tokens")).otherwise(wrong.cast("array<string>")).alias("tokens"))
    columns = []
    for k, (name, kind) in enumerate(zip(found.names, found.types)):
        field = F.col("tokens")[k]
        columns.append(F.when((field != "") & (field != marker), field.cast(kind)).alias(name))
    return tokens.select(*columns)


def same_layout(one: Inferred, other: Inferred) -> bool:
    """True if files of both can be read as one table by names and types."""
    return StructType.fromDDL(one.ddl) == StructType.fromDDL(other.ddl)
