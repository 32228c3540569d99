"""Loads that account for every line, in one pass over the file.

A line is parsed once, with the whole line kept where it does not fit. Good rows and rejected lines go out in one write,
in folders of their own, while observed counters run along. So the file is read once, and rows, rejects,
repeated headers and blank lines together are its lines. The counts go to the provenance table.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from genoweave.sources.delimited import NULL_MARKER

COUNTS = "source string, loaded_at timestamp, lines long, rows long, rejects long, headers long, blanks long"
_GOOD, _REJECT = "rows", "rejects"


@dataclass
class Load:
    """What one load gave: `rows`, `rejects` (value, fields, reason), and the counts as one provenance row."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]
    provenance: DataFrame


def load_audited(
    spark: SparkSession, path: str | list[str], schema: str, out: str, separator: str = "\t", header: bool = False,
    marker: str = NULL_MARKER, source: str | None = None,
) -> Load:
    """Loads delimited files into Parquet below `out`.

    A line is rejected if its number of fields is not the schema's, if a field does not fit its type, or if
    a flag is neither true/false, t/f nor 1/0. With `header` the schema's names are the header, which may come in
    any file and at any place; such lines are counted apart, and so are blank ones.
    """
    target = StructType.fromDDL(schema)
    flags = [f.name for f in target if isinstance(f.dataType, BooleanType)]
    fields = [StructField(f.name, StringType() if f.name in flags else f.dataType) for f in target]
    corrupt = "_corrupt"
    parsed = StructType([*fields, StructField(corrupt, StringType())])
    options = {"sep": separator, "quote": "", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt, "nullValue": marker}
    lines = spark.read.text(path).withColumn("_row", _parse(parsed, options))
    number = F.size(F.split("value", rf"\Q{separator}\E", -1))
    bad_flag = F.lit(False)
    for name in flags:
        text = F.col(f"_row.{name}")
        bad_flag = bad_flag | (text.isNotNull() & text.try_cast("boolean").isNull())
    names = separator.join(f.name for f in target)
    kind = (
        F.when(F.col("value") == "", "blanks")
        .when(F.lit(header) & (F.lower(F.ltrim("value", F.lit("#"))) == names.lower()), "headers")
        .when((number != len(target.fields)) | F.col(f"_row.{corrupt}").isNotNull() | bad_flag, _REJECT)
        .otherwise(_GOOD)
    )
    reason = F.when(number != len(target.fields), "fields").when(bad_flag, "flag").otherwise("type")
    kinds = lines.withColumns({"_kind": kind, "_fields": number, "_reason": reason})
    seen = Observation()
    counted = kinds.observe(seen, F.count(F.lit(1)).alias("lines"), *[F.count_if(F.col("_kind") == k).alias(k) for k in (_GOOD, _REJECT, "headers", "blanks")])
    good = F.col("_kind") == _GOOD
    values = [F.when(good, F.col(f"_row.{f.name}").try_cast(f.dataType)).alias(f.name) for f in target]
    rejected = F.when(~good, F.struct("value", F.col("_fields").alias("fields"), F.col("_reason").alias("reason"))).alias("_rejected")
    counted.filter(F.col("_kind").isin(_GOOD, _REJECT)).select("_kind", *values, rejected).write.partitionBy("_kind").parquet(out)
    counts = {k: int(v) for k, v in seen.get.items()}
    stored = StructType([*target.fields, StructField("_rejected", StructType.fromDDL("value string, fields int, reason string"))])

    def part(name: str) -> DataFrame:
        if not counts[name]:
            return spark.createDataFrame([], stored)
        return spark.read.schema(stored).parquet(f"{out.rstrip('/')}/_kind={name}")

    said = source or (path if isinstance(path, str) else ", ".join(path))
    row = (said, datetime.datetime.now(), *[counts[k] for k in ("lines", "rows", "rejects", "headers", "blanks")])
    return Load(part(_GOOD).select(*target.names), part(_REJECT).select("_rejected.*"), counts, spark.createDataFrame([row], COUNTS))


def _parse(parsed: StructType, options: dict[str, str]):
    return F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed), options)
