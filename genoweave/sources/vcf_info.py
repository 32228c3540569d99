"""INFO fields with their declared types, and one record per alternative allele.

The meta lines of a call file say of each INFO field how many values it has (a number, A: one per alternative
allele, R: one per allele, G: one per genotype, 0: a flag) and of which type. The declared fields become
columns of one struct; what a file does not declare stays text in a map. A record with several alternative
alleles becomes a record per allele, and fields of the arities A, R and G are cut to what belongs to the allele.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.sources.vcf import read_vcf_meta

# The types a meta line can name.
TYPES = {"Integer": "bigint", "Float": "double", "Flag": "boolean", "Character": "string", "String": "string"}
MISSING = "."


@dataclass(frozen=True)
class InfoField:
    """`number` is a count as text, or A, R, G or `.` (any number)."""

    name: str
    number: str
    kind: str

    @property
    def flag(self) -> bool:
        return self.kind == "boolean"

    @property
    def single(self) -> bool:
        return self.number == "1" and not self.flag


def info_fields(spark: SparkSession, path: str) -> list[InfoField]:
    """The declared fields, by name. A field that is declared twice has to be declared alike."""
    found = read_vcf_meta(spark, path).filter(F.col("key") == "INFO").select(
        *[F.regexp_extract("value", rf"[<,]{part}=([^,>]*)", 1).alias(part) for part in ("ID", "Number", "Type")]
    )
    fields: dict[str, InfoField] = {}
    for row in found.distinct().orderBy("ID", "Number", "Type").collect():  # the declarations of a file's head
        field = InfoField(row["ID"], "0" if row["Type"] == "Flag" else row["Number"], TYPES.get(row["Type"], "string"))
        if fields.setdefault(field.name, field) != field:
            raise ValueError(f"the INFO field {field.name} is declared in two ways")
    return list(fields.values())


def _values(text: Column, kind: str) -> Column:
    """The comma-separated values of a field; a dot is a missing one, and so is a value of another type."""
    return F.transform(F.split(text, ",", -1), lambda v: F.when(v != MISSING, v).try_cast(kind))


def typed_info(sites: DataFrame, fields: list[InfoField], info: str = "info") -> DataFrame:
    """`info` as a struct of the declared fields (single values plain, others as arrays, flags as booleans),
    and `info_other`, a map of the rest as text. A field a record lacks, or has as a dot, is NULL; a flag it lacks is false.
    Of a field that a record has twice the last one counts."""
    text = F.when(F.col(info) == MISSING, "").otherwise(F.coalesce(F.col(info), F.lit("")))
    entries = F.filter(F.split(text, ";"), lambda e: e != "")
    pairs = F.transform(entries, lambda e: F.struct(F.substring_index(e, "=", 1).alias("key"), F.when(e.contains("="), F.substring(e, F.instr(e, "=") + 1, F.length(e))).alias("value")))
    # A column of its own: inside a lambda it would be worked out again for every entry.
    rows = sites.withColumn("_pairs", pairs)
    pair, keys = F.col("_pairs"), F.col("_pairs.key")
    last = F.filter(pair, lambda p, k: ~F.exists(F.slice(pair, k + 2, F.size(pair)), lambda q: q["key"] == p["key"]))
    last = F.when(F.size(F.array_distinct(keys)) == F.size(keys), pair).otherwise(last)
    rows = rows.withColumn("_map", F.map_from_entries(last)).drop("_pairs")

    def one(field: InfoField) -> Column:
        if field.flag:
            return F.map_contains_key("_map", field.name)
        found = F.try_element_at("_map", F.lit(field.name))
        found = F.when(found != MISSING, found)
        return found.try_cast(field.kind) if field.single else _values(found, field.kind)

    declared = [f.name for f in fields]
    other = F.map_filter("_map", lambda k, v: ~k.isin(declared)) if declared else F.col("_map")
    struct = F.struct(*[one(f).alias(f.name) for f in fields]) if fields else F.lit(None).cast("struct<none:string>")
    return rows.withColumns({info: struct, "info_other": other}).drop("_map")


def _expected(field: InfoField, alleles: Column) -> Column | None:
    """How many values a field has beside so many alternative alleles; None for any number."""
    if field.number == "A":
        return alleles
    if field.number == "R":
        return alleles + 1
    if field.number == "G":
        return F.call_function("div", (alleles + 1) * (alleles + 2), F.lit(2)).cast("int")
    return F.lit(int(field.number)) if field.number.isdigit() else None


def _alternatives(alt: str) -> Column:
    return F.when(F.col(alt).isNull() | (F.col(alt) == MISSING), F.array().cast("array<string>")).otherwise(F.split(alt, ","))


def arity_errors(typed: DataFrame, fields: list[InfoField], keep: list[str], info: str = "info", alt: str = "alt") -> DataFrame:
    """(keep, field, expected, found) for values whose number is not the declared one; they are NULL in `per_allele`."""
    checks = []
    for field in fields:
        expected = _expected(field, F.size(_alternatives(alt)))
        if field.flag or field.single or expected is None:
            continue
        found = F.size(F.col(f"{info}.{field.name}"))
        check = F.struct(F.lit(field.name).alias("field"), expected.alias("expected"), found.alias("found"))
        checks.append(F.when(F.col(f"{info}.{field.name}").isNotNull() & (expected != found), check))
    if not checks:
        return typed.select(*keep, F.lit("").alias("field"), F.lit(0).alias("expected"), F.lit(0).alias("found")).limit(0)
    return typed.select(*keep, F.inline(F.array_compact(F.array(*checks))))


def per_allele(typed: DataFrame, fields: list[InfoField], info: str = "info", alt: str = "alt", calls: str | None = None) -> DataFrame:
    """One row per alternative allele, with `allele`, its number from 1; a record without any stays one row with
    allele 0 and a NULL `alt`.

    Of a field of arity A the allele's value stays, plain; of R the reference's and the allele's; of G those
    of the genotypes of these two (for two haplotypes). Other fields stay as they are. With `calls`, an array of calls,
    allele numbers are rewritten: 0 stays, the allele becomes 1, another one a dot.
    """
    listed = F.col("_listed")
    rows = typed.withColumn("_listed", _alternatives(alt))
    rows = rows.withColumns({"_n": F.size(listed), "_alt": F.when(F.size(listed) > 0, listed).otherwise(F.array(F.lit(None).cast("string")))})
    others = [c for c in typed.columns if c != alt]
    rows = rows.select(*others, "_n", F.posexplode("_alt").alias("_at", alt))
    rows = rows.withColumn("allele", F.when(F.col("_n") > 0, F.col("_at") + 1).otherwise(0))
    k = F.col("allele")

    def cut(field: InfoField) -> Column:
        value, expected = F.col(f"{info}.{field.name}"), _expected(field, F.col("_n"))
        if field.flag or field.single or expected is None:
            return value
        fits = F.size(value) == expected
        if field.number == "A":
            return F.when(fits, F.get(value, k - 1))
        if field.number == "R":
            return F.when(fits, F.when(k > 0, F.array(F.get(value, F.lit(0)), F.get(value, k))).otherwise(value))
        if field.number == "G":
            both = F.call_function("div", k * (k + 1), F.lit(2)).cast("int")
            return F.when(fits, F.when(k > 0, F.array(F.get(value, F.lit(0)), F.get(value, both), F.get(value, both + k))).otherwise(value))
        return F.when(fits, value)

    if fields:
        rows = rows.withColumn(info, F.struct(*[cut(f).alias(f.name) for f in fields]))
    if calls:
        rows = rows.withColumn(calls, F.transform(calls, lambda c: recoded_call(c, k)))
    return rows.select(*typed.columns, "allele")


def recoded_call(call: Column, allele: Column) -> Column:
    """A call such as `0|2:35` seen from one allele: its number is 1, the reference 0, any other a dot."""
    genotype = F.substring_index(call, ":", 1)
    rest = F.substring(call, F.length(genotype) + 1, F.length(call))
    numbers = F.split(genotype, "[|/]")
    marks = F.array_append(F.regexp_extract_all(genotype, F.lit("[|/]"), F.lit(0)), F.lit(""))
    new = F.transform(numbers, lambda n: F.when(n == "0", n).when(n == allele.cast("string"), "1").otherwise(MISSING))
    return F.concat(F.array_join(F.zip_with(new, marks, lambda n, m: F.concat(n, m)), ""), rest)
