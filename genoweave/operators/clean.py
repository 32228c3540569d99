"""Row filters, column choices and the profile of every column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.functions.alleles import with_peptide_slots

# The prefixes of the patient ids and the mark of a site outside a frame.
PATIENT_PREFIXES = ("sz", "cg", "el", "gc")
NO_FRAME = "n/a"


def _equal(left: str, right: str) -> Column:
    """True only for two equal values; a missing value equals nothing."""
    return F.coalesce(F.col(left) == F.col(right), F.lit(False))


def drop_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.filter(~_equal(left, right))


def equal_rows(df: DataFrame, left: str, right: str) -> DataFrame:
    """The rows `drop_equal` leaves out."""
    return df.filter(_equal(left, right))


def in_frame(sites: DataFrame) -> DataFrame:
    return sites.filter(~F.col("frame").like(NO_FRAME))


def peptide_differs(sites: DataFrame, strict: bool = False) -> DataFrame:
    """Keeps sites whose peptide slots are not all equal; needs peptide1..3.

    An empty third slot counts as different from the others, so a synonymous site with two
    alleles stays. With `strict` empty slots are ignored.
    """
    one, two, three = (F.col(f"peptide{n}") for n in (1, 2, 3))
    pairs = [(one, two), (one, three), (two, three)]
    if not strict:
        return sites.filter((one != two) | (one != three) | (two != three))
    differs = [(a != b) & (a != "") & (b != "") for a, b in pairs]
    return sites.filter(differs[0] | differs[1] | differs[2])


def coding_sites(annotation: DataFrame, strict: bool = False) -> DataFrame:
    """In-frame sites with differing peptides and peptide1..3 added."""
    return peptide_differs(with_peptide_slots(in_frame(annotation)), strict)


def study_patients(calls: DataFrame, prefixes: tuple[str, ...] = PATIENT_PREFIXES) -> DataFrame:
    """Calls of patients whose id has a study prefix and a digit from 1 to 9."""
    return calls.filter(F.col("patient").rlike(f"^({'|'.join(prefixes)}).*[1-9]"))


def matching_columns(df: DataFrame, prefixes: tuple[str, ...] = PATIENT_PREFIXES) -> DataFrame:
    """The same choice on a table with one column per patient."""
    return df.select(df.colRegex(f"`^({'|'.join(prefixes)}).*[1-9].*`"))


def column_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, count) for every value of every column, missing values left out."""
    chosen = columns or df.columns
    text = df.select(*[F.col(c).cast("string").alias(c) for c in chosen])
    values = text.unpivot([], chosen, "column", "value").filter(F.col("value").isNotNull())
    return values.groupBy("column", "value").agg(F.count("*").alias("count"))


def sorted_by(df: DataFrame, *order: str | Column) -> DataFrame:
    """A total sort. All other columns and the input partition break ties, so rows with
    one and the same key still spread over several tasks."""
    keys = [F.col(o) if isinstance(o, str) else o for o in order]
    named = [o for o in order if isinstance(o, str)]
    rest = [F.col(c) for c in df.columns if c not in named]
    return df.orderBy(*keys, *rest, F.spark_partition_id())


def by_frequency(profile: DataFrame) -> DataFrame:
    return sorted_by(profile, F.desc("count"), "column", "value")


def by_position(sites: DataFrame, numeric: bool = False) -> DataFrame:
    """Sorted by coordinate and gene; coordinates are text and sort as text by default."""
    place = F.col("coordinate").try_cast("long") if numeric else "coordinate"
    return sorted_by(sites, place, "gene_name")


def top_values(profile: DataFrame, k: int) -> DataFrame:
    """The k most frequent values of all columns together."""
    return profile.orderBy(F.desc("count"), "column", "value").limit(k)


def opposite_strand_counts(cells: DataFrame, cell: str) -> DataFrame:
    """How many cells carry both signs, only '+' and only '-'."""
    plus, minus = F.col(cell).contains("+"), F.col(cell).contains("-")
    return cells.agg(
        F.count_if(plus & minus).alias("both"),
        F.count_if(plus & ~minus).alias("positive"),
        F.count_if(minus & ~plus).alias("negative"),
    )


def line_strand_counts(lines: DataFrame, header_word: str = "patient") -> DataFrame:
    """The same counts over exported text lines: cells from the third one on."""
    body = lines.filter(~F.col("value").contains(header_word))
    fields = F.split("value", ",")
    cells = body.select(F.explode(F.slice(fields, F.lit(3), F.greatest(F.size(fields) - 2, F.lit(0)))).alias("cell"))
    return opposite_strand_counts(cells, "cell")
