"""Alleles, strands and the decoding of genotypes to peptides.

A site's decoding is put once on the site row as two aligned arrays (`code_letters`
and `code_peptides`), so a genotype row only looks its letters up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base pairs of the two strands.
OPPOSITE_BASE = {"G": "C", "C": "G", "A": "T", "T": "A"}

SLOTS = (1, 2, 3)


def slot(values: Column, n: int) -> Column:
    """The n-th one-letter entry of a comma-terminated list such as 'G,C,T,'."""
    return F.substring(values, 2 * n - 1, 1)


def opposite(base: Column) -> Column:
    """The base on the other strand, NULL for anything but A, C, G and T."""
    pairs = F.create_map(*[F.lit(b) for pair in OPPOSITE_BASE.items() for b in pair])
    return F.try_element_at(pairs, base)


def with_peptide_slots(sites: DataFrame) -> DataFrame:
    return sites.withColumns({f"peptide{n}": slot(F.col("peptides"), n) for n in SLOTS})


def with_allele_slots(sites: DataFrame) -> DataFrame:
    return sites.withColumns({f"allele{n}": slot(F.col("alleles"), n) for n in SLOTS})


def with_opposite_slots(sites: DataFrame) -> DataFrame:
    """Adds opallele1..3; needs allele1..3."""
    return sites.withColumns({f"opallele{n}": opposite(F.col(f"allele{n}")) for n in SLOTS})


def code_letters(alleles: Column) -> Column:
    """Own-strand letters first, then opposite-strand letters."""
    own = [slot(alleles, n) for n in SLOTS]
    return F.array(*own, *[opposite(a) for a in own])


def code_peptides(peptides: Column) -> Column:
    """Signed peptides aligned with `code_letters`."""
    return F.array(*[F.concat(F.lit(sign), slot(peptides, n)) for sign in "+-" for n in SLOTS])


def signed_peptide(letter: Column, letters: Column, peptides: Column) -> Column:
    """The signed peptide of one haplotype letter; the first matching slot wins."""
    place = F.nullif(F.array_position(letters, letter), F.lit(0))
    return F.try_element_at(peptides, place.cast("int"))


def genotype_peptides(genotype: Column, letters: Column, peptides: Column) -> Column:
    """'A/G' to '+H+R'; NULL as soon as one haplotype has no match.

    The third haplotype is optional: a genotype without one adds nothing.
    """
    first, second, third = (slot(genotype, n) for n in SLOTS)
    return F.concat(
        signed_peptide(first, letters, peptides),
        signed_peptide(second, letters, peptides),
        F.when(third == "", "").otherwise(signed_peptide(third, letters, peptides)),
    )


def allele_numbers(genotype: Column) -> Column:
    """'0|1:35' to its allele numbers as texts; further fields after ':' are ignored."""
    call = F.replace(F.substring_index(genotype, ":", 1), F.lit("/"), F.lit("|"))
    return F.split(call, r"\|")


def numbered_peptides(numbers: Column, names: Column) -> Column:
    """The unsigned peptides that allele numbers name, of the peptides as an array."""

    def name(n: int) -> Column:
        # A missing allele is no number; left to the cast, each would cost an exception.
        number = F.nullif(F.try_element_at(numbers, F.lit(n)), F.lit(".")).try_cast("int")
        return F.nullif(F.try_element_at(names, number + 1), F.lit(""))

    return F.when(F.size(numbers) == 1, name(1)).otherwise(F.concat(name(1), name(2)))


def index_peptides(genotype: Column, peptides: Column) -> Column:
    """'0|1' to the unsigned peptides those allele numbers name; NULL for './.'.

    Further fields after ':' are ignored. A call of one allele gives its one peptide.
    """
    return numbered_peptides(allele_numbers(genotype), F.split(peptides, ","))


def with_index_peptides(rows: DataFrame, genotype: str, peptides: str, name: str) -> DataFrame:
    """Adds `index_peptides`. The arrays are columns first: as parts of one expression each would
    be split again wherever it is used."""
    arrays = {"_numbers": allele_numbers(F.col(genotype)), "_names": F.split(peptides, ",")}
    pair = numbered_peptides(F.col("_numbers"), F.col("_names"))
    return rows.withColumns(arrays).withColumn(name, pair).drop(*arrays)
