"""Calls of a site as a dictionary of its genotypes and a small code per call.

A site has a handful of distinct genotypes, however many patients it has. They are decoded once per site and
decoding row; the calls stay an array of codes through every join and are exploded last, when a
call only picks its entry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.functions.alleles import genotype_peptides
from genoweave.operators.lists import with_pages

#: Calls in one block of a site.
BLOCK_CALLS = 4096


def site_blocks(
    calls: DataFrame, order: list[str], keep: list[str], site: str = "rsid", value: str = "gt", items: int = BLOCK_CALLS,
) -> DataFrame:
    """Long calls as one row per site and block of `items` calls: `calls`, and `keep` as arrays beside it.

    `order` is total inside a site; a site of very many calls is many blocks.
    """
    entry = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *keep, value])])
    blocks = with_pages(calls, [site], order, items).groupBy(site, "page").agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    arrays = [F.col(f"_rows.{c}").alias(c) for c in keep]
    return blocks.select(site, *arrays, F.col(f"_rows.{value}").alias("calls"))


def encode_calls(sites: DataFrame) -> DataFrame:
    """`genotypes` (the distinct ones) and `codes` (places in it from 1; NULL for a missing call) for `calls`."""
    rows = sites.withColumn("genotypes", F.array_compact(F.array_distinct("calls")))
    code = F.transform("calls", lambda c: F.array_position("genotypes", c).cast("short"))
    return rows.withColumn("codes", code).drop("calls")


def decode_dictionary(coded_sites: DataFrame, codes: DataFrame, site: str = "rsid") -> DataFrame:
    """Coded sites beside each of their decoding rows, with `peptide_groups` aligned with the genotypes."""
    joined = coded_sites.join(codes, site)
    groups = F.transform("genotypes", lambda g: genotype_peptides(g, F.col("code_letters"), F.col("code_peptides")))
    return joined.withColumn("peptide_groups", groups).drop("genotypes", "code_letters", "code_peptides")


def explode_codes(decoded: DataFrame, sites: list[str], calls: list[str], value: str = "peptide_group") -> DataFrame:
    """One row per call: the columns `sites`, `calls` (arrays aligned with the codes), and the decoded value."""
    long = decoded.select(*sites, "peptide_groups", F.explode(F.arrays_zip("codes", *calls)).alias("_call"))
    group = F.try_element_at("peptide_groups", F.col("_call.codes").cast("int"))
    return long.select(*sites, *[F.col(f"_call.{c}").alias(c) for c in calls], group.alias(value))


def explode_samples(decoded: DataFrame, sites: list[str], samples: list[str], value: str = "peptide_group") -> DataFrame:
    """The same for sites of call files, whose calls are in sample order."""
    long = decoded.select(*sites, "peptide_groups", F.posexplode("codes").alias("_at", "_code"))
    group = F.try_element_at("peptide_groups", F.col("_code").cast("int"))
    return long.select(*sites, F.element_at(F.lit(samples), F.col("_at") + 1).alias("patient"), group.alias(value))
