"""Frequencies, ranks and dictionary codes of peptide strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.operators.lists import PAGE_ITEMS, paged_texts
from genoweave.operators.positions import row_numbers
from genoweave.session import written


def string_counts(strings: DataFrame) -> DataFrame:
    """How many rows each patient has with each peptide string on each chromosome.

    `strings` either repeats a string on every row or says in `rows` how many it stands for.
    """
    present = strings.filter(F.col("pepstr").isNotNull())
    amount = F.sum("rows") if "rows" in strings.columns else F.count("*")
    return present.groupBy("patient", "chrom", "pepstr").agg(amount.alias("count"))


def string_totals(counts: DataFrame) -> DataFrame:
    """How many rows have each peptide string; of `string_counts`, or of strings with their `rows`."""
    if "rows" in counts.columns:
        counts = counts.filter(F.col("pepstr").isNotNull()).withColumnRenamed("rows", "count")
    return counts.groupBy("pepstr").agg(F.sum("count").alias("strsum"))


def string_ranks(totals: DataFrame) -> DataFrame:
    """Rank 1 for the most frequent string; ties in the order of the text."""
    return row_numbers(written(totals), [], ["strsum desc", "pepstr"], "str_rank")


def text_digest(text: str) -> Column:
    """128 bits that stand for a long text as a join key."""
    return F.unhex(F.md5(text))


def rank_encode(strings: DataFrame, ranks: DataFrame) -> DataFrame:
    """Strings with their rank, joined by digest: of the ranks only digest and number travel."""
    codes = ranks.select(text_digest("pepstr").alias("_digest"), "str_rank")
    return strings.withColumn("_digest", text_digest("pepstr")).join(codes, "_digest").drop("_digest")


def patient_rank_lists(
    encoded: DataFrame, page_items: int = PAGE_ITEMS
) -> DataFrame:
    """Per patient the distinct (rank, gene) pairs as two aligned lists."""
    pairs = encoded.select("patient", "str_rank", F.col("gene_name").alias("gene")).distinct()
    lists = paged_texts(
        pairs,
        ["patient"],
        ["str_rank", "gene"],
        {"peptide_string_num": ("str_rank", ","), "gene": ("gene", ",")},
        page_items,
    )
    return lists.withColumnRenamed("patient", "hg_patient")
