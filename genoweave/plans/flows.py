"""The flows a user calls: annotation, decoding, matrices and drug tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.functions.alleles import (
    code_letters,
    code_peptides,
    genotype_peptides,
    with_allele_slots,
    with_index_peptides,
    with_opposite_slots,
)
from genoweave.functions.text import gene_label, quoted, strip_brackets, strip_commas
from genoweave.operators import drugs as dg
from genoweave.operators import lists, ranks, reshape
from genoweave.operators.joins import gene_map, with_genes


def annotate_genes(rows: DataFrame, variation: DataFrame, genename: DataFrame,
                   id_column: str = "rsid") -> DataFrame:
    """Rows by variant id with the variation and each of its genes."""
    return with_genes(rows, gene_map(variation, genename), id_column)


def gene_lists(
    annotated: DataFrame, order: list[str], key: str = "gene_name", value: str = "rsid",
    page_items: int = lists.PAGE_ITEMS,
) -> tuple[DataFrame, DataFrame]:
    """Annotated variant rows, and the id list of each gene in input order."""
    return lists.rows_and_lists(annotated, key, value, order, "rsids_list", page_items)


def split_alleles(sites: DataFrame) -> DataFrame:
    return with_opposite_slots(with_allele_slots(sites))


def site_codes(
    sites: DataFrame, keys: tuple[str, ...] = ("gene_name",),
    page_items: int = lists.PAGE_ITEMS,
) -> DataFrame:
    """The decoding dimension: one row per distinct (gene, site, alleles, peptides).

    Transcripts that decode alike are merged here, once per site, and the page of the site
    in its gene is fixed here, so the genotypes need no numbering of their own.
    """
    known = sites.select(*keys, "rsid", "alleles", "peptides").distinct()
    pages = lists.with_pages(
        known, list(keys), ["rsid"], page_items, dense=True
    )
    return pages.select(
        *keys,
        "rsid",
        "page",
        "alleles",
        "peptides",
        code_letters(F.col("alleles")).alias("code_letters"),
        code_peptides(F.col("peptides")).alias("code_peptides"),
    )


def decode_genotypes(calls: DataFrame, codes: DataFrame, *keep: str) -> DataFrame:
    """(patient, gene_name, page, rsid, peptide_group) per call and decoding row."""
    value = genotype_peptides(F.col("gt"), F.col("code_letters"), F.col("code_peptides"))
    return calls.join(codes, "rsid").select(
        "patient", "gene_name", "page", "rsid", *keep, value.alias("peptide_group")
    )


def gene_peptides(decoded: DataFrame) -> DataFrame:
    """One peptide string per (patient, gene, page), with the ids it is made of."""
    entries = lists.entry_set("rsid", "peptide_group").alias("entries")
    return decoded.groupBy("patient", "gene_name", "page").agg(entries).select(
        "patient",
        "gene_name",
        "page",
        lists.joined("entries", "rsid", ",").alias("rsids"),
        lists.joined("entries", "peptide_group", "").alias("peptide_string"),
    )


def gene_peptides_audit(calls: DataFrame, codes: DataFrame) -> DataFrame:
    """The same strings beside 'genotype-alleles-peptides' of every call they come from."""
    decoded = decode_genotypes(calls, codes, "gt", "alleles", "peptides")
    trail = F.concat("gt", F.lit("-"), "alleles", F.lit("-"), "peptides")
    entries = lists.entry_set("rsid", "trail", "peptide_group").alias("entries")
    groups = decoded.withColumn("trail", trail).groupBy("patient", "gene_name", "page").agg(entries)
    return groups.select(
        "patient",
        "gene_name",
        "page",
        lists.joined("entries", "trail", ",").alias("trails"),
        lists.joined("entries", "peptide_group", "").alias("peptide_string"),
    )


def header_rsids(codes: DataFrame) -> DataFrame:
    """(gene_name, page, rsids): the ids of each feature in order."""
    ids = codes.select("gene_name", "page", "rsid").distinct()
    return ids.groupBy("gene_name", "page").agg(
        lists.ordered_concat("rsid", " ", ["rsid"]).alias("rsids")
    )


def feature_labels(rsids: DataFrame) -> DataFrame:
    label = strip_brackets(gene_label(F.col("gene_name"), F.col("rsids")))
    return rsids.withColumn("label", quoted(label))


def feature_labels_with_drugs(rsids: DataFrame, drugs: DataFrame) -> DataFrame:
    """Labels 'gene | rsids | drugs' without commas, for genes that have drugs.

    Page k of a gene's drug text stands in the label of its page k; a text with more pages
    than the gene has sites for goes on in labels of its own, whose cells are empty.
    """
    texts = drugs.select("gene_name", F.col("drugs_page").alias("page"), "gene_drugs")
    ours = rsids.join(texts.select("gene_name").distinct(), "gene_name", "left_semi")
    theirs = texts.join(rsids.select("gene_name").distinct(), "gene_name", "left_semi")
    label = F.concat_ws(" | ", "gene_name", "rsids", "gene_drugs")
    return ours.join(theirs, ["gene_name", "page"], "full_outer").withColumn(
        "label", quoted(strip_commas(strip_brackets(label)))
    )


def ml_matrix(strings: DataFrame, labels: DataFrame, patients: DataFrame,
              slice_columns: int = reshape.SLICE_COLUMNS):
    """(header lines, patient lines) of the machine-learning matrix."""
    features = reshape.matrix_features(labels, slice_columns)
    return reshape.matrix_header(features), reshape.matrix_lines(strings, features, patients)


def drug_gene_table(dg_tables: dict[str, DataFrame]) -> DataFrame:
    """(gene_name, page, drugs_info) for genes with a direct drug interaction."""
    names = dg.drug_names(dg_tables["drugs"], dg_tables["drug_claims_drugs"])
    claims = dg.gene_claims(dg_tables["genes"], dg_tables["gene_claims_genes"]).distinct()
    texts = dg.claim_texts(names, dg.drug_categories(dg_tables["drug_claim_attributes"]))
    links = dg_tables["interaction_claims"].select("gene_claim_id", "drug_claim_id").distinct()
    return dg.drug_gene_texts(dg.gene_drug_claims(claims, links), texts)


def alt_drug_gene_table(dg_tables: dict[str, DataFrame]) -> DataFrame:
    """The same for genes that interact with a gene that has drugs."""
    names = dg.drug_names(dg_tables["drugs"], dg_tables["drug_claims_drugs"])
    texts = dg.claim_texts(names, dg.drug_categories(dg_tables["drug_claim_attributes"]))
    alternatives = dg.alternative_genes(
        dg_tables["genes"], dg_tables["gene_gene_interaction_claims"]
    )
    pairs = dg.alternative_gene_drugs(
        alternatives, dg_tables["gene_claims_genes"], dg_tables["interaction_claims"]
    )
    return dg.drug_gene_texts(pairs, texts)


def population_strings(calls: DataFrame, codes: DataFrame) -> DataFrame:
    """Peptide strings of calls by variant id; see `pair_strings`."""
    return pair_strings(calls.join(codes, "rsid"))


def pair_strings(rows: DataFrame) -> DataFrame:
    """Peptide strings from allele numbers ('0|1'): one per (patient, chrom, gene, page).

    `rows` counts the calls behind a string; calls without a peptide count as well.
    """
    keys = ["patient", "chrom", "gene_name", "page"]
    values = with_index_peptides(rows, "gt_idx", "peptides", "pair").select(*keys, "rsid", "pair")
    groups = values.groupBy(*keys).agg(
        lists.entry_set("rsid", "pair").alias("entries"), F.count("*").alias("rows")
    )
    return groups.select(*keys, lists.joined("entries", "pair", "").alias("pepstr"), "rows")


def with_gene_strings(rows: DataFrame, strings: DataFrame) -> DataFrame:
    """Each row with the peptide string of its patient, gene and page."""
    return rows.join(strings, ["patient", "chrom", "gene_name", "page"])


def rows_with_strings(rows: DataFrame) -> DataFrame:
    """`rows` as `pair_strings` takes them, each with its string: the same as `with_gene_strings` of
    both. The rows are shuffled and sorted once; nothing is aggregated beside them and joined back.
    """
    keys = ["patient", "chrom", "gene_name", "page"]
    group = Window.partitionBy(*keys)
    named = with_index_peptides(rows.dropna(subset=keys), "gt_idx", "peptides", "_pair")
    before = {c: F.lag(c).over(group.orderBy("rsid", "_pair")) for c in ("rsid", "_pair")}
    again = F.col("rsid").eqNullSafe(before["rsid"]) & F.col("_pair").eqNullSafe(before["_pair"])
    first = named.withColumn("_first", F.when(~again, F.col("_pair")))
    text = lists.ordered_concat("_first", "", ["rsid", "_first"]).over(group)
    return first.withColumn("pepstr", F.nullif(text, F.lit(""))).select(*rows.columns, "pepstr")


def peptide_rank(strings: DataFrame) -> DataFrame:
    """(str_rank, pepstr, strsum) over all patients and chromosomes."""
    return ranks.string_ranks(ranks.string_totals(strings if "rows" in strings.columns else ranks.string_counts(strings)))
