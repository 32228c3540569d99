"""Genes, drugs and the claims that link them.

`drug_gene_texts` first brings the drug tables to distinct (gene, drug) pairs, so neither
the attributes nor the gene hops multiply rows that the result would merge again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.operators.lists import PAGE_ITEMS, paged_texts

# Fixed value: the attribute that holds a drug's categories.
CATEGORY_ATTRIBUTE = "Drug Categories"


def drug_names(drugs: DataFrame, drug_claims_drugs: DataFrame) -> DataFrame:
    named = drugs.select(F.col("id").alias("drug_id"), F.col("name").alias("drug_name"))
    return named.join(drug_claims_drugs, "drug_id").select("drug_name", "drug_claim_id")


def gene_claims(genes: DataFrame, gene_claims_genes: DataFrame) -> DataFrame:
    named = genes.select(F.col("id").alias("gene_id"), F.col("name").alias("gene_name"))
    return named.join(gene_claims_genes, "gene_id").select("gene_name", "gene_claim_id")


def gene_drug_claims(claims: DataFrame, interaction_claims: DataFrame) -> DataFrame:
    """Gene claims with the drug claims they interact with; other columns are kept."""
    links = interaction_claims.select("gene_claim_id", "drug_claim_id")
    return claims.join(links, "gene_claim_id")


def with_drug_names(gene_drugs: DataFrame, names: DataFrame) -> DataFrame:
    return gene_drugs.join(names, "drug_claim_id")


def with_drug_attributes(gene_drugs: DataFrame, drug_claim_attributes: DataFrame) -> DataFrame:
    attributes = drug_claim_attributes.select("drug_claim_id", "name", "value")
    return gene_drugs.join(attributes, "drug_claim_id")


def drug_categories(
    drug_claim_attributes: DataFrame, page_items: int = PAGE_ITEMS
) -> DataFrame:
    """The distinct categories of each drug claim, joined with '/'."""
    chosen = drug_claim_attributes.filter(F.col("name") == CATEGORY_ATTRIBUTE)
    values = chosen.select("drug_claim_id", "value").distinct()
    return paged_texts(
        values, ["drug_claim_id"], ["value"], {"drug_categories": ("value", "/")},
        page_items,
    )


def claim_texts(names: DataFrame, categories: DataFrame) -> DataFrame:
    """'DRUG{category/category}' of each drug claim."""
    text = F.concat("drug_name", F.lit("{"), "drug_categories", F.lit("}"))
    return names.join(categories, "drug_claim_id").select(
        "drug_claim_id", text.alias("drug_text")
    )


def drug_gene_texts(
    gene_drugs: DataFrame, texts: DataFrame, page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """The distinct drug texts of each gene, joined with blanks."""
    pairs = gene_drugs.select("gene_name", "drug_claim_id").distinct()
    entries = pairs.join(texts, "drug_claim_id").select("gene_name", "drug_text").distinct()
    return paged_texts(
        entries, ["gene_name"], ["drug_text"], {"drugs_info": ("drug_text", " ")},
        page_items,
    )


def alternative_genes(genes: DataFrame, gene_gene: DataFrame) -> DataFrame:
    """The name of each interacting gene beside the id of the gene it interacts with."""
    named = genes.select(F.col("id").alias("gene_id_alt"), F.col("name").alias("gene_name"))
    hops = gene_gene.select("gene_id", F.col("interacting_gene_id").alias("gene_id_alt"))
    return hops.join(named, "gene_id_alt").select("gene_name", "gene_id", "gene_id_alt")


def alternative_pairs(genes: DataFrame, alternatives: DataFrame) -> DataFrame:
    """Alternative genes with the name of the original gene as well."""
    named = genes.select(
        F.col("id").alias("gene_id"), F.col("name").alias("interactive_gene_name")
    )
    return alternatives.join(named, "gene_id")


def alternative_claims(alternatives: DataFrame, gene_claims_genes: DataFrame) -> DataFrame:
    """Alternative genes with the claims of the original gene."""
    joined = alternatives.join(gene_claims_genes, "gene_id")
    return joined.select("gene_id_alt", "gene_name", "gene_claim_id")


def alternative_gene_drugs(
    alternatives: DataFrame, gene_claims_genes: DataFrame, interaction_claims: DataFrame
) -> DataFrame:
    """Distinct (alternative gene, drug claim) pairs, made distinct before the gene hop."""
    links = interaction_claims.select("gene_claim_id", "drug_claim_id").distinct()
    own = gene_claims_genes.join(links, "gene_claim_id").select("gene_id", "drug_claim_id")
    hops = alternatives.select("gene_name", "gene_id").distinct()
    return hops.join(own.distinct(), "gene_id").select("gene_name", "drug_claim_id").distinct()


def with_interacting_names(drugs_info: DataFrame, pairs: DataFrame) -> DataFrame:
    """Drug texts of alternative genes beside the genes they interact with."""
    names = pairs.select("gene_name", "interactive_gene_name").distinct()
    return drugs_info.join(names, "gene_name")


def keep_genes_with_drugs(rows: DataFrame, drugs_info: DataFrame) -> DataFrame:
    """Rows of genes with drugs, with the drug text; the drug table is made distinct first."""
    texts = drugs_info.select(
        F.col("gene_name").alias("gene_name2"), F.col("page").alias("drugs_page"), "drugs_info"
    ).distinct()
    return rows.join(texts, F.col("gene_name") == F.col("gene_name2"))


def genes_with_drugs(
    gene_drugs: DataFrame, names: DataFrame, drug_claim_attributes: DataFrame
) -> DataFrame:
    """The genes that have a drug text, found without building any text."""
    categorised = drug_claim_attributes.filter(
        (F.col("name") == CATEGORY_ATTRIBUTE) & F.col("value").isNotNull()
    )
    usable = names.filter("drug_name is not null").join(categorised, "drug_claim_id", "left_semi")
    return gene_drugs.join(usable, "drug_claim_id", "left_semi").select("gene_name").distinct()


def header_drugs(genes: DataFrame, drugs_info: DataFrame) -> DataFrame:
    """The drug texts of the header's genes; only the gene names meet the texts."""
    texts = drugs_info.join(genes.select("gene_name").distinct(), "gene_name", "left_semi")
    return texts.select(
        "gene_name", F.col("page").alias("drugs_page"), F.col("drugs_info").alias("gene_drugs")
    )
