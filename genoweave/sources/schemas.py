"""Fixed table layouts of the input files, in file order."""

from __future__ import annotations

# Column names and types.
VARIATION = (
    "variation_id int, source_id int, rs_name string, validation_status string, "
    "ancestral_allele string, flipped boolean, class_attrib_id int, somatic boolean, "
    "minor_allele string, minor_allele_freq float, minor_allele_count int, "
    "clinical_significance string, evidence string"
)
GENENAME = "variation_id int, gene_name string"
CODING_SNP = (
    "bin smallint, chrom string, chromStart int, chromEnd int, name string, "
    "transcript string, frame string, alleleCount int, funcCodes string, alleles string, "
    "codons string, peptides string"
)
PROVENANCE = (
    "source string, genome string, reference_consortium string, table_name string, "
    "schema_link string, table_link string, documentation_link string, date_downloaded string"
)
DRUG_TABLE_COLUMNS = {
    "drug_claim_aliases": "id drug_claim_id alias description nomenclature",
    "drug_claim_attributes": "id drug_claim_id name value description",
    "drug_claim_types": "id type",
    "drug_claim_types_drug_claims": "drug_claim_id drug_claim_type_id",
    "drug_claims": "id name description nomenclature source_id primary_name",
    "drug_claims_drugs": "drug_id drug_claim_id",
    "drugs": "id name",
    "gene_claim_aliases": "id gene_claim_id alias description nomenclature",
    "gene_claim_attributes": "id gene_claim_id name value description",
    "gene_claim_categories": "id name",
    "gene_claim_categories_gene_claims": "gene_claim_id gene_claim_category_id",
    "gene_claims": "id name description nomenclature source_id",
    "gene_claims_genes": "gene_id gene_claim_id",
    "gene_gene_interaction_claim_attributes": "id gene_gene_interaction_claim_id name value",
    "gene_gene_interaction_claims": "id gene_id interacting_gene_id source_id",
    "genes": "id name long_name",
    "interaction_claim_attributes": "id interaction_claim_id name value",
    "interaction_claim_types": "id type",
    "interaction_claim_types_interaction_claims": "interaction_claim_type_id interaction_claim_id",
    "interaction_claims": (
        "id drug_claim_id gene_claim_id interaction_type description source_id known_action_type"
    ),
    "schema_migrations": "version",
    "source_trust_levels": "id level",
    "source_types": "id type display_name",
    "sources": (
        "id source_db_name source_db_version citation base_url site_url full_name source_type_id "
        "gene_claims_count drug_claims_count interaction_claims_count "
        "interaction_claims_in_groups_count gene_claims_in_groups_count "
        "drug_claims_in_groups_count source_trust_level_id gene_gene_interaction_claims_count"
    ),
}


def drug_table(name: str) -> str:
    """The schema of a drug table: counts are numbers, everything else is text."""
    kinds = {c: "int" if c.endswith("_count") else "string" for c in DRUG_TABLE_COLUMNS[name].split()}
    return ", ".join(f"{column} {kind}" for column, kind in kinds.items())
