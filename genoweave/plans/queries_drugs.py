"""Registered queries: drug and gene tables."""

from __future__ import annotations

from genoweave.operators import drugs as dg
from genoweave.plans import flows
from genoweave.plans.queries_sites import coded
from genoweave.plans.registry import query

SITE = ["rsid", "gene_name", "chrom", "chrom_start"]
ON_SITES = (
    "select s.rsid, s.gene_name, s.chrom, s.chrom_start, d.gene_name as gene_name2, "
    "d.page as drugs_page, d.drugs_info from coded s join {table} d on s.gene_name=d.gene_name"
)


def named_claims(x):
    return dg.gene_claims(x.genes, x.gene_claims_genes)


def gene_drugs(x):
    return dg.gene_drug_claims(named_claims(x), x.interaction_claims)


def labels(x):
    return dg.drug_names(x.drugs, x.drug_claims_drugs)


def alternatives(x):
    return dg.alternative_genes(x.genes, x.gene_gene_interaction_claims)


@query("drug_names", "drug_labels", "select * from drug_labels")
def _(x):
    return labels(x)


@query("gene_claims", "named_claims", "select * from named_claims")
def _(x):
    return named_claims(x)


@query("gene_drug_claims", "gene_drugs", "select * from gene_drugs")
def _(x):
    return gene_drugs(x)


@query("gene_drug_names", "named_gene_drugs", "select * from named_gene_drugs")
def _(x):
    return dg.with_drug_names(gene_drugs(x), labels(x))


@query("gene_drug_attributes", "gene_drug_values", "select * from gene_drug_values")
def _(x):
    named = dg.with_drug_names(gene_drugs(x), labels(x))
    return dg.with_drug_attributes(named, x.drug_claim_attributes)


@query("drug_categories", "categories", "select *, cast(0 as bigint) as page from categories")
def _(x):
    named = dg.with_drug_names(gene_drugs(x), labels(x))
    return named.join(dg.drug_categories(x.drug_claim_attributes), "drug_claim_id")


@query("drugs_info", "drug_texts", "select gene_name, page, drugs_info from drug_texts")
def _(x):
    return flows.drug_gene_table(x.drug_tables)


@query("alt_gene_names", "alt_names", "select * from alt_names")
def _(x):
    return alternatives(x)


@query("alt_gene_pairs", "alt_pairs", "select * from alt_pairs")
def _(x):
    return dg.alternative_pairs(x.genes, alternatives(x))


@query("alt_gene_claims", "alt_claims", "select * from alt_claims")
def _(x):
    return dg.alternative_claims(alternatives(x), x.gene_claims_genes)


@query("alt_drugs_info", "alt_texts", "select gene_name, page, drugs_info from alt_texts")
def _(x):
    return flows.alt_drug_gene_table(x.drug_tables)


@query("alt_interacting_names", "alt_texts alt_pairs",
       "select t.gene_name, t.page, t.drugs_info, p.interactive_gene_name from alt_texts t join "
       "(select distinct gene_name, interactive_gene_name from alt_pairs) p on t.gene_name=p.gene_name")
def _(x):
    pairs = dg.alternative_pairs(x.genes, alternatives(x))
    return dg.with_interacting_names(flows.alt_drug_gene_table(x.drug_tables), pairs)


@query("annotated_by_drugs", "coded drug_texts", ON_SITES.format(table="drug_texts"))
def _(x):
    return dg.keep_genes_with_drugs(coded(x).select(*SITE), flows.drug_gene_table(x.drug_tables))


@query("annotated_by_alt_drugs", "coded alt_texts", ON_SITES.format(table="alt_texts"))
def _(x):
    return dg.keep_genes_with_drugs(coded(x).select(*SITE), flows.alt_drug_gene_table(x.drug_tables))


@query("calls_of_drug_genes", "calls coded drug_texts",
       "select c.patient, c.rsid, c.l_orderkey, c.l_linenumber, s.gene_name from calls c "
       "join coded s on c.rsid=s.rsid where s.gene_name in (select gene_name from drug_texts)")
def _(x):
    """Sites are filtered before the calls meet them, by gene names alone."""
    genes = dg.genes_with_drugs(gene_drugs(x), labels(x), x.drug_claim_attributes)
    sites = coded(x).select("rsid", "gene_name").join(genes, "gene_name", "left_semi")
    return x.calls.select("patient", "rsid", "l_orderkey", "l_linenumber").join(sites, "rsid")


@query("header_with_drugs", "coded drug_texts",
       "select s.gene_name, d.page as drugs_page, d.drugs_info as gene_drugs from "
       "(select distinct gene_name from coded) s join drug_texts d on s.gene_name=d.gene_name")
def _(x):
    return dg.header_drugs(coded(x), flows.drug_gene_table(x.drug_tables))
