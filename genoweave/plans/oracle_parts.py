"""Subqueries several oracles share."""

from __future__ import annotations

from genoweave.plans.registry import SUBQUERIES


def _slots(list_column: str, name: str) -> str:
    return ", ".join(f"substr({list_column},{2 * n - 1},1) as {name}{n}" for n in (1, 2, 3))


def flip(letter: str) -> str:
    return (
        f"case {letter} when 'G' then 'C' when 'C' then 'G' when 'A' then 'T' when 'T' then 'A' end"
    )


def haplotype(letter: str) -> str:
    """The signed peptide of a letter, own strand before opposite strand."""
    arms = [
        f"when {letter}={side}{n} then '{sign}'||peptide{n}"
        for side, sign in (("allele", "+"), ("opallele", "-"))
        for n in (1, 2, 3)
    ]
    return "case " + " ".join(arms) + " end"


THIRD = f"case when substr(gt,5,1)='' then '' else {haplotype('substr(gt,5,1)')} end"
PEPTIDE_GROUP = (
    f"({haplotype('substr(gt,1,1)')})||({haplotype('substr(gt,3,1)')})||({THIRD})"
)


def _named(n: int) -> str:
    """The peptide that the n-th allele number of a call names."""
    number = f"try_cast(split_part(split_part(gt_idx,':',1),'|',{n}) as int)+1"
    return f"nullif(split_part(peptides,',',{number}),'')"


def page(keys: str, order: str, items: int) -> str:
    partition = f"partition by {keys} " if keys else ""
    return f"(row_number() over ({partition}order by {order})-1)//{items}"


SUBQUERIES.update(
    {
        "peptide_slots": ("sites", f"select *, {_slots('peptides', 'peptide')} from sites"),
        "coded": (
            "peptide_slots",
            "select * from peptide_slots where frame not like 'n/a' and "
            "(peptide1<>peptide2 or peptide1<>peptide3 or peptide2<>peptide3)",
        ),
        "allele_slots": ("coded", f"select *, {_slots('alleles', 'allele')} from coded"),
        "strands": (
            "allele_slots",
            "select *, "
            + ", ".join(f"{flip(f'allele{n}')} as opallele{n}" for n in (1, 2, 3))
            + " from allele_slots",
        ),
        "site_pages": (
            "strands",
            f"select *, {page('gene_name', 'rsid', 10000)} as page from strands",
        ),
        "decoded": (
            "calls site_pages",
            "select c.patient, s.gene_name, s.page, c.rsid, c.gt, s.alleles, s.peptides, "
            f"c.l_orderkey, c.l_linenumber, {PEPTIDE_GROUP} as peptide_group "
            "from calls c join site_pages s on c.rsid=s.rsid",
        ),
        "gene_strings": (
            "decoded",
            "select patient, gene_name, page, "
            "string_agg(rsid,',' order by rsid, peptide_group) as rsids, "
            "string_agg(peptide_group,'' order by rsid, peptide_group) as peptide_string "
            "from (select distinct patient, gene_name, page, rsid, peptide_group from decoded) t "
            "group by patient, gene_name, page",
        ),
        "header": (
            "site_pages",
            "select gene_name, page, string_agg(rsid,' ' order by rsid) as rsids "
            "from site_pages group by gene_name, page",
        ),
        "chrom_pages": (
            "sites",
            f"select *, {page('chrom, gene_name', 'rsid', 10000)} as page from sites",
        ),
        "pairs": (
            "calls chrom_pages",
            "select c.patient, s.chrom, s.gene_name, s.page, c.rsid, c.l_orderkey, c.l_linenumber, "
            f"case when contains(gt_idx,'|') then {_named(1)}||{_named(2)} else {_named(1)} end as pair "
            "from calls c join chrom_pages s on c.rsid=s.rsid",
        ),
        "pop_strings": (
            "pairs",
            "select patient, chrom, gene_name, page, "
            "string_agg(pair,'' order by rsid, pair) as pepstr, cast(sum(n) as bigint) as rows "
            "from (select patient, chrom, gene_name, page, rsid, pair, count(*) as n from pairs "
            "group by all) t group by patient, chrom, gene_name, page",
        ),
        "pop_counts": (
            "pop_strings",
            "select patient, chrom, pepstr, cast(sum(rows) as bigint) as count from pop_strings "
            "where pepstr is not null group by patient, chrom, pepstr",
        ),
        "pop_totals": (
            "pop_counts",
            "select pepstr, cast(sum(count) as bigint) as strsum from pop_counts group by pepstr",
        ),
        "pop_ranks": (
            "pop_totals",
            "select row_number() over (order by strsum desc, pepstr) as str_rank, pepstr, strsum "
            "from pop_totals",
        ),
        "drug_labels": (
            "drugs drug_claims_drugs",
            "select name as drug_name, drug_claim_id from drugs join drug_claims_drugs on id=drug_id",
        ),
        "named_claims": (
            "genes gene_claims_genes",
            "select name as gene_name, gene_claim_id from genes join gene_claims_genes on id=gene_id",
        ),
        "gene_drugs": (
            "named_claims interaction_claims",
            "select gene_name, g.gene_claim_id, drug_claim_id from named_claims g "
            "join interaction_claims i on g.gene_claim_id=i.gene_claim_id",
        ),
        "named_gene_drugs": (
            "gene_drugs drug_labels",
            "select gene_name, gene_claim_id, g.drug_claim_id, drug_name from gene_drugs g "
            "join drug_labels d on g.drug_claim_id=d.drug_claim_id",
        ),
        "gene_drug_values": (
            "named_gene_drugs drug_claim_attributes",
            "select gene_name, gene_claim_id, g.drug_claim_id, drug_name, value, name "
            "from named_gene_drugs g join drug_claim_attributes a on g.drug_claim_id=a.drug_claim_id",
        ),
        "categories": (
            "gene_drug_values",
            "select gene_name, gene_claim_id, drug_name, drug_claim_id, "
            "string_agg(value,'/' order by value) as drug_categories "
            "from (select distinct * from gene_drug_values where name='Drug Categories') t "
            "group by all",
        ),
        "drug_texts": (
            "categories",
            "select gene_name, cast(0 as bigint) as page, "
            "string_agg(drug_text,' ' order by drug_text) as drugs_info from "
            "(select distinct gene_name, drug_name||'{'||drug_categories||'}' as drug_text "
            "from categories) t group by gene_name",
        ),
        "alt_names": (
            "genes gene_gene_interaction_claims",
            "select name as gene_name, gene_id, interacting_gene_id as gene_id_alt from genes "
            "join gene_gene_interaction_claims on id=interacting_gene_id",
        ),
        "alt_pairs": (
            "genes alt_names",
            "select name as interactive_gene_name, gene_name, gene_id, gene_id_alt "
            "from genes join alt_names on id=gene_id",
        ),
        "alt_claims": (
            "alt_names gene_claims_genes",
            "select gene_id_alt, gene_name, gene_claim_id from alt_names a "
            "join gene_claims_genes g on a.gene_id=g.gene_id",
        ),
        "alt_texts": (
            "alt_claims interaction_claims drug_labels drug_claim_attributes",
            "select gene_name, cast(0 as bigint) as page, "
            "string_agg(drug_text,' ' order by drug_text) as drugs_info from "
            "(select distinct a.gene_name, t.drug_text from alt_claims a "
            "join interaction_claims i on a.gene_claim_id=i.gene_claim_id join "
            "(select l.drug_claim_id, drug_name||'{'||string_agg(value,'/' order by value)||'}' as drug_text "
            "from drug_labels l join drug_claim_attributes v on l.drug_claim_id=v.drug_claim_id "
            "where name='Drug Categories' group by l.drug_claim_id, drug_name) t "
            "on i.drug_claim_id=t.drug_claim_id) x group by gene_name",
        ),
    }
)
