"""Genomic look-alikes of the shared test tables.

Every view is a projection, distinct or equi-join of whole tables, so it grows with
them. The SELECT lists are SQL text that Spark and the check engine both accept, and the
oracle builds the same views from them (`view_sql`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GENE = "p_brand||'_'||p_type"
PART_ID = "'rs'||cast(p_partkey as varchar(20))"
LINE_ID = "'rs'||cast(l_partkey as varchar(20))"
FIRST = "substr('ACGT0',1+cast(l_orderkey%5 as int),1)"
SECOND = "substr('ACGT0',1+cast(l_linenumber%5 as int),1)"
THIRD = "case when l_linenumber=4 then '/'||substr('ACGT0',1+cast(l_partkey%5 as int),1) else '' end"
PATIENT = (
    "case when l_suppkey%5=0 then 'SZ' when l_suppkey%5=1 then 'CG' when l_suppkey%5=2 then 'EL' "
    "when l_suppkey%5=3 then 'GC' else 'XX' end||cast(l_suppkey as varchar(20))"
)
SUPPLIER_PATIENT = PATIENT.replace("l_suppkey", "s_suppkey")
FUNCTION_CODES = "'8,'||case when p_size%2=0 then '42,' else '3,' end"
ALLELES = (
    "substr('ACGT',1+cast(p_partkey%4 as int),1)||','||substr('CGTA',1+cast(p_size%4 as int),1)||','"
    "||case when p_size%10=0 then 'T,' else '' end"
)
CODONS = (
    "'A'||substr('ACGT',1+cast(p_partkey%4 as int),1)||'G,'||'A'||substr('CGTA',1+cast(p_size%4 as int),1)"
    "||'G,'||case when p_size%10=0 then 'ATG,' else '' end"
)
PEPTIDES = (
    "substr('ARNDCQEGHI',1+cast(p_partkey%10 as int),1)||','"
    "||substr('ARNDCQEGHI',1+cast(p_size%10 as int),1)||','||case when p_size%10=0 then 'K,' else '' end"
)
FRAME = "case when p_size%7=0 then 'n/a' else cast(p_size%3+1 as varchar(3)) end"

# view: (table, distinct, columns)
VIEWS = {
    "sites": ("part", False, [
        f"{PART_ID} as rsid", f"{GENE} as gene_name", "p_partkey as chrom_start",
        "cast(p_partkey*37 as varchar(20)) as coordinate",
        "cast(p_size%24+1 as varchar(2)) as chrom", f"{FRAME} as frame",
        f"{ALLELES} as alleles", f"{CODONS} as codons", f"{PEPTIDES} as peptides",
    ]),
    "coding": ("part", False, [
        "585+p_size as bin", "'chr'||cast(p_size%24+1 as varchar(2)) as chrom",
        "p_partkey as chrom_start", "p_partkey+1 as chrom_end", f"{PART_ID} as name",
        "'NM_'||cast(p_partkey%1000 as varchar(20)) as transcript", f"{FRAME} as frame",
        "case when p_size%10=0 then 3 else 2 end as allele_count", f"{FUNCTION_CODES} as func_codes",
        f"{ALLELES} as alleles", f"{CODONS} as codons", f"{PEPTIDES} as peptides",
    ]),
    "calls": ("lineitem", False, [
        f"lower({PATIENT}) as patient", f"{LINE_ID} as rsid", "l_orderkey", "l_linenumber",
        f"{FIRST}||'/'||{SECOND}||{THIRD} as gt",
        # Missing calls, calls of one allele, allele numbers up to 2, calls with further fields.
        "case when l_orderkey%11=0 then './.' when l_orderkey%13=0 then cast(l_linenumber%3 as varchar(2)) "
        "else cast(l_orderkey%2 as varchar(2))||'|'||cast(l_linenumber%3 as varchar(2))"
        "||case when l_orderkey%7=0 then ':35' else '' end end as gt_idx",
        f"nullif({FIRST},'0') as ref", f"nullif({SECOND},'0') as alt",
    ]),
    "raw_ids": ("lineitem", False, [f"{PATIENT} as sample", "l_orderkey", "l_linenumber"]),
    # Some variations carry a submitter id, which no call has.
    "variation": ("part", False, [
        "p_partkey as variation_id", "cast(p_size%4 as int) as source_id",
        f"case when p_size>5 then {PART_ID} else 's'||{PART_ID} end as rs_name",
        "case when p_size%6=0 then null else 'cluster,freq' end as validation_status",
        "substr('ACGT',1+cast(p_size%4 as int),1) as ancestral_allele", "p_size%2=0 as flipped",
        "p_size%9=0 as somatic", "substr('CGTA',1+cast(p_size%4 as int),1) as minor_allele",
        "p_size*3 as minor_allele_count",
    ]),
    "genename": ("lineitem", True, [
        "l_partkey as variation_id",
        "'G'||cast((l_partkey*7+l_linenumber%3)%1500 as varchar(20)) as gene_name",
    ]),
    "patients": ("supplier", True, [
        f"lower({SUPPLIER_PATIENT}) as patient",
        "cast(1+s_nationkey%2 as varchar(2)) as diagnosis",
    ]),
    "drugs": ("supplier", False, ["'d'||cast(s_suppkey as varchar(20)) as id", "upper(s_name) as name"]),
    "drug_claims_drugs": ("supplier", False, [
        "'d'||cast(s_suppkey as varchar(20)) as drug_id",
        "'dc'||cast(s_suppkey as varchar(20)) as drug_claim_id",
    ]),
    # Genes of one kind have names of their own, so not every gene of a site has drugs.
    "genes": ("part", True, [
        f"'g_'||{GENE} as id",
        f"case when p_type='ECONOMY' then 'E_'||{GENE} else {GENE} end as name",
    ]),
    "gene_claims_genes": ("part", False, [
        f"'g_'||{GENE} as gene_id", "'gc'||cast(p_partkey as varchar(20)) as gene_claim_id",
    ]),
    "interaction_claims": ("orders", True, [
        "'gc'||cast(o_custkey as varchar(20)) as gene_claim_id",
        "'dc'||cast((o_orderkey*31+o_custkey)%97 as varchar(20)) as drug_claim_id",
    ]),
    "drug_claim_attributes": ("lineitem", True, [
        "'dc'||cast(l_suppkey as varchar(20)) as drug_claim_id",
        "case when l_linenumber<=3 then 'Drug Categories' else 'Other' end as name",
        "'cat'||cast(cast(l_quantity as int)%7 as varchar(5)) as value",
    ]),
}

# Gene pairs come from two lookups of the part table per order.
GENE_PAIRS = (
    "select distinct 'g_'||a.p_brand||'_'||a.p_type as gene_id, "
    "'g_'||b.p_brand||'_'||b.p_type as interacting_gene_id from orders "
    "join part a on a.p_partkey=o_custkey join part b on b.p_partkey=o_orderkey%101"
)


def view_sql(name: str) -> str:
    """The view as one SELECT for the oracle."""
    if name == "gene_gene_interaction_claims":
        return GENE_PAIRS
    table, distinct, columns = VIEWS[name]
    return f"select {'distinct ' if distinct else ''}{', '.join(columns)} from {table}"


class Inputs:
    """The views as DataFrames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        table, distinct, columns = VIEWS[name]
        rows = self.table(table)
        rows = rows.selectExpr(*columns)
        return rows.distinct() if distinct else rows

    @property
    def gene_gene_interaction_claims(self) -> DataFrame:
        genes = self.table("part").selectExpr("p_partkey", f"'g_'||{GENE} as gene")
        orders = self.table("orders").selectExpr("o_custkey as a", "o_orderkey%101 as b").distinct()
        one = genes.selectExpr("p_partkey as a", "gene as gene_id")
        other = genes.selectExpr("p_partkey as b", "gene as interacting_gene_id")
        pairs = orders.join(one, "a").join(other, "b")
        return pairs.select("gene_id", "interacting_gene_id").distinct()

    @property
    def drug_tables(self) -> dict[str, DataFrame]:
        names = [
            "drugs", "drug_claims_drugs", "genes", "gene_claims_genes", "interaction_claims",
            "drug_claim_attributes", "gene_gene_interaction_claims",
        ]
        return {name: getattr(self, name) for name in names}
