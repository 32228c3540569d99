"""Registered queries: joins and lookups over clustered tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import drugs as dg
from genoweave.plans.queries_drugs import gene_drugs, labels
from genoweave.plans.queries_sites import TWO_TRANSCRIPTS, coded, transcripts
from genoweave.plans.registry import query
from genoweave.session import drop_later, scratch_path, scratch_table, written
from genoweave.sources.clustered import Clustered, bucket_count, calls_of_sites, join_clustered, save_clustered
from genoweave.sources.tables import write_by_chromosome
from genoweave.sources.updates import update_folders

#: Buckets of small tables.
BUCKETS = 8


def clustered(x, df, name: str, key: str, **options) -> Clustered:
    path = scratch_path(x.spark, "clustered")
    table = scratch_table(x.spark, name)
    drop_later(x.spark, f"{table}_rest")
    buckets = bucket_count(x.calls, x.sites, least=BUCKETS)
    return save_clustered(written(df), table, key, path, buckets, **options)


def call_table(x) -> Clustered:
    """Calls in a folder per chromosome, as a load of call files by chromosome gives them."""
    calls = x.calls.join(x.sites.select("rsid", "chrom"), "rsid")
    return clustered(x, calls, "calls", "rsid", partition="chrom", bloom={"patient": 1000})


@query("transcripts_clustered", "calls coding",
       "select c.patient, c.rsid, c.gt, c.l_orderkey, c.l_linenumber, t.name, t.transcript, "
       f"t.alleles, t.peptides from calls c join {TWO_TRANSCRIPTS} t on c.rsid=t.name")
def _(x):
    """Every call with the transcripts of its site."""
    annotation = clustered(x, transcripts(x), "coding", "name")
    return join_clustered(call_table(x), annotation, ["patient", "rsid", "gt", "l_orderkey", "l_linenumber"],
                          ["name", "transcript", "alleles", "peptides"])


@query("drug_calls_clustered", "calls coded drug_texts",
       "select c.patient, c.rsid, c.l_orderkey, c.l_linenumber, s.gene_name from calls c "
       "join coded s on c.rsid=s.rsid where s.gene_name in (select gene_name from drug_texts)")
def _(x):
    """Calls at the sites of genes with drugs."""
    genes = dg.genes_with_drugs(gene_drugs(x), labels(x), x.drug_claim_attributes)
    sites = clustered(x, coded(x).select("rsid", "gene_name", "chrom"), "sites", "rsid")
    return calls_of_sites(call_table(x), sites, written(genes), ["patient", "rsid", "l_orderkey", "l_linenumber"], ["gene_name"])


@query("site_lookup_clustered", "calls",
       "select patient, rsid, gt from calls where rsid in ('rs7','rs19','rs131')")
def _(x):
    """The calls of three sites."""
    return call_table(x).find(["rs7", "rs19", "rs131"]).select("patient", "rsid", "gt")


@query("folder_update", "sites",
       "select rsid, chrom, case when chrom in ('3','7') and chrom_start%2=0 then alleles||'!' else alleles end as alleles from sites")
def _(x):
    """A table by chromosome after an update that touches two of its folders."""
    path = scratch_path(x.spark, "folders")
    write_by_chromosome(x.sites.select("rsid", "alleles", "chrom"), path)
    values = x.sites.filter("chrom in ('3','7') and chrom_start%2=0").select("rsid", "chrom", F.lit("!").alias("alleles"))
    update_folders(x.spark, path, values, ["rsid"], "alleles", "chrom")
    return x.spark.read.schema("rsid string, alleles string, chrom string").parquet(path)
