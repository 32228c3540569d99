"""Registered queries: call files in blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.plans.queries_files import SAMPLES
from genoweave.plans.registry import query
from genoweave.session import scratch_path
from genoweave.sources import call_blocks, vcf, vcf_info

#: Compressed bytes of a task, small so that also a small table's file is read by several.
SPLIT = 256 << 10
#: Tasks beyond which ranges get longer instead, up to the reader's own length.
TASKS = 96
HEAD = ["##fileformat=VCFv4.2", "\t".join([*vcf.FIXED_COLUMNS, "HG001", "HG002"])]


def block_calls(x) -> str:
    """Every call is a site of the chromosome of its line number; files are sorted by chromosome and position."""
    site = [F.col("l_linenumber"), F.col("l_orderkey"), F.col("rsid"), F.col("ref"), F.col("alt")]
    site += [F.lit(v) for v in ("100", "PASS", "NS=2", "GT")]
    calls = F.array(*[F.expr(c) for _, c in SAMPLES])
    rows = x.calls.repartitionByRange("l_linenumber", "l_orderkey").sortWithinPartitions("l_linenumber", "l_orderkey")
    path = scratch_path(x.spark, "blocks")
    call_blocks.write_vcf_blocks(rows.select(call_blocks.call_line(site, calls).alias("value")), path, HEAD)
    return path


def split(x, path: str) -> int:
    """Compressed bytes of a task."""
    place = x.spark._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(x.spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()
    return min(max(SPLIT, size // TASKS), call_blocks.SPLIT)


@query("scan_vcf_blocks", "calls", " union all ".join(
    "select cast(l_linenumber as varchar) as chrom, l_orderkey as pos, rsid as id, coalesce(ref,'.') as ref, "
    f"coalesce(alt,'.') as alt, '{p}' as patient, {c} as gt from calls" for p, c in SAMPLES))
def _(x):
    path = block_calls(x)
    sites = call_blocks.read_vcf_blocks(x.spark, path, split=split(x, path)).select("chrom", "pos", "id", "ref", "alt", "calls")
    return vcf.explode_calls(sites, call_blocks.block_samples(path))


@query("vcf_block_region", "calls",
       "select cast(l_linenumber as varchar) as chrom, l_orderkey as pos, rsid as id from calls "
       "where l_linenumber in (2,5) and l_orderkey between 400 and 2000")
def _(x):
    """A lookup of two chromosomes and a range of positions."""
    path = block_calls(x)
    found = call_blocks.read_vcf_blocks(x.spark, path, ["2", "5"], 400, 2000, ordered=True, split=split(x, path))
    return found.select("chrom", "pos", "id")


# Two alternative alleles, one or none; INFO fields of all arities, one of them not declared.
ALT = "case l_linenumber%3 when 0 then 'C,G' when 1 then 'T' else '.' end"
AC = "case l_linenumber%3 when 0 then l_orderkey%7||','||l_orderkey%5 when 1 then cast(l_orderkey%7 as varchar(9)) else '.' end"
AD = "case l_linenumber%3 when 0 then '9,'||l_orderkey%3||',.' when 1 then '8,'||l_orderkey%3 else '7' end"
FLAG = "case when l_orderkey%2=0 then ';DB' else '' end"
INFO_HEAD = [
    '##INFO=<ID=AC,Number=A,Type=Integer,Description="Count, of alleles">', '##INFO=<ID=AD,Number=R,Type=Float,Description="Depth">',
    '##INFO=<ID=NS,Number=1,Type=Integer,Description="Samples">', '##INFO=<ID=DB,Number=0,Type=Flag,Description="Known">',
]


@query("typed_info_alleles", "calls",
       "with r as (select l_orderkey, l_linenumber, rsid, unnest(case l_linenumber%3 when 0 then ['C','G'] when 1 then ['T'] else [null] end) as alt, "
       "unnest(case l_linenumber%3 when 0 then [1,2] when 1 then [1] else [0] end) as allele from calls) "
       "select l_orderkey as pos, rsid as id, alt, allele, case allele when 1 then l_orderkey%7 when 2 then l_orderkey%5 end as ac, "
       "cast(case l_linenumber%3 when 0 then 9 when 1 then 8 else 7 end as double) as ad_ref, "
       "cast(case when allele=1 then l_orderkey%3 end as double) as ad_alt, l_linenumber::bigint as ns, l_orderkey%2=0 as db, 'q' as other, "
       "case when allele=0 then '0|.' when allele=1+l_orderkey%2 then '0|1' else '0|.' end as call from r")
def _(x):
    """A record per allele, with the fields that belong to it."""
    info = f"'AC='||{AC}||';XX=q;AD='||{AD}||';NS='||l_linenumber||{FLAG}"
    fixed = f"concat_ws('\t', '1', cast(l_orderkey as string), rsid, 'A', {ALT}, '.', 'PASS', {info}, 'GT', '0|'||(1+l_orderkey%2)) as value"
    path = scratch_path(x.spark, "info")
    call_blocks.write_vcf_blocks(x.calls.selectExpr(fixed), path, [*INFO_HEAD, "\t".join([*vcf.FIXED_COLUMNS, "S1"])])
    fields = vcf_info.info_fields(x.spark, path)
    sites = call_blocks.read_vcf_blocks(x.spark, path, split=split(x, path))
    rows = vcf_info.per_allele(vcf_info.typed_info(sites, fields), fields, calls="calls")
    return rows.select("pos", "id", "alt", "allele", F.col("info.AC").alias("ac"), F.col("info.AD")[0].alias("ad_ref"), F.get("info.AD", F.lit(1)).alias("ad_alt"),
                       F.col("info.NS").alias("ns"), F.col("info.DB").alias("db"), F.col("info_other")["XX"].alias("other"), F.col("calls")[0].alias("call"))
