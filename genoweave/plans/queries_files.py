"""Registered queries: a test table goes out to a file format and comes back."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.operators import clean
from genoweave.plans import flows
from genoweave.plans.queries_groups import pop_codes
from genoweave.plans.queries_shape import SLICE, strings_and_labels
from genoweave.plans.registry import SUBQUERIES, query
from genoweave.session import scratch_path, scratch_table
from genoweave.sources import audited, delimited, inference, matrix, tables, vcf

VARIATION = (
    "variation_id bigint, source_id int, rs_name string, validation_status string, "
    "ancestral_allele string, flipped boolean, somatic boolean, minor_allele string, "
    "minor_allele_count int"
)
SITES = (
    "rsid string, gene_name string, chrom_start bigint, coordinate string, chrom string, "
    "frame string, alleles string, codons string, peptides string"
)


def text_lines(x, df, name: str) -> str:
    path = scratch_path(x.spark, name)
    df.select("value").write.text(path)
    return path


@query("scan_header_tsv", "sites", "select * from sites")
def _(x):
    path = scratch_path(x.spark, "tsv")
    delimited.write_tsv(x.sites, path, header=True)
    return delimited.read_tsv(x.spark, path, SITES, header=True)


@query("scan_named_tsv", "variation", "select * from variation")
def _(x):
    path = scratch_path(x.spark, "tsv")
    delimited.write_tsv(x.variation, path)
    return delimited.read_tsv(x.spark, path, VARIATION)


@query("scan_gzip", "variation", "select * from variation")
def _(x):
    path = scratch_path(x.spark, "gzip")
    delimited.write_tsv(x.variation, path, compression="gzip")
    return delimited.read_tsv(x.spark, path, VARIATION)


@query("scan_null_marker", "variation",
       "select variation_id, coalesce(validation_status,'\\N') as validation_status from variation")
def _(x):
    path = scratch_path(x.spark, "tsv")
    delimited.write_tsv(x.variation.select("variation_id", "validation_status"), path)
    schema = "variation_id bigint, validation_status string"
    return delimited.read_tsv(x.spark, path, schema, keep_null_marker=True)


HEADER = "idnum SZ1 SZ2 CG1"
MATRIX_LINE = "concat_ws(' ', rsid, alleles, codons, peptides)"


def matrix_file(x) -> str:
    """A matrix whose rows with chrom_start divisible by 9 have a token too many; the header
    comes again beside every row divisible by 50."""
    lines = F.expr(f"case when chrom_start%9=0 then {MATRIX_LINE}||' extra' else {MATRIX_LINE} end")
    header = F.when(F.col("chrom_start") % 50 == 0, F.array(F.lit(HEADER), lines)).otherwise(F.array(lines))
    return text_lines(x, x.sites.select(F.explode(header).alias("value")), "matrix")


@query("scan_ws_matrix", "sites", " union all ".join(
    f"select rsid as idnum, '{p}' as patient, {c} as gt from sites where chrom_start%9<>0"
    for p, c in (("sz1", "alleles"), ("sz2", "codons"), ("cg1", "peptides"))))
def _(x):
    return matrix.read_matrix(x.spark, matrix_file(x))


@query("scan_reject_malformed", "sites",
       "select rsid||' '||alleles||' '||codons||' '||peptides||' extra' as value, 5 as tokens "
       "from sites where chrom_start%9=0")
def _(x):
    return matrix.rejected_lines(x.spark, matrix_file(x), "idnum")


@query("scan_site_list", "sites",
       "select cast(chrom_start as varchar) as numid, chrom as chr, rsid, coordinate from sites")
def _(x):
    line = "concat_ws('   ', '', chrom_start, chrom, rsid, coordinate)"
    first = x.sites.filter("chrom_start%500=0").select(F.lit("  numid  Chr  rsID Coordinate").alias("value"))
    path = text_lines(x, x.sites.selectExpr(f"{line} as value").unionByName(first), "sites")
    return matrix.read_table(x.spark, path, "numid")


SAMPLES = [
    ("hg001", "gt_idx"),
    ("hg002", "cast(l_linenumber%2 as varchar(2))||'|'||cast(l_orderkey%2 as varchar(2))"),
]


def vcf_file(x) -> str:
    """Two samples; every line of the table is a site. One meta line counts the sites of the site
    table, one stands for each of its chromosomes. Beside some lines stands one that is cut off."""
    body = x.calls.selectExpr(
        "concat_ws('\t', '1', l_orderkey, rsid, coalesce(ref,'.'), coalesce(alt,'.'), '100', 'PASS', "
        f"'AC='||l_linenumber||';NS=2', 'GT', {SAMPLES[0][1]}, {SAMPLES[1][1]}) as value")
    broken = x.calls.filter("l_orderkey%17=0").selectExpr("concat_ws('\t', '1', l_orderkey, rsid) as value")
    heads = [F.lit("##fileformat=VCFv4.2"), F.concat(F.lit("##sites="), F.count("*")),
             F.lit("\t".join([*vcf.FIXED_COLUMNS, "HG001", "HG002"]))]
    head = x.sites.agg(F.array(*heads).alias("heads")).select(F.explode("heads").alias("value"))
    contigs = x.sites.select("chrom").distinct().selectExpr("'##contig=<ID='||chrom||'>' as value")
    return text_lines(x, head.unionByName(contigs).unionByName(body).unionByName(broken), "vcf")


@query("scan_vcf_long", "calls", " union all ".join(
    "select '1' as chrom, cast(l_orderkey as varchar) as pos, rsid as id, coalesce(ref,'.') as ref, "
    "coalesce(alt,'.') as alt, cast(l_linenumber as varchar) as ac, "
    f"'{p}' as patient, {c} as gt from calls" for p, c in SAMPLES))
def _(x):
    rows = vcf.read_vcf(x.spark, vcf_file(x))
    return rows.select("chrom", "pos", "id", "ref", "alt", vcf.info_value("info", "AC").alias("ac"),
                       "patient", "gt")


@query("scan_vcf_meta", "sites",
       "select 'fileformat' as key, 'VCFv4.2' as value union all "
       "select 'sites', cast(count(*) as varchar) from sites union all "
       "select distinct 'contig', '<ID='||chrom||'>' from sites")
def _(x):
    return vcf.read_vcf_meta(x.spark, vcf_file(x))


@query("scan_vcf_rejects", "calls",
       "select '1'||chr(9)||l_orderkey||chr(9)||rsid as value, 3 as tokens from calls where l_orderkey%17=0")
def _(x):
    return vcf.rejected_vcf_lines(x.spark, vcf_file(x))


@query("scan_tsv_rejects", "sites",
       "select rsid||chr(9)||chrom as value, 2 as tokens from sites where chrom_start%9=0")
def _(x):
    """Rows of three fields, beside some of them one of two."""
    whole = x.sites.selectExpr("concat_ws('\t', rsid, chrom, alleles) as value")
    short = x.sites.filter("chrom_start%9=0").selectExpr("concat_ws('\t', rsid, chrom) as value")
    path = text_lines(x, whole.unionByName(short), "tsv")
    return delimited.rejected_tsv_lines(x.spark, path, "rsid string, chrom string, alleles string")


INFERRED = "select * replace (cast(coordinate as bigint) as coordinate, cast(chrom as bigint) as chrom) from sites"


@query("scan_inferred_tsv", "sites", INFERRED)
def _(x):
    """Names and types come from the file itself."""
    path = scratch_path(x.spark, "tsv")
    delimited.write_tsv(x.sites, path, header=True)
    return inference.read_inferred(x.spark, path)


AUDITED = "rsid string, chrom_start bigint, alleles string"
SHORT, WRONG = "chrom_start%9=0", "chrom_start%7=0"


def audited_load(x) -> audited.Load:
    """Beside some rows stands one of two fields, beside some one whose number is none, beside some a header."""
    whole = "concat_ws('\t', rsid, chrom_start, alleles)"
    lines = F.array(
        F.expr(whole), F.expr(f"case when {SHORT} then concat_ws('\t', rsid, chrom_start) end"),
        F.expr(f"case when {WRONG} then concat_ws('\t', rsid, 'x'||chrom_start, alleles) end"),
        F.expr("case when chrom_start%500=0 then 'rsid\tchrom_start\talleles' end"))
    path = text_lines(x, x.sites.select(F.explode(F.array_compact(lines)).alias("value")), "audited")
    return audited.load_audited(x.spark, path, AUDITED, scratch_path(x.spark, "loaded"), header=True, source="part")


@query("audited_rows", "sites", "select rsid, chrom_start, alleles from sites")
def _(x):
    return audited_load(x).rows


@query("audited_rejects", "sites",
       f"select rsid||chr(9)||chrom_start as value, 2 as fields, 'fields' as reason from sites where {SHORT} union all "
       f"select rsid||chr(9)||'x'||chrom_start||chr(9)||alleles, 3, 'type' from sites where {WRONG}")
def _(x):
    return audited_load(x).rejects


@query("audited_provenance", "sites",
       f"select 'part' as source, count(*) + count(*) filter ({SHORT}) + count(*) filter ({WRONG}) + count(*) filter (chrom_start%500=0) as lines, "
       f"count(*) as rows, count(*) filter ({SHORT}) + count(*) filter ({WRONG}) as rejects, count(*) filter (chrom_start%500=0) as headers, "
       "0::bigint as blanks from sites")
def _(x):
    return audited_load(x).provenance.drop("loaded_at")


@query("provenance_table", "sites calls",
       "select 'sites' as table_name, 'part' as source_file, count(*) as n from sites union all "
       "select 'calls', 'lineitem', count(*) from calls")
def _(x):
    """Loaded tables with the file they came from, beside their row counts."""
    path = scratch_path(x.spark, "provenance")
    loaded = [("sites", "part", x.sites), ("calls", "lineitem", x.calls)]
    rows = tables.provenance(x.spark, [(source, "test", None, name, None, None, None, None) for name, source, _ in loaded])
    name = scratch_table(x.spark, "provenance")
    tables.save_table(rows, name, path=path)
    kept = tables.need_table(x.spark, name)
    counts = tables.union_tables([df.agg(F.count("*").alias("n")).withColumn("table_name", F.lit(n)) for n, _, df in loaded])
    return kept.select("table_name", F.col("source").alias("source_file")).join(counts, "table_name")


@query("line_numbers", "sites",
       "select row_number() over (order by chrom_start) as line, rsid||' '||alleles as value from sites")
def _(x):
    ordered = x.sites.repartitionByRange("chrom_start").sortWithinPartitions("chrom_start")
    path = text_lines(x, ordered.selectExpr("rsid||' '||alleles as value"), "lines")
    return matrix.read_numbered_lines(x.spark, path)


@query("csv_roundtrip", "sites",
       "select gene_name, '['''||alleles||''', '''||frame||''']' as pair from sites")
def _(x):
    path = scratch_path(x.spark, "csv")
    pairs = x.sites.select("gene_name", F.array("alleles", "frame").alias("pair"))
    delimited.write_csv(pairs, path, max_rows_per_file=1000)
    return delimited.read_csv(x.spark, path, "gene_name string, pair string")


@query("matrix_file_strand_counts", "matrix_cells",
       "select count(*) filter (where contains(cell,'+') and contains(cell,'-')) as \"both\", "
       "count(*) filter (where contains(cell,'+') and not contains(cell,'-')) as positive, "
       "count(*) filter (where contains(cell,'-') and not contains(cell,'+')) as negative "
       "from matrix_cells")
def _(x):
    strings, labels = strings_and_labels(x)
    header, lines = flows.ml_matrix(strings, labels, x.patients, SLICE)
    path = scratch_path(x.spark, "matrix")
    delimited.write_lines(header.select("slice", "line").unionByName(lines.select("slice", "line")), path)
    written = x.spark.read.schema("value string, slice long").text(path).select("value")
    return clean.line_strand_counts(written)


@query("drug_table_scan", "drug_claim_attributes", "select drug_claim_id, name, value from drug_claim_attributes")
def _(x):
    path = scratch_path(x.spark, "drugs")
    rows = x.drug_claim_attributes.selectExpr(
        "drug_claim_id||name||value as id", "drug_claim_id", "name", "value", "cast(null as string) as description")
    delimited.write_tsv(rows, path)
    table = delimited.read_drug_table(x.spark, path, "drug_claim_attributes")
    return table.filter("description is null").select("drug_claim_id", "name", "value")


@query("coding_snp_scan", "coding", "select * from coding")
def _(x):
    path = scratch_path(x.spark, "coding")
    delimited.write_tsv(x.coding, path)
    return delimited.read_coding_snp(x.spark, path).toDF(*x.coding.columns)


@query("table_roundtrip", "sites", "select rsid, gene_name, chrom from sites")
def _(x):
    path = scratch_path(x.spark, "table")
    name = scratch_table(x.spark, "sites")
    rows = x.sites.select("rsid", "gene_name", "chrom")
    tables.empty_copy(rows, name, path)
    tables.append_to(rows.select("chrom", "gene_name", "rsid"), name)
    return tables.need_table(x.spark, name)


@query("catalog_lookup", "coded", "select rsid, alleles, peptides from coded")
def _(x):
    path = scratch_path(x.spark, "table")
    name = scratch_table(x.spark, "coding_filtered_final_spltal")
    tables.save_table(clean.coding_sites(x.sites).select("rsid", "alleles", "peptides"), name, path=path)
    found = tables.tables_like(x.spark, f"coding*_spltal_{name[-32:]}")
    return tables.need_table(x.spark, found[0])


SUBQUERIES.update({
    "two_samples": ("calls", " union all ".join(
        f"select '{p}' as patient, rsid, {c} as gt_idx, l_orderkey, l_linenumber from calls" for p, c in SAMPLES)),
    "two_pairs": ("two_samples chrom_pages", SUBQUERIES["pairs"][1].replace("from calls c", "from two_samples c")),
    "two_strings": ("two_pairs", SUBQUERIES["pop_strings"][1].replace("from pairs", "from two_pairs")),
})


@query("vcf_population_strings", "two_strings", "select * from two_strings")
def _(x):
    """Site rows of a call file are joined with the decoding before their calls are exploded."""
    path = vcf_file(x)
    columns = vcf.vcf_columns(x.spark, path)
    sites = vcf.read_vcf_sites(x.spark, path, columns).select(F.col("id").alias("rsid"), "calls")
    rows = sites.join(pop_codes(x).select("chrom", "gene_name", "page", "rsid", "peptides"), "rsid")
    calls = vcf.explode_calls(rows, vcf.sample_names(columns))
    return flows.pair_strings(calls.withColumnRenamed("gt", "gt_idx"))
