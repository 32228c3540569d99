"""Registered queries: unions, reshaping and the exported matrices."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from genoweave.functions.text import list_text, text_list
from genoweave.operators import drugs as dg
from genoweave.operators import lists, reshape, tiles
from genoweave.plans import flows
from genoweave.plans.oracle_parts import page
from genoweave.plans.queries_sites import coded, codes
from genoweave.plans.registry import SUBQUERIES, query
from genoweave.session import scratch_path, written
from genoweave.sources import export, tables
from genoweave.sources.matrix import paste, read_numbered_lines

SLICE = 60


@query("union_all", "sites calls",
       "select rsid as text from sites union all select gt from calls")
def _(x):
    sites = x.sites.select(F.col("rsid").alias("text"))
    return tables.union_tables([sites, x.calls.select(F.col("gt").alias("text"))])


@query("union_chromosomes", "sites", "select rsid, gene_name, chrom from sites")
def _(x):
    path = scratch_path(x.spark, "chromosomes")
    tables.write_by_chromosome(x.sites.select("rsid", "gene_name", "chrom"), path)
    return x.spark.read.schema("rsid string, gene_name string, chrom string").parquet(path)


@query("union_missing_columns", "sites variation",
       "select rsid, gene_name, cast(null as varchar) as minor_allele from sites union all "
       "select rs_name, null, minor_allele from variation")
def _(x):
    other = x.variation.select(F.col("rs_name").alias("rsid"), "minor_allele")
    return tables.union_tables([x.sites.select("rsid", "gene_name"), other])


@query("union_slices", "sites",
       "select rsid, 'sz1' as patient, alleles as gt from sites union all "
       "select rsid, 'sz2', codons from sites union all select rsid, 'cg1', peptides from sites")
def _(x):
    one = x.sites.selectExpr("rsid", "alleles as SZ1", "codons as SZ2")
    two = x.sites.selectExpr("rsid", "peptides as CG1")
    return tables.union_tables([reshape.to_long(s, ["rsid"]) for s in (one, two)])


@query("paste_by_key", "sites patients",
       "select a.line, a.value, b.value as other from "
       "(select row_number() over (order by chrom_start) as line, rsid as value from sites) a full outer join "
       "(select row_number() over (order by patient) as line, patient as value from patients) b on a.line=b.line")
def _(x):
    """Two numbered files of unequal length side by side."""
    def numbered(df, name):
        path = scratch_path(x.spark, "lines")
        df.repartitionByRange("at").sortWithinPartitions("at").select("value").write.text(path)
        return read_numbered_lines(x.spark, path).withColumnRenamed("value", name)

    sites = numbered(x.sites.selectExpr("chrom_start as at", "rsid as value"), "value")
    return paste(sites, numbered(x.patients.selectExpr("patient as at", "patient as value"), "other"))


@query("unpivot_long", "sites", " union all ".join(
    f"select rsid, '{p}' as patient, {c} as gt from sites"
    for p, c in (("sz1", "alleles"), ("sz2", "codons"), ("cg1", "peptides"), ("cg2", "frame"), ("el1", "chrom"),
                 ("el2", "coordinate"), ("gc1", "gene_name"), ("gc2", "cast(chrom_start as varchar)"))))
def _(x):
    wide = x.sites.selectExpr("rsid", "alleles as SZ1", "codons as SZ2", "peptides as CG1", "frame as CG2", "chrom as EL1",
                              "coordinate as EL2", "gene_name as GC1", "cast(chrom_start as string) as GC2")
    return reshape.to_long(wide, ["rsid"])


FLAGS = ["A", "N", "R"]
FLAG_MATRIX = (
    "select l_returnflag, count(*) as n, count(distinct l_partkey) as parts, "
    "max(l_linenumber) as longest from lineitem group by l_returnflag"
)


@query("transpose_small", "",
       f"with m as ({FLAG_MATRIX}) " + " union all ".join(
           f"select '{c}' as \"column\", "
           + ", ".join(f"max(case when l_returnflag='{f}' then cast({c} as varchar) end) as {f}" for f in FLAGS)
           + " from m" for c in ("n", "parts", "longest")))
def _(x):
    matrix = x.table("lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"),
        F.max("l_linenumber").alias("longest"))
    return reshape.transpose_wide(matrix, "l_returnflag")


TRANSPOSED = ["rsid", "gene_name", "chrom_start", "coordinate", "chrom", "frame", "alleles", "codons", "peptides"]


TRANSPOSE = (
       f"select \"column\", page, string_agg(value,',' order by pos) as line from (" + " union all ".join(
           f"select '{c}' as \"column\", chrom_start as pos, {page('', 'chrom_start', 500)} as page, "
           f"replace(cast({c} as varchar),',','') as value from sites" for c in TRANSPOSED)
       + ") t group by 1, 2")


@query("transpose_lines", "sites", TRANSPOSE)
def _(x):
    return reshape.transpose_lines(x.sites, ["chrom_start"], page_items=500)


@query("transpose_tiles", "sites", TRANSPOSE)
def _(x):
    return tiles.transpose_tiles(x.sites, ["chrom_start"], page_items=500, tile_rows=64, tile_columns=4)


@query("column_slice", "sites", "select * from sites")
def _(x):
    """All vertical slices, and the table they make together again."""
    whole, *rest = reshape.column_slices(x.sites, "rsid", 3)
    for part in rest:
        whole = whole.join(part, "rsid")
    return whole


@query("row_slices", "sites",
       f"select rsid, chrom_start, {page('', 'chrom_start', 100)} as slice from sites")
def _(x):
    return reshape.row_slices(x.sites.select("rsid", "chrom_start"), ["chrom_start"])


RECORD = [c for c in TRANSPOSED if c != "rsid"]


@query("record_vertical", "sites", " union all ".join(
    f"select rsid, {i} as field, '{c}' as name, cast({c} as varchar) as value from sites"
    for i, c in enumerate(RECORD)))
def _(x):
    named = x.sites.select(F.col("rsid").alias("id"), *RECORD)
    return reshape.records(named.select(*RECORD, "id"), ["id"]).filter("name<>'id'").select(
        F.col("id").alias("rsid"), "field", "name", "value")


@query("column_names_per_group", "sites",
       "select distinct gene_name, '[" + ", ".join(f"''{c}''" for c in TRANSPOSED) + "]' as names from sites")
def _(x):
    return reshape.names_per_group(x.sites, "gene_name")


@query("list_text_roundtrip", "sites",
       "select gene_name, 0::bigint as page, '['||string_agg(''''||rsid||'''',', ' order by rsid)||']' as text, "
       "count(*) as n, min(rsid) as first from sites group by gene_name")
def _(x):
    arrays = lists.group_arrays(x.sites.select("gene_name", "rsid"), ["gene_name"], "rsid", ["rsid"], "ids")
    text = arrays.select("gene_name", "page", list_text(F.col("ids")).alias("text"))
    back = text.withColumn("ids", text_list(F.col("text")))
    return back.select("gene_name", "page", "text", F.size("ids").cast("long").alias("n"),
                       F.col("ids")[0].alias("first"))


ODD = "case when chrom_start%5=0 then gene_name||', '||rsid when chrom_start%5=1 then 'it''s '||rsid when chrom_start%5=2 then null else rsid||'\"'||'\\' end"


@query("list_entries_roundtrip", "sites",
       f"select chrom, cast(row_number() over (partition by chrom order by chrom_start)-1 as int) as at, {ODD} as value from sites")
def _(x):
    """Every entry of every list, as it comes back from its text: separators, quotes and missing values inside."""
    odd = x.sites.select("chrom", "chrom_start", F.expr(ODD.replace("'it''s '", "\"it's \"").replace("\\'", "\\\\'")).alias("value"))
    arrays = lists.group_arrays(odd, ["chrom"], "value", ["chrom_start"], "values")
    back = arrays.select("chrom", "page", text_list(list_text(F.col("values"))).alias("values"))
    rows = back.select("chrom", "page", F.posexplode("values").alias("at", "value"))
    return rows.select("chrom", (F.col("page") * lists.PAGE_ITEMS + F.col("at")).cast("int").alias("at"), "value")


# The matrix: features in gene order, SLICE of them per line.
SUBQUERIES.update({
    "features": (
        "header",
        "select gene_name, page, rsids, ''''||regexp_replace(gene_name||' | '||rsids,'[()\\[\\]]','','g')||'''' as label, "
        "row_number() over (order by gene_name, page)-1 as feature from header"),
    "matrix_cells": (
        "features patients gene_strings",
        f"select p.patient, p.diagnosis, f.feature//{SLICE} as slice, f.feature, "
        "coalesce(''''||nullif(g.peptide_string,'')||'''','') as cell "
        "from patients p cross join features f left join gene_strings g "
        "on g.patient=p.patient and g.gene_name=f.gene_name and g.page=f.page"),
    "drug_features": (
        "header drug_texts",
        "select h.gene_name, h.page, ''''||replace(regexp_replace(h.gene_name||' | '||rsids||' | '||drugs_info,"
        "'[()\\[\\]]','','g'),',','')||'''' as label, "
        "row_number() over (order by h.gene_name, h.page)-1 as feature "
        "from header h join drug_texts d on h.gene_name=d.gene_name and h.page=d.page"),
    "drug_cells": (
        "drug_features patients gene_strings",
        f"select p.patient, p.diagnosis, f.feature//{SLICE} as slice, f.feature, "
        "coalesce(''''||nullif(g.peptide_string,'')||'''','') as cell "
        "from patients p cross join drug_features f left join gene_strings g "
        "on g.patient=p.patient and g.gene_name=f.gene_name and g.page=f.page"),
})


def _lines_sql(cells: str) -> str:
    return (
        "select patient, slice, ''''||patient||''','''||diagnosis||''','||"
        f"string_agg(cell,',' order by feature) as line from {cells} group by patient, diagnosis, slice"
    )


def _header_sql(features: str) -> str:
    return (
        f"select feature//{SLICE} as slice, '''patient'',''diagnosis'','||"
        f"string_agg(label,',' order by feature) as line from {features} group by 1"
    )


def strings_and_labels(x):
    book = written(codes(x))
    strings = flows.gene_peptides(flows.decode_genotypes(x.calls, book))
    return strings, flows.feature_labels(flows.header_rsids(book))


def with_drugs(x):
    strings, rsids = strings_and_labels(x)
    drugs = written(dg.header_drugs(coded(x), flows.drug_gene_table(x.drug_tables)))
    return strings, flows.feature_labels_with_drugs(rsids.drop("label"), drugs)


@query("ml_matrix", "matrix_cells", _lines_sql("matrix_cells"))
def _(x):
    strings, labels = strings_and_labels(x)
    return flows.ml_matrix(strings, labels, x.patients, SLICE)[1]


EXPORT = (
    "select slice, row_number() over (partition by slice order by kind, patient) as line, line as value from ("
    f"select slice, 0 as kind, null as patient, line from ({_header_sql('features')}) union all "
    f"select slice, 1, patient, line from ({_lines_sql('matrix_cells')}))"
)


@query("ordered_export", "features matrix_cells", EXPORT)
def _(x):
    """The exported files as they lie: every line with its place among its slice's parts."""
    strings, labels = strings_and_labels(x)
    header, lines = flows.ml_matrix(strings, labels, x.patients, SLICE)
    path = scratch_path(x.spark, "export")
    export.write_ordered_lines(header, lines, path, ["patient"])
    return export.read_ordered_lines(x.spark, path)


@query("ml_matrix_header", "features", _header_sql("features"))
def _(x):
    return reshape.matrix_header(reshape.matrix_features(strings_and_labels(x)[1], SLICE))


@query("ml_matrix_with_drugs", "drug_cells", _lines_sql("drug_cells"))
def _(x):
    strings, labels = with_drugs(x)
    return flows.ml_matrix(strings, labels, x.patients, SLICE)[1]


@query("ml_matrix_with_drugs_header", "drug_features", _header_sql("drug_features"))
def _(x):
    return reshape.matrix_header(reshape.matrix_features(with_drugs(x)[1], SLICE))


# The same with pages of two ids, so that genes go on over several features.
SMALL_PAGE = 2
SMALL = [("site_pages", "small_pages"), ("decoded", "small_decoded"), ("header", "small_header"),
         ("gene_strings", "small_strings"), ("features", "small_features"), ("matrix_cells", "small_cells")]


def _small(text: str) -> str:
    for name, small in SMALL:
        text = re.sub(rf"\b{name}\b", small, text)
    return text.replace("//10000", f"//{SMALL_PAGE}")


SUBQUERIES.update({small: tuple(_small(part) for part in SUBQUERIES[name]) for name, small in SMALL})


def small_strings_and_labels(x):
    book = written(flows.site_codes(coded(x), page_items=SMALL_PAGE))
    strings = flows.gene_peptides(flows.decode_genotypes(x.calls, book))
    return strings, flows.feature_labels(flows.header_rsids(book))


@query("gene_peptides_paged", "small_strings", "select patient, gene_name, page, rsids, peptide_string from small_strings")
def _(x):
    return small_strings_and_labels(x)[0]


@query("ml_matrix_paged", "small_cells", _lines_sql("small_cells"))
def _(x):
    strings, labels = small_strings_and_labels(x)
    return flows.ml_matrix(strings, labels, x.patients, SLICE)[1]
