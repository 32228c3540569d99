"""Registered queries: filters, projections, joins and decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from genoweave.functions import alleles as al
from genoweave.functions import text as tx
from genoweave.operators import clean, dictionary, joins, lists, positions
from genoweave.plans import flows
from genoweave.plans.oracle_parts import flip, haplotype, page
from genoweave.plans.registry import query

CALL = "patient, rsid, l_orderkey, l_linenumber, ref, alt"
CALL_COLUMNS = CALL.split(", ")


def coded(x):
    return clean.coding_sites(x.sites)


def codes(x):
    return flows.site_codes(coded(x))


@query("drop_equal_calls", "calls",
       f"select {CALL} from calls where ref is null or alt is null or ref<>alt")
def _(x):
    return clean.drop_equal(x.calls.select(*CALL_COLUMNS), "ref", "alt")


@query("rejected_calls", "calls", f"select {CALL} from calls where ref=alt")
def _(x):
    return clean.equal_rows(x.calls.select(*CALL_COLUMNS), "ref", "alt")


@query("coding_frame_filter", "sites", "select * from sites where frame<>'n/a'")
def _(x):
    return clean.in_frame(x.sites)


@query("split_peptides", "peptide_slots",
       "select rsid, peptides, peptide1, peptide2, peptide3 from peptide_slots")
def _(x):
    return al.with_peptide_slots(x.sites.select("rsid", "peptides"))


@query("peptide_differs", "coded",
       "select rsid, frame, peptides, peptide1, peptide2, peptide3 from coded")
def _(x):
    return coded(x).select("rsid", "frame", "peptides", "peptide1", "peptide2", "peptide3")


@query("peptide_differs_strict", "coded",
       "select rsid, peptides from coded where peptide1<>peptide2 and peptide1<>'' and peptide2<>'' "
       "or peptide1<>peptide3 and peptide1<>'' and peptide3<>'' "
       "or peptide2<>peptide3 and peptide2<>'' and peptide3<>''")
def _(x):
    return clean.coding_sites(x.sites, strict=True).select("rsid", "peptides")


@query("split_alleles", "allele_slots",
       "select rsid, alleles, allele1, allele2, allele3 from allele_slots")
def _(x):
    return al.with_allele_slots(coded(x)).select("rsid", "alleles", "allele1", "allele2", "allele3")


@query("opposite_strand", "strands",
       "select rsid, alleles, opallele1, opallele2, opallele3 from strands")
def _(x):
    sites = flows.split_alleles(coded(x))
    return sites.select("rsid", "alleles", "opallele1", "opallele2", "opallele3")


@query("flipped_genotypes", "calls",
       f"select l_orderkey, l_linenumber, gt, {flip('substr(gt,1,1)')} as opposite1, "
       f"{flip('substr(gt,3,1)')} as opposite2 from calls")
def _(x):
    first, second = (al.opposite(al.slot(F.col("gt"), n)) for n in (1, 2))
    return x.calls.select("l_orderkey", "l_linenumber", "gt", first.alias("opposite1"),
                          second.alias("opposite2"))


@query("select_rename_drop", "coding",
       "select name as rsid, transcript, frame, allele_count, func_codes, alleles, codons, peptides, "
       "bin, chrom_start, chrom_end from coding")
def _(x):
    return x.coding.drop("chrom").withColumnRenamed("name", "rsid")


@query("patient_regex", "calls",
       "select patient, rsid, gt, l_orderkey, l_linenumber from calls "
       "where regexp_matches(patient,'^(sz|cg|el|gc).*[1-9]')")
def _(x):
    return clean.study_patients(x.calls.select("patient", "rsid", "gt", "l_orderkey", "l_linenumber"))


@query("or_lookup", "variation",
       "select variation_id, rs_name, minor_allele, minor_allele_count from variation "
       "where minor_allele='A' or minor_allele='T'")
def _(x):
    chosen = x.variation.select("variation_id", "rs_name", "minor_allele", "minor_allele_count")
    return chosen.filter(F.col("minor_allele").isin("A", "T"))


@query("distinct_gene_rsid", "calls sites",
       "select distinct s.gene_name, c.rsid from calls c join sites s on c.rsid=s.rsid")
def _(x):
    called = x.calls.select("rsid").distinct()
    return called.join(x.sites.select("gene_name", "rsid"), "rsid").select("gene_name", "rsid").distinct()


@query("label_concat", "header",
       "select gene_name, page, gene_name||' | '||rsids as label, ''''||gene_name||'''' as quoted "
       "from header")
def _(x):
    label = tx.gene_label(F.col("gene_name"), F.col("rsids")).alias("label")
    quoted = tx.quoted(F.col("gene_name")).alias("quoted")
    return flows.header_rsids(codes(x)).select("gene_name", "page", label, quoted)


@query("with_patient_literal", "calls",
       "select rsid, gt, patient||'_name' as name_column, patient as name from calls")
def _(x):
    name = F.col("patient")
    return x.calls.select("rsid", "gt", F.concat(name, F.lit("_name")).alias("name_column"),
                          name.alias("name"))


@query("diagnosis_dimension", "patients", "select patient, diagnosis from patients")
def _(x):
    marked = x.patients.select(F.lit("1").alias("idnum"), "patient", F.col("diagnosis").alias("gt"))
    matrix = marked.unionByName(x.calls.select(F.col("rsid").alias("idnum"), "patient", "gt"))
    return joins.diagnosis_dimension(matrix)


@query("calls_with_diagnosis", "calls patients",
       "select c.patient, p.diagnosis, count(*) as calls from calls c "
       "left join patients p on c.patient=p.patient group by all")
def _(x):
    counted = x.calls.groupBy("patient").agg(F.count("*").alias("calls"))
    return joins.with_diagnosis(counted, x.patients).select("patient", "diagnosis", "calls")


@query("gene_map_join", "variation genename",
       "select v.*, g.gene_name from variation v join genename g on v.variation_id=g.variation_id")
def _(x):
    return joins.gene_map(x.variation, x.genename)


@query("annotate_left_right_key", "calls variation genename",
       "select c.patient, c.rsid, c.gt, l_orderkey, l_linenumber, v.rs_name, v.variation_id, "
       "v.minor_allele, g.gene_name from calls c join variation v on c.rsid=v.rs_name "
       "join genename g on v.variation_id=g.variation_id where ref is null or alt is null or ref<>alt")
def _(x):
    kept = clean.drop_equal(x.calls, "ref", "alt").drop("ref", "alt", "gt_idx")
    genes = x.variation.select("variation_id", "rs_name", "minor_allele")
    return flows.annotate_genes(kept, genes, x.genename)


@query("annotate_fanout", "sites variation genename",
       "select s.rsid, s.chrom, s.chrom_start, v.rs_name, v.variation_id, g.gene_name "
       "from sites s join variation v on s.rsid=v.rs_name "
       "join genename g on v.variation_id=g.variation_id")
def _(x):
    genes = x.variation.select("variation_id", "rs_name")
    return flows.annotate_genes(x.sites.select("rsid", "chrom", "chrom_start"), genes, x.genename)


# Two transcripts for a third of the sites make the annotation fan out.
TWO_TRANSCRIPTS = (
    "(select * from coding union all "
    "select * replace('NM_b' as transcript) from coding where allele_count=3)"
)


def transcripts(x):
    second = x.coding.filter("allele_count=3").withColumn("transcript", F.lit("NM_b"))
    return x.coding.unionByName(second)


@query("annotate_transcripts", "calls coding",
       "select c.patient, c.rsid, c.gt, c.l_orderkey, c.l_linenumber, t.name, t.transcript, "
       f"t.alleles, t.peptides from calls c join {TWO_TRANSCRIPTS} t on c.rsid=t.name")
def _(x):
    rows = joins.with_annotation(x.calls, transcripts(x))
    return rows.select("patient", "rsid", "gt", "l_orderkey", "l_linenumber", "name", "transcript",
                       "alleles", "peptides")


@query("two_step_annotate", "coding calls variation",
       "select c.patient, c.l_orderkey, c.l_linenumber, t.name, t.transcript, v.rs_name, v.minor_allele "
       f"from calls c join {TWO_TRANSCRIPTS} t on c.rsid=t.name join variation v on t.name=v.rs_name")
def _(x):
    genes = x.variation.select("rs_name", "minor_allele")
    rows = joins.annotate_twice(x.calls, transcripts(x), genes)
    return rows.select("patient", "l_orderkey", "l_linenumber", "name", "transcript", "rs_name",
                       "minor_allele")


@query("sites_full_outer", "calls sites",
       "select c.idnum, c.patient, c.gt, s.numid, s.chrom, s.coordinate from "
       "(select rsid as idnum, patient, gt from calls) c full outer join "
       "(select 'rs'||cast(chrom_start*2 as varchar(20)) as numid, chrom, coordinate from sites) s "
       "on c.idnum=s.numid")
def _(x):
    calls = x.calls.select(F.col("rsid").alias("idnum"), "patient", "gt")
    numid = "'rs'||cast(chrom_start*2 as varchar(20)) as numid"
    return joins.calls_and_sites(calls, x.sites.selectExpr(numid, "chrom", "coordinate"))


WHOLE_LISTS = (
    "select gene_name, '['||string_agg(''''||rsid||'''', ', ' order by chrom_start)||']' as rsids_list "
    "from sites group by gene_name"
)


@query("list_join_back", "sites",
       f"select s.gene_name, s.rsid, s.chrom_start, cast(1 as bigint) as pages, cast(0 as bigint) as page, l.rsids_list "
       f"from sites s join ({WHOLE_LISTS}) l on s.gene_name=l.gene_name")
def _(x):
    rows = x.sites.select("gene_name", "rsid", "chrom_start")
    rows, texts = flows.gene_lists(rows, ["chrom_start"])
    return lists.with_lists(rows, texts, "gene_name")


@query("gene_lists", "sites",
       f"select gene_name, pos//5 as page, '['||string_agg(''''||rsid||'''', ', ' order by chrom_start)||']' as rsids_list "
       f"from (select *, {page('gene_name', 'chrom_start', 1)} as pos from sites) t group by 1, 2")
def _(x):
    rows = x.sites.select("gene_name", "rsid", "chrom_start")
    return flows.gene_lists(rows, ["chrom_start"], page_items=5)[1]


@query("keyed_update", "sites header",
       "select g.gene_name, 'ids:'||coalesce(h.rsids,'') as rsids, h.page from "
       "(select distinct gene_name from sites) g left join header h on g.gene_name=h.gene_name")
def _(x):
    rsids = flows.header_rsids(codes(x))
    genes = x.sites.select("gene_name").distinct().join(rsids.select("gene_name", "page"), "gene_name", "left")
    blank = genes.withColumn("rsids", F.lit("ids:"))
    return joins.keyed_update(blank, rsids, ["gene_name", "page"], "rsids")


@query("decode_haplotype", "calls site_pages",
       "select c.l_orderkey, c.l_linenumber, s.gene_name, c.gt, "
       f"{haplotype('substr(gt,1,1)')} as peptide1st, {haplotype('substr(gt,3,1)')} as peptide2nd "
       "from calls c join site_pages s on c.rsid=s.rsid")
def _(x):
    book = F.col("code_letters"), F.col("code_peptides")
    parts = [al.signed_peptide(al.slot(F.col("gt"), n), *book) for n in (1, 2)]
    return x.calls.join(codes(x), "rsid").select(
        "l_orderkey", "l_linenumber", "gene_name", "gt", parts[0].alias("peptide1st"),
        parts[1].alias("peptide2nd"))


@query("decode_genotype", "decoded",
       "select patient, gene_name, page, rsid, l_orderkey, l_linenumber, peptide_group from decoded")
def _(x):
    return flows.decode_genotypes(x.calls, codes(x), "l_orderkey", "l_linenumber")


@query("decode_dictionary", "decoded",
       "select patient, gene_name, page, rsid, l_orderkey, l_linenumber, peptide_group from decoded")
def _(x):
    """Calls as blocks of sites: genotypes are decoded once per site, the calls are exploded last."""
    keep = ["patient", "l_orderkey", "l_linenumber"]
    blocks = dictionary.encode_calls(dictionary.site_blocks(x.calls, ["l_orderkey", "l_linenumber"], keep))
    decoded = dictionary.decode_dictionary(blocks, codes(x))
    return dictionary.explode_codes(decoded, ["gene_name", "page", "rsid"], keep)


@query("decode_vcf_index", "pairs", "select patient, rsid, l_orderkey, l_linenumber, pair from pairs")
def _(x):
    rows = x.calls.join(x.sites.select("rsid", "peptides"), "rsid")
    named = al.with_index_peptides(rows, "gt_idx", "peptides", "pair")
    return named.select("patient", "rsid", "l_orderkey", "l_linenumber", "pair")


@query("sort_sites", "coded",
       "select rsid, chrom_start, codons from coded order by chrom_start, codons")
def _(x):
    return clean.sorted_by(coded(x).select("rsid", "chrom_start", "codons"), "chrom_start", "codons")


@query("sort_text_coordinate", "sites",
       "select coordinate, gene_name, rsid from sites order by coordinate, gene_name")
def _(x):
    return clean.by_position(x.sites.select("coordinate", "gene_name", "rsid"))


@query("sort_number_coordinate", "sites",
       "select coordinate, gene_name, rsid from sites order by cast(coordinate as bigint), gene_name")
def _(x):
    return clean.by_position(x.sites.select("coordinate", "gene_name", "rsid"), numeric=True)


@query("limit_n", "coded", "select rsid, alleles, peptides from coded order by rsid limit 10")
def _(x):
    return coded(x).select("rsid", "alleles", "peptides").orderBy("rsid").limit(10)


@query("row_numbers", "coded",
       "select chrom, rsid, row_number() over (partition by chrom order by chrom_start, rsid) as row "
       "from coded")
def _(x):
    rows = coded(x).select("chrom", "chrom_start", "rsid")
    return positions.row_numbers(rows, ["chrom"], ["chrom_start", "rsid"]).select("chrom", "rsid", "row")


@query("strip_brackets", "sites",
       "select rsid, regexp_replace('('||gene_name||')['||alleles||']','[()\\[\\]]','','g') as label from sites")
def _(x):
    label = F.expr("'('||gene_name||')['||alleles||']'")
    return x.sites.select("rsid", tx.strip_brackets(label).alias("label"))


@query("strip_commas", "sites",
       "select rsid, replace(alleles,',','') as alleles, replace(codons,',','') as codons from sites")
def _(x):
    return x.sites.select("rsid", *[tx.strip_commas(F.col(c)).alias(c) for c in ("alleles", "codons")])


@query("split_tokens", "",
       "select p_partkey, split_part(p_name,' ',1) as first, split_part(p_name,' ',2) as second, "
       "cast(len(string_split(p_name,' ')) as bigint) as tokens from part")
def _(x):
    tokens = tx.words(F.concat(F.lit("  "), "p_name", F.lit("\t")))
    return x.table("part").select("p_partkey", tokens[0].alias("first"), tokens[1].alias("second"),
                                  F.size(tokens).cast("long").alias("tokens"))


@query("lower_ids", "raw_ids",
       "select l_orderkey, l_linenumber, lower(sample) as patient from raw_ids")
def _(x):
    return x.raw_ids.select("l_orderkey", "l_linenumber", F.lower("sample").alias("patient"))


@query("typed_casts", "",
       "select p_partkey, p_size as size, cast(p_size as bigint) as big, p_size%2=1 as flag, "
       "cast(null as int) as bad, p_size%2=0 as letter from part")
def _(x):
    text = x.table("part").selectExpr(
        "p_partkey", "cast(p_size as string) as size", "cast(p_size%2 as string) as flag",
        "case when p_size%2=0 then 't' else 'f' end as letter", "'n/a' as bad")
    return text.select(
        "p_partkey", F.col("size").try_cast("int").alias("size"),
        F.col("size").try_cast("long").alias("big"), F.col("flag").try_cast("boolean").alias("flag"),
        F.col("bad").try_cast("int").alias("bad"), F.col("letter").try_cast("boolean").alias("letter"))


@query("empty_string_test", "peptide_slots",
       "select rsid, peptide3='' as empty, peptide3 is null as missing from peptide_slots")
def _(x):
    third = F.col("peptide3")
    return al.with_peptide_slots(x.sites).select(
        "rsid", (third == "").alias("empty"), third.isNull().alias("missing"))
