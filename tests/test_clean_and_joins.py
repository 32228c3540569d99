import pytest
from pyspark.sql import functions as F

from genoweave.operators import clean, joins, lists
from genoweave.plans import flows

CALLS = [
    (1, 72017, "rs14160", "A", "."), (1, 81335, "rs6680825", "B", "A"), (1, 98156, "rs14158", "B", "C"),
    (1, 555047, "rs7340047", "N", "N"), (1, 555733, "rs14158", "N", "."), (1, 556327, "rs10465888", "N", "."),
    (1, 556738, "rs2185539", "N", "."), (1, 557730, "rs2000096", "B", "B"), (1, 558151, "rs14160", "N", "A"),
]
CALL_SCHEMA = "chrom int, pos int, rsid string, ref string, alt string"
VARIATION = [(14000 + i, f"rs{14153 + i}") for i in range(10)]
GENENAME = [
    (14000, "EEF1DP3"), (2, "EEF1DP3"), (3, "AC000120.7"), (14000, "KRIT1"), (4, "CYP51A1"),
    (4, "LRRD1"), (5, "CTB-161K23.1"), (14007, "LRRD1"), (6, "CDK6"), (7, "CDK6"),
]


def genes(frame):
    return (frame("variation_id int, rs_name string", *VARIATION),
            frame("variation_id int, gene_name string", *GENENAME))


def test_equal_alleles_are_dropped(frame):
    df = frame(CALL_SCHEMA, *CALLS)
    assert clean.drop_equal(df, "ref", "alt").count() == 7
    assert {r.pos for r in clean.equal_rows(df, "ref", "alt").collect()} == {555047, 557730}


def test_missing_alleles_are_kept(frame):
    df = frame("a string, b string", ("A", "A"), ("A", "G"), (None, None), (None, "A"))
    assert clean.drop_equal(df, "a", "b").count() == 3
    assert clean.equal_rows(df, "a", "b").count() == 1


def test_peptide_filter_keeps_a_synonymous_site_with_two_alleles(frame):
    df = frame("frame string, peptides string", ("3", "H,H,"), ("2", "F,C,"), ("n/a", "F,C,"), ("1", "K,K,K,"))
    kept = {r.peptides for r in clean.coding_sites(df).collect()}
    assert kept == {"H,H,", "F,C,"}
    assert [r.peptides for r in clean.coding_sites(df, strict=True).collect()] == ["F,C,"]


def test_gene_map_and_annotation(frame):
    variation, genename = genes(frame)
    mapped = {(r.variation_id, r.gene_name) for r in joins.gene_map(variation, genename).collect()}
    assert mapped == {(14000, "EEF1DP3"), (14000, "KRIT1"), (14007, "LRRD1")}
    kept = clean.drop_equal(frame(CALL_SCHEMA, *CALLS), "ref", "alt")
    rows = flows.annotate_genes(kept, variation, genename).collect()
    assert {(r.rsid, r.pos, r.gene_name) for r in rows} == {("rs14160", 72017, "LRRD1"), ("rs14160", 558151, "LRRD1")}


def test_ids_of_a_gene_on_its_rows(frame):
    kept = clean.drop_equal(frame(CALL_SCHEMA, *CALLS), "ref", "alt")
    rows, texts = flows.gene_lists(flows.annotate_genes(kept, *genes(frame)), ["rsid"])
    rows = lists.with_lists(rows, texts, "gene_name").collect()
    assert [(r.gene_name, r.page, r.rsids_list) for r in rows] == [("LRRD1", 0, "['rs14160', 'rs14160']")] * 2


def test_sorts_are_total(spark, frame):
    sites = frame("coordinate string, gene_name string, rsid string", ("9", "b", "r1"), ("10", "a", "r2"),
                  ("9", "a", "r3"), ("x", "a", "r4"))
    assert [r.rsid for r in clean.by_position(sites).collect()] == ["r2", "r3", "r1", "r4"]
    assert [r.rsid for r in clean.by_position(sites, numeric=True).collect()] == ["r4", "r3", "r1", "r2"]
    # Rows with one and the same key still fall into several range partitions.
    same = spark.range(0, 4000, numPartitions=8).select(F.lit("k").alias("coordinate"), F.lit("g").alias("gene_name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        filled = clean.by_position(same).select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert filled > 4


def test_one_variant_with_several_genes(frame):
    calls = frame("rsid string, gt string", ("rs6680825", "G/G"), ("rs4096712", "G/G"))
    named = frame("rs_name string, gene_name string", *[("rs6680825", g) for g in ("G7", "G8")],
                  *[("rs4096712", g) for g in ("AC", "AP", "G7")])
    assert joins.with_genes(calls, named).select("rsid", "gene_name").distinct().count() == 5


def test_full_outer_join_keeps_both_sides(frame):
    calls = frame("idnum string, gt string", ("1", "2"), ("2", "A/A"), ("9", "G/G"))
    sites = frame("numid string, rsid string", ("1", "null"), ("2", "rs4477212"), ("3", "rs6680825"))
    rows = {(r.idnum, r.numid, r.rsid) for r in joins.calls_and_sites(calls, sites).collect()}
    assert rows == {("1", "1", "null"), ("2", "2", "rs4477212"), ("9", None, None), (None, "3", "rs6680825")}


def test_transcripts_fan_out(frame):
    annotation = frame("chrom string, name string, transcript string", ("chr1", "rs1", "a"), ("chr1", "rs1", "b"))
    rows = joins.with_annotation(frame("rsid string, gt string", ("rs1", "A/A"), ("rs2", "G/G")), annotation)
    assert {r.transcript for r in rows.collect()} == {"a", "b"}
    assert "chrom" not in rows.columns


def test_keyed_update(frame):
    target = frame("gene string, pepstr string", ("a", ""), ("b", "x"), ("c", ""))
    values = frame("gene string, pepstr string", ("a", "AA"), ("b", "BB"))
    rows = {r.gene: r.pepstr for r in joins.keyed_update(target, values, ["gene"], "pepstr").collect()}
    assert rows == {"a": "AA", "b": "xBB", "c": ""}


def test_update_with_a_repeated_key_fails(frame):
    target, values = frame("gene string, pepstr string", ("a", "")), frame("gene string, pepstr string", ("a", "A"), ("a", "B"))
    with pytest.raises(Exception, match="more than one row for a key"):
        joins.keyed_update(target, values, ["gene"], "pepstr").collect()


def test_diagnosis_row_becomes_a_dimension(frame):
    matrix = frame("idnum string, patient string, gt string", ("1", "sz1", "2"), ("1", "sz2", "1"), ("2", "sz1", "A/A"))
    found = joins.diagnosis_dimension(matrix)
    assert {tuple(r) for r in found.collect()} == {("sz1", "2"), ("sz2", "1")}
    joined = joins.with_diagnosis(frame("patient string", ("sz1",), ("sz9",)), found)
    assert {tuple(r) for r in joined.collect()} == {("sz1", "2"), ("sz9", None)}


def test_patient_choice(frame):
    names = ["sz1", "cg20", "el7", "gc3", "hg1", "sz0", "xsz1", "szabc"]
    long = frame("patient string", *[(n,) for n in names])
    assert {r.patient for r in clean.study_patients(long).collect()} == {"sz1", "cg20", "el7", "gc3"}
    wide = frame(", ".join(f"{n} string" for n in names), tuple("A" for _ in names))
    assert clean.matching_columns(wide).columns == ["sz1", "cg20", "el7", "gc3"]


def test_column_profile(frame):
    df = frame("a string, b int", ("x", 1), ("x", 2), (None, 1), ("y", 1))
    profile = clean.column_profile(df)
    assert {tuple(r) for r in profile.collect()} == {("a", "x", 2), ("a", "y", 1), ("b", "1", 3), ("b", "2", 1)}
    assert [tuple(r) for r in clean.top_values(profile, 2).collect()] == [("b", "1", 3), ("a", "x", 2)]


def test_strand_counts(frame):
    lines = frame("value string", ("'patient','diagnosis','g | rs1'",), ("'sz+1','2','+H+R','-T-T','+H-T','',",),
                  ("'sz2','1','+R+R'",), ("'sz3','1'",))
    assert tuple(clean.line_strand_counts(lines).first()) == (1, 2, 1)
    cells = frame("cell string", ("+A",), ("-A",), ("+A-B",), ("",), (None,))
    row = clean.opposite_strand_counts(cells, "cell").first()
    assert (row.both, row.positive, row.negative) == (1, 1, 1)
    assert lines.filter(F.col("value").contains("patient")).count() == 1
