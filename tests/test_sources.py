import gzip

import pytest
from pyspark.sql import functions as F

from genoweave.sources import delimited, matrix, schemas, tables, vcf

VARIATION = [
    "14000\t1\trs14153\tcluster,freq\tC\t1\t2\t0\tT\t0.499541\t1088\t\\N\tMultiple_observations,Frequency",
    "14006\t1\trs14159\t\\N\tA\t0\t2\t1\t\\N\t\\N\t\\N\t\\N\tMultiple_observations",
]


def test_typed_load_with_null_marker(spark, text_file):
    rows = delimited.read_variation(spark, text_file("variation", *VARIATION)).orderBy("variation_id").collect()
    assert (rows[0].flipped, rows[0].somatic, rows[0].minor_allele_count) == (True, False, 1088)
    assert rows[0].minor_allele_freq == pytest.approx(0.499541)
    assert rows[0].clinical_significance is None
    assert (rows[1].validation_status, rows[1].minor_allele_freq, rows[1].somatic) == (None, None, True)


def test_null_marker_as_text(spark, text_file):
    path = text_file("variation", "1\t\\N", "2\tx", "3\t")
    rows = delimited.read_tsv(spark, path, "a int, b string", keep_null_marker=True).orderBy("a").collect()
    assert [r.b for r in rows] == ["\\N", "x", None]


def test_gzip_and_gene_names(spark, tmp_path):
    path = tmp_path / "genename.txt.gz"
    with gzip.open(path, "wt") as file:
        file.write("14000\tEEF1DP3\n14000\tKRIT1\n")
    assert {tuple(r) for r in delimited.read_genename(spark, str(path)).collect()} == {(14000, "EEF1DP3"), (14000, "KRIT1")}


def test_header_starting_with_a_hash(spark, text_file):
    path = text_file("calls", "#CHROM\tPOS\tID", "1\t72017\trs1", "1\t81335\trs2")
    rows = delimited.read_tsv(spark, path, "chrom string, pos int, id string", header=True)
    assert [r.pos for r in rows.orderBy("pos").collect()] == [72017, 81335]


def test_malformed_lines_are_dropped(spark, text_file):
    path = text_file("calls", "1\ta", "2", "3\tc\td", "4\te")
    rows = delimited.read_tsv(spark, path, "n int, v string", drop_malformed=True).collect()
    assert {r.n for r in rows} == {1, 4}


def test_malformed_lines_fail_by_default(spark, text_file):
    for bad in ("2", "3\tc\td", "q\tz"):
        path = text_file(f"calls{len(bad)}", "1\ta", bad)
        with pytest.raises(Exception, match="[Mm]alformed"):
            delimited.read_tsv(spark, path, "n int, v string").collect()
        if "q" not in bad:
            with pytest.raises(Exception, match="[Mm]alformed"):
                delimited.read_tsv(spark, path, "n int, v string").select("v").collect()


def test_rejected_lines_of_a_tsv(spark, text_file):
    path = text_file("calls", "1\ta", "2", "3\tc\td")
    rows = delimited.rejected_tsv_lines(spark, path, "n int, v string").collect()
    assert {(r.value, r.tokens) for r in rows} == {("2", 1), ("3\tc\td", 3)}


def test_header_in_another_order_fails(spark, text_file):
    path = text_file("named", "b\ta", "B1\tA1")
    with pytest.raises(Exception, match="(?i)header"):
        delimited.read_tsv(spark, path, "a string, b string", header=True).collect()


def test_coding_and_drug_layouts(spark, text_file):
    path = text_file("snp", "585\tchr1\t69269\t69270\trs14155\tNM_001005484\t3\t2\t8,3,\tA,G,\tTCA,TCG,\tS,S,")
    row = delimited.read_coding_snp(spark, path).first()
    assert (row.bin, row.alleleCount, row.peptides) == (585, 2, "S,S,")
    path = text_file("drugs", "d1\tIBUPROFEN", "d2\t\\N")
    assert {tuple(r) for r in delimited.read_drug_table(spark, path, "drugs").collect()} == {("d1", "IBUPROFEN"), ("d2", None)}
    assert len(schemas.DRUG_TABLE_COLUMNS) == 24
    assert "gene_claims_count int" in schemas.drug_table("sources")


MATRIX = [
    "idnum SZPABR0002 SZPABR0003", "1 2 2", "2 A/A A/A", "3 G/G", "idnum SZPABR0002 SZPABR0003",
    "4 G/G G/G extra", "   5\tA/G  0/0 ",
]


def test_matrix_comes_out_long(spark, text_file):
    path = text_file("fint", *MATRIX)
    rows = {tuple(r) for r in matrix.read_matrix(spark, path).collect()}
    assert rows == {("1", "szpabr0002", "2"), ("1", "szpabr0003", "2"), ("2", "szpabr0002", "A/A"),
                    ("2", "szpabr0003", "A/A"), ("5", "szpabr0002", "A/G"), ("5", "szpabr0003", "0/0")}
    rejected = {(r.value, r.tokens) for r in matrix.rejected_lines(spark, path, "idnum").collect()}
    assert rejected == {("3 G/G", 2), ("4 G/G G/G extra", 4)}
    with pytest.raises(ValueError):
        matrix.read_matrix(spark, path, "nokey")


def test_site_list_keeps_the_word_null(spark, text_file):
    path = text_file("sites", "     numid      Chr     rsID    Coordinate", "     1  null    null    null", "     2  1       rs4477212       72017")
    rows = matrix.read_table(spark, path, "numid")
    assert rows.columns == ["numid", "chr", "rsid", "coordinate"]
    assert {tuple(r) for r in rows.collect()} == {("1", "null", "null", "null"), ("2", "1", "rs4477212", "72017")}


def test_numbered_lines_over_files_and_blocks(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    wanted = []
    for part in range(3):
        lines = [f"file {part} line {n} {'x' * (n % 50)}" for n in range(400)]
        (folder / f"part-{part}").write_text("\n".join(lines) + "\n")
        wanted += lines
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        numbered = matrix.read_numbered_lines(spark, str(folder)).orderBy("line").collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert [r.line for r in numbered] == list(range(1, 1201))
    assert [r.value for r in numbered] == wanted


def test_paste(frame):
    left, right = frame("line long, a string", (1, "x"), (2, "y")), frame("line long, b string", (1, "p"), (2, "q"))
    assert {(r.a, r.b) for r in matrix.paste(left, right).collect()} == {("x", "p"), ("y", "q")}


def test_paste_keeps_the_longer_side(frame):
    left, right = frame("line long, a string", (1, "x"), (2, "y"), (3, "z")), frame("line long, b string", (1, "p"))
    assert {tuple(r) for r in matrix.paste(left, right).collect()} == {(1, "x", "p"), (2, "y", None), (3, "z", None)}


VCF = ["##fileformat=VCFv4.2", "##contig=<ID=26,length=16185>",
       "\t".join(vcf.FIXED_COLUMNS + ["HG00096", "HG00097"]),
       "21\t9411239\trs559462325\tG\tA\t100\tPASS\tAC=1;AF=0.1\tGT\t0|0\t1|0",
       "21\t9411245\trs181691356\t\tC\tA\t100\tPASS\tAC=1\tGT\t0|0\t1|0",
       "21\t9411264\trs548263598\tA\tC\t100\tPASS\tNS=2504\tGT\t0|1\t./."]


def test_vcf_comes_out_long(spark, text_file):
    path = text_file("pop.vcf", *VCF)
    rows = vcf.read_vcf(spark, path)
    assert rows.columns == ["chrom", "pos", "id", "ref", "alt", "qual", "filter", "info", "format", "patient", "gt"]
    assert {(r.id, r.patient, r.gt) for r in rows.collect()} == {
        ("rs559462325", "hg00096", "0|0"), ("rs559462325", "hg00097", "1|0"),
        ("rs548263598", "hg00096", "0|1"), ("rs548263598", "hg00097", "./.")}
    ac = {r.id: r.ac for r in rows.select("id", vcf.info_value("info", "AC").alias("ac")).collect()}
    assert ac == {"rs559462325": "1", "rs548263598": None}
    assert [r.tokens for r in vcf.rejected_vcf_lines(spark, path).collect()] == [12]
    assert {tuple(r) for r in vcf.read_vcf_meta(spark, path).collect()} == {
        ("fileformat", "VCFv4.2"), ("contig", "<ID=26,length=16185>")}


def test_vcf_without_info(spark, text_file):
    path = text_file("small.vcf", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tFORMAT\tHG1\tHG2", "21\t1\trs1\tA\tC\t100\tPASS\tGT\t0|0\t0|1")
    rows = vcf.read_vcf(spark, path)
    assert "info" not in rows.columns
    assert {(r.patient, r.gt) for r in rows.collect()} == {("hg1", "0|0"), ("hg2", "0|1")}


def test_vcf_files_with_different_samples_are_refused(spark, tmp_path):
    for name in ("a", "b"):
        head = "\t".join(vcf.FIXED_COLUMNS + [name])
        (tmp_path / f"{name}.vcf").write_text(head + "\n")
    with pytest.raises(Exception, match="different columns"):
        vcf.read_vcf(spark, str(tmp_path / "*.vcf")).collect()


def test_file_without_column_line(spark, text_file):
    with pytest.raises(ValueError):
        vcf.vcf_columns(spark, text_file("no.vcf", "##fileformat=VCFv4.2"))


def test_matrix_files_with_different_patients_are_refused(spark, text_file):
    path = text_file("fint", "idnum A B", "1 x y", "idnum A C", "2 x y")
    with pytest.raises(Exception, match="different columns"):
        matrix.read_matrix(spark, path).collect()


def test_sites_are_annotated_before_their_calls_are_exploded(spark, text_file, frame):
    path = text_file("pop.vcf", *VCF)
    sites = vcf.read_vcf_sites(spark, path)
    assert [r.calls for r in sites.orderBy("pos").collect()] == [["0|0", "1|0"], ["0|1", "./."]]
    genes = frame("id string, gene_name string", ("rs559462325", "G1"), ("rs559462325", "G2"))
    long = vcf.explode_calls(sites.join(genes, "id"), vcf.sample_names(vcf.vcf_columns(spark, path)))
    assert {(r.gene_name, r.patient, r.gt) for r in long.collect()} == {
        (g, p, c) for g in ("G1", "G2") for p, c in (("hg00096", "0|0"), ("hg00097", "1|0"))}


def test_lines_of_a_call_file_are_cut_once(spark, text_file, frame):
    path = text_file("pop.vcf", *VCF)
    columns = vcf.vcf_columns(spark, path)
    genes = frame("id string, gene_name string", ("rs559462325", "G1"))
    sites = vcf.read_vcf_sites(spark, path, columns).select("id", "calls").join(genes, "id")
    long = vcf.explode_calls(sites, vcf.sample_names(columns))
    assert long._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert {(r.patient, r.gt) for r in long.collect()} == {("hg00096", "0|0"), ("hg00097", "1|0")}


def test_csv_with_lists(spark, frame, tmp_path):
    path = str(tmp_path / "out.csv")
    delimited.write_csv(frame("gene string, ids array<string>", ("LRRD1", ["rs1", "rs1"]), ("LRRD3", ["rs2"])), path)
    text = sorted(r.value for r in spark.read.text(path).filter("value<>'gene,ids'").collect())
    assert text == ["LRRD1,\"['rs1', 'rs1']\"", "LRRD3,['rs2']"]
    assert {tuple(r) for r in delimited.read_csv(spark, path, "gene string, ids string").collect()} == {
        ("LRRD1", "['rs1', 'rs1']"), ("LRRD3", "['rs2']")}


def test_matrix_lines_by_slice(spark, frame, tmp_path):
    path = str(tmp_path / "matrix")
    delimited.write_lines(frame("slice long, line string", (0, "a,b"), (1, "c,d")), path)
    assert {(r.value, r.slice) for r in spark.read.text(path).collect()} == {("a,b", 0), ("c,d", 1)}


def test_catalog(spark, frame):
    df = frame("a int, b string", (1, "x"))
    name = "x_filtered_final_spltal"
    spark.sql(f"drop table if exists {name}")
    try:
        with pytest.raises(LookupError):
            tables.need_table(spark, name)
        tables.save_table(df, name)
        with pytest.raises(Exception):
            tables.save_table(df, name)
        assert tables.save_table(df, name, overwrite=True).count() == 1
        tables.append_to(df.select("b", "a"), name)
        assert tables.need_table(spark, name).count() == 2
        assert tables.tables_like(spark, "x_*final_spltal") == [name]
        spark.sql("drop table if exists empty_like_x")
        assert tables.empty_copy(df, "empty_like_x").count() == 0
    finally:
        spark.sql(f"drop table if exists {name}")
        spark.sql("drop table if exists empty_like_x")


def test_provenance_and_union(spark, frame):
    row = ("ucsc", "GRCh37", "grch37", "coding", "s", "t", "d", None)
    assert tables.provenance(spark, [row]).first().genome == "GRCh37"
    whole = tables.union_tables([frame("a int, b int", (1, 2)), frame("a int", (3,))])
    assert {tuple(r) for r in whole.collect()} == {(1, 2), (3, None)}


def test_union_by_chromosome_is_pruned(spark, frame, tmp_path):
    path = str(tmp_path / "chromosomes")
    tables.write_by_chromosome(frame("rsid string, chrom string", ("rs1", "1"), ("rs2", "2")), path)
    rows = spark.read.parquet(path).filter(F.col("chrom") == "2")
    assert [r.rsid for r in rows.collect()] == ["rs2"]
    assert "PartitionFilters: [isnotnull(chrom" in rows._jdf.queryExecution().toString()
