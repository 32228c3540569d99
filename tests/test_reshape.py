import pytest
from pyspark.sql import functions as F

from genoweave.operators import reshape

SMALL = [(1, "rs14160", "0/0", "LRRD1"), (1, "rs14161", "0/0", "LRRD1"), (1, "rs14162", "A,G", "LRRD3"), (1, "rs14164", None, "LRRD2")]
SCHEMA = "chrom int, id string, SZPABR0002 string, gene_name string"


def test_transposed_lines(frame):
    rows = reshape.transpose_lines(frame(SCHEMA, *SMALL), ["id"]).collect()
    assert {r.column: r.line for r in rows} == {
        "chrom": "1,1,1,1", "id": "rs14160,rs14161,rs14162,rs14164",
        "SZPABR0002": "0/0,0/0,AG,", "gene_name": "LRRD1,LRRD1,LRRD3,LRRD2"}


def test_transposed_lines_in_pages(frame):
    rows = reshape.transpose_lines(frame(SCHEMA, *SMALL), ["id"], page_items=3).collect()
    assert {(r.column, r.page): r.line for r in rows}[("id", 1)] == "rs14164"


def test_transposing_twice_gives_the_matrix_back(frame):
    matrix = frame("patient string, rs1 string, rs2 string", ("p1", "A/A", "G/G"), ("p2", "A/G", "0/0"))
    turned = reshape.transpose_wide(matrix, "patient", ["p1", "p2"])
    assert {tuple(r) for r in turned.collect()} == {("rs1", "A/A", "A/G"), ("rs2", "G/G", "0/0")}
    again = reshape.transpose_wide(turned.withColumnRenamed("column", "patient"), "patient", ["rs1", "rs2"])
    assert {tuple(r) for r in again.collect()} == {tuple(r) for r in matrix.collect()}
    with pytest.raises(ValueError):
        reshape.transpose_wide(matrix, "patient", [str(i) for i in range(901)])


def test_long_form(frame):
    matrix = frame("idnum string, SZ1 string, SZ2 string", ("1", "2", "1"), ("2", "A/A", "A/G"))
    rows = {tuple(r) for r in reshape.to_long(matrix, ["idnum"]).collect()}
    assert rows == {("1", "sz1", "2"), ("1", "sz2", "1"), ("2", "sz1", "A/A"), ("2", "sz2", "A/G")}
    chosen = reshape.to_long(matrix, ["idnum"], ["SZ2"])
    assert {r.patient for r in chosen.collect()} == {"sz2"}


def test_column_slices(frame):
    df = frame("idnum int, a int, b int, c int", (1, 2, 3, 4))
    assert [s.columns for s in reshape.column_slices(df, "idnum", 2)] == [["idnum", "a", "b"], ["idnum", "c"]]


def test_row_slices(spark):
    rows = reshape.row_slices(spark.range(250), ["id"], 100)
    assert {r.slice: r.n for r in rows.groupBy("slice").agg(F.count("*").alias("n")).collect()} == {0: 100, 1: 100, 2: 50}


def test_records(frame):
    rows = reshape.records(frame("id string, alt int", ("rs1", 5)), ["id"]).collect()
    assert [(r.id, r.field, r.name, r.value) for r in rows] == [("rs1", 0, "id", "rs1"), ("rs1", 1, "alt", "5")]


def test_names_per_group(frame):
    rows = reshape.names_per_group(frame(SCHEMA, *SMALL), "gene_name").collect()
    assert {r.names for r in rows} == {"['chrom', 'id', 'SZPABR0002', 'gene_name']"} and len(rows) == 3


@pytest.mark.parametrize("rows", [[("A", 1), ("N", 2), ("Z", 3)], [("A", 1), ("N", 2), ("A", 3)], [("A", 1), (None, 2)]])
def test_keys_that_would_be_lost_fail(frame, rows):
    matrix = frame("k string, v int", *rows)
    with pytest.raises(Exception, match="not listed, or more than once"):
        reshape.transpose_wide(matrix, "k", ["A", "N"]).collect()
    strings = frame("patient string, label string, peptide_string string", *[("p", k, str(v)) for k, v in rows])
    with pytest.raises(Exception, match="not listed, or more than once"):
        reshape.to_wide(strings, ["A", "N"]).collect()


def test_row_names_from_the_data(frame):
    turned = reshape.transpose_wide(frame("k string, v int", ("b", 1), ("a", 2)), "k")
    assert turned.columns == ["column", "a", "b"] and [tuple(r) for r in turned.collect()] == [("v", "2", "1")]
