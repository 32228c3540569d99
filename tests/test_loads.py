"""Types found in files, and loads that account for every line."""

import pytest
from pyspark.sql import functions as F
from test_clustered import nodes

from genoweave.sources import audited, inference


def types(spark, path, **more):
    found = inference.infer_schema(spark, path, **more)
    return dict(zip(found.names, found.types))


def test_types(spark, text_file):
    path = text_file(
        "a.tsv", "id\tpos\tscore\tflag\tmixed\tnone\tbig\tname", "1\t5\t0.5\ttrue\t1\t\\N\t9223372036854775808\tx",
        "-2\t\\N\t1e-3\tFalse\tx\t\t1\t1", "+3\t7\t.5\tTRUE\t2\t\\N\t1\t", "", "id\tpos\tscore\tflag\tmixed\tnone\tbig\tname", "4\t8\t6.\t\t1\t\t2\ty")
    assert types(spark, path) == {"id": "bigint", "pos": "bigint", "score": "double", "flag": "boolean", "mixed": "string", "none": "string", "big": "double", "name": "string"}
    rows = inference.read_inferred(spark, path).orderBy("id").collect()
    assert [r.id for r in rows] == [-2, 1, 3, 4] and [r.pos for r in rows] == [None, 5, 7, 8]
    assert [r.flag for r in rows] == [False, True, True, None] and [r.name for r in rows] == ["1", "x", None, "y"]
    assert inference.infer_schema(spark, path).missing == [0, 1, 0, 1, 0, 4, 0, 1]


@pytest.mark.parametrize("text, kind", [("NaN", "text"), ("1.5.2", "text"), ("1e5", "number"), ("007", "whole"), ("0x1f", "text"), (" 1", "text"), ("-", "text"),
                                        ("9" * 30, "number"), ("true ", "text"), ("\\N", "missing"), ("Infinity", "text"), ("1d", "text"), ("é", "text")])
def test_classes(spark, text, kind):
    df = spark.createDataFrame([(text,)], "t string").select(inference.value_class(F.col("t")).alias("c"))
    assert df.first().c == kind


def test_thousands_of_columns_need_no_wide_plan(spark, text_file):
    names = [f"S{k}" for k in range(3105)]
    path = text_file("w.tsv", "\t".join(names), *["\t".join(str(r * k % 5) if k % 2 else "A/A" for k in range(3105)) for r in range(20)])
    counts = inference.class_counts(spark, path)
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("\n") < 10
    (shuffle,) = [n for n in nodes(_ran(counts)) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert shuffle.metrics().apply("shuffleRecordsWritten").value() <= 2 * 3105  # per task: columns and classes, not fields
    assert types(spark, path) == {n: "bigint" if k % 2 else "string" for k, n in enumerate(names)}


def _ran(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def test_files_that_are_no_table(spark, text_file):
    with pytest.raises(ValueError, match="more than 2"):
        inference.infer_schema(spark, text_file("a", "x\ty", "1\t2", "1\t2\t3"))
    with pytest.raises(ValueError, match="fewer than 2"):
        inference.infer_schema(spark, text_file("b", "x\ty", "1", "1\t2"))
    with pytest.raises(ValueError, match="one name"):
        inference.infer_schema(spark, text_file("c", "x\tx", "1\t2"))
    with pytest.raises(ValueError, match="no header"):
        inference.infer_schema(spark, text_file("d"))
    good = inference.infer_schema(spark, text_file("e", "x\ty", "1\t2"))
    with pytest.raises(Exception, match="cannot be cast|CAST"):
        inference.read_inferred(spark, text_file("f", "x\ty", "1\tz"), inferred=good).collect()
    assert not inference.same_layout(good, inference.infer_schema(spark, text_file("g", "x\ty", "1\tz")))


def test_other_separators_and_no_header(spark, text_file):
    assert types(spark, text_file("a", "1.|x|3", "2.5|y|"), separator="|", names=["a", "b", "c"]) == {"a": "double", "b": "string", "c": "bigint"}
    empty = inference.read_inferred(spark, text_file("b", "x\ty"))
    assert empty.count() == 0 and empty.dtypes == [("x", "string"), ("y", "string")]


SCHEMA = "name string, pos bigint, flipped boolean, score double"
LINES = ["#Name\tpos\tflipped\tscore", "a\t1\tt\t0.5", "b\t2\t0\t\\N", "", "c\tx\t1\t1", "d\t4", "e\t5\t1\t1\textra", "f\t6\tmaybe\t1", "name\tpos\tflipped\tscore",
         "g\t\\N\t\\N\t2", "\\N\t7\tfalse\t1e3", '"h\t8\t1\t1']


def test_every_line_is_accounted_for(spark, text_file, tmp_path):
    load = audited.load_audited(spark, text_file("a.tsv", *LINES), SCHEMA, str(tmp_path / "out"), header=True, source="test")
    assert load.counts == {"lines": 12, "rows": 5, "rejects": 4, "headers": 2, "blanks": 1}
    rows = [("a", 1, True, 0.5), ("b", 2, False, None), ("g", None, None, 2.0), (None, 7, False, 1000.0), ('"h', 8, True, 1.0)]
    assert sorted(map(tuple, load.rows.collect()), key=repr) == sorted(rows, key=repr)
    assert load.rows.schema.simpleString() == "struct<name:string,pos:bigint,flipped:boolean,score:double>"
    assert sorted(map(tuple, load.rejects.collect())) == [
        ("c\tx\t1\t1", 4, "type"), ("d\t4", 2, "fields"), ("e\t5\t1\t1\textra", 5, "fields"), ("f\t6\tmaybe\t1", 4, "flag")]
    row = load.provenance.first()
    assert (row.source, row.lines, row["rows"], row.rejects, row.headers, row.blanks) == ("test", 12, 5, 4, 2, 1)


def test_the_file_is_read_once(spark, text_file, tmp_path):
    path = text_file("a.tsv", *LINES)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    load = audited.load_audited(spark, path, SCHEMA, str(tmp_path / "out"), header=True)
    jobs = set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - set(before)
    assert len(jobs) == 1
    for df in (load.rows, load.rejects):
        assert "a.tsv" not in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("lines, counts", [([], (0, 0, 0)), (["a\t1\t1\t1"], (1, 1, 0)), (["a"], (1, 0, 1))])
def test_loads_with_nothing_of_a_kind(spark, text_file, tmp_path, lines, counts):
    load = audited.load_audited(spark, text_file("a.tsv", *lines), SCHEMA, str(tmp_path / "out"))
    assert (load.counts["lines"], load.rows.count(), load.rejects.count()) == counts
