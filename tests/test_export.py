"""Exports: what lies in the files, and in which order."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from genoweave.sources import export


def matrix(spark, n=500, slices=12):
    lines = spark.range(n).select(F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.concat(F.lit("p"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("patient"))
    lines = lines.withColumn("line", F.concat_ws(",", "patient", "slice")).repartition(6)
    return spark.range(slices).select(F.col("id").alias("slice"), F.concat(F.lit("'patient',s"), F.col("id")).alias("line")), lines


def texts(path, slice_):
    parts = sorted((Path(path) / f"slice={slice_}").glob("part-*"))
    return len(parts), "".join(p.read_text() for p in parts).splitlines()


@pytest.mark.parametrize("order, way", [("patient", 1), ("patient desc", -1)])
def test_parts_together_are_the_export(spark, tmp_path, order, way):
    path = str(tmp_path / "matrix")
    header, lines = matrix(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = export.write_ordered_lines(header, lines, path, [order])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = 0
    for k in range(12):
        n, have = texts(path, k)
        parts += n
        assert have == [f"'patient',s{k}"] + [f"p{i:04},{k}" for i in range(500)][::way]
    assert parts > 12  # some slices lie in several parts
    assert found.count() == parts and found.agg(F.sum("rows")).first()[0] == 12 * 501
    places = {(r.slice, r.line): r.value for r in export.read_ordered_lines(spark, path).collect()}
    assert len(places) == 12 * 501 and all(places[k, n + 1] == v for k in range(12) for n, v in enumerate(texts(path, k)[1]))
    assert export.check_export(spark, path).count() == 0


def test_a_lost_part_is_noticed(spark, tmp_path):
    path = str(tmp_path / "matrix")
    export.write_ordered_lines(*matrix(spark, 50, 2), path, ["patient"])
    next((tmp_path / "matrix" / "slice=1").glob("part-*")).rename(tmp_path / "elsewhere")
    assert [r.slice for r in export.check_export(spark, path).collect()] == [1]


def test_missing_headers_and_patients(spark, tmp_path):
    header, lines = matrix(spark, 3, 2)
    lines = lines.unionByName(spark.createDataFrame([(0, None, "none,0")], "slice int, patient string, line string"))
    export.write_ordered_lines(header.filter("slice = 1"), lines, str(tmp_path / "m"), ["patient"])
    assert texts(tmp_path / "m", 0)[1] == ["none,0", "p0000,0", "p0001,0", "p0002,0"]
    assert texts(tmp_path / "m", 1)[1][0] == "'patient',s1"


def test_large_files_are_read_in_blocks(spark, tmp_path):
    path = str(tmp_path / "m")
    export.write_ordered_lines(*matrix(spark, 3000, 1), path, ["patient"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        places = export.read_ordered_lines(spark, path).orderBy("line").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.value for r in places] == texts(path, 0)[1] and [r.line for r in places] == list(range(1, 3002))


def test_empty_export(spark, tmp_path):
    header, lines = matrix(spark, 0, 1)
    assert export.write_ordered_lines(header.limit(0), lines, str(tmp_path / "m"), ["patient"]).count() == 0
