"""Transposing by tiles and decoding by dictionary: same rows, fewer of them moved."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_clustered import nodes, run

from genoweave.functions.alleles import code_letters, code_peptides
from genoweave.operators import dictionary, tiles
from genoweave.operators.positions import running_position
from genoweave.operators.reshape import transpose_lines
from genoweave.plans import flows
from genoweave.session import written


def wide(spark, rows=900, columns=37):
    cells = [((F.col("id") * 7 + k) % 11).cast("string").alias(f"c{k}") for k in range(columns - 2)]
    odd = [F.when(F.col("id") % 3 == 0, F.concat(F.lit("a,"), F.col("id"))).alias("text"), (F.col("id") / 4).alias("number")]
    return spark.range(rows).select("id", *cells, *odd).repartition(5)


def moved(df):
    """Rows each shuffle wrote."""
    found = [n for n in nodes(run(df)) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    return [n.metrics().apply("shuffleRecordsWritten").value() for n in found]


@pytest.mark.parametrize("rows, page, tile_rows, tile_columns", [(900, 250, 64, 10), (900, 10_000, 512, 256), (40, 7, 3, 1), (1, 5, 5, 5), (0, 5, 5, 5)])
def test_tiles_give_the_same_lines(spark, rows, page, tile_rows, tile_columns):
    df = wide(spark, rows)
    ours = tiles.transpose_tiles(df, ["id desc"], ",", page, tile_rows, tile_columns)
    theirs = transpose_lines(df, ["id desc"], ",", page)
    assert sorted(map(tuple, ours.select("column", "page", "line").collect())) == sorted(map(tuple, theirs.select("column", "page", "line").collect()))


def test_a_tile_is_one_row_of_the_shuffle(spark):
    df = wide(spark)
    made = tiles.tiles(df, ["id"], tile_rows=100, tile_columns=10)
    n = made.count()
    assert n <= (900 / 100 + 8 + 8) * 4  # 38 columns in four; ranges and pages cut some tiles short
    lines = tiles.transpose_tiles(df, ["id"], tile_rows=100, tile_columns=10)
    assert 0 < max(moved(lines)) <= n  # tiles of one task and page go together


def test_wide_rows_move_once(spark):
    df = wide(spark)
    placed = running_position(df, [], ["id"], "at")
    assert sorted((r.id, r["at"]) for r in placed.collect()) == [(k, k) for k in range(900)]
    assert max(moved(placed)) <= 8  # the numbered rows stay where they were written


def test_cuts():
    assert tiles._cuts(np.array([0, 0, 0, 1, 1]), np.array([7, 8, 9, 10, 11]), 2) == [(0, 2), (2, 3), (3, 5)]
    assert tiles._cuts(np.array([0, 0, 0]), np.array([1, 2, 5]), 9) == [(0, 2), (2, 3)]
    assert tiles._cuts(np.array([]), np.array([]), 9) == []


def test_separators_and_missing_values():
    batch = pa.RecordBatch.from_pydict({"a": ["x,y", None, ""], "_page": [0, 0, 0], "_place": [0, 1, 2]})
    (out,) = tiles.turned(iter([batch]), ["a"], ",", 9, 9)
    assert out.to_pylist() == [{"page": 0, "chunk": 0, "start": 0, "pieces": ["xy,,"]}]


SITES = [("s1", "G,A,", "R,H,"), ("s2", "G,C,T,", "K,N,N,"), ("s2", "G,C,T,", "K,N,M,"), ("s3", "T,G,", "F,C,")]


@pytest.fixture
def codes(spark):
    sites = spark.createDataFrame([(f"g{k}", 0, *s) for k, s in enumerate(SITES)], "gene_name string, page int, rsid string, alleles string, peptides string")
    return sites.withColumns({"code_letters": code_letters(F.col("alleles")), "code_peptides": code_peptides(F.col("peptides"))})


def calls(spark, n=3000):
    gt = F.element_at(F.array(*[F.lit(x) for x in ("A/G", "G/G", "C/C", "0/0", "A/A", "T/G/C", "")] + [F.lit(None)]), (F.col("id") % 8 + 1).cast("int"))
    site = F.when(F.col("id") % 3 < 2, "s2").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string")))
    return spark.range(n).select(F.concat(F.lit("p"), F.col("id")).alias("patient"), site.alias("rsid"), gt.alias("gt"), F.col("id").alias("n"))


@pytest.mark.parametrize("items", [100, 4096])
def test_dictionary_decodes_alike(spark, codes, items):
    blocks = dictionary.encode_calls(dictionary.site_blocks(calls(spark), ["n"], ["patient"], items=items))
    assert blocks.agg(F.max(F.size("codes"))).first()[0] <= items
    assert blocks.agg(F.max(F.size("genotypes"))).first()[0] <= 7
    decoded = dictionary.decode_dictionary(blocks, codes)
    ours = dictionary.explode_codes(decoded, ["gene_name", "page", "rsid"], ["patient"])
    theirs = flows.decode_genotypes(calls(spark), codes)
    columns = ["patient", "gene_name", "page", "rsid", "peptide_group"]
    assert sorted(map(repr, ours.select(*columns).collect())) == sorted(map(repr, theirs.select(*columns).collect()))


def test_decoding_is_below_the_explode(spark, codes):
    blocks = written(dictionary.encode_calls(dictionary.site_blocks(calls(spark), ["n"], ["patient"])))
    ours = dictionary.explode_codes(dictionary.decode_dictionary(blocks, written(codes)), ["rsid"], ["patient"])
    plan = ours._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index("transform(genotypes")
    assert "transform(genotypes" not in plan[: plan.index("Generate explode")]


def test_calls_of_a_call_file(spark, codes):
    sites = spark.createDataFrame([("s1", ["A/G", None, "G/G"]), ("s3", ["T/T", "T/X", "G/T"])], "rsid string, calls array<string>")
    decoded = dictionary.decode_dictionary(dictionary.encode_calls(sites), codes)
    rows = dictionary.explode_samples(decoded, ["rsid"], ["a", "b", "c"]).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([
        ("s1", "a", "+H+R"), ("s1", "b", None), ("s1", "c", "+R+R"), ("s3", "a", "+F+F"), ("s3", "b", None), ("s3", "c", "+C+F")], key=repr)
