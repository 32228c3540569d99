"""Clustered tables: what moves, what is opened, and heavy keys."""

import pytest
from pyspark.sql import functions as F

from genoweave.plans import inputs, queries_clustered
from genoweave.session import drop_later, remove_written, scratch_path, scratch_table
from genoweave.sources.clustered import bucket_count, calls_of_sites, heavy_keys, join_clustered, save_clustered


def nodes(plan):
    """All nodes of a plan that has run, as JVM objects."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
        return
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from nodes(children.apply(k))


def run(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def scans(df, table):
    """(files that tasks open, rows they give) of the scans of a table."""
    found = [n for n in nodes(run(df)) if n.getClass().getSimpleName() == "FileSourceScanExec" and table in n.toString()]
    files = [sum(len(p.files()) for p in n.inputRDD().partitions()) for n in found]
    return list(zip(files, [n.metrics().apply("numOutputRows").value() for n in found]))


def exchanges(df):
    return [n.toString().split("\n")[0] for n in nodes(run(df)) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]


@pytest.fixture
def save(spark):
    def make(df, key, **options):
        name = scratch_table(spark, "t")
        drop_later(spark, f"{name}_rest")
        return save_clustered(df, name, key, scratch_path(spark, "clustered"), options.pop("buckets", 8), **options)

    yield make


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def calls(spark, n=4000):
    site = (F.col("id") % 200).cast("string")
    return spark.range(n).select(F.concat(F.lit("rs"), site).alias("rsid"), (F.col("id") % 200 % 4).cast("string").alias("chrom"),
                                 F.concat(F.lit("p"), F.col("id")).alias("patient"))


def sites(spark, n=200):
    return spark.range(n).select(F.concat(F.lit("rs"), F.col("id").cast("string")).alias("name"), (F.col("id") % 4).cast("string").alias("chrom"),
                                 (F.col("id") % 7).alias("gene"))


def test_tables_meet_without_moving(spark, save, no_broadcast):
    left, right = save(calls(spark), "rsid"), save(sites(spark), "name")
    assert left.heavy == right.heavy == []
    df = join_clustered(left, right, ["patient", "rsid"], ["gene"])
    assert exchanges(df) == []
    plain = calls(spark).join(sites(spark), F.col("rsid") == F.col("name")).select("patient", "rsid", "gene")
    assert sorted(df.collect()) == sorted(plain.collect())
    with pytest.raises(ValueError):
        join_clustered(left, save(sites(spark), "name", buckets=4), ["rsid"], ["gene"])


def test_chosen_sites_open_few_folders(spark, save, no_broadcast):
    left, right = save(calls(spark), "rsid", partition="chrom"), save(sites(spark), "name")
    df = calls_of_sites(left, right, (F.col("chrom") == "2") & F.col("gene").isin(1, 2), ["patient", "rsid"], ["gene"])
    files = sum(f for f, _ in scans(df, left.name))
    assert 0 < files <= 8  # of 32: one folder of four
    assert not any("rsid" in x for x in exchanges(df))
    plain = calls(spark).join(sites(spark).drop("chrom"), F.col("rsid") == F.col("name")).filter("chrom = '2' and gene in (1, 2)")
    assert sorted(df.collect()) == sorted(plain.select("patient", "rsid", "gene").collect()) != []
    genes = spark.createDataFrame([(3,)], "gene long")
    chosen = calls_of_sites(left, right, genes, ["patient"], ["gene"])
    assert chosen.count() == calls(spark).join(sites(spark).drop("chrom"), F.col("rsid") == F.col("name")).filter("gene = 3").count()
    assert not any("_key" in x or "rsid" in x for x in exchanges(chosen))


def test_lookups_open_one_bucket(spark, save):
    table = save(calls(spark), "rsid", bloom={"patient": 1000})
    assert [f for f, _ in scans(table.find(["rs17"]), table.name)] == [1]
    assert table.find(["rs17"]).count() == 20
    # No value of this name is there, though it lies between the least and the largest of each file.
    (_, rows), *_ = scans(table.even.filter("patient = 'p1x'"), table.name)
    assert rows == 0
    assert table.rows.filter("patient = 'p1234'").count() == 1


@pytest.mark.parametrize("partition", [None, "chrom"])
def test_heavy_and_missing_keys(spark, save, no_broadcast, partition):
    hot = spark.range(2000).select(F.lit("rs5").alias("rsid"), F.lit("1").alias("chrom"), F.concat(F.lit("h"), F.col("id")).alias("patient"))
    none = spark.range(700).select(F.lit(None).cast("string").alias("rsid"), F.lit("1").alias("chrom"), F.lit("n").alias("patient"))
    whole = calls(spark).unionByName(hot).unionByName(none)
    assert heavy_keys(whole, "rsid", 8) == ["rs5"]
    left = save(whole, "rsid", partition=partition)
    double = sites(spark).unionByName(sites(spark).filter("name in ('rs5', 'rs6')"))
    for right in (save(double, "name"), save(double.unionByName(double.filter("name = 'rs9'").crossJoin(spark.range(99)).drop("id")), "name")):
        assert left.rows.count() == whole.count() and left.rest.count() == 2020 + 700
        assert left.find(["rs5", "rs6"]).count() == 2040
        plain = whole.join(right.rows.select("name", "gene"), F.col("rsid") == F.col("name")).select("patient", "gene")
        assert sorted(join_clustered(left, right, ["patient"], ["gene"]).collect()) == sorted(plain.collect())
        if partition:
            wanted = plain.filter("gene in (2, 5)")
            assert sorted(calls_of_sites(left, right, F.col("gene").isin(2, 5), ["patient"], ["gene"]).collect()) == sorted(wanted.collect())


def test_empty_tables(spark, save):
    left, right = save(calls(spark).limit(0), "rsid"), save(sites(spark), "name")
    assert join_clustered(left, right, ["rsid"], ["gene"]).count() == 0 and left.find(["rs1"]).count() == 0


def test_tables_go_with_the_written_files(spark):
    name = scratch_table(spark, "gone")
    spark.range(3).write.option("path", scratch_path(spark, "gone")).saveAsTable(name)
    assert spark.catalog.tableExists(name)
    remove_written(spark)
    assert not spark.catalog.tableExists(name)


def test_buckets_grow_with_the_largest_table(spark, monkeypatch):
    few, many = spark.range(10), spark.range(1000)
    assert bucket_count(few, least=8, rows=100) == 8
    assert bucket_count(few, many, least=8, rows=100) == 16
    assert bucket_count(many, least=1, rows=10) == 128
    assert bucket_count(many, least=1, most=32, rows=10) == 32
    monkeypatch.setattr(queries_clustered, "bucket_count", lambda *tables, least: bucket_count(*tables, least=least, rows=500))
    x = inputs.Inputs(spark, "")
    x.__dict__.update(calls=calls(spark), sites=sites(spark))
    table = queries_clustered.clustered(x, calls(spark), "calls", "rsid")
    rows = table.even.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert table.buckets == 8 and rows <= 1000
    x.__dict__["calls"] = calls(spark, 40_000)
    assert queries_clustered.clustered(x, calls(spark, 40_000), "calls", "rsid").buckets == 128
