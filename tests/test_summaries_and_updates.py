"""Bounded summaries, callers' aggregates, typed INFO fields and updates in place."""

import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_clustered import nodes, run

from genoweave.operators import heavy, user_aggregates
from genoweave.session import written
from genoweave.sources import vcf_info
from genoweave.sources.updates import rewrite_folders, update_folders


def brute(rows, names, k):
    out = []
    for at, name in enumerate(names):
        counts = Counter(r[at] for r in rows if r[at] is not None)
        out += [(name, v, n, rank + 1) for rank, (v, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k])]
    return sorted(out)


def table(seed, n=6000):
    """A skewed column, one where all values differ, one of few values, one of ties, one without values."""
    rng = random.Random(seed)
    return [(f"v{int(rng.paretovariate(0.9))}", f"u{k}", f"f{k % 3}", f"t{k // 2 % 900}", None if k % 4 else "x", None) for k in range(n)]


NAMES = ["skewed", "unique", "few", "ties", "holes", "none"]


@pytest.mark.parametrize("k, entries", [(5, 64), (20, 2000), (1, 1), (3, 8), (50, 50)])
def test_top_values_are_exact(spark, k, entries):
    rows = table(k)
    df = written(spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES)).repartition(6))
    found = heavy.top_values(df, k, entries=entries)
    assert sorted(map(tuple, found.select("column", "value", "n", "rank").collect())) == brute(rows, NAMES, k)


def test_proven_columns_shuffle_summaries_alone(spark):
    rows = [("hot" if k % 3 else f"w{k}", f"g{k % 2}") for k in range(9000)]
    df = written(spark.createDataFrame(rows, "a string, b string").repartition(4))
    made = heavy.summaries(df, ["a", "b"], 32)
    found = [n for n in nodes(run(made)) if n.getClass().getSimpleName() == "ShuffleExchangeExec"]
    assert max(n.metrics().apply("shuffleRecordsWritten").value() for n in found) <= 4 * 2 * 33
    assert [tuple(r)[1:3] for r in heavy.top_values(df, 1, entries=32).orderBy("column").collect()] == [("hot", 6000), ("g0", 4500)]


@pytest.mark.parametrize("entries", [1, 7, 40])
def test_summary_bound(entries):
    rng = random.Random(entries)
    values = [f"v{int(rng.paretovariate(1))}" for _ in range(4000)]
    summary = heavy.Summary(entries)
    for k in range(0, 4000, 500):
        counts = Counter(values[k : k + 500])
        summary.add(list(counts), list(counts.values()))
    for value, n in Counter(values).items():
        assert summary.counts.get(value, 0) <= n <= summary.counts.get(value, 0) + summary.lost
    assert len(summary.counts) <= entries and summary.lost <= 4000 / (entries + 1) + 500


def test_a_callers_aggregate(spark):
    """Sums and counts of a group in pages of 10 rows, merged three at a time, and a median over the merged values."""
    rows = [(f"g{k % 3}" if k % 50 else None, k, float(k * 7 % 101)) for k in range(1000)]
    df = spark.createDataFrame(rows, "key string, at long, value double")
    seen = spark.sparkContext.accumulator(0)

    def step(t):
        assert len(t) <= 10
        seen.add(1)
        return pa.table({"value": t["value"]})

    def merge(t):
        return t.sort_by("value")

    def finish(t):
        values = sorted(t["value"].to_pylist())
        return pa.table({"n": [len(values)], "median": [values[len(values) // 2]]})

    found = user_aggregates.aggregate_pages(df, ["key"], ["at"], step, merge, finish, "value double", "n long, median double", 10, 3)
    groups = {}
    for key, _, value in rows:
        groups.setdefault(key, []).append(value)
    assert {r.key: (r.n, r.median) for r in found.collect()} == {k: (len(v), sorted(v)[len(v) // 2]) for k, v in groups.items()}
    assert seen.value >= 100
    assert user_aggregates.aggregate_pages(df.limit(0), ["key"], ["at"], step, merge, finish, "value double", "n long, median double").count() == 0


HEAD = ['##INFO=<ID=AC,Number=A,Type=Integer,Description="x, Number=1">', "##INFO=<ID=AD,Number=R,Type=Integer>", "##INFO=<ID=GL,Number=G,Type=Float>",
        "##INFO=<ID=NS,Number=1,Type=Integer>", "##INFO=<ID=DB,Number=0,Type=Flag>", "##INFO=<ID=P2,Number=2,Type=String>", "##INFO=<ID=ANY,Number=.,Type=String>"]


def sites(spark, *rows):
    return spark.createDataFrame(list(rows), "alt string, info string, calls array<string>")


def test_declared_fields(spark, text_file):
    fields = vcf_info.info_fields(spark, text_file("a.vcf", *HEAD, HEAD[0]))
    assert {f.name: (f.number, f.kind) for f in fields}["AC"] == ("A", "bigint") and len(fields) == 7
    with pytest.raises(ValueError, match="two ways"):
        vcf_info.info_fields(spark, text_file("b.vcf", HEAD[0], "##INFO=<ID=AC,Number=1,Type=Integer>"))
    row = vcf_info.typed_info(sites(spark, ("C", "AC=5;NS=3;DB;P2=a,.;Q=1=2;R;GL=.", [])), fields).first()
    assert row.info.asDict() == {"AC": [5], "AD": None, "GL": None, "NS": 3, "DB": True, "P2": ["a", None], "ANY": None}
    assert row.info_other == {"Q": "1=2", "R": None}
    for text in (None, ".", "", ";"):
        row = vcf_info.typed_info(sites(spark, ("C", text, [])), fields).first()
        assert row.info.DB is False and row.info.NS is None and row.info_other == {}
    row = vcf_info.typed_info(sites(spark, ("C", "NS=1;NS=x;AC=1;AC=2", [])), fields).first()
    assert (row.info.NS, row.info.AC) == (None, [2])
    assert vcf_info.typed_info(sites(spark, ("C", "A=1", [])), []).first().info_other == {"A": "1"}


def test_one_record_per_allele(spark, text_file):
    fields = vcf_info.info_fields(spark, text_file("a.vcf", *HEAD))
    rows = sites(spark, ("C,T", "AC=5,6;AD=1,2,3;GL=0,1,2,3,4,5;NS=9;DB;P2=a,b;ANY=x,y,z", ["0|1", "2/1:35", "./.", "2"]), ("G", "AC=7;AD=1;P2=a", ["1|0"]), (".", "AC=1;AD=4;NS=2", []), (None, ".", None))
    typed = vcf_info.typed_info(rows, fields)
    out = {(r.alt, r.allele): r for r in vcf_info.per_allele(typed, fields, calls="calls").collect()}
    assert set(out) == {("C", 1), ("T", 2), ("G", 1), (None, 0)}
    c, t, g = out["C", 1], out["T", 2], out["G", 1]
    assert (c.info.AC, c.info.AD, c.info.GL, c.info.NS, c.info.P2, c.info.ANY) == (5, [1, 2], [0, 1, 2], 9, ["a", "b"], ["x", "y", "z"])
    assert (t.info.AC, t.info.AD, t.info.GL) == (6, [1, 3], [0, 3, 5])
    assert c.calls == ["0|1", "./1:35", "./.", "."] and t.calls == ["0|.", "1/.:35", "./.", "1"]
    assert (g.info.AC, g.info.AD, g.info.P2, g.info.DB) == (7, None, None, False)
    errors = sorted(map(tuple, vcf_info.arity_errors(typed, fields, ["alt"]).collect()), key=repr)
    assert errors == sorted([("G", "AD", 2, 1), ("G", "P2", 2, 1), (".", "AC", 0, 1)], key=repr)
    assert vcf_info.arity_errors(typed, [f for f in fields if f.name == "NS"], ["alt"]).count() == 0


def folders(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(40).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("a").alias("text"), (F.col("id") % 4).alias("chrom")).write.partitionBy("chrom").parquet(path)
    return path


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_an_update_rewrites_touched_folders_only(spark, tmp_path):
    path = folders(spark, tmp_path)
    before = files(path)
    values = spark.createDataFrame([("k1", "!", 1), ("k6", "?", 2), ("none", "?", 2), ("x", "y", 9)], "key string, text string, chrom long")
    assert update_folders(spark, path, values, ["key"], "text", "chrom") == [1, 2]
    after = files(path)
    assert {f for f in before if f in after} == {f for f in before if f.startswith(("chrom=0", "chrom=3"))}
    assert all(before[f] == after[f] for f in before if f in after)
    found = {r.key: (r.text, r.chrom) for r in spark.read.parquet(path).collect()}
    assert len(found) == 40 and found["k1"] == ("a!", 1) and found["k6"] == ("a?", 2) and found["k5"] == ("a", 1)
    assert update_folders(spark, path, values.filter("chrom = 9"), ["key"], "text", "chrom") == []


@pytest.mark.parametrize("change, same", [
    (lambda rows: rows.withColumn("text", F.when(F.col("key") != "k5", F.col("text")).otherwise(F.raise_error(F.lit("broken")))), True),
    (lambda rows: rows.filter("key <> 'k5'"), True), (lambda rows: rows.withColumn("chrom", F.col("chrom") + 1), False), (lambda rows: rows.limit(0), False)])
def test_a_failed_update_changes_nothing(spark, tmp_path, change, same):
    path = folders(spark, tmp_path)
    before = files(path)
    with pytest.raises(Exception, match="broken|number of rows|other folders|lose all"):
        rewrite_folders(spark, path, change, spark.createDataFrame([(1,)], "chrom long"), "chrom", same)
    assert files(path) == before
    twice = spark.createDataFrame([("k1", "!", 1), ("k1", "?", 1)], "key string, text string, chrom long")
    with pytest.raises(Exception, match="more than one row"):
        update_folders(spark, path, twice, ["key"], "text", "chrom")
    assert files(path) == before


def test_info_entries_are_cut_once(spark):
    """Not again for every entry: the name of an entry is cut out at one place of the plan."""
    fields = [vcf_info.InfoField("AC", "A", "bigint"), vcf_info.InfoField("NS", "1", "bigint")]
    plan = vcf_info.typed_info(sites(spark, ("C", "AC=5;NS=3", [])), fields)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring_index") == 1


def test_calls_of_short_and_long_allele_numbers(spark):
    calls = ["0|2:35", "./.", "2", "", "10|2", "1/12", "2|", "0/1/2:a|2", "x|2"]
    wanted = {0: ["0|.:35", "./.", ".", ".", ".|.", "./.", ".|.", "0/./.:a|2", ".|."], 2: ["0|1:35", "./.", "1", ".", ".|1", "./.", "1|.", "0/./1:a|2", ".|1"]}
    wanted |= {10: ["0|.:35", "./.", ".", ".", "1|.", "./.", ".|.", "0/./.:a|2", ".|."], 12: ["0|.:35", "./.", ".", ".", ".|.", "./1", ".|.", "0/./.:a|2", ".|."]}
    rows = spark.createDataFrame([(calls, k) for k in wanted], "calls array<string>, k int")
    found = rows.select("k", F.transform("calls", lambda c: vcf_info.recoded_call(c, F.col("k"))).alias("calls"))
    assert {r.k: r.calls for r in found.collect()} == wanted
