"""Block-compressed call files: ranges, regions, parts."""

import gzip
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, EqualTo, GreaterThanOrEqual, In, LessThan

from genoweave.sources import call_blocks as cb
from genoweave.sources import vcf

HEAD = ["##fileformat=VCFv4.2", "\t".join([*vcf.FIXED_COLUMNS, "HG001", "hg002"])]


def lines_of(n, seed=1, chroms=("1", "2", "10", "X")):
    """Sorted data lines of very different lengths."""
    rng = random.Random(seed)
    out = []
    for chrom in chroms:
        pos = 0
        for _ in range(n // len(chroms)):
            pos += rng.randrange(3)
            info = "".join(rng.choices("ACGT;=0123456789", k=rng.choice([5, 40, 400, 3000])))
            out.append("\t".join([chrom, str(pos), f"rs{len(out)}", "A", "G", ".", "PASS", info, "GT", "0|1", "./."]))
    return out


def block_file(path, text, step=None, end=True):
    """`text` in blocks of `step` bytes, or of many sizes."""
    rng = random.Random(5)
    data, out, at = text.encode(), b"", 0
    while at < len(data):
        size = step or rng.choice([1, 50, 4000, cb.FILLED])
        out += cb.pack_block(data[at : at + size])
        at += size
    path.write_bytes(out + (cb.LAST if end else b""))
    return str(path)


@pytest.mark.parametrize("step, feed", [(None, "\n"), (1000, "\n"), (64, "\n"), (777, "")])
def test_every_line_has_one_owner(tmp_path, step, feed):
    text = "\n".join([*HEAD, *lines_of(200)]) + feed
    path = block_file(tmp_path / "a.vcf.gz", text, step)
    assert gzip.open(path).read().decode() == text
    rng = random.Random(2)
    for cuts in (0, 1, 7, 60):
        file = cb.BlockFile(cb.fs.LocalFileSystem(), path)
        at = [0, *sorted(rng.sample(range(1, file.size), cuts)), file.size]
        got = b"".join(chunk for a, b in zip(at[:-1], at[1:]) for chunk in file.lines(a, b))
        assert got.decode() == text + ("" if feed else "\n")


def test_lines_longer_than_blocks_and_ranges(tmp_path):
    text = "\n".join([HEAD[1], "1\t5\t" + "x" * 300_000, "1\t6\t" + "y" * 10, ""])
    path = block_file(tmp_path / "a.gz", text, 900)
    file = cb.BlockFile(cb.fs.LocalFileSystem(), path)
    got = [b"".join(file.lines(a, min(a + 700, file.size))) for a in range(0, file.size, 700)]
    assert b"".join(got).decode() == text and sum(map(bool, got)) <= 3


def test_no_blocks_no_reading(tmp_path):
    plain = tmp_path / "a.gz"
    plain.write_bytes(gzip.compress("\n".join([*HEAD, *lines_of(40)]).encode()))
    with pytest.raises(ValueError, match="not block-compressed"):
        cb.block_columns(str(plain))
    path = tmp_path / "b.gz"
    whole = open(block_file(path, "\n".join([*HEAD, *lines_of(40)]), 500), "rb").read()
    path.write_bytes(whole[:700] + bytes([whole[700] ^ 255]) + whole[701:])
    file = cb.BlockFile(cb.fs.LocalFileSystem(), str(path))
    with pytest.raises(Exception, match="damaged|broken|Error"):
        list(file.lines(0, file.size))


def rows(text_lines):
    out = []
    for line in text_lines:
        t = line.split("\t")
        out.append((t[0], int(t[1]), *t[2:9], t[9:]))
    return sorted(out)


def test_one_file_by_several_tasks(spark, tmp_path):
    lines = lines_of(400)
    broken = ["1\t3\tshort", "2\t4\t" + "\t".join("x" * 12)]
    path = block_file(tmp_path / "a.vcf.gz", "\n".join([*HEAD, *lines[:100], *broken, *lines[100:], ""]), 5000)
    df = cb.read_vcf_blocks(spark, path, split=20_000)
    assert df.rdd.getNumPartitions() > 5
    assert sorted(map(tuple, df.collect())) == rows(lines)
    assert df.select(F.spark_partition_id()).distinct().count() > 5
    assert sorted(map(tuple, cb.rejected_block_lines(spark, path, 20_000).collect())) == sorted((b, len(b.split("\t"))) for b in broken)
    assert cb.block_samples(path) == ["hg001", "hg002"]
    text = vcf.read_vcf_sites(spark, path)
    assert sorted(map(tuple, text.withColumn("pos", F.col("pos").cast("long")).collect())) == rows(lines)


@pytest.mark.parametrize("region", [(["2"], None, None), (["2", "X"], 10, 30), (None, 40, 41), (["10"], 49, 49), (["7"], None, None), (None, None, 3)])
def test_regions(spark, tmp_path, region):
    lines = lines_of(400)
    path = block_file(tmp_path / "a.vcf.gz", "\n".join([*HEAD, *lines, ""]), 3000)
    chroms, low, high = region
    wanted = [r for r in rows(lines) if (chroms is None or r[0] in chroms) and (low or 0) <= r[1] <= (high if high is not None else 1 << 60)]
    for ordered in (True, False):
        df = cb.read_vcf_blocks(spark, path, chroms, low, high, ordered, split=50_000)
        assert sorted(map(tuple, df.collect())) == wanted


def test_a_region_opens_few_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(cb, "GRAIN", 8 << 10)
    lines = lines_of(8000)
    path = block_file(tmp_path / "a.vcf.gz", "\n".join([*HEAD, *lines, ""]), 4000)
    blocks = len(list(cb.BlockFile(cb.fs.LocalFileSystem(), path).blocks(0)))

    def opened(filters, **options):
        reader = cb.FilteringReader({"path": path, "splitbytes": "200000", **options})
        assert list(reader.pushFilters(filters)) == filters
        parts = reader.partitions()
        found = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
        return len(parts), len(found), reader.opened

    filters = [EqualTo(("chrom",), "10"), GreaterThanOrEqual(("pos",), 700), LessThan(("pos",), 720)]
    parts, n, few = opened(filters, ordered="true")
    assert parts > 5 and n == sum(line.startswith("10\t") and 700 <= int(line.split("\t")[1]) < 720 for line in lines) > 5
    assert few < blocks / 8
    assert opened(filters)[1:] == (n, pytest.approx(blocks, rel=0.1))
    assert opened([In(("chrom",), ("3", "4"))], ordered="true")[1:] < (1, blocks / 3)


def test_pushed_filters(spark, tmp_path):
    lines = lines_of(200)
    path = block_file(tmp_path / "a.vcf.gz", "\n".join([*HEAD, *lines, ""]), 3000)
    df = cb.read_vcf_blocks(spark, path, ordered=True, split=10_000).filter("chrom = '2' and pos between 5 and 25 and id <> 'rs60'")
    wanted = [r for r in rows(lines) if r[0] == "2" and 5 <= r[1] <= 25 and r[2] != "rs60"]
    assert sorted(map(tuple, df.collect())) == wanted
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
    try:
        plain = cb.read_vcf_blocks(spark, path, ordered=True).filter("chrom = '2' and pos between 5 and 25 and id <> 'rs60'")
        assert sorted(map(tuple, plain.collect())) == wanted
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def test_written_parts(spark, tmp_path):
    lines = lines_of(300)
    path = str(tmp_path / "calls")
    df = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, value string").repartitionByRange(3, "k").sortWithinPartitions("k")
    cb.write_vcf_blocks(df, path, HEAD)
    assert [p.name for p in sorted((tmp_path / "calls").iterdir())] == [f"part-{k:05d}.vcf.gz" for k in range(3)]
    assert sorted(map(tuple, cb.read_vcf_blocks(spark, path, split=30_000).collect())) == rows(lines)
    text = "".join(gzip.open(p, "rt").read() for p in sorted((tmp_path / "calls").iterdir()))
    assert [x for x in text.split("\n") if x and not x.startswith("#")] == lines
    with pytest.raises(Exception, match="is there already"):
        cb.write_vcf_blocks(df, path, HEAD)
    with pytest.raises(ValueError):
        cb.write_vcf_blocks(df, path + "2", ["##only"])


def test_files_with_other_columns(spark, tmp_path):
    block_file(tmp_path / "a.vcf.gz", "\n".join([*HEAD, *lines_of(8), ""]))
    block_file(tmp_path / "b.vcf.gz", "\n".join([HEAD[1] + "\tHG3", ""]))
    with pytest.raises(Exception, match="different columns"):
        cb.read_vcf_blocks(spark, str(tmp_path)).collect()


def test_columns_that_are_missing(spark, tmp_path):
    head = "\t".join([*vcf.FIXED_COLUMNS[:7], "FORMAT", "S1"])
    path = block_file(tmp_path / "a.vcf.gz", head + "\n1\tx\trs1\tA\tC\t.\tPASS\tGT\t0/0\n")
    row = cb.read_vcf_blocks(spark, path).first()
    assert (row.pos, row.info, row.format, row.calls) == (None, None, "GT", ["0/0"])
    assert cb.read_vcf_blocks(spark, block_file(tmp_path / "c.vcf.gz", head + "\n")).count() == 0


def test_writers_take_batches_of_lines(tmp_path):
    """Blocks do not depend on how the lines come; a line of several blocks is whole."""
    assert issubclass(cb.CallBlockWriter, DataSourceArrowWriter)
    lines = ["x" * k for k in (0, 5, 200_000, 7)]
    assert cb.joined_lines(pa.array(lines)) == "".join(x + "\n" for x in lines).encode()
    batch = pa.RecordBatch.from_arrays([pa.array(lines)], ["value"])
    assert [x.num_rows for x in cb.slices(batch, "value", 100)] == [2, 1, 1]
    with pytest.raises(ValueError):
        cb.joined_lines(pa.array(["a", None]))
