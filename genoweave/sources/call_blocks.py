"""Block-compressed call files, read and written in parallel.

A block-compressed file is a row of small gzip members, each of which names its own length, so a
reader can start at any of them. A partition of the scan is a range of the compressed file: it owns the
lines that start after the start of its first block and up to the start of the first block of the
next range, so every line has one owner wherever the ranges are cut. Ranges need no index and no pass
over the file; the driver looks at names, sizes and the column line alone.

Where the caller states that the files are sorted (`ordered`), a task compares the first record of its range
and that of the next one with the wanted chromosomes and positions, leaves the range out or
halves it until it is down to `GRAIN` bytes. A lookup thus opens a few blocks of a range, however long it is.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
    LessThanOrEqual, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from genoweave.sources.vcf import COLUMN_LINE, FIXED_COLUMNS

NAME = "call_blocks"
SCHEMA = "chrom string, pos long, id string, ref string, alt string, qual string, filter string, info string, format string, calls array<string>"
#: Compressed bytes of a task, and of the smallest range that is looked at on its own.
SPLIT, GRAIN = 64 << 20, 128 << 10
#: Bytes of lines that become one Arrow batch.
BATCH = 4 << 20
# How a block starts, the longest block, the bytes a writer puts into one, and the last block.
MAGIC = b"\x1f\x8b\x08\x04"
LONGEST = 1 << 16
FILLED = 0xFF00
LAST = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def block_length(head: bytes) -> int:
    """The length of the block that `head` starts with, 0 if none does."""
    if len(head) < 18 or head[:4] != MAGIC:
        return 0
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 6 <= min(end, len(head)):
        length = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"BC" and length == 2:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + length
    return 0


def pack_block(data: bytes) -> bytes:
    """One block of at most `FILLED` bytes."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    if len(body) + 26 > LONGEST:  # what does not shrink is stored
        packer = zlib.compressobj(0, zlib.DEFLATED, -15)
        body = packer.compress(data) + packer.flush()
    head = MAGIC + bytes(4) + b"\x00\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def joined_lines(lines: pa.Array) -> bytes:
    """The lines, each with its line feed."""
    if lines.null_count:
        raise ValueError("a line is NULL")
    if not len(lines):
        return b""
    whole = pa.ListArray.from_arrays([0, len(lines)], lines.cast(pa.string()))
    return pc.binary_join(whole, "\n")[0].as_buffer().to_pybytes() + b"\n"


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about `most` bytes of one column; a longer line is a part of its own."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(column)), 0).cast(pa.int64())).to_numpy()
    begin = 0
    while begin < len(ends):
        end = max(begin + 1, int(ends.searchsorted((ends[begin - 1] if begin else 0) + most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


class BlockFile:
    """One open file. `opened` counts the blocks that were unpacked."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.path, self.file = path, files.open_input_file(path)
        self.size = self.file.size()
        self.opened = 0

    def start_of_block(self, at: int) -> int:
        """The first block that starts at `at` or later; the file's size if there is none."""
        window = self.file.read_at(min(self.size - at, 2 * LONGEST + 64), at) if at < self.size else b""
        found = window.find(MAGIC)
        while 0 <= found < LONGEST:
            length = block_length(window[found : found + 256])
            after = at + found + length
            if length and (after == self.size or block_length(self.file.read_at(256, after))):
                return at + found
            found = window.find(MAGIC, found + 1)
        if at == 0 and self.size:
            raise ValueError(f"{self.path} is not block-compressed: read it with read_vcf")
        if at + LONGEST < self.size:
            raise ValueError(f"{self.path} has no block within {LONGEST} bytes of {at}")
        return self.size

    def blocks(self, at: int) -> Iterator[tuple[int, bytes]]:
        """(offset, unpacked bytes) from the first block at `at` or later to the end."""
        at = self.start_of_block(at)
        while at < self.size:
            whole = self.file.read_at(min(LONGEST, self.size - at), at)
            length = block_length(whole[:256])
            if not length or length > len(whole):
                raise ValueError(f"{self.path} has a broken block at {at}")
            body = 12 + struct.unpack_from("<H", whole, 10)[0]
            data = zlib.decompress(whole[body : length - 8], -15)
            if zlib.crc32(data) != struct.unpack_from("<I", whole, length - 8)[0]:
                raise ValueError(f"{self.path} has a damaged block at {at}")
            self.opened += 1
            yield at, data
            at += length

    def lines(self, begin: int, end: int) -> Iterator[bytes]:
        """The lines of a range, many at a time, each with its line feed."""
        rest, at, limit, partial = b"", 0, None, begin > 0
        for offset, data in self.blocks(begin):
            if limit is None and offset >= end:
                limit = at + len(rest)
                if limit == 0:  # no block starts in this range
                    return
            rest += data
            if partial:
                cut = rest.find(b"\n") + 1
                if not cut and limit is not None:
                    return
                at, rest, partial = at + (cut or len(rest)), rest[cut:] if cut else b"", not cut
                if partial:
                    continue
            if limit is None:
                cut = rest.rfind(b"\n") + 1
            elif at > limit:
                return
            else:
                cut = rest.find(b"\n", limit - at) + 1
            if cut:
                yield rest[:cut]
                if limit is not None:
                    return
                at, rest = at + cut, rest[cut:]
        if rest and not partial:
            yield rest + b"\n"

    def first_record(self, begin: int) -> tuple[str, int] | None:
        """Chromosome and position of the first data line owned by a range from `begin` on."""
        for chunk in self.lines(begin, self.size):
            for line in chunk.split(b"\n"):
                if line and not line.startswith(b"#"):
                    chrom, pos = (line.split(b"\t", 2) + [b""])[:2]
                    return chrom.decode(), int(pos) if pos.isdigit() else -1
        return None


@dataclass
class Region:
    """What a scan wants: chromosomes (None: all) and positions from `low` to `high`."""

    chroms: set[str] | None = None
    low: int = 0
    high: int = 1 << 62

    def misses(self, first: tuple[str, int] | None, after: tuple[str, int] | None) -> bool:
        """True if no line between the two records can be wanted, in a sorted file."""
        if first is None:  # no data line from here on
            return True
        if after is None or first[0] != after[0] or min(first[1], after[1]) < 0:
            return False
        return (self.chroms is not None and first[0] not in self.chroms) or after[1] < self.low or first[1] > self.high

    def keep(self, chrom: pa.Array, pos: pa.Array) -> pa.Array:
        wanted = pc.and_(pc.greater_equal(pos, self.low), pc.less_equal(pos, self.high))
        if self.low <= 0 and self.high >= 1 << 62:
            wanted = pc.or_kleene(pc.is_null(pos), wanted)
        return pc.and_(wanted, pc.is_in(chrom, pa.array(sorted(self.chroms), pa.string()))) if self.chroms is not None else wanted


@dataclass
class Range(InputPartition):
    path: str
    begin: int
    end: int

    def __post_init__(self) -> None:
        super().__init__((self.path, self.begin))


def _files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    files, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = files.get_file_info(place)
    if info.type == fs.FileType.Directory:
        found = files.get_file_info(fs.FileSelector(place))
        kept = [x for x in found if x.type == fs.FileType.File and not x.base_name.startswith((".", "_"))]
        return files, sorted(kept, key=lambda x: x.path)
    if info.type != fs.FileType.File:
        raise FileNotFoundError(path)
    return files, [info]


def block_columns(path: str) -> list[str]:
    """The names in the column line of the first file."""
    files, found = _files(path)
    for info in found[:1]:
        file = BlockFile(files, info.path)
        for chunk in file.lines(0, file.size):
            for line in chunk.decode().split("\n"):
                if line.startswith(COLUMN_LINE):
                    return line.split("\t")
                if line and not line.startswith("#"):
                    break
    raise ValueError(f"no column line in {path}")


class CallBlockReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.rejects = options["path"], options.get("rejects", "false") == "true"
        self.split = int(options.get("splitbytes", SPLIT))
        self.ordered = options.get("ordered", "false") == "true"
        chroms = options.get("chroms")
        self.region = Region(set(chroms.split(",")) if chroms else None, int(options.get("low", 0)), int(options.get("high", 1 << 62)))
        self.columns = block_columns(self.path)
        self.opened = 0

    def partitions(self) -> list[Range]:
        _, found = _files(self.path)
        return [Range(x.path, k, min(k + self.split, x.size)) for x in found for k in range(0, x.size, self.split)] or [Range("", 0, 0)]

    def _ranges(self, file: BlockFile, begin: int, end: int, known: dict[int, tuple | None]) -> Iterator[tuple[int, int]]:
        """The parts of a range that can hold wanted lines."""
        for at in (begin, end):
            if at not in known:
                known[at] = file.first_record(at) if at < file.size else None
        if self.region.misses(known[begin], known[end]):
            return
        if end - begin <= GRAIN:
            yield begin, end
        else:
            middle = (begin + end) // 2
            yield from self._ranges(file, begin, middle, known)
            yield from self._ranges(file, middle, end, known)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        files = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        file = BlockFile(files, partition.path)
        narrow = self.ordered and not self.rejects and self.region != Region()
        ranges = self._ranges(file, partition.begin, partition.end, {}) if narrow else [(partition.begin, partition.end)]
        held, size = [], 0
        for begin, end in ranges:
            for chunk in file.lines(begin, end):
                held.append(chunk)
                size += len(chunk)
                if size >= BATCH:
                    yield self._batch(b"".join(held))
                    held, size = [], 0
        if held:
            yield self._batch(b"".join(held))
        self.opened += file.opened

    def _batch(self, text: bytes) -> pa.RecordBatch:
        lines = pc.list_flatten(pc.split_pattern(pa.array([text.decode()], pa.string()), "\n"))
        for line in lines.filter(pc.starts_with(lines, COLUMN_LINE)).to_pylist():
            if line.split("\t") != self.columns:
                raise ValueError("read files with different columns apart and union them")
        lines = lines.filter(pc.invert(pc.or_(pc.equal(lines, ""), pc.starts_with(lines, "#"))))
        tokens = pc.split_pattern(lines, "\t")
        fits = pc.equal(pc.list_value_length(tokens), len(self.columns))
        if self.rejects:
            wrong = pc.invert(fits)
            counts = pc.list_value_length(tokens).filter(wrong)
            return pa.RecordBatch.from_arrays([lines.filter(wrong), counts.cast(pa.int32())], ["value", "tokens"])
        tokens = tokens.filter(fits)
        fixed = [c for c in self.columns[: len(FIXED_COLUMNS)] if c in FIXED_COLUMNS]
        site = {c: pc.list_element(tokens, k) if len(tokens) else pa.array([], pa.string()) for k, c in enumerate(fixed)}
        arrays = [site.get(c, pa.nulls(len(tokens), pa.string())) for c in FIXED_COLUMNS]
        number = pc.match_substring_regex(arrays[1], r"^\d{1,18}$")
        arrays[1] = pc.if_else(number, arrays[1], pa.scalar(None, pa.string())).cast(pa.int64())
        calls = pc.list_slice(tokens, len(fixed), len(self.columns)).cast(pa.list_(pa.string()))
        keep = self.region.keep(arrays[0], arrays[1])
        return pa.RecordBatch.from_arrays([x.filter(keep) for x in [*arrays, calls]], [f.split()[0] for f in SCHEMA.split(", ")])


class FilteringReader(CallBlockReader):
    """For sessions that hand filters to such sources; in others a reader must not ask for them."""

    def pushFilters(self, filters):
        """Bounds on chromosome and position narrow the region; Spark filters the rows again."""
        for found in filters:
            place, value = getattr(found, "attribute", None), getattr(found, "value", None)
            if place == ("chrom",) and isinstance(found, EqualTo | In):
                chroms = {found.value} if isinstance(found, EqualTo) else set(found.value)
                self.region.chroms = chroms if self.region.chroms is None else self.region.chroms & chroms
            elif place == ("pos",) and isinstance(found, EqualTo | GreaterThan | GreaterThanOrEqual):
                self.region.low = max(self.region.low, value + isinstance(found, GreaterThan))
            if place == ("pos",) and isinstance(found, EqualTo | LessThan | LessThanOrEqual):
                self.region.high = min(self.region.high, value - isinstance(found, LessThan))
            yield found


@dataclass
class Part(WriterCommitMessage):
    name: str
    hidden: str


class CallBlockWriter(DataSourceArrowWriter):
    """Parts in partition order, each a file of its own with the head lines. Parts of failed or repeated
    attempts stay hidden; what counts is renamed when all are done."""

    def __init__(self, path: str, head: str):
        self.path, self.head = path.rstrip("/"), head

    def _place(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def write(self, iterator) -> Part:
        from pyspark import TaskContext

        files, folder = self._place()
        files.create_dir(folder, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.vcf.gz"
        hidden = f".{name}.{uuid.uuid4().hex}"
        rest = self.head.encode() + b"\n" if self.head else b""
        with files.open_output_stream(f"{folder}/{hidden}", compression=None) as out:
            for batch in iterator:
                for part in slices(batch, "value", BATCH):
                    rest += joined_lines(part.column("value"))
                    full = len(rest) // FILLED * FILLED
                    for k in range(0, full, FILLED):
                        out.write(pack_block(rest[k : k + FILLED]))
                    rest = rest[full:]
            if rest:
                out.write(pack_block(rest))
            out.write(LAST)
        return Part(name, hidden)

    def commit(self, messages) -> None:
        files, folder = self._place()
        for part in messages:
            files.move(f"{folder}/{part.hidden}", f"{folder}/{part.name}")

    def abort(self, messages) -> None:
        files, folder = self._place()
        for part in messages:
            if part is not None:
                files.delete_file(f"{folder}/{part.hidden}")


class CallBlocks(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "value string, tokens int" if self.options.get("rejects", "false") == "true" else SCHEMA

    def reader(self, schema: StructType) -> CallBlockReader:
        kind = FilteringReader if self.options.get("pushdown", "false") == "true" else CallBlockReader
        return kind(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> CallBlockWriter:
        files, folder = CallBlockWriter(self.options["path"], "")._place()
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            raise FileExistsError(f"{folder} is there already")
        return CallBlockWriter(self.options["path"], self.options.get("head", ""))


def _load(spark: SparkSession, path: str, split: int, **options) -> DataFrame:
    spark.dataSource.register(CallBlocks)
    given = {k: str(v) for k, v in options.items() if v is not None}
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return spark.read.format(NAME).options(path=path, splitbytes=str(split), pushdown=pushdown, **given).load()


def read_vcf_blocks(
    spark: SparkSession, path: str, chroms: list[str] | None = None, low: int | None = None, high: int | None = None,
    ordered: bool = False, split: int = SPLIT,
) -> DataFrame:
    """One row per site of block-compressed call files (a file or a folder): the fixed columns, `pos` as a
    number, and all calls as one array, in sample order.

    `chroms`, `low` and `high` (inclusive) choose a region. A filter on `chrom` and `pos` does the same where the
    session has `spark.sql.python.filterPushdown.enabled`. With `ordered` the caller states that every file is
    sorted: each chromosome in one piece, positions rising; ranges without wanted lines are then not unpacked. Lines with a wrong
    number of fields are left out (`rejected_block_lines` has them), a position that is no number is NULL.
    """
    if chroms is not None and not chroms:
        raise ValueError("no chromosome is wanted")
    wanted = ",".join(chroms) if chroms else None
    return _load(spark, path, split, chroms=wanted, low=low, high=high, ordered="true" if ordered else None)


def rejected_block_lines(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """The lines the reader leaves out, with their number of fields."""
    return _load(spark, path, split, rejects="true")


def block_samples(path: str) -> list[str]:
    columns = block_columns(path)
    fixed = [c for c in columns[: len(FIXED_COLUMNS)] if c in FIXED_COLUMNS]
    return [name.lower() for name in columns[len(fixed) :]]


def call_line(site: list[Column], calls: Column) -> Column:
    """A data line of the fixed columns and an array of calls; nothing may be NULL but becomes a dot."""
    from pyspark.sql import functions as F

    return F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit(".")) for c in site], F.array_join(calls, "\t", "."))


def write_vcf_blocks(lines: DataFrame, path: str, head: list[str]) -> None:
    """Writes `value` lines as block-compressed parts, one per partition, each after the head lines. The
    last head line has to be the column line."""
    if not head or not re.match(COLUMN_LINE, head[-1]):
        raise ValueError("the last head line has to name the columns")
    lines.sparkSession.dataSource.register(CallBlocks)
    lines.select("value").write.format(NAME).mode("append").options(path=path, head="\n".join(head)).save()
