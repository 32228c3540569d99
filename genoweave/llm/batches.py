"""Documents in batches, and questions that batches ask of shards.

Operators that compare all documents with all others by hashes or by text work in rounds. A batch
(some megabytes of text, one row of a written table) derives keys from its texts, and sends them to
the shards they hash to, one packed row per batch and shard. A shard sees the keys of all batches
and answers each row with one bit per key. The answers return to the batches, which derive
their keys again, in the same order. So texts never shuffle: the table is bucketed by batch.

A key that very many documents share is sent once per batch, so no shard's share grows with
the copies of one text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from genoweave.llm.common import keep_in, partitions
from genoweave.session import scratch_path, scratch_table

#: Bytes of text at which a batch is closed, unless the operator closes it earlier; a longer document is a batch of its own.
BATCH_BYTES = 6 << 20
NO_ID = np.iinfo(np.int64).max
REQUEST = "shard int, batch long, payload binary"
REPLY = "batch long, shard int, bits binary"


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def expand(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def planes(values: np.ndarray) -> bytes:
    """Bytes of integers, all first bytes, then all second ones and so on; ready to be squeezed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


class Batch:
    """Texts of a batch, separated by a line feed; `begins` and `ends` are their places in `data`.

    A null `doc_id` counts as larger than all others.
    """

    def __init__(self, doc_ids: bytes, sizes: bytes, text: bytes):
        self.doc_ids = np.frombuffer(doc_ids, dtype="<i8")
        sizes = np.frombuffer(sizes, dtype="<i8")
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        self.text = expand(text)
        self.data = np.frombuffer(self.text, dtype=np.uint8)


def with_added(docs: DataFrame, added: str) -> tuple[DataFrame, StructType]:
    """`docs` without columns that have an added column's name, and the schema of its columns but
    `text`, with the added ones after them."""
    new = StructType.fromDDL(added)
    taken = {x.lower() for x in new.fieldNames()}
    docs = docs.select(*[F.col(f"`{x}`") for x in docs.columns if x.lower() not in taken])
    return docs, StructType([*docs.drop("text").schema.fields, *new.fields])


def write_batches(docs: DataFrame, most: int = BATCH_BYTES) -> tuple[DataFrame, int]:
    """The table of batches of about `most` bytes and their number. All columns of `docs` but `text` travel in `rest`."""
    spark = docs.sparkSession
    rows = docs.withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.coalesce("text", F.lit(""))})
    fields = [x for x in rows.columns if x != "text"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        texts: list[bytes] = []
        held: list[pa.RecordBatch] = []
        size = 0

        def close() -> pa.RecordBatch:
            rest = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema) as stream:
                stream.write_batch(rest)
            row = {
                "batch": part << 32 | number,
                "doc_ids": rest.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                "sizes": np.array([len(x) for x in texts], dtype="<i8").tobytes(),
                "text": squeeze(b"".join([x + b"\n" for x in texts])),
                "rest": squeeze(sink.getvalue().to_pybytes()),
            }
            return pa.RecordBatch.from_pylist([row], schema=_ROW)

        for batch in batches:
            begin = 0
            column = batch.column("text")
            for k in range(len(batch)):
                texts.append(column[k].as_py().encode())
                size += len(texts[-1])
                if size >= most:
                    held.append(batch.slice(begin, k + 1 - begin).select(fields))
                    yield close()
                    begin, number, size = k + 1, number + 1, 0
                    texts.clear()
                    held.clear()
            if begin < len(batch):
                held.append(batch.slice(begin).select(fields))
        if texts:
            yield close()

    name = scratch_table(spark, "batches")  # `remove_written` drops it
    packed = rows.mapInArrow(pack, "batch long, doc_ids binary, sizes binary, text binary, rest binary")
    # The planner joins a bucketed table as it lies only if it has as many buckets as a shuffle has partitions.
    writer = packed.write.bucketBy(partitions(spark), "batch").option("path", scratch_path(spark, name))
    writer.option("compression", "none").saveAsTable(name)
    table = spark.table(name)
    return table, table.select("batch").count()


_ROW = pa.schema([("batch", pa.int64()), ("doc_ids", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary()), ("rest", pa.binary())])


def others(rest: bytes) -> pa.RecordBatch:
    """The columns beside `text`, as they came."""
    return pa.ipc.open_stream(expand(rest)).read_next_batch()


def shards(batches: DataFrame, count: int, most: int = BATCH_BYTES) -> int:
    """How many shards to deal keys to: a fixed amount of text's worth of keys each, in batches of whatever size."""
    return max(64, 2 * partitions(batches.sparkSession), count * most // (2 * BATCH_BYTES))


def ask(requests: DataFrame, judge: Callable[[list[bytes]], list[np.ndarray]]) -> DataFrame:
    """Answers requests shard by shard: `judge` gets a shard's payloads and gives the bits of each.

    Returns one row per batch: `batch` and its `answers`, by shard.
    """

    def answer(table: pa.Table) -> pa.Table:
        payloads = [x.as_py() for x in table.column("payload")]
        bits = [squeeze(np.packbits(x).tobytes()) if x.any() else b"" for x in judge(payloads)]
        return pa.table({"batch": table.column("batch"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})

    replies = requests.groupBy("shard").applyInArrow(answer, REPLY).filter(F.length("bits") > 0)
    return keep_in(replies.groupBy("batch").agg(F.collect_list(F.struct("shard", "bits")).alias("answers")), "answers")


def answers_to_bits(answers: list[dict] | None, counts: np.ndarray) -> np.ndarray:
    """The bits of all keys of a batch, `counts[k]` of them in shard k, in the order of shards."""
    begins = np.concatenate([[0], np.cumsum(counts)])
    bits = np.zeros(begins[-1], dtype=bool)
    for x in answers or ():
        a, b = begins[x["shard"]], begins[x["shard"] + 1]
        bits[a:b] = np.unpackbits(np.frombuffer(expand(x["bits"]), np.uint8), count=b - a)
    return bits


def request_rows(batch: int, counts: np.ndarray, payload: Callable[[int, int], bytes]) -> pa.RecordBatch:
    """One row per shard that gets keys; `payload(a, b)` packs the keys from a to b."""
    begins = np.concatenate([[0], np.cumsum(counts)])
    used = np.flatnonzero(counts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(used.astype(np.int32)),
            pa.array(np.full(len(used), batch, np.int64)),
            pa.array([payload(int(begins[k]), int(begins[k + 1])) for k in used], pa.binary()),
        ],
        ["shard", "batch", "payload"],
    )


# Hashing of whole arrays

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every word; `data` ends with a space."""
    word = ~SPACES[data]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if len(data) and word[0]:
        edge = np.concatenate([[0], edge])
    return edge[0::2], edge[1::2]


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left = ends - begins
    out = mix(left.astype(np.uint64) * _A)
    at = np.arange(len(begins))
    step = 0
    while len(at):
        rest = left[at] - step
        value = eights[begins[at] + step]
        cut = np.minimum(rest, 8).astype(np.uint64)
        value = np.where(cut < 8, value & ((np.uint64(1) << (cut * np.uint64(8) % np.uint64(64))) - np.uint64(1)), value)
        out[at] = mix((out[at] ^ value) * _A + _C)
        step += 8
        at = at[rest > 8]
    return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of `width` consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out = out * _A + hashes[k : k + n]
        out ^= out >> np.uint64(29)
    return mix(out)
