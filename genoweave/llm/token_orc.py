"""Token ids as ORC: sorted by document, run-length encoded, with row indexes and Bloom filters.

The texts are range-partitioned and sorted by `doc_id` before they are encoded (text shuffles
smaller than ids), so file k holds smaller ids than file k + 1 and every stripe and row group covers
a narrow range of `doc_id`: a filter on it skips files, stripes and row groups by their minimum and
maximum, and by the Bloom filter where the range does not decide. The ids are an integer array,
which ORC stores run-length encoded.

Null texts count as empty; an empty document still gets the end id. Rows that repeat a `doc_id` are
documents of their own, ordered by text; they share a file. An empty table gives no rows. Columns of `docs` other than
`doc_id` and `text` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from genoweave.llm.common import documents, slices
from genoweave.llm.tokens import library_encoder

FILE_SCHEMA = "doc_id long, n_tokens long, segment int, segment_start long, ids array<int>"


def write_token_orc(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, stride: int = 1000, stripe_mb: int = 16
) -> None:
    """Encodes `docs` with the tokenizers file `tokenizer` and writes the folder `path`.

    `segment` numbers the range partitions; `segment_start` counts the ids before the document in
    its segment. `stride` is the number of rows per row index entry and Bloom filter.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, segment, start = library_encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [x + end for x in encoder(part.column("text").to_pylist())]
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
                values = np.frombuffer(b"".join(ids), dtype="<i4")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(offsets)),
                        pa.array(np.full(len(ids), segment, dtype=np.int32)),
                        pa.array(start + offsets[:-1]),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)),
                    ],
                    ["doc_id", "n_tokens", "segment", "segment_start", "ids"],
                )
                start += int(offsets[-1])

    (
        documents(docs)
        .repartitionByRange("doc_id")  # on ids alone, so that sampling the bounds reads no text
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, FILE_SCHEMA)
        .write.option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", stride)
        .option("orc.stripe.size", stripe_mb << 20)
        .option("compression", "zstd")
        .orc(path)
    )


def read_token_orc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the files; a filter on `doc_id` is pushed down to stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def token_spans(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id`, `start`, `n_tokens` and `ids_crc32` of every document, from the files.

    Segment totals (one row per file) are summed up in order and joined to the documents, so no
    task sees more than its own stripes.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
            crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [batch.column(x) for x in ("doc_id", "segment", "segment_start", "n_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(crc, pa.int64())],
                ["doc_id", "segment", "segment_start", "n_tokens", "ids_crc32"],
            )

    rows = read_token_orc(spark, path)
    totals = rows.groupBy("segment").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("segment", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    spans = rows.mapInArrow(
        digest, "doc_id long, segment int, segment_start long, n_tokens long, ids_crc32 long"
    )
    return spans.join(first, "segment").select(
        "doc_id", (F.col("first") + F.col("segment_start")).alias("start"), "n_tokens", "ids_crc32"
    )
