"""Best-fit packing of token pieces with certified bin counts.

Every document is encoded and gets the end id. A longer one than `size` is cut into pieces of
exactly `size` tokens, the shorter remainder first, so that only remainders have to be packed; whole
pieces fill a sequence each. The rest are dealt over partitions of bounded size and packed there by
best-fit decreasing. A lower bound by dual feasible functions certifies a partition whose bin count
equals it; in a partition that is not certified, and wherever a bin keeps a gap, the documents of
the bins with gaps are exchanged: all partitions send them on to fewer partitions, which rerun
best-fit decreasing over them. This ends when every partition is certified and only one is left
with gaps, or when one partition holds all that is left. A partition's rows are bounded by
`PART_ROWS` as long as gaps are few, which the bound guarantees from round to round: what is sent on
is the content of at most a fixed share of a partition's bins.

Null texts count as empty (one token, the end id). Rows that repeat a `doc_id` are packed each.
An empty table gives no rows. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import documents, keep_in, slices
from genoweave.llm.tokens import MEMO, library_encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Rows that a partition packs at once, on average.
PART_ROWS = 20_000


def cut_pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, memo: int = MEMO) -> DataFrame:
    """One row per piece, with the checksum of its ids but without them."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, memo)
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                rows = []
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder(part.column("text").to_pylist())):
                    ids, start, number = ids + end, 0, 0
                    total = len(ids) // 4
                    while start < total:
                        length = (total - start) % size or size if start == 0 else size
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        rows.append((doc_id, number, start, length, crc))
                        start, number = start + length, number + 1
                columns = list(zip(*rows))
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(columns, types)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return documents(docs).mapInArrow(cut, PIECES)


def lower_bound(lengths: np.ndarray, size: int) -> int:
    """The most bins that two families of dual feasible functions prove necessary.

    f_k rounds x (k + 1) / size down to multiples of 1 / k where that is no whole number; u_e drops
    items below e and lifts those above size - e to a whole bin.
    """
    values, counts = np.unique(lengths, return_counts=True)
    best = ceil(Fraction(int((values * counts).sum()), size))
    for k in range(1, 21):
        up, left = np.divmod(values * (k + 1), size)
        # whole number: x itself, else the multiple below, both over k * size
        weight = np.where(left == 0, values * k, up * size)
        best = max(best, ceil(Fraction(int((weight * counts).sum()), k * size)))
    for e in np.unique(np.minimum(values, size - values)):
        if 0 < e <= size // 2:
            weight = np.where(values > size - e, size, np.where(values < e, 0, values))
            best = max(best, ceil(Fraction(int((weight * counts).sum()), size)))
    return best


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item by best-fit decreasing, and the fill of each bin."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    fill: list[int] = []
    gaps: list[int] = []  # distinct gaps, ascending
    by_gap: dict[int, list[int]] = {}
    for k in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[k])
        at = bisect_left(gaps, n)
        if at == len(gaps):
            which, gap = len(fill), size
            fill.append(0)
        else:
            gap = gaps[at]
            which = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap], gaps[at]
        bins[k], offsets[k] = which, fill[which]
        fill[which] += n
        if gap > n:
            if gap - n not in by_gap:
                insort(gaps, gap - n)
                by_gap[gap - n] = []
            by_gap[gap - n].append(which)
    return bins, offsets, np.array(fill, dtype=np.int64)


def pack_pieces(pieces: DataFrame, size: int) -> DataFrame:
    """Adds `sequence_id` and `offset` to rows that `cut_pieces` made."""
    done = [
        pieces.filter(F.col("length") == size)
        .withColumn("sequence_id", F.monotonically_increasing_id() * 2)
        .withColumn("offset", F.lit(0).cast("long"))
    ]
    left, turn = pieces.filter(F.col("length") < size), 0
    rows = left.count()
    while rows:
        parts = -(-rows // PART_ROWS)
        last, base = parts == 1, turn

        def pack(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
            lengths = rows.column("length").to_numpy()
            bins, offsets, fill = best_fit(lengths, size)
            certified = len(fill) == lower_bound(lengths, size)
            # A partition that the bound certifies sends on its worst bin alone, the others the bins
            # with the widest gaps: as many as the bound leaves open, and as much again for partners.
            extra = 1 if certified else 1 + 4 * (len(fill) - lower_bound(lengths, size))
            order = np.argsort(fill, kind="stable")
            send = np.zeros(len(fill), bool)
            if not last:
                send[order[: min(extra, max(1, len(fill) // 4))]] = True
                send &= fill < size
            number = ((base << 24 | rows.column("part")[0].as_py()) << 24 | bins) * 2 + 1
            rows = rows.drop_columns("part").append_column("sequence_id", pa.array(number))
            return rows.append_column("offset", pa.array(offsets)).append_column("again", pa.array(send[bins]))

        # Equal lengths are dealt evenly: the key is a hash of the row, not of its length.
        dealt = left.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(turn)), F.lit(parts)).cast("int"))
        packed = keep_in(dealt.groupBy("part").applyInArrow(pack, PACKED + ", again boolean"), "packed")
        done.append(packed.filter("not again").drop("again"))
        left = packed.filter("again").select(*pieces.columns)
        turn, rows = turn + 1, left.count()
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, memo: int = MEMO) -> DataFrame:
    """The place of every piece of every document: `sequence_id` and `offset`. `memo` bounds what a task remembers of the tokenizer's work."""
    return pack_pieces(keep_in(cut_pieces(docs, tokenizer, size, end_id, memo), "pieces"), size)


def sequences(docs: DataFrame, places: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """`sequence_id` and `ids`, the tokens of each sequence: at most `size` of them.

    `places` are the rows of `pack_documents(docs, ...)`; `doc_id` must be unique here.
    """
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [np.frombuffer(x + end, dtype="<i4") for x in encoder(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"]
                )

    encoded = documents(docs).mapInArrow(encode, "doc_id long, ids array<int>")
    parts = places.join(encoded, "doc_id").select(
        "sequence_id", "offset", F.slice("ids", F.col("start").cast("int") + 1, F.col("length").cast("int")).alias("ids")
    )
    gathered = parts.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
