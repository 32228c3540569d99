"""Removal of lines that many documents share.

Every document sends one row per distinct line key: the key's 128-bit hash, the document and the
places of its lines. The rows are range-partitioned by hash, document and place and sorted by them, so
a key of very many documents lies in many partitions, and each partition is read as a stream in
which a key's first occurrences come first. A stream holds a key's rows until the key is seen in
`least_documents` documents; from then on they go straight out. The first and the last key of a
partition may go on in its neighbours: their undecided rows go out as open ones, with the first
documents of each, and are decided by a join of a few rows a partition. What comes back to a document
is not text but a compressed bitmap of its lines.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. A document is a
`doc_id`; rows that repeat one with another text count as one document, and each gets its own lines
back. Rows with a null `doc_id` are a document per distinct text. Null and empty texts are one empty
line. Empty keys are never dropped; neither are keys shorter than `least_chars` code points. Repeated
rows stay and are cut alike. Very long texts are read whole, one at a time. An empty table gives no
rows. Columns other than `doc_id` and `text` are not read, so other columns can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import documents, keep_in, slices

#: Rows of an undecided key that a stream holds before it sends them out as open ones.
HELD = 1024
_DROPPED, _OPEN, _SEEN = 0, 1, 2
_ROWS = pa.schema(
    [("kind", pa.int8()), ("key", pa.binary()), ("doc_id", pa.int64()), ("twin", pa.binary()), ("at", pa.int32()), ("more", pa.binary())]
)


def _with_twin(docs: DataFrame) -> DataFrame:
    """`twin`, the text's digest, tells rows of one id (or of none) apart."""
    return documents(docs).withColumn("twin", F.unhex(F.md5("text")))


def line_keys(docs: DataFrame, least_chars: int = 1) -> DataFrame:
    """One row per row of `docs` and distinct key: its hash, first place, and further places (packed ints)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, docs_, twins, firsts, more = [], [], [], [], []
                for doc, twin, text in zip(*(part.column(x).to_pylist() for x in ("doc_id", "twin", "text"))):
                    places: dict[bytes, list[int]] = {}
                    for at, line in enumerate(text.encode().split(b"\n")):
                        key = line.strip().lower()  # on bytes: the six ASCII spaces, and A-Z
                        if key:
                            places.setdefault(key, []).append(at)
                    for key, found in places.items():
                        if least_chars > 1 and len(key.decode()) < least_chars:
                            continue
                        keys.append(xxhash.xxh3_128_digest(key))
                        docs_.append(doc)
                        twins.append(twin)
                        firsts.append(found[0])
                        more.append(np.array(found[1:], "<i4").tobytes() if len(found) > 1 else None)
                arrays = [pa.array(keys, pa.binary()), pa.array(docs_, pa.int64()), pa.array(twins, pa.binary()),
                          pa.array(firsts, pa.int32()), pa.array(more, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "twin", "at", "more"])

    return docs.select("doc_id", "twin", "text").mapInArrow(run, "key binary, doc_id long, twin binary, at int, more binary")


class _Run:
    """The key that a stream is at."""

    def __init__(self, key: bytes, first: bool):
        self.key, self.first, self.leaked = key, first, False
        self.docs: list[tuple] = []  # the first documents, `least` at most
        self.held: list[tuple] = []


def stream_shared(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and document in, dropped and open rows out (`_ROWS`)."""
    out: list[tuple] = []
    run: _Run | None = None
    first = True

    def flush() -> Iterator[pa.RecordBatch]:
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _ROWS)], schema=_ROWS)
            out.clear()

    def close(run: _Run | None, last: bool) -> None:
        if run is not None and (run.first or last or run.leaked):
            # The key may be in other partitions too: what is known of it is sent with its rows.
            out.extend((_OPEN, run.key, *x) for x in run.held)
            out.extend((_SEEN, run.key, *x, None, None) for x in run.docs)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), "<u8").reshape(-1, 2)
        begins = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
        for n, (a, b) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
            # A whole key inside the batch with too few rows is in no other partition and stays.
            if 0 < n < len(begins) - 2 and b - a < least:
                if n == 1:
                    close(run, False)
                    run, first = None, False
                continue
            key = batch.column("key")[a].as_py()
            if run is None or run.key != key:
                close(run, False)
                run = _Run(key, first)
                first = False
            part = batch.slice(a, b - a)
            for row in zip(*(part.column(x).to_pylist() for x in ("doc_id", "twin", "at", "more"))):
                known = (row[0], row[1] if row[0] is None else None)
                if len(run.docs) < least and (not run.docs or run.docs[-1] != known):
                    run.docs.append(known)
                if len(run.docs) >= least:
                    out.extend((_DROPPED, None, *x) for x in [*run.held, row])
                    run.held.clear()
                else:
                    run.held.append(row)
                    if len(run.held) > HELD:
                        out.extend((_OPEN, key, *x) for x in run.held)
                        run.held.clear()
                        run.leaked = True
                if len(out) > 8192:
                    yield from flush()
        yield from flush()
    close(run, True)
    yield from flush()


def shared_lines(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """`doc_id`, `twin`, `at`, `more`: the lines to drop. `docs` has `doc_id`, `text`, `twin`."""
    order = ["key", "doc_id", "twin", "at"]
    ranged = line_keys(docs, least_chars).repartitionByRange(*order).sortWithinPartitions(*order)
    ddl = "kind byte, key binary, doc_id long, twin binary, at int, more binary"
    found = keep_in(ranged.mapInArrow(lambda b: stream_shared(b, least_documents), ddl), "shared-lines")
    seen = found.filter(F.col("kind") == _SEEN).groupBy("key").agg(F.count_distinct(F.struct("doc_id", "twin")).alias("docs"))
    often = seen.filter(F.col("docs") >= least_documents).select("key")
    opened = found.filter(F.col("kind") == _OPEN).join(often, "key", "left_semi")
    columns = ["doc_id", "twin", "at", "more"]
    return found.filter(F.col("kind") == _DROPPED).select(*columns).unionByName(opened.select(*columns))


def pack_bitmap(dropped: np.ndarray) -> bytes:
    """Places of dropped lines as a compressed bitmap of kept ones; lines past its end are kept."""
    bits = np.ones((int(dropped.max()) // 8 + 1) * 8, bool)
    bits[dropped] = False
    return zlib.compress(np.packbits(bits).tobytes(), 1)


def unpack_bitmap(packed: bytes | None, lines: int) -> np.ndarray:
    """True for every line that is kept."""
    keep = np.ones(lines, bool)
    if packed:
        bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[:lines]
        keep[: len(bits)] = bits == 1
    return keep


def keep_bitmaps(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """`doc_id`, `twin`, `keep`: the compressed bitmap of each row's kept lines, for rows that lose any."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for places in batch.column("places").to_pylist():
                at = [np.array([x["at"] for x in places], np.int64)]
                at += [np.frombuffer(x["more"], "<i4") for x in places if x["more"]]
                keep.append(pack_bitmap(np.concatenate(at)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("twin"), pa.array(keep, pa.binary())], ["doc_id", "twin", "keep"])

    lines = shared_lines(docs, least_documents, least_chars)
    # At most the lines of one text: rows of one id and text have the same places.
    grouped = lines.groupBy("doc_id", "twin").agg(F.collect_set(F.struct("at", "more")).alias("places"))
    return grouped.mapInArrow(pack, "doc_id long, twin binary, keep binary")


def drop_shared_lines(docs: DataFrame, least_documents: int = 10, least_chars: int = 1) -> DataFrame:
    """`doc_id`, `n_lines` before dropping, `n_dropped`, `kept` (the other lines), a row per row of `docs`."""
    docs = _with_twin(docs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n_lines, n_dropped, kept = [], [], []
                for text, packed in zip(part.column("text").to_pylist(), part.column("keep").to_pylist()):
                    total = text.count("\n") + 1
                    gone = 0
                    if packed:
                        keep = unpack_bitmap(packed, total)
                        text = "\n".join([x for x, k in zip(text.split("\n"), keep.tolist()) if k])
                        gone = total - int(keep.sum())
                    n_lines.append(total)
                    n_dropped.append(gone)
                    kept.append(text)
                arrays = [part.column("doc_id"), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_lines", "n_dropped", "kept"])

    marks = keep_bitmaps(docs, least_documents, least_chars).select(F.col("doc_id").alias("_id"), F.col("twin").alias("_twin"), "keep")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("twin") == F.col("_twin"))
    joined = docs.join(marks, same, "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, kept string")
