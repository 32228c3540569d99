"""Substring deduplication by fixed-block anchors.

Reference: every document is cut into non-overlapping blocks of `BLOCK` = 7 words, which are
indexed by hash. Any window of 13 words holds a whole block, so a repeated window is found where a
rolling window of seven words of one document hits a block of another place. Hits are extended: all
13-word windows around a hit are looked up by hash, which gives the smallest document each starts
in, and consecutive repeated windows merge to the maximal repeats.

The index and both lookups are spread over shards (see `batches`): round one tells each batch
which of its rolling windows hit, round two which of the windows around hits start in a
smaller document. Hashes have 64 bits in round two; round one's 32 bits within a shard only choose
candidates.

Null texts count as empty and hold no words. Texts shorter than a window keep all words. Rows that
repeat a `doc_id` never remove each other's words (no smaller id), but both lose what a smaller id has. A null
`doc_id` counts as larger than all others. A very long text is a batch of its own. An empty table gives no rows. Columns beside `text` are handed
through, unless an added column has the name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from genoweave.llm.batches import (
    REQUEST,
    Batch,
    answers_to_bits,
    ask,
    expand,
    from_planes,
    others,
    planes,
    request_rows,
    shards,
    squeeze,
    windows,
    with_added,
    word_hashes,
    words,
    write_batches,
)

#: Bytes of text in a batch. A task's arrays take some twenty times as many, beside a JVM that earlier stages have filled.
BATCH_BYTES = 2 << 20
ADDED = "n_words long, n_removed long, spans array<struct<begin: long, end: long>>, kept string"


class Worded:
    """Words of a batch and the keys they give, the same every time."""

    def __init__(self, row: dict, window: int, count: int):
        self.batch = Batch(row["doc_ids"], row["sizes"], row["text"])
        self.window, self.count = window, count
        self.block = (window + 1) // 2
        self.begins, self.ends = words(self.batch.data)
        self.hashes = word_hashes(self.batch.data, self.begins, self.ends)
        # Which document each word is in; first word and number of words of each document.
        self.doc = np.searchsorted(self.batch.ends, self.begins)
        self.first = np.searchsorted(self.begins, self.batch.begins)
        self.n = np.diff(np.append(self.first, len(self.begins)))
        h = windows(self.hashes, self.block)
        inside = self._inside(self.block)
        self.at = np.flatnonzero(inside)
        key = (h[inside] >> np.uint64(40)) % np.uint64(count) << np.uint64(32) | h[inside] & np.uint64(0xFFFFFFFF)
        self.keys, self.key_of, copies = np.unique(key, return_inverse=True, return_counts=True)
        self.several = copies > 1
        self.anchor = np.zeros(len(self.keys), bool)
        aligned = (self.at - self.first[self.doc[self.at]]) % self.block == 0
        self.anchor[self.key_of[aligned]] = True
        self.counts = np.bincount((self.keys >> np.uint64(32)).astype(np.int64), minlength=count)

    def _inside(self, width: int) -> np.ndarray:
        """Whether a window of `width` words stays in its document."""
        n = max(0, len(self.begins) - width + 1)
        return self.doc[:n] == self.doc[len(self.begins) - n :] if n else np.zeros(0, bool)

    def probes(self, batch: int) -> pa.RecordBatch:
        low = (self.keys & np.uint64(0xFFFFFFFF)).astype("<u4")

        def payload(a: int, b: int) -> bytes:
            flags = np.packbits(np.concatenate([self.anchor[a:b], self.several[a:b]])).tobytes()
            steps = np.diff(low[a:b], prepend=np.uint32(0))
            return squeeze((b - a).to_bytes(4, "little") + flags + planes(steps))

        return request_rows(batch, self.counts, payload)

    def extend(self, answers: list[dict] | None) -> None:
        """The windows around hits, with their hash and the smallest document here they start in."""
        hit = np.zeros(len(self.begins) + 1, np.int64)
        hit[self.at + 1] = answers_to_bits(answers, self.counts)[self.key_of]
        total = np.cumsum(hit)
        inside = self._inside(self.window)
        n = len(inside)
        near = total[self.window - self.block + 1 :][:n] > total[:n]
        self.places = np.flatnonzero(inside & near)
        h = windows(self.hashes, self.window)[self.places]
        doc_ids = self.batch.doc_ids[self.doc[self.places]]
        shard = ((h >> np.uint64(40)) % np.uint64(self.count)).astype(np.int64)
        order = np.lexsort((doc_ids, h, shard))
        ordered = h[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        self.window_hashes, self.least = ordered[new], doc_ids[order][new]
        self.window_of = np.empty(len(order), np.int64)
        self.window_of[order] = np.cumsum(new) - 1
        self.window_counts = np.bincount(shard[order][new], minlength=self.count)

    def lookups(self, batch: int) -> pa.RecordBatch:
        def payload(a: int, b: int) -> bytes:
            left = squeeze(planes(np.diff(self.window_hashes[a:b], prepend=np.uint64(0))))
            return len(left).to_bytes(4, "little") + left + squeeze(planes(self.least[a:b]))

        return request_rows(batch, self.window_counts, payload)

    def repeated(self, answers: list[dict] | None) -> np.ndarray:
        """Whether each word is covered by a window that starts in a smaller document too."""
        smaller = answers_to_bits(answers, self.window_counts)
        own = self.batch.doc_ids[self.doc[self.places]]
        flagged = self.places[smaller[self.window_of] | (self.least[self.window_of] < own)]
        edges = np.zeros(len(self.begins) + 1, np.int64)
        np.add.at(edges, flagged, 1)
        np.add.at(edges, flagged + self.window, -1)
        return np.cumsum(edges)[:-1] > 0


def judge_probes(payloads: list[bytes]) -> list[np.ndarray]:
    """A key is a hit if it occurs in two places and one of them is a block."""
    keys, anchors, several = [], [], []
    for payload in payloads:
        data = expand(payload)
        n = int.from_bytes(data[:4], "little")
        size = (2 * n + 7) // 8
        flags = np.unpackbits(np.frombuffer(data, np.uint8, size, 4), count=2 * n).astype(bool)
        keys.append(np.cumsum(from_planes(data[4 + size :], "<u4"), dtype=np.uint32))
        anchors.append(flags[:n])
        several.append(flags[n:])
    sizes = [len(x) for x in keys]
    _, which, copies = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    places = copies + np.bincount(which, np.concatenate(several), len(copies))
    hit = (places > 1) & (np.bincount(which, np.concatenate(anchors), len(copies)) > 0)
    return np.split(hit[which], np.cumsum(sizes)[:-1])


def judge_windows(payloads: list[bytes]) -> list[np.ndarray]:
    """Whether some other batch has the window in a smaller document than this one does."""
    hashes, least = [], []
    for payload in payloads:
        size = int.from_bytes(payload[:4], "little")
        hashes.append(np.cumsum(from_planes(expand(payload[4 : 4 + size]), "<u8"), dtype=np.uint64))
        least.append(from_planes(expand(payload[4 + size :]), "<i8"))
    sizes = [len(x) for x in hashes]
    h, d = np.concatenate(hashes), np.concatenate(least)
    order = np.lexsort((d, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    first = d[order][new][np.cumsum(new) - 1]
    smaller = np.empty(len(order), bool)
    smaller[order] = first < d[order]
    return np.split(smaller, np.cumsum(sizes)[:-1])


def spans(covered: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0, append=0))
    return [{"begin": a, "end": b} for a, b in zip(edge[0::2].tolist(), edge[1::2].tolist())]


def remove_repeats(docs: DataFrame, window: int = 13, layout: bool = False) -> DataFrame:
    """The columns of `docs` but `text`, `n_words`, `n_removed`, `spans` (of removed words, by
    position) and `kept`: the words that stay, joined by one space, or, with `layout`, the text
    from which removed words are cut with the white space after them."""
    docs, schema = with_added(docs, ADDED)
    table, number = write_batches(docs, BATCH_BYTES)
    count = shards(table, number, BATCH_BYTES)

    # A batch's arrays end with the call that made them, so a task holds those of one batch at a time.
    def extended(row: dict) -> Worded:
        worded = Worded(row, window, count)
        worded.extend(row["answers"])
        return worded

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                yield Worded(row, window, count).probes(row["batch"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                yield extended(row).lookups(row["batch"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                whole = _rows(batch.slice(k, 1).to_pylist()[0])
                for begin in range(0, len(whole), 1000):
                    yield whole.slice(begin, 1000)

    def _rows(row: dict) -> pa.RecordBatch:
        worded = extended(row)
        covered = worded.repeated(row["found"])
        rest, text = others(row["rest"]), worded.batch.text
        removed, held, kept = [], [], []
        for k, (first, n) in enumerate(zip(worded.first.tolist(), worded.n.tolist())):
            away = covered[first : first + n]
            begin, end = int(worded.batch.begins[k]), int(worded.batch.ends[k])
            gone = spans(away)
            removed.append(int(away.sum()))
            held.append(gone)
            if layout:
                stays, at = [], begin
                for x in gone:
                    stays.append(text[at : worded.begins[first + x["begin"]]])
                    at = int(worded.begins[first + x["end"]]) if x["end"] < n else end
                kept.append(b"".join([*stays, text[at:end]]).decode())
            else:
                here = text[begin:end].split()
                kept.append(b" ".join([x for x, y in zip(here, away.tolist()) if not y] if gone else here).decode())
        added = [
            pa.array(worded.n.astype(np.int64)),
            pa.array(removed, pa.int64()),
            pa.array(held, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
            pa.array(kept, pa.string()),
        ]
        return pa.RecordBatch.from_arrays([*rest.columns, *added], [*rest.schema.names, "n_words", "n_removed", "spans", "kept"])

    hits = ask(table.select("batch", "doc_ids", "sizes", "text").mapInArrow(probe, REQUEST), judge_probes)
    near = table.select("batch", "doc_ids", "sizes", "text").join(hits, "batch", "left")
    found = ask(near.mapInArrow(look_up, REQUEST), judge_windows)
    every = table.join(hits, "batch", "left").join(found.withColumnRenamed("answers", "found"), "batch", "left")
    return every.mapInArrow(cut, schema)
