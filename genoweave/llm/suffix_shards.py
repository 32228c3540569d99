"""Substring deduplication in bytes by sorted suffixes.

Every 50-byte string has a smallest 16-byte gram by hash, its anchor; equal strings have equal
anchors. Round one finds the anchors that occur more than once: other strings are not repeated. In
round two the runs of consecutive strings with the same repeated anchor travel, as text, to
the shard of the anchor, once per batch and content. A shard takes the anchors in turn, puts distinct segments of
as many as `MOST` bytes allow into one text and sorts its suffixes by external induced sorting (see `induced_sort`). Neighbours
in that order with a common prefix of 50 bytes or more start equal strings, and the smallest document of such a group is known. One
bit per string goes back to the batches, which mark what is repeated and cut it out. Where one anchor's distinct segments
are longer than that, they are cut again by anchors of longer grams, at last of whole strings: equal strings still meet.

Anchors are compared by 32 bits within a shard, which only chooses candidates; strings are compared
as text. Shards are as many as the batches require; a shard's queues are on the disk of its task. A task holds the arrays of one
batch, hashed by slices, or the segments of one shard and the sort of one text.

Null texts count as empty. Texts shorter than a string stay whole. Rows that repeat a `doc_id` never
remove each other's bytes, but both lose what a smaller id has. Cuts go through characters where the
strings do, so what remains is bytes. A null `doc_id` counts as larger than all others. An empty table gives no rows. Columns beside `text` are handed
through, unless an added column has the name.
"""

from __future__ import annotations

import io
import tempfile
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
    mix,
    others,
    planes,
    request_rows,
    shards,
    squeeze,
    with_added,
    write_batches,
)
from genoweave.llm.block_anchors import spans
from genoweave.llm.common import partitions
from genoweave.llm.induced_sort import InducedSorter

ADDED = "n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"
GRAM = 16
#: Strings whose hashes or places a task makes at once.
SLICE = 1 << 18
#: Bytes of segments that are compared at once, and of those that are sorted at once. A sort takes 58 times as many.
BLOCK = 1 << 22
MOST = 1 << 20

_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_K = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the `gram` bytes from each position on."""
    h = _BYTE[data]
    have = 1
    factor = _K
    while have < gram:
        more = min(have, gram - have)
        h = h[:-more] * factor + h[more:]
        factor = np.uint64(int(factor) * int(factor) % 2**64)
        have += more
    return mix(h)


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values."""
    have = 1
    while have < width:
        more = min(have, width - have)
        h = np.minimum(h[:-more], h[more:])
        have += more
    return h


def anchor_hashes(data: np.ndarray, length: int, gram: int = GRAM) -> np.ndarray:
    """The anchor's hash of the string from each position on."""
    return least_of(gram_hashes(data, gram), length - gram + 1)


def packed(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive sizes that reach `most` together; a larger one is a range of its own."""
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):
        end = max(begin + 1, int(np.searchsorted(ends, ends[begin] - sizes[begin] + most, "right")))
        yield begin, end
        begin = end


def steps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each item of runs of these sizes, its run and its place there."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return run, np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def pieces(begins: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The runs and places of items, some at a time; runs begin at `begins`."""
    for a, b in packed(sizes, SLICE):
        run, step = steps(sizes[a:b])
        yield run + a, begins[a:b][run] + step


class Anchored:
    """Strings of a batch and their anchors, the same every time."""

    def __init__(self, row: dict, length: int, count: int):
        self.batch = Batch(row["doc_ids"], row["sizes"], row["text"])
        self.length, self.count = length, count
        data, n = self.batch.data, max(0, len(self.batch.data) - length + 1)
        sizes = self.batch.ends - self.batch.begins
        # Where a string begins that stays in its document.
        edges = np.zeros(n + 1, np.int8)
        full = sizes >= length
        edges[self.batch.begins[full]] += 1
        edges[self.batch.ends[full] - length + 1] -= 1
        inside = np.cumsum(edges, dtype=np.int8)[:n] > 0
        # Runs of strings with one anchor, in one document.
        begins, anchors = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        last = None
        for a in range(0, n, SLICE):
            here = inside[a : a + SLICE]
            least = anchor_hashes(data[a : a + len(here) + length - 1], length)
            new = np.ones(len(here), bool)
            new[1:] = (least[1:] != least[:-1]) | (here[1:] != here[:-1])
            new[0] = (least[0], here[0]) != last
            last = least[-1], here[-1]
            begins.append(np.flatnonzero(new) + a)
            anchors.append(least[new])
        begins = np.concatenate(begins)
        ends = np.append(begins[1:], n)[: len(begins)]
        use = inside[begins]
        self.run_begin, self.run_end = begins[use], ends[use]
        h = np.concatenate(anchors)[use]
        key = (h >> np.uint64(40)) % np.uint64(count) << np.uint64(32) | h & np.uint64(0xFFFFFFFF)
        self.keys, self.key_of, copies = np.unique(key, return_inverse=True, return_counts=True)
        self.several = copies > 1
        self.counts = np.bincount((self.keys >> np.uint64(32)).astype(np.int64), minlength=count)

    def anchors(self, batch: int) -> pa.RecordBatch:
        low = (self.keys & np.uint64(0xFFFFFFFF)).astype("<u4")

        def payload(a: int, b: int) -> bytes:
            steps = np.diff(low[a:b], prepend=np.uint32(0))
            return squeeze((b - a).to_bytes(4, "little") + np.packbits(self.several[a:b]).tobytes() + planes(steps))

        return request_rows(batch, self.counts, payload)

    def segment(self, answers: list[dict] | None) -> None:
        """Distinct segments, by shard and anchor: their place, number of strings and smallest document."""
        keep = np.flatnonzero(answers_to_bits(answers, self.counts)[self.key_of])
        keep = keep[np.argsort(self.key_of[keep], kind="stable")]
        self.begin, self.end, key = self.run_begin[keep], self.run_end[keep], self.key_of[keep]
        self.docs = self.batch.doc_ids[np.searchsorted(self.batch.ends, self.begin)]
        text, more = self.batch.text, self.length - 1
        # Equal segments have equal anchors: only runs with an anchor that comes again here are compared.
        alike = np.arange(len(keep))
        again = np.flatnonzero(self.several[key])
        seen: dict[bytes, int] = {}
        last = None
        for at in range(0, len(again), SLICE):
            some = again[at : at + SLICE]
            for k, anchor, a, b in zip(some.tolist(), key[some].tolist(), self.begin[some].tolist(), self.end[some].tolist()):
                if anchor != last:
                    seen.clear()
                    last = anchor
                alike[k] = seen.setdefault(text[a : b + more], k)
        new = alike == np.arange(len(keep))
        self.which = (np.cumsum(new) - 1)[alike]
        self.first = np.flatnonzero(new)
        self.least = np.full(len(self.first), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.which, self.docs)
        self.strings = (self.end - self.begin)[self.first]
        self.in_shard = (self.keys[key[self.first]] >> np.uint64(32)).astype(np.int64)
        self.string_counts = np.bincount(self.in_shard, self.strings, self.count).astype(np.int64)

    def segments(self, batch: int) -> pa.RecordBatch:
        def payload(a: int, b: int) -> bytes:
            numbers = squeeze(planes(self.strings[a:b].astype("<i8"))), squeeze(planes(self.least[a:b].astype("<i8")))
            places = zip(self.begin[self.first[a:b]].tolist(), self.end[self.first[a:b]].tolist())
            text = squeeze(b"".join([self.batch.text[x : y + self.length - 1] for x, y in places]))
            return len(numbers[0]).to_bytes(4, "little") + len(numbers[1]).to_bytes(4, "little") + b"".join(numbers) + text

        return request_rows(batch, np.bincount(self.in_shard, minlength=self.count), payload)

    def repeated(self, answers: list[dict] | None) -> np.ndarray:
        """Whether each byte is covered by a string that starts in a smaller document too."""
        smaller = answers_to_bits(answers, self.string_counts)
        offset = np.cumsum(self.strings) - self.strings
        sizes = self.end - self.begin
        here = self.least[self.which] < self.docs
        covered = np.zeros(len(self.batch.data), bool)
        for a, b in packed(sizes, SLICE):
            # String by string: its place in the batch, its bit, and whether its document is the smallest here.
            run, step = steps(sizes[a:b])
            run += a
            flagged = smaller[offset[self.which[run]] + step] | here[run]
            covered[(self.begin[run] + step)[flagged]] = True
        have = 1  # bytes that are marked of each string
        while have < self.length:
            more = min(have, self.length - have)
            covered[more:] |= covered[:-more].copy()
            have += more
        return covered


def judge_anchors(payloads: list[bytes]) -> list[np.ndarray]:
    keys, several = [], []
    for payload in payloads:
        data = expand(payload)
        n = int.from_bytes(data[:4], "little")
        size = (n + 7) // 8
        several.append(np.unpackbits(np.frombuffer(data, np.uint8, size, 4), count=n))
        keys.append(np.cumsum(from_planes(data[4 + size :], "<u4"), dtype=np.uint32))
    _, which, copies = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    more = copies + np.bincount(which, np.concatenate(several), len(copies)) > 1
    return np.split(more[which], np.cumsum([len(x) for x in keys])[:-1])


def smallest_documents(contents: list[bytes], first: np.ndarray, length: int) -> np.ndarray:
    """For each string of each segment, the smallest document that any segment with it has."""
    # One text: segments with a separator (1) after each, and the end (0); bytes are 2 and up.
    sizes = np.array([len(x) for x in contents])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    text = np.ones(int((sizes + 1).sum()) + 1, np.uint16)
    text[-1] = 0
    inside = np.ones(len(text), bool)
    inside[begins + sizes] = False
    inside[-1] = False
    text[inside] = np.frombuffer(b"".join(contents), np.uint8).astype(np.uint16) + 2
    with tempfile.TemporaryDirectory() as folder:
        order, common = InducedSorter(text, folder, length).order()
    # The smallest document of every group of neighbours that share a whole string.
    starts = np.zeros(len(text), bool)
    for_segment, step = steps(sizes - length + 1)
    place = begins[for_segment] + step
    starts[place] = True
    segment_of = np.zeros(len(text), np.int64)
    segment_of[place] = for_segment
    use = starts[order]
    # A suffix that is no string's start has less than a string before its separator: it joins no group.
    group = np.cumsum(common < length)[use]
    found = order[use]
    smallest = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(smallest, group, first[segment_of[found]])
    of_start = np.zeros(len(text), np.int64)
    of_start[found] = smallest[group]
    return of_start[place]


class Segments:
    """Places of segments in a text, their numbers of strings and their documents."""

    def __init__(self, text: bytes, begin: np.ndarray, strings: np.ndarray, least: np.ndarray, length: int):
        self.text, self.begin, self.strings, self.least, self.length = text, begin, strings, least, length
        self.sizes = strings + length - 1

    def take(self, which: np.ndarray, least: np.ndarray | None = None) -> Segments:
        return Segments(self.text, self.begin[which], self.strings[which], self.least[which] if least is None else least, self.length)

    def contents(self) -> Iterator[bytes]:
        for a, b in packed(self.sizes, BLOCK):
            for begin, size in zip(self.begin[a:b].tolist(), self.sizes[a:b].tolist()):
                yield self.text[begin : begin + size]

    def by_anchor(self, gram: int, part: int, parts: int) -> tuple[Segments, np.ndarray, np.ndarray]:
        """The strings of one part of all anchors, in segments of one anchor each, their anchors and the first one's number."""
        begin, strings, least, anchors, number = [], [], [], [], []
        before = 0
        for a, b in packed(self.sizes, SLICE):
            some = self.take(np.arange(a, b))
            run, step = steps(some.strings)
            places = (np.cumsum(some.sizes) - some.sizes)[run] + step
            h = anchor_hashes(np.frombuffer(b"".join(some.contents()), np.uint8), self.length, gram)[places]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (run[1:] != run[:-1])
            at = np.flatnonzero(new)
            use = h[at] % np.uint64(parts) == part
            strings.append(np.diff(np.append(at, len(h)))[use])
            at = at[use]
            begin.append(some.begin[run[at]] + step[at])
            least.append(some.least[run[at]])
            anchors.append(h[at])
            number.append(at + before)
            before += len(h)
        found = Segments(self.text, *map(np.concatenate, (begin, strings, least)), self.length)
        return found, np.concatenate(anchors), np.concatenate(number)

    def distinct(self) -> np.ndarray | None:
        """The number of each segment's content, by first occurrence; nothing if they are too much text."""
        seen: dict[bytes, int] = {}
        which, size = np.empty(len(self.begin), np.int64), 0
        for k, x in enumerate(self.contents()):
            known = len(seen)
            which[k] = seen.setdefault(x, known)
            if len(seen) > known:
                size += len(x)
                if size > BLOCK:
                    return None
        return which


def smaller_elsewhere(segments: Segments, gram: int = GRAM) -> np.ndarray:
    """For each string of each segment, whether some segment has it in a smaller document."""
    bits = np.zeros(int(segments.strings.sum()), bool)
    # Longer grams can cut segments to single strings, so anchors are taken in parts.
    parts = 1 if gram == GRAM else 1 + len(bits) // (4 * SLICE)
    for part in range(parts):
        cut, anchors, number = segments.by_anchor(gram, part, parts)
        # Equal strings have equal anchors: where one segment alone has an anchor, nothing is to be found.
        _, group, copies = np.unique(anchors, return_inverse=True, return_counts=True)
        order = np.argsort(group, kind="stable")
        order = order[copies[group[order]] > 1]
        group = group[order]
        begins = np.flatnonzero(np.diff(group, prepend=-1))
        ends = np.append(begins[1:], len(group))[: len(begins)]
        for a, b in packed(np.add.reduceat(cut.sizes[order], begins), BLOCK) if len(order) else ():
            some = slice(begins[a], ends[b - 1])
            here = cut.take(order[some])
            _put(bits, number[order[some]], here.strings, _smaller_among(here, group[some], gram))
    return bits


def _put(bits: np.ndarray, begins: np.ndarray, sizes: np.ndarray, found: np.ndarray) -> None:
    """Writes the bits of runs that begin at `begins`, one after the other in `found`."""
    at = 0
    for _, places in pieces(begins, sizes):
        bits[places] = found[at : at + len(places)]
        at += len(places)


def _smaller_among(segments: Segments, group: np.ndarray, gram: int) -> np.ndarray:
    """The same for segments of a few anchors, `group` by `group`."""
    finer = min(2 * gram, segments.length)
    which = segments.distinct()
    if which is None and finer > gram:
        return smaller_elsewhere(segments, finer)
    if which is None:
        which = np.arange(len(segments.begin))
    first = np.unique(which, return_index=True)[1]
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, which, segments.least)
    contents = segments.take(first, least)
    bits = np.zeros(int(contents.strings.sum()), bool)
    offset = np.cumsum(contents.strings) - contents.strings
    _, of, copies = np.unique(group[first], return_inverse=True, return_counts=True)
    rivals = np.flatnonzero(copies[of] > 1)
    begins = np.flatnonzero(np.diff(of[rivals], prepend=-1))
    ends = np.append(begins[1:], len(rivals))[: len(begins)]
    for a, b in packed(np.add.reduceat(contents.sizes[rivals], begins), MOST) if len(rivals) else ():
        some = rivals[begins[a] : ends[b - 1]]
        chosen = contents.take(some)
        if int(chosen.sizes.sum()) > MOST and finer > gram:
            found = smaller_elsewhere(chosen, finer)
        else:
            found = smallest_documents(list(chosen.contents()), chosen.least, segments.length) < np.repeat(chosen.least, chosen.strings)
        _put(bits, offset[some], chosen.strings, found)
    late = least[which] < segments.least
    return np.concatenate([bits[places] | late[run] for run, places in pieces(offset[which], segments.strings)])


def judge_segments(payloads: list[bytes], length: int) -> list[np.ndarray]:
    """Whether each string starts in a smaller document than the smallest one of its request."""
    least, strings, text = [], [], io.BytesIO()
    for payload in payloads:
        a, b = int.from_bytes(payload[:4], "little"), int.from_bytes(payload[4:8], "little")
        strings.append(from_planes(expand(payload[8 : 8 + a]), "<i8"))
        least.append(from_planes(expand(payload[8 + a : 8 + a + b]), "<i8"))
        text.write(expand(payload[8 + a + b :]))
    numbers = np.concatenate(strings)
    begin = np.cumsum(numbers + length - 1) - (numbers + length - 1)
    bits = smaller_elsewhere(Segments(text.getvalue(), begin, numbers, np.concatenate(least), length))
    return np.split(bits, np.cumsum([int(x.sum()) for x in strings])[:-1])


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """The columns of `docs` but `text`, `n_bytes`, `n_removed`, `spans` (of removed bytes) and
    `kept`, the bytes that stay."""
    if length < GRAM:
        raise ValueError(f"strings have {GRAM} bytes or more")
    docs, schema = with_added(docs, ADDED)
    table, number = write_batches(docs)
    # Every sort has a fixed cost, so shards are fewer and larger than elsewhere.
    count = max(2 * partitions(table.sparkSession), shards(table, number) // 2)

    def anchor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                yield Anchored(row, length, count).anchors(row["batch"])

    # A batch's arrays end with the call that made them, so a task holds those of one batch at a time.
    def segmented(row: dict) -> Anchored:
        anchored = Anchored(row, length, count)
        anchored.segment(row["answers"])
        return anchored

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                yield segmented(row).segments(row["batch"])

    def covered(row: dict) -> tuple[Batch, np.ndarray]:
        anchored = segmented(row)
        return anchored.batch, anchored.repeated(row["found"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                yield from rows(others(row["rest"]), *covered(row))

    def rows(rest: pa.RecordBatch, texts: Batch, away: np.ndarray) -> Iterator[pa.RecordBatch]:
        for begin in range(0, len(rest), 1000):
            some = slice(begin, begin + 1000)
            held, kept = [], []
            for a, b in zip(texts.begins[some].tolist(), texts.ends[some].tolist()):
                gone = away[a:b]
                if gone.any():
                    held.append(spans(gone))
                    kept.append(texts.data[a:b][~gone].tobytes())
                else:
                    held.append([])
                    kept.append(texts.text[a:b])
            sizes = texts.ends[some] - texts.begins[some]
            added = [
                pa.array(sizes),
                pa.array(sizes - np.array([len(x) for x in kept], dtype=np.int64)),
                pa.array(held, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                pa.array(kept, pa.binary()),
            ]
            part = rest.slice(begin, 1000)
            yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, "n_bytes", "n_removed", "spans", "kept"])

    places = table.select("batch", "doc_ids", "sizes", "text")
    hits = ask(places.mapInArrow(anchor, REQUEST), judge_anchors)
    found = ask(places.join(hits, "batch", "left").mapInArrow(send, REQUEST), lambda x: judge_segments(x, length))
    every = table.join(hits, "batch", "left").join(found.withColumnRenamed("answers", "found"), "batch", "left")
    return every.mapInArrow(cut, schema)
