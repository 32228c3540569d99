"""Near duplicates by SimHash, found exactly through vantage-point trees.

A vantage-point tree over whole 64-bit fingerprints prunes next to nothing: distances from any
vantage point lie within 32 +- 4 for unrelated texts, so a search of radius 4 visits both sides of
seven splits in ten. Fingerprints are therefore partitioned in subspaces. They are cut into
`radius + 1` blocks; two that differ in at most `radius` bits agree in one block, that is, lie there
within radius 0 of each other, and by the triangle inequality have the same distance from every
vantage point of that block. The leaves of the trees of that subspace are thus its values, and no
boundary overlaps. Inside such a shard a vantage-point tree over the whole fingerprint does the
search: it splits at the median distance, and of the two sides only the bands within `radius` of the
boundary are compared with each other. A shard above `SHARD_ROWS` is first split by annuli around one
of its members over several tasks; what lies within `radius` below an upper boundary goes to the next
annulus too.

Shards yield spanning edges, never all pairs. Equal fingerprints are one row throughout.

Null texts count as empty: fingerprint zero, linked like any other. Repeated rows share a
fingerprint. Rows with a null `doc_id` tie nothing together; they get the component of their
fingerprint, or null if no other row has it. Very long texts are read whole, one at a time. An empty table gives
no rows. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import documents, keep_in, partitions, slices
from genoweave.llm.components import components

SEED = 42
#: Rows of a shard beyond which it is split over tasks by annuli.
SHARD_ROWS = 20_000
#: Points that a leaf of a tree compares with each other directly.
LEAF = 256


def fingerprint(text: str, width: int = 4) -> int:
    """One bit per position that more than half the shingle hashes set."""
    words = text.encode().lower().split()  # on bytes: A-Z, and the six ASCII spaces
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(x) + 1 for x in words])
    begins = np.concatenate([[0], ends[:-1]])
    if len(words) <= width:
        spans = [(0, len(joined))]
    else:
        spans = zip(begins[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    more = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(more, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """`doc_id` and `fp`, the fingerprint's bits as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = np.array([fingerprint(x, width) for x in part.column("text").to_pylist()], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return documents(docs).mapInArrow(run, "doc_id long, fp long")


class _Sets:
    """Disjoint sets of 0 .. n - 1; the root of a set is its smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _link(points: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, sets: _Sets) -> None:
    """Joins all of `a` with all of `b` (positions in `points`) within `radius`, in blocks."""
    step = max(1, (1 << 18) // max(1, len(b)))
    for k in range(0, len(a), step):
        rows = a[k : k + step]
        i, j = np.nonzero(np.bitwise_count(points[rows, None] ^ points[None, b]) <= radius)
        i, j = rows[i], b[j]
        if len(i) > 4096:  # a dense block: one link per pair of sets is enough
            i = np.array([sets.root(x) for x in i.tolist()])
            j = np.array([sets.root(x) for x in j.tolist()])
            i, j = np.unique(np.stack([i, j]), axis=1)
        for x, y in zip(i.tolist(), j.tolist()):
            if x != y:
                sets.join(x, y)


def vantage_link(points: np.ndarray, radius: int) -> np.ndarray:
    """The smallest position in each point's component, links being distances up to `radius`."""
    sets = _Sets(len(points))
    todo = [np.arange(len(points))]
    while todo:
        here = todo.pop()
        if len(here) <= LEAF:
            _link(points, here, here, radius, sets)
            continue
        away = np.bitwise_count(points[here] ^ points[here[len(here) // 2]]).astype(np.int64)
        middle = int(np.median(away))
        if not (away > middle).any():
            middle -= 1
        inner, outer = here[away <= middle], here[away > middle]
        if not len(inner) or not len(outer):
            _link(points, here, here, radius, sets)
            continue
        _link(points, here[(away <= middle) & (away > middle - radius)], here[(away > middle) & (away <= middle + radius)], radius, sets)
        todo += [inner, outer]
    return np.array([sets.root(x) for x in range(len(points))], dtype=np.int64)


def block_ranges(radius: int) -> list[tuple[int, int]]:
    """First bit and width of each of `radius + 1` blocks."""
    cuts = [64 * k // (radius + 1) for k in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


def links(points: DataFrame, radius: int = 4) -> DataFrame:
    """Spanning edges `u`, `v` (representatives) of points `fp`, `rep` within `radius` bits."""
    spark = points.sparkSession
    values = [
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << n) - 1)).alias("value"))
        for k, (a, n) in enumerate(block_ranges(radius))
    ]
    keyed = points.select("fp", "rep", F.explode(F.array(*values)).alias("k"))
    keyed = keep_in(keyed.select("k.block", "k.value", F.lit(0).alias("annulus"), "fp", "rep"), "shards")
    key, width = ["block", "value", "annulus"], radius + 1
    # Two rounds of splitting around members; annuli are numbered on from 100 times the last one.
    for _ in range(2):
        large = keyed.groupBy(*key).agg(F.count("*").alias("n"), F.min_by("fp", F.xxhash64("fp")).alias("vantage"))
        large = keep_in(large.filter(F.col("n") > SHARD_ROWS).drop("n"), "large")
        if large.isEmpty():
            break
        away = F.bit_count(F.col("fp").bitwiseXOR(F.col("vantage")))
        ring, over = F.floor(away / width).cast("int"), F.floor((away + radius) / width).cast("int")
        split = keyed.join(large, key, "left")
        split = split.select(
            "block", "value", "fp", "rep", "annulus",
            F.explode(F.when(F.col("vantage").isNull(), F.array(F.lit(-1))).otherwise(F.array_distinct(F.array(ring, over)))).alias("ring"),
        )
        keyed = keep_in(split.withColumn("annulus", F.col("annulus") * 100 + F.col("ring") + 1).drop("ring"), "shards")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted by shard; a shard may go on in the next batch."""
        rest: list[np.ndarray] = []

        def found(rows: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            u, v = [], []
            for part in np.split(rows, edge):
                if len(part) > 1:
                    part = part[np.argsort(part[:, 4], kind="stable")]
                    reps = part[:, 4]
                    root = vantage_link(part[:, 3].copy().view(np.uint64), radius)
                    tied = np.flatnonzero(root != np.arange(len(root)))
                    u.append(reps[tied])
                    v.append(reps[root[tied]])
            none = np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([none, *u])), pa.array(np.concatenate([none, *v]))], ["u", "v"])

        for batch in batches:
            rows = np.stack([batch.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (*key, "fp", "rep")], axis=1)
            if not len(rows):
                continue
            same = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            last = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if last or rest and (rest[-1][-1, :3] != rows[0, :3]).any():
                yield found(np.concatenate([*rest, rows[:last]]))
                rest = []
            rest.append(rows[last:])
        if rest:
            yield found(np.concatenate(rest))

    dealt = keyed.repartition(partitions(spark), *key).sortWithinPartitions(*key)
    return dealt.mapInArrow(search, "u long, v long")


def near_duplicates(docs: DataFrame, radius: int = 4, width: int = 4) -> DataFrame:
    """`doc_id`, `fp` and `component_id`, the smallest `doc_id` reachable over links."""
    marked = keep_in(fingerprints(docs, width), "fingerprints")
    points = keep_in(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "points")
    tied = components(links(points.filter("rep is not null"), radius)).withColumnRenamed("node", "rep")
    # `tied` has few rows; points without a link are their own component.
    known = points.join(tied, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return marked.join(known, "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
