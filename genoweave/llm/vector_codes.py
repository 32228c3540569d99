"""Compression of vectors to codes of 16 parts, nearest entries found through a GNAT.

Every part position has a codebook of at most `ENTRIES` integer entries. For each codebook a geometric
near-neighbour access tree is built: a node picks split points far apart, deals its entries to
the nearest one, and stores for every pair of split point and child the range of distances between
them. A batch of parts goes down the tree together: the distances to the split points give a first
bound, then the child of the nearest split point is searched, and any other child is left out for the
parts where some split point's range lies strictly beyond the bound. Distances are square roots of exact
integers, widened by `SLACK` on both sides, so rounding never leaves out an entry; equality never
does either, and the winner is decided on the integer squares, ties to the lower index.

Codebooks start as the parts of the vectors with the smallest ids and are refined in rounds. A task
adds up its own assigned parts; per task the shuffle gets one row per entry, and the driver gets the sums
of `ENTRIES` x 16 entries. No vector but the first `ENTRIES` leaves the executors.

Vectors that are null or hold null or non-finite components take no part. Of the others all must have
the length of the first one and a multiple of 16, and components must keep sums and squares within
63 bits: otherwise the query fails and says so. An empty vector is a row with 16 empty parts. Null ids come after all
others. Repeated rows count each. An empty table gives no rows. Columns other than `vec_id`,
`embedding` and `label` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import keep_in

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Split points of a node, and entries that are compared without a node of their own.
DEGREE, LEAF = 6, 6
#: Above the relative error of a float's square root of an integer, by far.
SLACK = 1e-12


@dataclass
class Node:
    """`splits`: entries compared here. `children` hold the others; `low`, `high`: split point x child."""

    splits: np.ndarray
    children: list[Node] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, point by entry."""
    apart = points[:, None, :] - entries[None, :, :]
    return np.einsum("ijk,ijk->ij", apart, apart)


class Gnat:
    """Nearest entries of one codebook."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        #: Distances computed between points and entries, to be compared with points x entries.
        self.compared = 0
        self.root = self._build(np.arange(len(entries)))

    def _build(self, members: np.ndarray) -> Node:
        if len(members) <= LEAF:
            return Node(members)
        away = squares(self.entries[members], self.entries[members])
        chosen = [0]
        while len(chosen) < DEGREE:
            gap = away[chosen].min(axis=0)
            far = int(gap.argmax())
            if gap[far] == 0:  # only copies of split points are left
                break
            chosen.append(far)
        if len(chosen) == 1:
            return Node(members)
        owner = away[chosen].argmin(axis=0)
        owner[chosen] = -1
        node = Node(members[chosen])
        lows, highs = [], []
        for k in range(len(chosen)):
            mine = np.flatnonzero(owner == k)
            if not len(mine):
                continue
            ranges = np.sqrt(away[np.ix_(chosen, mine)].astype(float))
            lows.append(ranges.min(axis=1) * (1 - SLACK))
            highs.append(ranges.max(axis=1) * (1 + SLACK))
            child = self._build(members[mine])
            node.children.append(child)
        if node.children:
            node.low, node.high = np.stack(lows, axis=1), np.stack(highs, axis=1)
        return node

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and exact squared distance of each point's nearest entry, ties to the lower index."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries))
        self._visit(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _visit(self, node: Node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        if not len(rows):
            return
        away = squares(points[rows], self.entries[node.splits])
        self.compared += away.size
        for k, entry in enumerate(node.splits.tolist()):
            better = (away[:, k] < best[rows]) | ((away[:, k] == best[rows]) & (entry < index[rows]))
            best[rows[better]] = away[better, k]
            index[rows[better]] = entry
        if not node.children:
            return
        roots = np.sqrt(away.astype(float))
        near, far = roots * (1 - SLACK), roots * (1 + SLACK)
        # The child whose ranges fit best comes first, for a good bound.
        outside = np.stack([np.maximum(node.low[:, j] - far, near - node.high[:, j]).max(axis=1) for j in range(len(node.children))], axis=1)
        first = outside.argmin(axis=1)
        for turn in (True, False):
            for j, child in enumerate(node.children):
                here = np.flatnonzero((first == j) == turn)
                reach = np.sqrt(best[rows[here]].astype(float)) * (1 + SLACK)
                self._visit(child, points, rows[here[outside[here, j] <= reach]], best, index)


def _whole(vectors: pa.Array, scale: float) -> np.ndarray:
    """floor(scale * x) of all components, row by row."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False))
    if len(lengths) and (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths have no common codebooks")
    width = int(lengths[0]) if len(lengths) else 0
    bound = (2.0**60 / max(1, width)) ** 0.5  # squared differences of `width` components stay below 2^62
    if len(flat) and np.abs(flat).max() > bound:
        raise ValueError(f"components beyond {bound:.0f} after scaling do not fit the integer distances")
    return flat.astype(np.int64).reshape(len(lengths), width)


def usable(embeddings: DataFrame) -> DataFrame:
    """`vec_id`, `v`, `label` of the vectors that take part."""
    label = F.col("label") if "label" in embeddings.columns else F.lit(None).cast("int")
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"), label.alias("label"))
    return rows.filter(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def first_codebooks(rows: DataFrame, scale: float) -> np.ndarray | None:
    """PARTS x entries x part length, from the vectors of the smallest ids; None without vectors."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()  # ENTRIES at most
    if not first:
        return None
    width = len(first[0]["v"])
    if width % PARTS:
        raise ValueError(f"vectors of {width} components can't be cut into {PARTS} equal parts")
    whole = _whole(pa.array([x["v"] for x in first], pa.list_(pa.float64())), scale)
    return np.ascontiguousarray(whole.reshape(len(whole), PARTS, width // PARTS).transpose(1, 0, 2))


def assign(whole: np.ndarray, trees: list[Gnat]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every vector's parts, and their exact squared distances (vector x part)."""
    width = whole.shape[1] // PARTS
    found = [trees[p].nearest(whole[:, p * width : (p + 1) * width]) for p in range(PARTS)]
    return np.stack([x[0] for x in found], axis=1), np.stack([x[1] for x in found], axis=1)


def _blocks(batch: pa.RecordBatch, books: np.ndarray, scale: float, most: int = 4096) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for k in range(0, batch.num_rows, most):
        part = batch.slice(k, most)
        whole = _whole(part.column("v"), scale)
        if whole.shape[1] != PARTS * books.shape[2]:
            raise ValueError("vectors of different lengths have no common codebooks")
        yield part, whole


def refine(rows: DataFrame, books: np.ndarray, scale: float) -> np.ndarray:
    """One round: every entry becomes the componentwise floor of the mean of its parts."""
    parts, entries, width = books.shape

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(x) for x in books]
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, whole in _blocks(batch, books, scale):
                index, _ = assign(whole, trees)
                for p in range(parts):
                    counts[p] += np.bincount(index[:, p], minlength=entries)
                    np.add.at(sums[p], index[:, p], whole[:, p * width : (p + 1) * width])
        used = np.flatnonzero(counts.ravel())
        if len(used):
            flat = sums.reshape(parts * entries, width)[used]
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts.ravel()[used]), pa.array(flat.tolist(), pa.list_(pa.int64()))], ["entry", "n", "sums"])

    partial = rows.select("v").mapInArrow(add_up, "entry long, n long, sums array<long>")
    # Component -1 carries the number of parts, and stands for the entry also where parts are empty.
    cells = partial.select("entry", F.posexplode(F.concat(F.array("n"), "sums")).alias("at", "value"))
    total = cells.groupBy("entry", "at").agg(F.sum("value").alias("value")).groupBy("entry").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("cells"))
    books = books.copy()
    for row in total.collect():  # PARTS * ENTRIES rows at most
        cells = row["cells"]
        books[row["entry"] // entries, row["entry"] % entries] = [cells[k + 1] // cells[0] for k in range(width)]
    return books


def fit_codebooks(rows: DataFrame, rounds: int = ROUNDS, scale: float = 256.0) -> np.ndarray | None:
    books = first_codebooks(rows, scale)
    for _ in range(rounds if books is not None else 0):
        books = refine(rows, books, scale)
    return books


def encode(rows: DataFrame, books: np.ndarray, scale: float = 256.0) -> DataFrame:
    """`vec_id`, `label`, `code` (an entry number per part, a byte each) and `error`."""
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(x) for x in books]
        for batch in batches:
            for part, whole in _blocks(batch, books, scale):
                index, away = assign(whole, trees)
                code = pa.array([x.tobytes() for x in index.astype(np.uint8)], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("label"), code, pa.array(away.sum(axis=1))], ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id long, label {kind}, code binary, error long")


def decode(code: bytes, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books[p, k] for p, k in enumerate(code)]) if books.size else np.zeros(0, np.int64)


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds `label_error`, the sum of the errors of equal labels; the sums are combined before they
    shuffle, and the join back can be split, so a label of very many rows is no one task's work."""
    totals = codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    return codes.join(totals, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def compress(embeddings: DataFrame, rounds: int = ROUNDS, scale: float = 256.0) -> DataFrame:
    """`vec_id`, `label`, `code`, `error`, `label_error`, `codebooks_sha256`."""
    rows = usable(embeddings)
    books = fit_codebooks(rows, rounds, scale)
    if books is None:
        kind = rows.schema["label"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code binary, error long, label_error long, codebooks_sha256 string")
    codes = keep_in(encode(rows, books, scale), "codes")
    return with_label_error(codes).withColumn("codebooks_sha256", F.lit(codebooks_digest(books)))
