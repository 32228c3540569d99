"""Exact top-k by inner product over a pivot-distance index.

Vectors get one more component, so that all have the length of the longest; inner products then fall
as distances grow, and the triangle inequality bounds them. Pivots are fitted on a bounded sample
(`SAMPLE` vectors); every vector is keyed by its nearest pivot and its distance from it, sorted by that
key and packed into blocks, each an annulus around a pivot. A query's k-th best score so far, at first
from the sample, gives the widest distance that still matters; only annuli within that distance of
the query's own distance from the pivot are visited: round one those of the query's own pivot, round
two, with the better bound, those of the others. Within a block sorted sub-annuli are expanded outwards
until the bound stops them.

Equal vectors are one row of the index with their k + 1 smallest ids: no more can be wanted.

Vectors that are null, empty, hold null or non-finite components, or have another length than most
(ties: the longer) take no part; neither do null ids. Rows that repeat id and vector count once, and a row
with the query's id is never its answer. Ties go to the smaller id. Empty tables and queries without
candidates give no rows. Columns other than `vec_id` and `embedding` are not read. Components must
keep scores within 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.llm.common import keep_in

SAMPLE, PIVOTS = 4096, 48
#: Vectors in a block, and in a sub-annulus of it; queries in a block.
BLOCK, RING, ASKED = 2048, 256, 256


def integer_vectors(embeddings: DataFrame, scale: float = 256.0) -> DataFrame:
    """`vec_id` and `vec`: floor(scale * x) of the vectors that take part, as packed longs."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & fine)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    most = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    width = most["n"] if most else 0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            whole = np.floor(scale * flat).astype("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([x.tobytes() for x in whole], pa.binary())], ["vec_id", "vec"])

    return rows.filter(F.size("v") == width).mapInArrow(pack, "vec_id long, vec binary")


def unpack(packed: list[bytes] | pa.Array) -> np.ndarray:
    rows = packed if isinstance(packed, list) else packed.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<i8").reshape(len(rows), -1)


def distinct_vectors(vectors: DataFrame, keep: int) -> DataFrame:
    """`vec` and `ids`, its `keep` smallest ids. Combined per batch first, so a vector that very
    many rows share reaches the shuffle a few times."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, list[int]] = {}
            for vec, key in sorted(zip(batch.column("vec").to_pylist(), batch.column("vec_id").to_pylist()), key=lambda x: x[1]):
                ids = seen.setdefault(vec, [])
                if len(ids) < keep and (not ids or ids[-1] != key):
                    ids.append(key)
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.list_(pa.int64()))], ["vec", "ids"])

    rows = vectors.mapInArrow(combine, "vec binary, ids array<long>")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return rows.groupBy("vec").agg(ids.alias("ids"))


@dataclass
class Space:
    """The pivots in the lengthened space, the square of the longest length, and the sample."""

    pivots: np.ndarray
    top: float
    sample: np.ndarray
    sample_ids: np.ndarray

    def lengthen(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors.astype(float)
        return np.column_stack([v, np.sqrt(np.maximum(0, self.top - (v * v).sum(axis=1)))])

    def away(self, lengthened: np.ndarray) -> np.ndarray:
        """Distances from every pivot."""
        p, v = self.pivots, lengthened
        return np.sqrt(np.maximum(0, (v * v).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * v @ p.T))

    def reach(self, norms: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The distance beyond which scores are below `least`, rounded up for safety."""
        return np.sqrt(np.maximum(0, norms + self.top - 2 * least)) * (1 + 1e-9) + 1e-3


def dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products, by floats where those are exact."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    return (a.astype(float) @ b.T.astype(float)).astype(np.int64) if bound < 2.0**52 else a @ b.T


def fit_space(distinct: DataFrame) -> Space | None:
    """Pivots by a few rounds of k-means over the sample."""

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = unpack(batch.column("vec")).astype(float)
            yield pa.RecordBatch.from_arrays([pa.array([float((v * v).sum(axis=1).max(initial=0))])], ["top"])

    top = distinct.select("vec").mapInArrow(norms, "top double").agg(F.max("top")).first()[0]
    rows = distinct.orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).collect()  # SAMPLE rows at most
    if not rows:
        return None
    sample = unpack([bytes(x["vec"]) for x in rows])
    space = Space(np.zeros((0, 0)), float(top), sample, np.array([(x["ids"] + [-1])[:1] for x in rows])[:, 0])
    long = space.lengthen(sample)
    space.pivots = long[:PIVOTS].copy()
    for _ in range(8):
        near = space.away(long).argmin(axis=1)
        for k in range(len(space.pivots)):
            if (near == k).any():
                space.pivots[k] = long[near == k].mean(axis=0)
    return space


def build_index(distinct: DataFrame, space: Space) -> DataFrame:
    """Blocks of the index: `block`, `pivot`, `low`, `high` and packed `radii`, `vecs`, `ids`."""
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = space.away(space.lengthen(unpack(batch.column("vec")))) if len(batch) else np.zeros((0, 1))
            near = away.argmin(axis=1)
            columns = [pa.array(near.astype(np.int32)), pa.array(away[np.arange(len(near)), near]), batch.column("vec"), batch.column("ids")]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "radius", "vec", "ids"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[tuple] = []

        def block(rows: list[tuple]) -> pa.RecordBatch:
            radii = np.array([x[1] for x in rows])
            ids = [x[3] for x in rows]
            row = {
                "pivot": rows[0][0], "low": radii[0], "high": radii[-1], "radii": radii.tobytes(),
                "vecs": b"".join(x[2] for x in rows), "ids": ids,
            }
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        for batch in batches:
            for row in zip(*(batch.column(x).to_pylist() for x in ("pivot", "radius", "vec", "ids"))):
                if rest and (rest[0][0] != row[0] or len(rest) == BLOCK):
                    yield block(rest)
                    rest = []
                rest.append(row)
        if rest:
            yield block(rest)

    keyed = keep_in(distinct.mapInArrow(key, "pivot int, radius double, vec binary, ids array<long>"), "keyed")
    dealt = keyed.repartitionByRange("pivot", "radius", F.xxhash64("vec")).sortWithinPartitions("pivot", "radius")
    blocks = dealt.mapInArrow(pack, "pivot int, low double, high double, radii binary, vecs binary, ids array<array<long>>")
    return keep_in(blocks.withColumn("block", F.monotonically_increasing_id()), "index")


_BLOCK = pa.schema(
    [("pivot", pa.int32()), ("low", pa.float64()), ("high", pa.float64()), ("radii", pa.binary()), ("vecs", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64())))]
)


def _visit(queries: DataFrame, index: DataFrame, space: Space, k: int, own: bool) -> DataFrame:
    """`query_id`, `vec_id`, `score`: the k best of every visited block. `queries` has `query_id`,
    `vec`, `least` (the k-th score so far or null), `home`; `own` visits the home pivot, else the others."""
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per block of queries and pivot to visit, with the distances that matter."""
        for whole in batches:
            for begin in range(0, len(whole), ASKED):
                batch = whole.slice(begin, ASKED)
                vecs = unpack(batch.column("vec"))
                norms = (vecs.astype(float) ** 2).sum(axis=1)
                # A query may be longer than the longest vector in no case: it is one of them.
                away = space.away(space.lengthen(vecs) * np.append(np.ones(vecs.shape[1]), 0))
                least = batch.column("least").to_pandas().fillna(-np.inf).to_numpy(dtype=float)
                reach = space.reach(norms, least)
                home = batch.column("home").to_numpy(zero_copy_only=False)
                ids = batch.column("query_id").to_numpy(zero_copy_only=False).astype("<i8")
                rows = []
                for p in range(len(space.pivots)):
                    at = np.flatnonzero((home == p) == own)
                    if len(at):
                        low, high = float((away[at, p] - reach[at]).min()), float((away[at, p] + reach[at]).max())
                        rows.append(
                            {
                                "pivot": p, "from": low, "to": high, "queries": ids[at].tobytes(), "asked": vecs[at].astype("<i8").tobytes(),
                                "away": away[at, p].tobytes(), "least": least[at].tobytes(),
                            }
                        )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ASK)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(len(batch)):
                row = batch.slice(n, 1).to_pylist()[0]
                found = _search_block(row, space, k)
                yield pa.RecordBatch.from_arrays([pa.array(found[:, j]) for j in range(3)], ["query_id", "vec_id", "score"])

    order = queries.repartitionByRange("home", "radius").sortWithinPartitions("home", "radius") if own else queries
    asked = keep_in(order.mapInArrow(group, "pivot int, `from` double, `to` double, queries binary, asked binary, away binary, least binary"), "asked")
    asked = asked.withColumn("ask", F.monotonically_increasing_id())
    rings = index.select("block", "pivot", "low", "high")
    pairs = asked.select("ask", "pivot", "from", "to").join(rings, "pivot").filter("low <= `to` and high >= `from`").select("ask", "block")
    both = keep_in(pairs, "pairs").join(asked.drop("pivot", "from", "to"), "ask").join(index.drop("pivot", "low", "high"), "block")
    return both.select("queries", "asked", "away", "least", "radii", "vecs", "ids").mapInArrow(search, "query_id long, vec_id long, score long")


_ASK = pa.schema(
    [("pivot", pa.int32()), ("from", pa.float64()), ("to", pa.float64()), ("queries", pa.binary()), ("asked", pa.binary()), ("away", pa.binary()), ("least", pa.binary())]
)


def _search_block(row: dict, space: Space, k: int) -> np.ndarray:
    queries = np.frombuffer(row["queries"], dtype="<i8")
    radii, ids = np.frombuffer(row["radii"]), row["ids"]
    vecs = np.frombuffer(row["vecs"], dtype="<i8").reshape(len(radii), -1)
    asked = np.frombuffer(row["asked"], dtype="<i8").reshape(len(queries), -1)
    away, least = np.frombuffer(row["away"]), np.frombuffer(row["least"]).copy()
    norms = (asked.astype(float) ** 2).sum(axis=1)
    best: list[list[tuple[int, int]]] = [[] for _ in queries]
    rings = [(a, min(a + RING, len(radii))) for a in range(0, len(radii), RING)]
    middle = float(np.median(away))
    # Outwards from where the queries lie.
    rings.sort(key=lambda r: max(radii[r[0]] - middle, middle - radii[r[1] - 1], 0))
    for a, b in rings:
        reach = space.reach(norms, least)
        at = np.flatnonzero((away - reach <= radii[b - 1]) & (away + reach >= radii[a]))
        if not len(at):
            continue
        scores = dot(asked[at], vecs[a:b])
        for n, line in zip(at.tolist(), scores):
            hits = np.flatnonzero(line >= least[n])
            if len(hits) > 4 * k:  # only the k + 1 highest distinct places, and ties with them, can matter
                floor = np.partition(line[hits], len(hits) - k - 1)[len(hits) - k - 1]
                hits = hits[line[hits] >= floor]
            if len(hits):
                own = int(queries[n])
                new = [(-int(line[h]), x) for h in hits.tolist() for x in ids[a + h] if x != own]
                best[n] = sorted(best[n] + new)[:k]
                if len(best[n]) == k:
                    least[n] = max(least[n], -best[n][-1][0])
    out = [(int(queries[n]), x, -s) for n, found in enumerate(best) for s, x in found]
    return np.array(out, dtype=np.int64).reshape(-1, 3)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """`query_id`, `rank` from 1, `vec_id`, `score`. Both inputs have `vec_id` and `vec` as
    `integer_vectors` gives them; queries are rows of `vectors`."""
    spark = vectors.sparkSession
    distinct = keep_in(distinct_vectors(vectors, k + 1), "distinct")
    space = fit_space(distinct)
    if space is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = build_index(distinct, space)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The home pivot and, from the sample, a first bound: the k-th score without the best one,
        which may be the query's own."""
        for batch in batches:
            if not len(batch):
                continue
            vecs = unpack(batch.column("vec"))
            away = space.away(space.lengthen(vecs))
            home = away.argmin(axis=1)
            scores = np.sort(dot(vecs, space.sample), axis=1)
            least = scores[:, -k - 1] if scores.shape[1] > k else [None] * len(vecs)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("vec"), pa.array(home.astype(np.int32)),
                    pa.array(away[np.arange(len(home)), home]), pa.array(least, pa.int64()),
                ],
                ["query_id", "vec", "home", "radius", "least"],
            )

    asked = keep_in(queries.distinct().mapInArrow(start, "query_id long, vec binary, home int, radius double, least long"), "queries")
    near = keep_in(_top(_visit(asked, index, space, k, True), k), "near")
    bound = near.filter(F.col("rank") == k).select("query_id", F.col("score").alias("found"))
    again = asked.join(bound, "query_id", "left").withColumn("least", F.greatest("least", "found")).drop("found")
    far = _visit(again, index, space, k, False)
    every = near.select("query_id", "vec_id", "score").unionByName(far)
    return _top(every, k).select("query_id", "rank", "vec_id", "score")
