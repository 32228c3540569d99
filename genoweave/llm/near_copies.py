"""Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words are cut and lower-cased as in `simhash`; a text of fewer than five words is one shingle.
Candidates come from two searches. One is op7's: SimHash fingerprints, here of five-word shingles, whose links at `RADIUS` bits
or fewer are found by `simhash.links` through vantage-point trees. Those reach some 3 % of the pairs at a similarity of 0.8, so the
other search is MinHash: `BANDS` bands of `ROWS` least hashes each, so a pair of similarity 0.8
shares a band but for 5 in 100,000, a pair of 0.9 but for 1 in a thousand million. Candidates are then compared by
their whole shingle sets (64-bit hashes), so nothing below the similarity is linked, whichever search found it.

In a bucket of up to `FEW` sets all pairs are compared. In a larger one all sets are compared with one first, the one
with the least share of shingles that no other set of large buckets has. Sets that this leaves outside the bucket's largest
component could still be near to others; but shingles that are a set's own count towards no intersection and towards
every union, so two sets of c and d shared and u and v own shingles have a similarity of at most min(c, d) / (u + v + max(c, d)).
Sets are binned by their share of own shingles and meet only those that this bound allows, and of these only those whose
parity bitmaps differ in few bits: a bit that differs stands for a shingle, at least, that one of two sets has alone. So every pair
of a bucket is compared, already connected, or proven to be below the similarity, and copies of one text cost
one comparison each.

Equal sets are one point throughout. Null and blank texts have the empty set and are one group. Rows
with a null `doc_id` are grouped like any other. Repeated rows stay once. Very long texts are read whole, one at a
time. An empty table gives no rows. Columns of any names are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm import simhash
from genoweave.llm.batches import mix, windows, word_hashes, words
from genoweave.llm.common import Scratch, keep_in, slices
from genoweave.llm.components import components

WIDTH = 5
BANDS, ROWS = 25, 5
FEW = 16
#: Bits in which fingerprints of candidates may differ.
RADIUS = 4

_XOR = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))
_TIMES = mix(_XOR) | np.uint64(1)
_BAND = mix(np.arange(1001, 1001 + BANDS, dtype=np.uint64))


def shingles(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    parts = [x.encode().lower() for x in texts]
    data = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
    ends_of = np.cumsum([len(x) + 1 for x in parts])
    begins, ends = words(data)
    hashes = word_hashes(data, begins, ends)
    runs = windows(hashes, WIDTH)
    cuts = [0, *np.searchsorted(begins, ends_of).tolist()]
    out = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a >= WIDTH:
            out.append(np.unique(runs[a : b - WIDTH + 1]))
        else:
            out.append(windows(hashes[a:b], b - a)[: b > a])
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """A key per band of the least hashes of a set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), 1024):
        np.minimum(least, ((found[k : k + 1024, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    key = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T:
        key = mix(key ^ column)
    return key.view(np.int64)


def _rows(docs: DataFrame) -> DataFrame:
    """`doc_id`, a hash of the whole row, and the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(*docs.columns).alias("row"), F.coalesce("text", F.lit("")).alias("text")
    )


def mark(docs: DataFrame) -> DataFrame:
    """`doc_id`, `row` (its hash), `point` (of its shingle set), `n`, `keys` and `fp` (its fingerprint) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                texts = part.column("text").to_pylist()
                sets = shingles(texts)
                prints = np.array([simhash.fingerprint(x, WIDTH) for x in texts], np.uint64)
                points = [int(mix(np.bitwise_xor.reduce(mix(x)) + np.uint64(len(x)))) if len(x) else 0 for x in sets]
                keys = [bands(x) if len(x) else np.zeros(0, np.int64) for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("row"),
                        pa.array(np.array(points, np.uint64).view(np.int64)),
                        pa.array([len(x) for x in sets], pa.int32()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(prints.view(np.int64)),
                    ],
                    ["doc_id", "row", "point", "n", "keys", "fp"],
                )

    return _rows(docs).mapInArrow(run, "doc_id long, row long, point long, n int, keys array<long>, fp long")


def _sets(texts: DataFrame) -> DataFrame:
    """`point` and its shingle hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                sets = [x.view(np.int64) for x in shingles(part.column("text").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("point"), pa.array(sets, pa.list_(pa.int64()))], ["point", "found"])

    return texts.select("point", "text").mapInArrow(run, "point long, found array<long>")


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The edges `u`, `v` among pairs (`u`, `nu`, `v`, `nv`)."""
    pairs = pairs.filter("u != v and 5 * least(nu, nv) >= 4 * greatest(nu, nv)")
    pairs = pairs.select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), (F.col("nu") + F.col("nv")).alias("both")
    ).distinct()
    pairs = pairs.join(sets.toDF("u", "su"), "u").join(sets.toDF("v", "sv"), "v")
    return pairs.filter(9 * F.size(F.array_intersect("su", "sv")) >= 4 * F.col("both")).select("u", "v")


def fingerprint_pairs(marked: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs `u`, `v` of points that op7's search ties: spanning links of fingerprints, and points of one fingerprint."""
    prints = scratch.keep(marked.filter("n > 0").select("fp", "point").distinct(), "prints")
    least = scratch.keep(prints.groupBy("fp").agg(F.min("point").alias("rep")), "print-points")
    equal = prints.join(least, "fp").select(F.col("point").alias("u"), F.col("rep").alias("v"))
    pairs = simhash.links(least, RADIUS).select("u", "v").unionByName(equal)
    return scratch.keep(pairs.filter("u != v").distinct(), "print-pairs")


def groups(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """`node` and `component` of the points of `marked` that have a near copy."""
    scratch = Scratch(docs.sparkSession)
    points = marked.filter("n > 0").groupBy("point").agg(F.min("n").alias("n"), F.min("row").alias("row"), F.min("keys").alias("keys"))
    points = scratch.keep(points, "points")
    keyed = points.select("point", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    keyed = scratch.keep(keyed.join(shared, "key").join(points.select("point", "n", "row"), "point"), "buckets")
    tied = fingerprint_pairs(marked, scratch)
    near = tied.select(F.explode(F.array("u", "v")).alias("point")).distinct().join(points, "point")
    wanted = keyed.select("point", "row").unionByName(near.select("point", "row")).distinct()
    texts = _rows(docs).select("row", "text").join(wanted, "row").dropDuplicates(["point"])
    sets = scratch.keep(_sets(texts), "shingles")

    known = points.select("point", "n")
    tied = tied.join(known.toDF("u", "nu"), "u").join(known.toDF("v", "nv"), "v").select("u", "nu", "v", "nv")
    few = keyed.filter(F.col("size") <= FEW).select("key", "point", "n")
    pairs = few.toDF("key", "u", "nu").join(few.toDF("key", "v", "nv"), "key").filter("u < v")
    large = keyed.filter(F.col("size") > FEW)
    own = own_shingles(sets.join(large.select("point").distinct(), "point", "left_semi"))
    large = large.select("key", "point", "n").join(own, "point", "left").withColumn("own", F.coalesce("own", F.lit(0)))
    large = scratch.keep(large, "large-buckets")
    least = F.min(F.struct((F.col("own") / F.col("n")).alias("share"), F.xxhash64("point").alias("any"), "point", "n"))
    leads = large.groupBy("key").agg(least.alias("lead")).select("key", F.col("lead.point").alias("v"), F.col("lead.n").alias("nv"))
    members = large.select("key", F.col("point").alias("u"), F.col("n").alias("nu"))
    pairs = pairs.unionByName(members.join(leads, "key")).drop("key").unionByName(tied)
    edges = scratch.keep(_similar(pairs, sets), "similar")
    tied = scratch.keep(components(edges), "tied")
    more = _similar(possible_pairs(large, tied, sets, scratch), sets)
    tied = keep_in(components(edges.unionByName(more)), "tied")
    scratch.drop()
    return tied


def own_shingles(sets: DataFrame) -> DataFrame:
    """`point` and `own`, the number of its shingles that no other of `sets` has."""
    counts = sets.select("point", F.explode("found").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"), F.min("point").alias("point"))
    return counts.filter("n = 1").groupBy("point").agg(F.count("*").cast("int").alias("own"))


#: Longs of a parity bitmap.
PARITY = 16


def parities(sets: DataFrame) -> DataFrame:
    """`point` and `bits`: for each of 64 * PARITY classes of shingles, whether the set has an odd number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for found in batch.column("found"):
                hashes = found.values.to_numpy(zero_copy_only=False).view(np.uint64)
                odd = np.bincount((hashes % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("point"), pa.array(bits, pa.list_(pa.int64()))], ["point", "bits"])

    return sets.mapInArrow(run, "point long, bits array<long>")


#: Bins of the share of own shingles, from none to the most that a near copy can have.
BINS = 16


def possible_pairs(large: DataFrame, tied: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs (`u`, `nu`, `v`, `nv`) of large buckets that are not connected yet and may be near.

    With `shared` = n - own shingles, near means own(u) + own(v) <= shared / 4 for the smaller `shared`, and the shared ones differ
    by a factor of 5 / 4 at most. So own(v) / shared(v) is at most 1 / 4 - own(u) / shared(u), which is a range of bins. And of
    n(u) + n(v) shingles a ninth at most may be in one of the two sets alone.
    """
    labels = tied.withColumnRenamed("node", "point")
    rows = large.withColumn("shared", F.col("n") - F.col("own")).filter("4 * own <= shared and shared > 0")
    rows = scratch.keep(rows.join(labels, "point", "left").withColumn("component", F.coalesce("component", "point")), "labelled")
    sizes = scratch.keep(rows.groupBy("key", "component").agg(F.count("*").alias("size")), "sizes")
    main = sizes.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
    rows = scratch.keep(rows.join(main.filter("parts > 1").drop("parts"), "key"), "open-buckets")
    wanted = scratch.keep(sets.join(rows.select("point").distinct(), "point", "left_semi"), "open-sets")
    rows = rows.join(scratch.keep(parities(wanted), "parities"), "point")
    share = 4 * F.col("own") / F.col("shared")
    upto = F.least(F.lit(BINS), F.floor(BINS * (1 - share) + 1e-6)).cast("int")
    apart = rows.filter("component != main").select(
        "key", F.col("point").alias("u"), F.col("n").alias("nu"), F.col("own").alias("ou"), F.col("shared").alias("su"), F.col("component").alias("cu"), F.col("bits").alias("bu"),
        F.explode(F.sequence(F.lit(0), upto)).alias("bin"),
    )
    others = rows.select(
        "key", F.col("point").alias("v"), F.col("n").alias("nv"), F.col("own").alias("ov"), F.col("shared").alias("sv"), F.col("component").alias("cv"), F.col("bits").alias("bv"),
        F.floor(BINS * share).cast("int").alias("bin"),
    )
    near = "cu != cv and 5 * least(su, sv) >= 4 * (ou + ov + greatest(su, sv))"
    near += " and 9 * aggregate(zip_with(bu, bv, (x, y) -> bit_count(x ^ y)), 0, (x, y) -> x + y) <= nu + nv"
    return apart.join(others, ["key", "bin"]).filter(near).select("u", "nu", "v", "nv").distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies, with all its columns: that of the smallest `doc_id`, nulls last,
    and of several such rows the one of the smallest hash. A row that is repeated stays once."""
    marked = keep_in(mark(docs), "marked")
    tied = groups(docs, marked).withColumnRenamed("node", "point")
    known = marked.select("doc_id", "row", "point").join(tied, "point", "left")
    known = known.groupBy(F.coalesce("component", "point").alias("component"), "doc_id", "row").agg(F.count("*").alias("copies"))
    first = known.groupBy("component").agg(F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "row", "copies")).alias("first"))
    first = keep_in(first.select(F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row"), F.col("first.copies").alias("copies")), "first")

    # The row goes through as one value, so its columns may have any names.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_whole")
    every = docs.select(whole, F.xxhash64(*docs.columns).alias("_row"), F.col("doc_id").cast("long").alias("_id"))

    def matching(some: DataFrame) -> DataFrame:
        same = (F.col("_row") == F.col("first_row")) & F.col("_id").eqNullSafe(F.col("first_id"))
        return every.join(some, same, "left_semi")

    single = matching(first.filter("copies = 1"))
    repeated = matching(first.filter("copies > 1")).dropDuplicates(["_id", "_row"])
    return single.unionByName(repeated).select("_whole.*")
