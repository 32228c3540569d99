"""Repeated passages and near duplicates against brute force."""

import hashlib
import re
import tempfile
import tracemalloc
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from genoweave.llm import block_anchors, induced_sort, simhash, suffix_shards
from genoweave.llm.batches import planes, squeeze
from genoweave.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = 1 << 62


def key(doc_id):
    return LAST if doc_id is None else doc_id


def repeated(sequences, length):
    """For each (id, sequence): which items a window covers that starts in a smaller id too."""
    first = {}
    for i, s in sequences:
        for k in range(len(s) - length + 1):
            w = s[k : k + length]
            first[w] = min(first.get(w, LAST), key(i))
    out = []
    for i, s in sequences:
        covered = bytearray(len(s))
        for k in range(len(s) - length + 1):
            if first[s[k : k + length]] < key(i):
                covered[k : k + length] = b"\1" * length
        out.append(covered)
    return out


@pytest.fixture(scope="module")
def cut_words(docs):
    return block_anchors.remove_repeats(docs).cache()


def test_words(rows, cut_words):
    sequences = [(r[0], tuple(WORD.findall(r[1] or ""))) for r in rows]
    expected = Counter()
    for (i, words), covered in zip(sequences, repeated(sequences, 13)):
        expected[i, len(words), sum(covered), " ".join(w for w, c in zip(words, covered) if not c)] += 1
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in cut_words.collect())
    assert got == expected
    assert any(n for _, _, n, _ in got)


def test_other_columns_stay(docs, cut_words):
    assert cut_words.columns == [x for x in docs.columns if x not in ("text", "kept", "n_words")] + ["n_words", "n_removed", "spans", "kept"]
    same = ["doc_id", "lang", "source", "n_chars", "batch", "fp"]
    assert Counter(map(tuple, cut_words.select(same).collect())) == Counter(map(tuple, docs.select(same).collect()))


def test_spans(cut_words):
    for r in cut_words.collect():
        assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]
        assert all(a["end"] < b["begin"] for a, b in zip(r["spans"], r["spans"][1:]))


def test_layout(docs, rows):
    got = Counter((r["doc_id"], r["n_removed"] > 0, r["kept"]) for r in block_anchors.remove_repeats(docs, layout=True).collect())
    texts = Counter((r[0], r[1] or "") for r in rows)
    for (i, removed, kept), n in got.items():
        assert removed or texts[i, kept] == n


def test_no_words(no_docs):
    assert block_anchors.remove_repeats(no_docs).count() == 0


def test_bytes(docs, rows):
    sequences = [(r[0], (r[1] or "").encode()) for r in rows]
    expected = Counter()
    for (i, data), covered in zip(sequences, repeated(sequences, 50)):
        kept = bytes(b for b, c in zip(data, covered) if not c)
        expected[i, len(data), sum(covered), len(re.findall(b"\1+", bytes(covered))), kept] += 1
    got = suffix_shards.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got) == expected


def test_no_bytes(no_docs):
    assert suffix_shards.remove_repeats(no_docs).count() == 0


def batch_row(docs):
    ids, texts = [i for i, _ in docs], [x for _, x in docs]
    sizes = np.array([len(x) for x in texts], "<i8")
    return {"doc_ids": np.array(ids, "<i8").tobytes(), "sizes": sizes.tobytes(), "text": squeeze(b"".join(x + b"\n" for x in texts))}


def answered(requests, judge):
    """What `ask` returns, by batch."""
    by_shard, answers = {}, {}
    for request in requests:
        for x in request.to_pylist():
            by_shard.setdefault(x["shard"], []).append(x)
    for shard, some in by_shard.items():
        for x, bits in zip(some, judge([x["payload"] for x in some]), strict=True):
            answers.setdefault(x["batch"], []).append({"shard": shard, "bits": squeeze(np.packbits(bits).tobytes())})
    return answers


@pytest.mark.parametrize("limits", [(7, 300, 100), (50, 1000, 60), (1 << 18, 1 << 22, 200)])
def test_bytes_by_slices(limits, monkeypatch):
    """Slices, blocks and sorts that are smaller than a document change nothing."""
    for name, value in zip(("SLICE", "BLOCK", "MOST"), limits):
        monkeypatch.setattr(suffix_shards, name, value)
    rng = np.random.default_rng(5)
    shared = bytes(rng.integers(97, 100, 400).astype(np.uint8))
    docs = [(0, b""), (9, b"a" * 300), (3, b"a" * 200), (8, shared), (8, shared)]
    for k in range(40):
        a, b = sorted(rng.integers(0, 400, 2).tolist())
        docs.append((k, bytes(rng.integers(97, 99, 70).astype(np.uint8)) + shared[a:b] + b"xy" * int(rng.integers(0, 60))))
    parts = [docs[:12], docs[12:30], docs[30:]]
    for length in (16, 31, 50):
        held = [suffix_shards.Anchored(batch_row(x), length, 2) for x in parts]
        hits = answered([x.anchors(k) for k, x in enumerate(held)], suffix_shards.judge_anchors)
        for k, x in enumerate(held):
            x.segment(hits.get(k))
        found = answered([x.segments(k) for k, x in enumerate(held)], lambda x: suffix_shards.judge_segments(x, length))
        expected = [bytes(x) for x in repeated(docs, length)]
        got = []
        for k, x in enumerate(held):
            covered = x.repeated(found.get(k))
            got += [bytes(covered[a:b].astype(np.uint8)) for a, b in zip(x.batch.begins, x.batch.ends)]
        assert got == expected and any(map(any, got))


def test_one_anchor_of_a_shard_in_bounded_memory():
    """All segments of the shard have one anchor and differ, so they were one sort of 200 MB."""
    length, n = 50, 30_000
    rng = np.random.default_rng(11)
    grams = rng.integers(97, 123, (1 << 20, 16)).astype(np.uint8)
    flat = suffix_shards.gram_hashes(grams.ravel())[::16]
    gram = grams[int(np.argmin(flat))]
    around = rng.integers(97, 123, (n, 84)).astype(np.uint8)
    around[:, 34:50] = gram
    around[n // 2 :, :83] = around[: n - n // 2, :83]  # all but the last byte of another one
    ids = rng.permutation(n)
    payloads, requests = [], np.array_split(np.arange(n), 30)
    for some in requests:
        numbers = squeeze(planes(np.full(len(some), 35, "<i8"))), squeeze(planes(ids[some].astype("<i8")))
        payloads.append(b"".join([len(x).to_bytes(4, "little") for x in numbers]) + b"".join(numbers) + squeeze(around[some].tobytes()))
    tracemalloc.start()
    got = suffix_shards.judge_segments(payloads, length)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    least = {}
    for i, x in zip(ids.tolist(), map(bytes, around)):
        for k in range(35):
            least[x[k : k + length]] = min(least.get(x[k : k + length], LAST), i)
    expected = [[least[x[k : k + length]] < i for k in range(35)] for i, x in zip(ids.tolist(), map(bytes, around))]
    assert [x.tolist() for x in got] == [sum((expected[k] for k in some), []) for some in requests]
    assert peak < 120 << 20


def test_one_text_many_times_is_one_content(monkeypatch):
    monkeypatch.setattr(suffix_shards, "BLOCK", 200)
    text = b"Is onhe. " * 10 + b"By onhe. " * 10
    many = np.zeros(100, np.int64)
    same = suffix_shards.Segments(text, many, many + 30, many, 50)
    assert same.distinct().tolist() == [0] * 100
    assert suffix_shards.Segments(text, np.arange(100), many + 30, many, 50).distinct() is None


def test_arrays_of_a_batch_of_bytes():
    rng = np.random.default_rng(12)
    texts = rng.integers(97, 123, (1500, 4000)).astype(np.uint8)
    texts[750:, :2000], texts[750:, 2000] = texts[:750, :2000], 65
    row = batch_row([(k, x.tobytes()) for k, x in enumerate(texts)])
    anchored = suffix_shards.Anchored(row, 50, 64)
    every = [{"shard": k, "bits": squeeze(np.packbits(np.ones(n, bool)).tobytes())} for k, n in enumerate(anchored.counts.tolist())]
    anchored.segment(every)
    found = answered([anchored.segments(0)], lambda x: suffix_shards.judge_segments(x, 50))
    del anchored
    tracemalloc.start()
    anchored = suffix_shards.Anchored(row, 50, 64)
    anchored.segment(every)
    covered = anchored.repeated(found[0])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    expected = np.zeros((1500, 4001), bool)
    expected[750:, :2000] = True
    assert (covered == expected.ravel()).all()
    assert peak < 16 * texts.size


@pytest.mark.parametrize("held", [4, 1 << 19])
def test_suffix_order(held, monkeypatch):
    monkeypatch.setattr(induced_sort, "HELD", held)
    rng = np.random.default_rng(3)
    for trial in range(80):
        text = rng.integers(1, rng.integers(2, 5), rng.integers(1, 90))
        text = np.append(np.tile(text[:3], 20) if trial % 9 == 0 else text, 0).astype(np.uint16)
        with tempfile.TemporaryDirectory() as folder:
            order, common = induced_sort.InducedSorter(text, folder, 200).order()
        suffixes = [tuple(text[k:]) for k in range(len(text))]
        assert order.tolist() == sorted(range(len(text)), key=suffixes.__getitem__)
        for k in range(1, len(order)):
            a, b = suffixes[order[k - 1]], suffixes[order[k]]
            assert common[k] == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(points, radius=4):
    """Smallest id reachable, for each (id, fingerprint)."""
    up = list(range(len(points)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(points)):
        for b in range(a):
            if (points[a][1] ^ points[b][1]).bit_count() <= radius:
                up[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(points):
        least[root(k)] = min(least.get(root(k), LAST), key(i))
    return [least[root(k)] for k in range(len(points))]


def test_near_duplicates(docs, rows):
    points = [(r[0], plain_fingerprint(r[1])) for r in rows]
    known = [p for p in points if p[0] is not None]
    component = dict(zip(known, linked(known)))
    by_print = {f: c for (_, f), c in component.items()}
    expected = Counter((i, f, by_print.get(f)) for i, f in points)
    got = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got) == expected


def test_no_fingerprints(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("rows_of_shard", [20_000, 60])
def test_links_of_planted_clusters(spark, monkeypatch, rows_of_shard):
    """Chains and dense clusters, with shards split by annuli too."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", rows_of_shard)
    rng = np.random.default_rng(5)
    points = []
    for _ in range(12):
        point = int(rng.integers(0, 1 << 63))
        for _ in range(40):
            points.append(point)
            for _ in range(int(rng.integers(1, 6))):
                point ^= 1 << int(rng.integers(0, 64))
    points = sorted(set(points))
    rows = [(k, np.uint64(p).view(np.int64).item()) for k, p in enumerate(points)]
    frame = spark.createDataFrame([(p, k) for k, p in rows], "fp long, rep long")
    found = {r["node"]: r["component"] for r in components(simhash.links(frame)).collect()}
    assert [found.get(k, k) for k in range(len(points))] == linked(list(enumerate(points)))


def test_trees_find_all_links():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    points = np.unique((base[:, None] ^ (np.uint64(1) << rng.integers(0, 64, (30, 40)).astype(np.uint64))).ravel())
    assert simhash.vantage_link(points, 2).tolist() == linked([(k, int(p)) for k, p in enumerate(points)], 2)


def test_components(spark):
    edges = [(k, k + 1) for k in range(20)] + [(100, 101), (103, 101)] + [(200, 300 + k) for k in range(50)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[k] for k in range(21)} == {0} and {found[k] for k in (100, 101, 103)} == {100}
    assert {found[300 + k] for k in range(50)} == {200}


def test_kept_digest_of_query(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    from genoweave.llm.queries import QUERIES

    got = {r["doc_id"]: r["kept_sha256"] for r in QUERIES["op2_block_anchors"](spark, str(tmp_path)).collect()}
    assert got == {1: hashlib.sha256(b"a b").hexdigest(), 2: hashlib.sha256(b"").hexdigest()}


def test_memory_of_a_batch_of_words(spark, monkeypatch):
    """Arrays of one batch, beside a JVM that earlier stages have filled."""
    hashed = F.transform(F.sequence(F.lit(0), F.lit(20_000)), lambda k: F.hex(F.xxhash64("id", k % 19_000)))
    docs = spark.range(24).coalesce(1).select(F.col("id").alias("doc_id"), F.concat_ws(" ", hashed).alias("text"))
    tables, write = [], block_anchors.write_batches

    def kept(*args):
        tables.append(write(*args))
        return tables[-1]

    monkeypatch.setattr(block_anchors, "write_batches", kept)
    assert block_anchors.remove_repeats(docs).count() == 24
    table, number = tables[0]
    assert number > 2
    row = max(table.select("doc_ids", "sizes", "text").collect(), key=lambda r: len(r["text"])).asDict()
    tracemalloc.start()
    worded = block_anchors.Worded(row, 13, 64)
    worded.extend(None)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
