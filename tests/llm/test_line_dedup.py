"""Shared lines against brute force, and the streams and bitmaps on their own."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from genoweave.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, least, least_chars=1):
    owners = defaultdict(set)
    for row in rows:
        text = row[1] or ""
        for line in text.split("\n"):
            owners[key_of(line)].add(("id", row[0]) if row[0] is not None else ("text", text))
    often = {k for k, v in owners.items() if len(k) >= max(1, least_chars) and len(v) >= least}
    out = Counter()
    for row in rows:
        lines = (row[1] or "").split("\n")
        kept = [x for x in lines if key_of(x) not in often]
        out[row[0], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def found(docs, **more):
    return Counter(map(tuple, line_dedup.drop_shared_lines(docs, **more).select("doc_id", "n_lines", "n_dropped", "kept").collect()))


def test_corpus_of_all_cases(docs, rows, no_docs):
    assert found(docs, least_documents=2) == brute(rows, 2)
    assert found(docs) == brute(rows, 10)
    assert line_dedup.drop_shared_lines(no_docs).collect() == []


@pytest.fixture(scope="module")
def hot_rows():
    """One line in every document, some in just under and over ten, in many spellings and places."""
    rng = random.Random(3)
    rows = []
    for k in range(400):
        lines = [f"own line {k} {j}" for j in range(rng.randrange(4))] + ["  Accept ALL cookies\r", ""]
        lines += [f"shared {j}" for j in range(9, 12) if k % 40 < j and k < 40] + ["É A"] * (k % 100 < 3) + ["accept all Cookies"] * (k % 3)
        rng.shuffle(lines)
        rows.append((k, "\n".join(lines), None))
    rows += [(5, "own\naccept all cookies", None)] * 3 + [(None, "own\naccept all cookies", None), (None, "shared 9", None), (None, "shared 9", None)]
    return rows


@pytest.mark.parametrize("least, held", [(10, 1024), (3, 2), (1, 1024)])
def test_hot_lines_over_many_partitions(spark, hot_rows, monkeypatch, least, held):
    monkeypatch.setattr(line_dedup, "HELD", held)
    docs = spark.createDataFrame(hot_rows, "doc_id long, text string, key string").repartition(7)
    assert found(docs, least_documents=least) == brute(hot_rows, least)


def test_short_keys_stay(spark, hot_rows):
    docs = spark.createDataFrame(hot_rows, "doc_id long, text string, at string")
    assert found(docs, least_documents=3, least_chars=9) == brute(hot_rows, 3, 9)


@pytest.mark.parametrize("seed", range(6))
def test_any_cut_into_partitions_decides_alike(seed):
    """The sorted rows are cut anywhere into partitions and batches: the decisions stay the same."""
    rng = random.Random(seed)
    rows = sorted(
        (xxhash.xxh3_128_digest(bytes([k])), doc, b"t", at)
        for k in range(12) for doc in range(rng.choice([1, 2, 3, 4, 9])) for at in range(rng.choice([1, 1, 5]))
    )
    least = 4
    owners = defaultdict(set)
    for key, doc, _, _ in rows:
        owners[key].add(doc)
    wanted = sorted((doc, at) for key, doc, _, at in rows if len(owners[key]) >= least)
    cuts = sorted(rng.sample(range(len(rows) + 1), 4))
    dropped, opened, seen = [], [], defaultdict(set)
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        step = rng.choice([1, 2, 7, 100])
        batches = []
        for k in range(a, b, step):
            part = rows[k : min(b, k + step)]
            keys, docs, twins, at = zip(*part)
            arrays = [pa.array(keys, pa.binary()), pa.array(docs), pa.array(twins, pa.binary()), pa.array(at, pa.int32()), pa.nulls(len(part), pa.binary())]
            batches.append(pa.RecordBatch.from_arrays(arrays, ["key", "doc_id", "twin", "at", "more"]))
        for batch in line_dedup.stream_shared(iter(batches), least):
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    dropped.append((row["doc_id"], row["at"]))
                elif row["kind"] == 1:
                    opened.append((row["key"], row["doc_id"], row["at"]))
                else:
                    seen[row["key"]].add(row["doc_id"])
    dropped += [(doc, at) for key, doc, at in opened if len(seen[key]) >= least]
    assert sorted(dropped) == wanted


@pytest.mark.parametrize("lines, gone", [(1, [0]), (8, [7]), (9, [0, 8]), (100, [3, 17, 64]), (17, list(range(17)))])
def test_bitmaps(lines, gone):
    keep = line_dedup.unpack_bitmap(line_dedup.pack_bitmap(np.array(gone)), lines)
    assert np.flatnonzero(~keep).tolist() == gone
    assert line_dedup.unpack_bitmap(None, 3).all()
    assert len(line_dedup.pack_bitmap(np.arange(80_000))) < 1000  # compressed
