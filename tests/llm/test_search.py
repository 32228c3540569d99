"""Exact top-k against all inner products."""

import numpy as np
import pytest

from genoweave.llm import pivot_index

SCHEMA = "vec_id long, embedding array<float>, score string"


def frames(spark, rows):
    vectors = pivot_index.integer_vectors(spark.createDataFrame(rows, SCHEMA))
    return vectors, vectors.filter("vec_id % 50 = 0")


def brute(rows, k=5):
    whole = {}
    for i, v, _ in rows:
        if i is None or v is None or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole[i] = np.floor(256 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64)
    out = []
    for q in whole:
        if q % 50 == 0:
            best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [64, 2048])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(pivot_index, "BLOCK", block)
    monkeypatch.setattr(pivot_index, "RING", 16)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 8))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=8)).tolist(), "x") for i in range(900)]
    rows += [(1000 + i, rows[7][1], None) for i in range(300)]  # many equal vectors
    rows += [(2000, rows[7][1], None), rows[50], rows[50]]
    rows += [(3000, None, None), (3050, [], None), (3100, [1.0] * 7, None), (3150, [float("nan")] * 8, None), (3200, [float("inf")] + [0.0] * 7, None)]
    rows += [(3250, [None] + [1.0] * 7, None), (None, [1.0] * 8, None), (3300, [0.0] * 8, None)]
    got = pivot_index.top_k(*frames(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)


def test_few_rows(spark):
    rows = [(0, [1.0] * 8, None), (1, [0.5] * 8, None), (2, [0.5] * 8, None)]
    assert sorted(tuple(r) for r in pivot_index.top_k(*frames(spark, rows)).collect()) == brute(rows)
    assert pivot_index.top_k(*frames(spark, rows[:1])).count() == 0
    assert pivot_index.top_k(*frames(spark, [])).count() == 0
