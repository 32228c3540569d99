"""Near copies at a similarity of 0.8, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from genoweave.llm import near_copies

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def first_ids(texts):
    """The smallest id of each group of texts (by id) linked at 0.8."""
    sets = {i: shingle_set(t) for i, t in texts.items()}
    up = {i: i for i in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and similarity(sets[a], sets[b]) >= 0.8 and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {root(i) for i in texts}


def edited(words, n, rng):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"new{rng.random()}"
    return " ".join(out)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    out = {}
    for k in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        out[2 * k] = " ".join(words)
        out[2 * k + 1] = edited(words, 1 + k % 5, rng)
    base = [f"hot{k}" for k in range(80)]
    out[1000] = " ".join(base)
    out.update({1001 + k: edited(base, 1 + k % 3, rng) for k in range(60)})
    out.update({2000: "", 2001: " \n", 2002: "one two", 2003: "One  two", 2004: "one three"})
    return out


def test_shingles(texts):
    sets = near_copies.shingles(list(texts.values()))
    assert [len(x) for x in sets] == [len(shingle_set(x)) for x in texts.values()]


def test_stage_links_at_eight_tenths(spark, texts):
    rows = [(i, t, "en", "s", len(t)) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(got) == sorted(first_ids(texts))


def test_own_shingles_bound_never_hides_a_near_copy(spark):
    """A large group around a text that is not there, edited lightly and heavily, with cuts and additions."""
    rng = random.Random(5)
    base = [f"base{k}" for k in range(120)]
    texts = {}
    for k in range(260):
        words = edited(base, rng.choice([0, 1, 1, 2, 2, 3, 4, 6, 9]), rng).split()
        cut = rng.choice([0, 0, 0, 5, 12, 20])
        words = words[cut // 2 : len(words) - cut // 2] + [f"more{rng.random()}" for _ in range(rng.choice([0, 0, 0, 3, 10]))]
        texts[k] = " ".join(words)
    assert 30 < len(first_ids(texts)) < 250
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA).repartition(4)
    got = [r["doc_id"] for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(got) == sorted(first_ids(texts))


def test_names_that_clash_and_empty_tables(spark):
    columns = "doc_id long, text string, first_row long, wanted string, first_id long, _row string, _whole string, _id long"
    rows = [(1, "one two three", 5, "w", 6, "r", "h", 9), (2, "one two three", 5, "w", 6, "r", "h", 9), (3, "other", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, columns)
    assert sorted(map(tuple, near_copies.keep_one(docs).collect())) == [rows[0], rows[2]]
    assert near_copies.keep_one(docs.limit(0)).collect() == []


@pytest.mark.parametrize("similarity_wanted", [0.8, 0.85, 0.9, 0.95])
def test_recall_at_each_similarity(spark, similarity_wanted):
    """Pairs of texts just above a similarity: all are found."""
    rng = random.Random(int(similarity_wanted * 100))
    texts = {}
    for k in range(400):
        words = [f"p{k}w{j}" for j in range(400)]
        other = list(words)
        places = list(range(3, 397, 5))
        rng.shuffle(places)
        for n, at in enumerate(places):
            other[at] = f"new{k}x{n}"
            if similarity(shingle_set(" ".join(words)), shingle_set(" ".join(other))) < similarity_wanted:
                other[at] = words[at]
                break
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(other)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA)
    assert near_copies.keep_one(docs).count() == 400


def test_null_ids_and_repeated_rows(spark):
    long = " ".join(f"own{k}" for k in range(50))
    rows = [(None, "alone", None, None, 5), (7, "twice here", "en", "s", 10), (7, "twice here", "en", "s", 10), (8, long, "en", "s", 1)]
    rows += [(None, long, None, None, 1), (None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (None, "No id", "de", "s", 5)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in got) == [(0, "alone"), (0, "no id"), (7, "twice here"), (8, long)]
    assert all(tuple(r) in rows for r in got)


def test_the_stage_takes_the_links_of_fingerprints(spark, texts):
    """Without a shared MinHash band what op7's search ties is still found, and checked by whole sets."""
    base = [f"solo{k}" for k in range(60)]
    texts = {**texts, 3000: " ".join(base), 3001: " ".join([*base[:-1], "other"]), 3002: " ".join(base * 3), 3003: " ".join(base * 3 + base[:9])}
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], SCHEMA).repartition(4)
    marked = near_copies.mark(docs)
    point = {r["doc_id"]: r["point"] for r in marked.select("doc_id", "point").collect()}
    alone = marked.withColumn("keys", F.array(F.col("point"))).localCheckpoint()
    found = {r["node"]: r["component"] for r in near_copies.groups(docs, alone).collect()}
    assert point[3002] in found and found[point[3002]] == found[point[3003]]
    sets = {point[i]: shingle_set(t) for i, t in texts.items()}
    groups = {}
    for node, component in found.items():
        groups.setdefault(component, []).append(node)
    assert all(any(similarity(sets[a], sets[b]) >= 0.8 for b in group if b != a) for group in groups.values() for a in group)
