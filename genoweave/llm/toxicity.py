"""A toxicity classifier with a counterfactual penalty.

Features are the presence of words and of word beginnings (four to six letters), which also reach
inflected forms. Spark counts over the training rows in how many toxic and other documents each
feature is; the ones that tell the classes apart most surely are kept, and a logistic model is fitted on
them. Training sentences that hold an identity term are paired with copies in which the term is
swapped for another, or for a word without a weight; the fit penalises the squared change of score over those pairs, so that the mere
mention of a group moves no score.

The model is fitted on at most `TRAIN_ROWS` labelled documents, those with the smallest hash of `doc_id`, one row each:
of several labels of one id the toxic one counts, of several texts the one of the smallest hash. Held-out rows are never among
them. The bias counts both classes alike, however few toxic documents there are, so a score is the chance of a text that is as
likely toxic as not before it is read. Scoring covers every document, whole texts.

A null text counts as empty and gets the score of a document without features. Null labels are not
learned from. Without any labelled row of one class there is nothing to tell apart: every score is 0 and
nothing is rejected by accident. Repeated rows are scored each. Columns other than
`doc_id` and `text` (of documents), `doc_id` and `toxic` (of labels) are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import documents, keep_in, slices

#: The most labelled rows the classifier is fitted on.
TRAIN_ROWS = 20_000
#: The most features it uses, and the most different sentence pairs, those of most sentences first.
FEATURES, PAIRS = 4_000, 50_000
#: Training documents that a feature has to be in, and how surely (in standard errors) it has to tell the classes apart.
LEAST_DOCS, SURELY = 2, 3.0
#: The price of a weight, against the mean logistic loss.
SPARSE = 1e-5
#: A feature is hashed to one of these.
SLOTS = 1 << 20

#: Words that name groups of people; each line holds words that can stand for each other.
IDENTITY_TERMS = [
    "women men girls boys woman man girl boy female male transgender nonbinary".split(),
    "muslim muslims christian christians jewish jews hindu hindus buddhist buddhists catholic catholics atheist atheists sikh sikhs".split(),
    "black white asian african latino latina hispanic arab european american mexican chinese indian indigenous".split(),
    "gay lesbian straight bisexual homosexual heterosexual queer".split(),
    "immigrant immigrants refugee refugees foreigner foreigners migrant migrants".split(),
    "disabled deaf blind autistic elderly old young".split(),
    "frauen männer juden muslime christen ausländer flüchtlinge schwule lesben".split(),
    "femmes hommes juifs musulmans chrétiens étrangers réfugiés homosexuels lesbiennes".split(),
    "mujeres hombres judíos musulmanes cristianos extranjeros refugiados homosexuales lesbianas".split(),
]

_WORD = re.compile(r"[^\W\d_]+")


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def word_features(word: str) -> tuple[str, ...]:
    """The word, marked, and its beginnings."""
    return ("=" + word, *(f"{k}{word[:k]}" for k in (4, 5, 6) if len(word) > k))


def slot(feature: str) -> int:
    return zlib.crc32(feature.encode()) % SLOTS


def _others() -> dict[str, str]:
    return {x: line[(k + 1) % len(line)] for line in IDENTITY_TERMS for k, x in enumerate(line)}


@dataclass
class Model:
    weights: dict[int, float]
    bias: float
    fixed: float | None = None

    def score(self, texts: list[str]) -> np.ndarray:
        if self.fixed is not None:
            return np.full(len(texts), self.fixed)
        memo, weights, out = {}, self.weights, []
        for text in texts:
            found: set[int] = set()
            for word in _WORD.findall(text.lower()):
                slots = memo.get(word)
                if slots is None:
                    slots = memo[word] = tuple({s for s in map(slot, word_features(word)) if s in weights})
                if slots:
                    found.update(slots)
            out.append(self.bias + sum(weights[s] for s in sorted(found)))
            if len(memo) > 200_000:
                memo.clear()
        return 1 / (1 + np.exp(-np.clip(np.array(out, dtype=float), -40, 40)))


def training_rows(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Labelled texts to learn from: `text` and `toxic`. The labels are bounded before they meet
    the documents, so they may be broadcast (16 bytes a row)."""
    use = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    use = use.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    use = use.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # One text per id, so there are no more of them than labels.
    found = documents(docs).join(F.broadcast(use), "doc_id")
    return found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.min("toxic").alias("toxic")).drop("doc_id")


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SLOTS), dtype=np.int32)
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            words = set(_WORD.findall(text.lower()))
            counts[toxic, list({slot(f) for w in words for f in word_features(w)})] += 1
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], ["slot", "other", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS, penalty: float = 10.0) -> Model:
    """`penalty` weighs the squared change of score between a sentence and its counterfactual."""
    # At most `most` texts, so their number of partitions is fixed too.
    rows = keep_in(training_rows(docs, labels, most).repartition(16), "train")
    totals = {x["toxic"]: x["n"] for x in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return Model({}, 0.0, 0.0)
    counts = rows.mapInArrow(_counts, "slot long, other int, toxic int").groupBy("slot").agg(
        F.sum("other").alias("other"), F.sum("toxic").alias("toxic")
    )
    share = (F.col("toxic") + F.col("other")) / (n0 + n1)
    surely = (F.col("toxic") / n1 - F.col("other") / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1) + 1e-12)
    chosen = counts.filter((F.col("toxic") + F.col("other") >= LEAST_DOCS) & (F.abs(surely) >= SURELY))
    chosen = chosen.orderBy(F.abs(surely).desc(), "slot").limit(FEATURES).select("slot").collect()
    swaps = _others()
    slots = sorted({x["slot"] for x in chosen} | {slot("=" + x) for x in swaps})
    column = {s: k for k, s in enumerate(slots)}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Columns of a text's features, and per identity sentence those it has alone and those its copy has alone."""

        def columns(words: set[str]) -> set[int]:
            return {column[s] for w in words for f in word_features(w) if (s := slot(f)) in column}

        for batch in batches:
            found, pairs = [], []
            for text in batch.column("text").to_pylist():
                text = text.lower()
                words = set(_WORD.findall(text))
                found.append(sorted(columns(words)))
                own = []
                if words & swaps.keys():
                    for sentence in re.split(r"[.!?\n]", text):
                        here = set(_WORD.findall(sentence))
                        if here & swaps.keys():
                            a = columns(here)
                            for copy in ({swaps.get(w, w) for w in here}, here - swaps.keys()):
                                b = columns(copy)
                                own.append(sorted(a - b) + [-1 - x for x in sorted(b - a)])
                pairs.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array(found, pa.list_(pa.int32())), pa.array(pairs, pa.list_(pa.list_(pa.int32())))],
                ["toxic", "found", "pairs"],
            )

    both = keep_in(rows.mapInArrow(sparse, "toxic int, found array<int>, pairs array<array<int>>"), "sparse")
    # At most `most` rows of at most FEATURES small numbers each; few features are in any text.
    data = both.select("toxic", "found").collect()
    alike = both.select(F.explode("pairs").alias("pair")).filter(F.size("pair") > 0).groupBy("pair").agg(F.count("*").alias("n"))
    alike = alike.orderBy(F.desc("n"), "pair").limit(PAIRS).collect()
    y = np.array([x["toxic"] for x in data], dtype=float)
    row = np.repeat(np.arange(len(data)), [len(x["found"]) for x in data])
    col = np.array([c for x in data for c in x["found"]], dtype=np.int64)
    pairs = [x["pair"] for x in alike]
    prow = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
    pcol = np.array([c if c >= 0 else -1 - c for p in pairs for c in p], dtype=np.int64)
    psign = np.array([1.0 if c >= 0 else -1.0 for p in pairs for c in p])
    share = np.array([x["n"] for x in alike], dtype=float)
    w = _minimise(row, col, y, prow, pcol, psign, len(slots), penalty, share / max(1.0, share.sum()))
    b = float(w[-1]) + float(np.log(n0 / n1))
    return Model({s: float(x) for s, x in zip(slots, w[:-1]) if x}, b)


def _minimise(row, col, y, prow, pcol, psign, width: int, penalty: float, share=None, steps: int = 800) -> np.ndarray:
    """Weights and, last, the bias that minimise the mean logistic loss, `penalty` times the mean
    squared change of score over the pairs (weighed by `share`), and `SPARSE` times the sum of absolute weights.

    Accelerated proximal gradient. What the strong features explain leaves nothing to the words that
    merely stand beside them, in copies of one text for instance, and their weights become zero.
    """
    pairs = int(prow[-1]) + 1 if len(prow) else 0

    def apply(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return w[-1] + np.bincount(row, w[col], len(y)), np.bincount(prow, psign * w[pcol], pairs)

    def back(gap: np.ndarray, change: np.ndarray) -> np.ndarray:
        g = np.bincount(col, gap[row], width + 1)
        g[-1] += gap.sum()
        return g + np.bincount(pcol, change[prow] * psign, width + 1)

    scale = 2 * penalty * (np.full(pairs, 1 / max(1, pairs)) if share is None else share)
    v = np.full(width + 1, 1.0)
    for _ in range(30):  # the largest curvature, by power iteration
        v /= np.linalg.norm(v)
        scores, change = apply(v)
        v = back(scores / (4 * len(y)), scale * change)
    rate = 0.9 / max(np.linalg.norm(v), 1e-9)
    w = ahead = np.zeros(width + 1)
    momentum = 1.0
    for _ in range(steps):
        scores, change = apply(ahead)
        chance = 1 / (1 + np.exp(-np.clip(scores, -40, 40)))
        new = ahead - rate * back((chance - y) / len(y), scale * change)
        new[:-1] = np.sign(new[:-1]) * np.maximum(0, np.abs(new[:-1]) - rate * SPARSE)
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / after * (new - w)
        w, momentum = new, after
    return w


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`doc_id` and `score` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = model.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    return documents(docs).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """`doc_id`, `held_out`, `score` and `predicted`."""
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text scores below `threshold`."""
    fields = docs.schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                scores = model.score([x or "" for x in part.column("text").to_pylist()])
                yield part.filter(pa.array(scores < threshold))

    return docs.mapInArrow(run, docs.schema).select(*fields)
