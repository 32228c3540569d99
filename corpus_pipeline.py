"""The corpus pipeline: quality rules, toxicity, near duplicates, repeated passages, packing.

Every stage gets what the stage before kept, written and read again, and hands on the columns of
`documents`; the last one returns the place of every piece of every document.

Null and empty texts have no words and go with the quality rules. Rows without a `doc_id` go through all
stages like others; of near copies they stay only if no row with an id does. A row that is repeated stays once, from
the near-copy stage on. Very long texts go through whole. Empty tables give no rows. Columns beside those of
`documents` are dropped at the first stage, so none can clash.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.llm import block_anchors, near_copies, packing, rules, toxicity
from genoweave.llm.common import keep_in, table
from genoweave.llm.queries import LIBRARY_FILE

#: Cuts in a generation of a packing task's memo: fewer than alone, beside a JVM that the stages before have filled.
MEMO = 200_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return rules.judge(docs, *COLUMNS).filter("kept").select(*COLUMNS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go. It learns from the labelled ones among `docs`."""
    docs = docs.select(*COLUMNS)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, that of the smallest id (five-word shingles, Jaccard 0.8 or more).

    op7's fingerprints and vantage-point search give candidates, MinHash those that differ in more bits; both are checked exactly."""
    return near_copies.keep_one(docs.select(*COLUMNS))


def repeated_passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words or more that a document with a smaller id has too are cut out."""
    cut = block_anchors.remove_repeats(docs.select(*COLUMNS), layout=True).withColumnRenamed("kept", "text")
    n_chars = F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", n_chars.cast("long")).select(*COLUMNS)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return packing.pack_documents(docs, public_tokenizers.path(LIBRARY_FILE), memo=MEMO)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", repeated_passage_stage),
    ("packing", packing_stage),
]

#: A fitted classifier and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep_in(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
