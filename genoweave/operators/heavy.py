"""The most frequent values of every column, exact, without shuffling every distinct value.

Every task keeps, per column, a summary of at most `entries` values with counts. Where a summary grows beyond that, the
count of its (entries + 1)-th value is taken off all, and values without any count left go; what was taken off is
summed up. Summaries merge by addition, so a value that is in none of them has at most as many copies as were
taken off in all. The summaries' values that can be among the wanted ones are then counted exactly. If the last wanted
count is above the bound of what may have been lost, the answer is proven; only columns where it is not are
counted in full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from genoweave.session import written

#: Values of a column that a task keeps.
ENTRIES = 4096
_SUMMARY = "column string, value string, n long, lost long"


class Summary:
    """Counts of at most `entries` values; `lost` is what a value may have more than its count."""

    def __init__(self, entries: int):
        self.entries, self.lost = entries, 0
        self.counts: dict = {}

    def add(self, values: list, counts: list[int]) -> None:
        have = self.counts
        for value, n in zip(values, counts):
            have[value] = have.get(value, 0) + n
        if len(have) > self.entries:
            kept = np.fromiter(have.values(), np.int64, len(have))
            off = int(np.partition(kept, len(kept) - self.entries - 1)[len(kept) - self.entries - 1])
            self.counts = {v: n - off for v, n in have.items() if n > off}
            self.lost += off


def _summarise(batches: Iterator[pa.RecordBatch], columns: list[str], entries: int) -> Iterator[pa.RecordBatch]:
    kept = {c: Summary(entries) for c in columns}
    for batch in batches:
        for c in columns:
            found = pc.value_counts(batch.column(c).drop_null())
            kept[c].add(found.field("values").to_pylist(), found.field("counts").to_pylist())
    rows = [(c, v, n, 0) for c, s in kept.items() for v, n in s.counts.items()]
    # What was lost goes in a row of its own, without a count.
    rows += [(c, None, 0, s.lost) for c, s in kept.items() if s.lost]
    if rows:
        names = [f.split()[0] for f in _SUMMARY.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names)


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def summaries(df: DataFrame, columns: list[str], entries: int = ENTRIES) -> DataFrame:
    """(column, value, n, lost): the merged summaries; `lost` is the same in all rows of a column. A column that
    lost anything has a row without a value too, so it is there even if no value is left of it."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    parts = text.mapInArrow(lambda b: _summarise(b, columns, entries), _SUMMARY)
    merged = parts.groupBy("column", "value").agg(F.sum("n").alias("n"), F.sum("lost").alias("lost"))
    lost = merged.groupBy("column").agg(F.sum("lost").alias("lost"))
    return merged.drop("lost").join(F.broadcast(lost), "column")  # a row per column


def top_values(df: DataFrame, k: int, columns: list[str] | None = None, entries: int = ENTRIES) -> DataFrame:
    """(column, value, n, rank): the `k` most frequent values of each column as text, ties by value; missing
    values do not count.

    `df` is read once for the summaries and once for the exact counts, so hand in stored rows.
    """
    columns = columns or df.columns
    if not 0 < k <= entries:
        raise ValueError(f"k has to be between 1 and {entries}")
    found = written(summaries(df, columns, entries))
    seen = {r[0] for r in found.select("column").distinct().collect()}  # columns with any value
    found = found.filter("value is not null")
    # Of the k-th largest count at least so much is certain; what can't reach it is no candidate.
    least = _ranked(found, k).groupBy("column").agg(F.min("n").alias("least"), F.count("*").alias("ranks"))
    least = least.withColumn("least", F.when(F.col("ranks") == k, F.col("least")).otherwise(0)).drop("ranks")
    candidates = found.join(F.broadcast(least), "column").filter(F.col("n") + F.col("lost") >= F.col("least"))  # a row per column
    candidates = written(candidates.select("column", "value", "lost"))
    sizes = candidates.groupBy("column").agg(F.count("*").alias("n"), F.max("lost").alias("lost")).collect()  # a row per column
    lost = {r["column"]: r["lost"] for r in sizes}
    few = sorted(r["column"] for r in sizes if r["n"] <= entries)
    exact = written(_ranked(_counted(df, few, candidates), k))
    last = {r["column"]: r for r in exact.groupBy("column").agg(F.min("n").alias("last"), F.count("*").alias("ranks")).collect()}
    # Proven if k values are above what a value outside may have, or if nothing was lost at all.
    proven = [c for c in few if not lost[c] or (last[c]["ranks"] == k and last[c]["last"] > lost[c])]
    doubtful = [c for c in columns if c in seen and c not in proven]
    sure = exact.filter(F.col("column").isin(proven))
    return sure.unionByName(_ranked(_all_counts(df, doubtful), k)) if doubtful else sure


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot([], columns, "column", "value").filter("value is not null")


def _all_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _long(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def _counted(df: DataFrame, columns: list[str], candidates: DataFrame) -> DataFrame:
    """Exact counts of the candidates of `columns`, of which each has no more than a summary's entries."""
    if not columns:
        return candidates.select("column", "value", F.lit(0).cast("long").alias("n")).limit(0)
    wanted = candidates.filter(F.col("column").isin(columns)).select("column", "value")
    kept = _long(df, columns).join(F.broadcast(wanted), ["column", "value"], "left_semi")
    return kept.groupBy("column", "value").agg(F.count("*").alias("n"))
