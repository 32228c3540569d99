"""Site and call tables stored for joins and lookups by site.

A clustered table is bucketed and sorted by its key, so tables of the same key and number of buckets
meet without moving again, and a lookup by key opens one bucket's files. It may have a folder per
chromosome, which static and dynamic filters prune, and Parquet Bloom filters, which leave out row groups in lookups
by other columns.

A bucket is one task's work, so the number of buckets has to grow with the tables (`bucket_count`). Keys with more rows than an even bucket would have, and rows without a key, are therefore
stored in a second, unbucketed table beside it; there are fewer such keys than buckets. Joins
treat the two apart: the buckets meet as they lie, the heavy keys' rows meet in a join that can be split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from genoweave.sources.tables import need_table


@dataclass
class Clustered:
    """A clustered table in the catalog. `heavy` are the keys stored apart, fewer than `buckets`."""

    spark: SparkSession
    name: str
    key: str
    buckets: int
    partition: str | None
    heavy: list

    @property
    def even(self) -> DataFrame:
        """The rows in buckets."""
        return need_table(self.spark, self.name)

    @property
    def rest(self) -> DataFrame:
        """The rows of heavy keys and those without a key."""
        return need_table(self.spark, f"{self.name}_rest")

    @property
    def rows(self) -> DataFrame:
        return self.even.unionByName(self.rest)

    def find(self, keys: list) -> DataFrame:
        """The rows of some keys; opens their buckets, and the rest only if a key is heavy."""
        found = self.even.filter(F.col(self.key).isin(keys))
        heavy = [k for k in keys if k in self.heavy]
        return found.unionByName(self.rest.filter(F.col(self.key).isin(heavy))) if heavy else found


#: Rows of a bucket, one task's work, beyond which there are more buckets instead.
BUCKET_ROWS = 1_000_000


def bucket_count(*tables: DataFrame, least: int = 1, most: int = 4096, rows: int = BUCKET_ROWS) -> int:
    """`least`, doubled until the largest of `tables` has at most `rows` rows a bucket. For tables that are to lie together."""
    largest = max(table.count() for table in tables)
    buckets = least
    while buckets * rows < largest and 2 * buckets <= most:
        buckets *= 2
    return buckets


def heavy_keys(df: DataFrame, key: str, share: int) -> list:
    """Keys with more than one in `share` of all rows: fewer than `share` of them reach the driver."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.filter((F.col("n") * share > total) & (F.col("n") > 1) & F.col(key).isNotNull())
    return sorted(r[0] for r in found.select(key).collect())


def save_clustered(
    df: DataFrame, name: str, key: str, path: str, buckets: int = 64, partition: str | None = None,
    bloom: dict[str, int] | None = None,
) -> Clustered:
    """Stores `df` as tables `name` and `name`_rest below `path`. `bloom`: columns with their expected
    number of distinct values per file. `df` is read several times, so hand in stored rows."""
    heavy = heavy_keys(df, key, buckets)
    apart = F.col(key).isNull() | F.coalesce(F.col(key).isin(heavy), F.lit(False))

    def save(rows: DataFrame, table: str, bucketed: bool) -> None:
        writer = rows.write.option("path", f"{path}/{table}")
        for column, values in (bloom or {}).items():
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
        if partition:
            writer = writer.partitionBy(partition)
        if bucketed:
            writer = writer.bucketBy(buckets, key).sortBy(key)
        writer.saveAsTable(table)

    # A task writes whole buckets: one file per bucket, and per folder it has rows of.
    save(df.filter(~apart).repartition(buckets, key), name, True)
    save(df.filter(apart).hint("rebalance"), f"{name}_rest", False)
    return Clustered(df.sparkSession, name, key, buckets, partition, heavy)


def join_clustered(left: Clustered, right: Clustered, left_columns: list[str], right_columns: list[str]) -> DataFrame:
    """Rows of both with equal keys: bucket by bucket, without moving either, and the heavy keys apart.

    The planner may still broadcast a table below its own limit.
    """
    if left.buckets != right.buckets:
        raise ValueError("tables with different numbers of buckets do not lie together")
    heavy = sorted({*left.heavy, *right.heavy})

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        a = a.select(*left_columns, F.col(left.key).alias("_key"))
        b = b.select(*right_columns, F.col(right.key).alias("_other"))
        return a.join(b, F.col("_key") == F.col("_other")).select(*left_columns, *right_columns)

    even = meet(left.even, right.even)
    if not heavy:
        return even

    def of(table: Clustered) -> DataFrame:
        return table.find(heavy)

    return even.unionByName(meet(of(left), of(right)))


def in_folders_of(calls: Clustered, sites: DataFrame, even: bool = True) -> DataFrame:
    """The rows of `calls` in folders that `sites` have rows of, found while the query runs.

    The folder values are broadcast: there are as many as `calls` has folders at most.
    """
    wanted = sites.select(F.col(calls.partition)).distinct()
    rows = calls.even if even else calls.rest
    return rows.join(F.broadcast(wanted), calls.partition, "left_semi")


def calls_of_sites(calls: Clustered, sites: Clustered, wanted: Column | DataFrame, columns: list[str], site_columns: list[str]) -> DataFrame:
    """Calls of chosen sites: `wanted` is a condition on `sites`, or a table with one of its columns.

    The sites are chosen in their buckets, folders without a chosen site are never opened, and
    the calls meet the sites bucket by bucket.
    """

    def chosen(rows: DataFrame) -> DataFrame:
        if isinstance(wanted, DataFrame):
            return rows.join(wanted, wanted.columns, "left_semi")
        return rows.filter(wanted)

    def meet(rows: DataFrame, others: DataFrame) -> DataFrame:
        rows = rows.select(*columns, F.col(calls.key).alias("_key"))
        others = others.select(*site_columns, F.col(sites.key).alias("_other"))
        return rows.join(others, F.col("_key") == F.col("_other")).select(*columns, *site_columns)

    folders = chosen(sites.rows)
    even = in_folders_of(calls, folders)
    out = meet(even, chosen(sites.even))
    heavy = sorted({*calls.heavy, *sites.heavy})
    if heavy:
        rows = even.unionByName(in_folders_of(calls, folders, even=False)).filter(F.col(calls.key).isin(heavy))
        out = out.unionByName(meet(rows, chosen(sites.find(heavy))))
    return out
