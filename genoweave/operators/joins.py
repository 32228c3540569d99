"""Joins between genotypes, sites, genes and patients.

All are equi-joins. The planner broadcasts a side below its size threshold and otherwise
sorts and merges; adaptive execution splits hot keys of the large side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gene_map(variation: DataFrame, genename: DataFrame) -> DataFrame:
    """Variations with each of their genes."""
    return variation.join(genename, "variation_id")


def with_genes(rows: DataFrame, genes: DataFrame, id_column: str = "rsid") -> DataFrame:
    """Rows by variant id with each of the variant's genes; both ids are kept."""
    return rows.join(genes, rows[id_column] == genes["rs_name"])


def calls_and_sites(calls: DataFrame, sites: DataFrame) -> DataFrame:
    """Full outer join of calls (idnum) and the site list (numid).

    Made of a left join, whose hot keys can be split, and the sites without any call.
    """
    matched = calls.join(sites, F.col("idnum") == F.col("numid"), "left")
    called = calls.select("idnum").distinct()
    uncalled = sites.join(called, F.col("idnum") == F.col("numid"), "left_anti")
    return matched.unionByName(uncalled, allowMissingColumns=True)


def with_annotation(rows: DataFrame, annotation: DataFrame, id_column: str = "rsid") -> DataFrame:
    """Rows by variant id with every transcript annotation (`name`) of the variant."""
    return rows.join(annotation.drop("chrom"), rows[id_column] == annotation["name"])


def annotate_twice(calls: DataFrame, annotation: DataFrame, genes: DataFrame) -> DataFrame:
    """Calls with transcript annotation and with genes."""
    return with_genes(with_annotation(calls, annotation), genes, "name")


def keyed_update(target: DataFrame, values: DataFrame, keys: list[str], column: str) -> DataFrame:
    """`column` of the target, extended by the text of `values` that has the same keys.

    `values` holds one row per key, else the query fails; keys without one keep their text.
    """
    twice = F.raise_error(F.lit("an update has more than one row for a key")).cast("string")
    text = F.when(F.count("*") == 1, F.max(column)).otherwise(twice)
    new = values.groupBy(*keys).agg(text.alias("_new"))
    text = F.concat(F.col(column), F.coalesce(F.col("_new"), F.lit("")))
    return target.join(new, keys, "left").withColumn(column, text).drop("_new")


def diagnosis_dimension(calls: DataFrame, row_key: str = "1") -> DataFrame:
    """(patient, diagnosis) from the matrix row that holds the diagnosis."""
    found = calls.filter(F.col("idnum") == row_key)
    return found.groupBy("patient").agg(F.min("gt").alias("diagnosis"))


def with_diagnosis(rows: DataFrame, diagnosis: DataFrame) -> DataFrame:
    return rows.join(diagnosis, "patient", "left")
