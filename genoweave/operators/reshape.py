"""Wide to long, long to wide, and the slices and lines a matrix is exported in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoweave.operators.lists import PAGE_ITEMS, ordered_concat, paged_texts, with_pages
from genoweave.operators.positions import running_position
from genoweave.session import written

# Cells of one exported line; the tables the matrix is loaded to stop at 1000 columns.
SLICE_COLUMNS = 900


def to_long(matrix: DataFrame, ids: list[str], patients: list[str] | None = None) -> DataFrame:
    """One row per patient column, with lower-case patient ids."""
    columns = patients or [c for c in matrix.columns if c not in ids]
    long = matrix.unpivot(ids, columns, "patient", "gt")
    return long.withColumn("patient", F.lower("patient"))


def _only(names: list[str], key: str, value: str) -> list[Column]:
    """One cell per name; a key that is not listed, or comes twice, fails the query."""
    listed = F.count_if(~F.coalesce(F.col(key).isin(names), F.lit(False))) == 0
    wrong = F.raise_error(F.concat(F.lit("not listed, or more than once: "), F.lit(key)))
    return [
        F.when(listed & (F.count_if(F.col(key) == n) <= 1), F.max(F.when(F.col(key) == n, F.col(value))))
        .otherwise(wrong.cast("string"))
        .alias(n)
        for n in names
    ]


def transpose_wide(df: DataFrame, row_key: str, row_names: list[str] | None = None) -> DataFrame:
    """Columns become rows, and the row keys, which have to be unique, become columns.

    For short lists; without `row_names` the keys of the data are taken, in order.
    `transpose_lines` has no such bound.
    """
    if row_names is None:
        keys = df.select(F.col(row_key).cast("string").alias("k")).distinct().orderBy("k")
        row_names = [r["k"] for r in keys.limit(SLICE_COLUMNS + 1).collect()]
    if len(row_names) > SLICE_COLUMNS:
        raise ValueError(f"more than {SLICE_COLUMNS} rows: use transpose_lines")
    columns = [c for c in df.columns if c != row_key]
    text = df.select(F.col(row_key).cast("string").alias(row_key),
                     *[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([row_key], columns, "column", "value")
    return long.groupBy("column").agg(*_only(row_names, row_key, "value"))


def transpose_lines(
    df: DataFrame, order: list[str], separator: str = ",", page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """One line per column with the values of all rows in order, separators removed from
    the values and missing values left empty."""
    columns = df.columns
    named = df.select(*[F.col(o.split()[0]).alias(f"_order{i}") for i, o in enumerate(order)],
                      *[F.translate(F.coalesce(F.col(c).cast("string"), F.lit("")), separator, "")
                        .alias(c) for c in columns])
    sorts = [" ".join([f"_order{i}", *o.split()[1:]]) for i, o in enumerate(order)]
    paged = with_pages(named, [], sorts, page_items)
    keep = [f"_order{i}" for i in range(len(order))] + ["page"]
    long = paged.unpivot(keep, columns, "column", "value")
    return long.groupBy("column", "page").agg(
        ordered_concat("value", separator, sorts).alias("line")
    )


def column_slices(df: DataFrame, key: str, size: int = SLICE_COLUMNS) -> list[DataFrame]:
    """Vertical slices of `size` columns, each with the key."""
    others = [c for c in df.columns if c != key]
    return [df.select(key, *others[i : i + size]) for i in range(0, len(others), size)]


def row_slices(
    df: DataFrame, order: list[str], size: int = 100
) -> DataFrame:
    """Adds the number of the horizontal slice of `size` rows."""
    return with_pages(df, [], order, size).withColumnRenamed("page", "slice")


def records(df: DataFrame, ids: list[str]) -> DataFrame:
    """One row per field: (ids, field number, name, value as text)."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("field"), F.lit(c).alias("name"),
                F.col(c).cast("string").alias("value"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return df.select(*ids, F.inline(fields))


def names_per_group(df: DataFrame, key: str) -> DataFrame:
    """The list of column names, once per group."""
    names = "[" + ", ".join(f"'{c}'" for c in df.columns) + "]"
    return df.select(key).distinct().withColumn("names", F.lit(names))


def matrix_features(
    labels: DataFrame, slice_columns: int = SLICE_COLUMNS
) -> DataFrame:
    """Numbers the (gene_name, page) features in gene order and assigns them to slices.

    The labels are written first: the size check, the slice widths, the header and the
    lines all start from them.
    """
    placed = running_position(
        written(labels), [], ["gene_name", "page"], "feature"
    )
    return placed.withColumns(
        {
            "slice": F.call_function("div", F.col("feature"), F.lit(slice_columns)),
            "place": (F.col("feature") % slice_columns).cast("int"),
        }
    )


def slice_widths(features: DataFrame) -> DataFrame:
    return features.groupBy("slice").agg((F.max("place") + 1).alias("width"))


def matrix_header(features: DataFrame, label: str = "label") -> DataFrame:
    """One header line per slice."""
    heads = features.groupBy("slice").agg(ordered_concat(label, ",", ["place"]).alias("cells"))
    line = F.concat(F.lit("'patient','diagnosis',"), F.col("cells"))
    return heads.select("slice", line.alias("line"))


def matrix_lines(strings: DataFrame, features: DataFrame, patients: DataFrame) -> DataFrame:
    """One line per patient and slice: patient, diagnosis, a cell for each feature.

    `strings` has (patient, gene_name, page, peptide_string). A feature without a string
    is an empty cell: each cell is preceded by as many separators as features lie
    between it and the one before, so no row per empty cell is made.
    """
    widths = slice_widths(features)
    last = widths.agg(F.max("slice")).first()[0]
    if last is None:
        return patients.select("patient", F.lit(None).cast("long").alias("slice"),
                               F.lit(None).cast("string").alias("line")).limit(0)
    places = features.select("gene_name", "page", "slice", "place")
    cells = strings.join(places, ["gene_name", "page"]).select(
        "patient", "slice", "place", F.coalesce("peptide_string", F.lit("")).alias("cell")
    )
    gap = Window.partitionBy("patient", "slice").orderBy("place")
    before = F.coalesce(F.lag("place").over(gap), F.lit(0))
    quoted = F.when(F.col("cell") == "", "").otherwise(F.concat(F.lit("'"), "cell", F.lit("'")))
    pieces = cells.withColumn("piece", F.concat(F.repeat(F.lit(","), F.col("place") - before), quoted))
    filled = pieces.groupBy("patient", "slice").agg(
        ordered_concat("piece", "", ["place"]).alias("cells"), F.max("place").alias("last")
    )
    start = F.concat(F.lit("'"), F.col("patient"), F.lit("','"), F.coalesce("diagnosis", F.lit("")), F.lit("',"))
    people = patients.select("patient", start.alias("start"))
    # One row per slice, so that the lines themselves stay where they are.
    widths = F.broadcast(widths)

    def lines(rows: DataFrame, cells: Column, last: Column) -> DataFrame:
        rest = F.repeat(F.lit(","), F.col("width") - 1 - last)
        line = F.concat("start", cells, rest)
        return rows.join(widths, "slice").select("patient", "slice", line.alias("line"))

    filled = written(filled)
    full = lines(people.join(filled, "patient"), F.col("cells"), F.col("last"))
    # Patients are few beside their lines, which are most of the work: they are dealt by number, not by size.
    taken = filled.groupBy("patient").agg(F.collect_list("slice").alias("taken"))
    count = int(patients.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = people.join(taken, "patient", "left").repartition(count)
    slices = F.array_except(F.sequence(F.lit(0).cast("long"), F.lit(last)), F.coalesce("taken", F.array().cast("array<bigint>")))
    empty = lines(rest.select("patient", "start", F.explode(slices).alias("slice")), F.lit(""), F.lit(0))
    return full.unionByName(empty)


def to_wide(strings: DataFrame, labels: list[str]) -> DataFrame:
    """Patient rows and one column per listed feature label; for short lists."""
    if len(labels) > SLICE_COLUMNS:
        raise ValueError(f"more than {SLICE_COLUMNS} columns: use matrix_lines")
    return strings.groupBy("patient").agg(*_only(labels, "label", "peptide_string"))
