"""Lists in cells: ordered concatenation per group, cut into pages of bounded length.

A list that fits one page is one row with page 0. A longer list goes on in the rows with
page 1, 2 ..., so no group is gathered whole and no entry is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genoweave.functions.text import list_entry, list_text
from genoweave.operators.positions import running_position
from genoweave.session import written

# Entries in one cell.
PAGE_ITEMS = 10_000


def ordered_concat(value: str, separator: str, order: list[str]) -> Column:
    """listagg with an order; `value` and the separator are SQL text."""
    return F.expr(f"listagg({value}, '{separator}') within group (order by {', '.join(order)})")


def entry_set(*columns: str) -> Column:
    """The distinct entries of a group in the order of their fields.

    Equal entries are merged before the shuffle. Only for groups of bounded size, such as
    the calls of one patient on one page of a gene.
    """
    return F.array_sort(F.collect_set(F.struct(*columns)))


def joined(entries: str, field: str, separator: str) -> Column:
    """One field of all entries as text; NULL if no entry has it."""
    return F.nullif(F.array_join(F.col(f"{entries}.{field}"), separator), F.lit(""))


def with_pages(
    items: DataFrame,
    keys: list[str],
    order: list[str],
    page_items: int = PAGE_ITEMS,
    dense: bool = False,
) -> DataFrame:
    """Adds the page each item falls on; with `dense` equal items count once."""
    placed = running_position(
        items, keys, order, "page", dense=dense
    )
    return placed.withColumn("page", _page(F.col("page"), page_items))


def _page(position: Column, page_items: int) -> Column:
    return F.call_function("div", position, F.lit(page_items))


def paged_texts(
    items: DataFrame,
    keys: list[str],
    order: list[str],
    texts: dict[str, tuple[str, str]],
    page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Concatenates distinct items; `texts` maps an output name to (column, separator)."""
    pages = with_pages(written(items), keys, order, page_items)
    return pages.groupBy(*keys, "page").agg(
        *[ordered_concat(col, sep, order).alias(name) for name, (col, sep) in texts.items()]
    )


def paged_runs(
    rows: DataFrame,
    keys: list[str],
    value: str,
    separator: str,
    name: str,
    page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Concatenates values in their own order, duplicates kept.

    Equal values are counted before anything is shuffled as text; a run that is longer
    than the rest of its page goes on in the next one.
    """
    runs = written(value_runs(rows, keys, value))
    return _run_pages(runs, keys, value, separator, name, page_items)


def value_runs(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The distinct values per group with the number of their copies."""
    return rows.groupBy(*keys, value).agg(F.count("*").alias("_copies"))


def _run_pages(
    runs: DataFrame, keys: list[str], value: str, separator: str, name: str, page_items: int,
) -> DataFrame:
    placed = running_position(runs, keys, [value], "_start", "_copies")
    end = F.col("_start") + F.col("_copies")
    page_start = F.col("page") * page_items
    copies = F.least(end, page_start + page_items) - F.greatest(F.col("_start"), page_start)
    first_page, last_page = _page(F.col("_start"), page_items), _page(end - 1, page_items)
    spread = placed.withColumn("page", F.explode(F.sequence(first_page, last_page)))
    again = F.concat(F.lit(separator), F.col(value))
    text = F.concat(F.col(value), F.repeat(again, (copies - 1).cast("int")))
    return (
        spread.withColumn("_text", text)
        .groupBy(*keys, "page")
        .agg(ordered_concat("_text", separator, [value]).alias(name))
    )


def group_lists(
    rows: DataFrame, keys: list[str], value: str, name: str, page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Every group's values as "['a', 'b']", duplicates kept."""
    return _run_lists(written(value_runs(rows, keys, value)), keys, value, name, page_items)


def _run_lists(
    runs: DataFrame, keys: list[str], value: str, name: str, page_items: int
) -> DataFrame:
    entries = runs.withColumn(value, list_entry(F.col(value)))
    lists = _run_pages(entries, keys, value, ", ", name, page_items)
    return lists.withColumn(name, F.concat(F.lit("["), F.col(name), F.lit("]")))


def group_arrays(
    rows: DataFrame, keys: list[str], value: str, order: list[str], name: str,
    page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Every group's values as an array in the given (total) order, duplicates kept."""
    pages = with_pages(rows, keys, order, page_items)
    entry = F.struct(*[F.col(o) for o in order], F.col(value).alias("_value"))
    return (
        pages.groupBy(*keys, "page")
        .agg(F.array_sort(F.collect_list(entry)).alias("_entries"))
        .select(*keys, "page", F.col("_entries._value").alias(name))
    )


def rows_and_lists(
    rows: DataFrame, key: str, value: str, order: list[str], name: str, page_items: int = PAGE_ITEMS,
) -> tuple[DataFrame, DataFrame]:
    """Rows with the number of `pages` of their group's list, and the lists: (key, page, name).

    A list holds every row's value in the given (total) order. Both relations are complete; the text
    is not copied to the rows. `with_lists` does that.
    """
    arrays = group_arrays(rows, [key], value, order, "_values", page_items)
    texts = written(arrays.select(key, "page", list_text(F.col("_values")).alias(name)))
    pages = texts.groupBy(key).agg((F.max("page") + 1).alias("pages"))
    return rows.join(pages, key), texts


def with_lists(rows: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Each row once per page of its group's list, with the page: rows times pages.

    `rows` have the number of `pages`, as `rows_and_lists` gives them. Rows of one text lie together, so a
    columnar file holds the text once and not once per row; a merge keeps them so.
    """
    spread = rows.withColumn("page", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pages") - 1)))
    others = [c for c in texts.columns if c not in (key, "page")]
    # A count of partitions that is given stays as it is: the rows are few bytes, what is made of them is not.
    spread = spread.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, "page")
    return spread.join(texts.hint("merge"), [key, "page"]).select(*rows.columns, "page", *others)


def distinct_concat(
    df: DataFrame, key: str, separator: str = "", page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """Per group and column the distinct values, sorted and joined; columns as text."""
    columns = [c for c in df.columns if c != key]
    text = df.select(key, *[F.col(c).cast("string").alias(c) for c in columns])
    entries = text.unpivot([key], columns, "column", "value").distinct()
    entries = entries.filter(F.col("value").isNotNull())
    joined = paged_texts(
        entries, [key, "column"], ["value"], {"text": ("value", separator)}, page_items
    )
    cell = {c: F.max(F.when(F.col("column") == c, F.col("text"))).alias(c) for c in columns}
    return joined.groupBy(key, "page").agg(*cell.values())


def ids_by_gene(
    rows: DataFrame, separator: str, key: str = "gene_name", value: str = "rsid",
    name: str = "rsids", page_items: int = PAGE_ITEMS,
) -> DataFrame:
    """The distinct values per group in order."""
    entries = rows.select(key, value).distinct()
    return paged_texts(entries, [key], [value], {name: (value, separator)}, page_items)
