"""Aggregates that a caller brings as Python functions on Arrow tables.

A group is cut into pages of bounded length, so no group is ever whole in a task. `step` turns the rows of one page
into rows of a state; `merge` turns the states of a few pages into one again, in as many rounds as it takes;
`finish` makes the result. States are tables as well, so large ones need not be single values.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.operators.lists import PAGE_ITEMS, with_pages
from genoweave.session import written

Tables = Callable[[pa.Table], pa.Table]
#: States that are merged at a time.
FAN_IN = 16


def _applied(df: DataFrame, keys: list[str], function: Tables, out: str) -> DataFrame:
    """`function` over the rows of each (keys, page), without these columns; they come back beside its rows."""
    kinds = [f"`{k}` {df.schema[k].dataType.simpleString()}" for k in [*keys, "page"]]

    def run(key, table):
        made = function(table.drop_columns([*keys, "page"]))
        beside = [pa.array([k.as_py()] * len(made), table.schema.field(n).type) for k, n in zip(key, [*keys, "page"])]
        return pa.table([*beside, *made.columns], names=[*keys, "page", *made.column_names])

    return df.groupBy(*keys, "page").applyInArrow(run, ", ".join([*kinds, out]))


def aggregate_pages(
    rows: DataFrame, keys: list[str], order: list[str], step: Tables, merge: Tables, finish: Tables, state: str, out: str,
    page_items: int = PAGE_ITEMS, fan_in: int = FAN_IN,
) -> DataFrame:
    """`keys` and the columns `out` of each group.

    `state` and `out` are the schemas of what `step` and `merge`, and `finish` give. `merge` gets the rows of
    up to `fan_in` states in no order; it has to give the same whatever pages met first. `order` is total inside
    a group, or its ties are alike. NULL keys are groups.
    """
    states = written(_applied(with_pages(rows, keys, order, page_items), keys, step, state))
    pages = (states.agg(F.max("page")).first()[0] or 0) + 1  # one number
    while pages > 1:
        paged = states.withColumn("page", F.call_function("div", F.col("page"), F.lit(fan_in)).cast("long"))
        states = written(_applied(paged, keys, merge, state))
        pages = -(-pages // fan_in)
    return _applied(states, keys, finish, out).drop("page")
