"""Transposing by tiles.

Rows are numbered while they are range-partitioned, and cut where they lie into tiles of neighbouring rows and
columns. A tile is turned inside its task, in Arrow columns: each of its columns becomes one piece of that
column's line. So what is shuffled is one row per tile and not one per cell, and no cell carries a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.operators.lists import PAGE_ITEMS
from genoweave.operators.positions import running_position

#: Rows and columns of a tile.
TILE_ROWS, TILE_COLUMNS = 512, 256


def _cuts(pages: np.ndarray, places: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Runs of neighbouring rows of one page, of at most `rows` rows."""
    if not len(places):
        return []
    breaks = np.flatnonzero((np.diff(places) != 1) | (np.diff(pages) != 0)) + 1
    edges = [0, *breaks.tolist(), len(places)]
    return [(k, min(k + rows, b)) for a, b in zip(edges[:-1], edges[1:]) for k in range(a, b, rows)]


def turned(batches: Iterator[pa.RecordBatch], names: list[str], separator: str, rows: int, columns: int) -> Iterator[pa.RecordBatch]:
    """Numbered rows (`names`, `_page`, `_place`) in, tiles (`page`, `chunk`, `start`, `pieces`) out."""
    for batch in batches:
        pages, places = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_page", "_place"))
        cuts = _cuts(pages, places, rows)
        if not cuts:
            continue
        offsets = pa.array([a for a, _ in cuts] + [len(places)], pa.int32())
        tiles: list[tuple] = []
        for chunk, first in enumerate(range(0, len(names), columns)):
            joined = []
            for name in names[first : first + columns]:
                values = pc.fill_null(batch.column(name), "")
                if separator:
                    values = pc.replace_substring(values, separator, "")
                # The runs lie side by side, so the column is one list per run.
                joined.append(pc.binary_join(pa.ListArray.from_arrays(offsets, values), separator).to_pylist())
            tiles += [(pages[a], chunk, places[a], [x[k] for x in joined]) for k, (a, _) in enumerate(cuts)]
        page, chunk, start, pieces = zip(*tiles)
        arrays = [pa.array(page, pa.int64()), pa.array(chunk, pa.int32()), pa.array(start, pa.int64()), pa.array(pieces, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(arrays, ["page", "chunk", "start", "pieces"])


def tiles(
    df: DataFrame, order: list[str], separator: str = ",", page_items: int = PAGE_ITEMS, tile_rows: int = TILE_ROWS,
    tile_columns: int = TILE_COLUMNS,
) -> DataFrame:
    """`page`, `chunk` of columns, `start` row, and the piece of each of the chunk's columns."""
    names = df.columns
    placed = running_position(df, [], order, "_place")
    page = F.call_function("div", F.col("_place"), F.lit(page_items)).cast("long")
    text = placed.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in names], page.alias("_page"), "_place")
    return text.mapInArrow(
        lambda b: turned(b, names, separator, tile_rows, tile_columns), "page long, chunk int, start long, pieces array<string>"
    )


def transpose_tiles(
    df: DataFrame, order: list[str], separator: str = ",", page_items: int = PAGE_ITEMS, tile_rows: int = TILE_ROWS,
    tile_columns: int = TILE_COLUMNS,
) -> DataFrame:
    """The lines of `transpose_lines` (column, page, line), for tables of very many columns.

    One line per column and page of `page_items` rows, values in the (total) order, the separator removed from them,
    missing ones empty. A task gathers the tiles of one page and `tile_columns` columns.
    """
    names = df.columns
    cut = tiles(df, order, separator, page_items, tile_rows, tile_columns)
    whole = cut.groupBy("page", "chunk").agg(F.array_sort(F.collect_list(F.struct("start", "pieces"))).alias("tiles"))
    width = F.size(F.col("tiles")[0]["pieces"])
    lines = F.transform(F.sequence(F.lit(0), width - 1), lambda k: F.array_join(F.transform("tiles", lambda t: t["pieces"][k]), separator))
    rows = whole.select("page", "chunk", F.posexplode(lines).alias("at", "line"))
    return rows.select(F.element_at(F.lit(names), F.col("chunk") * tile_columns + F.col("at") + 1).alias("column"), "page", "line")
