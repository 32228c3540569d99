"""Queries with SQL: both give the same rows."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from genoweave.llm.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    tables = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        tables.execute(f"create view {path.stem} as select * from '{path}'")
    theirs = tables.sql(ORACLES[name])
    ours = QUERIES[name](spark, str(FOLDER)).select(*theirs.columns)
    assert Counter(map(tuple, ours.collect())) == Counter(theirs.fetchall())
