import re
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from genoweave.plans.registered import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")

# Queries that run Python on executors, in Arrow batches: a data source, tiles, a caller's own functions.
PYTHON = {"scan_vcf_blocks", "vcf_block_region", "transpose_tiles", "typed_info_alleles", "top_values_bounded", "user_distinct_concat"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_oracle(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    text = plan(df)
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text or (node == "Python" and name in PYTHON)
    # A window without keys may only run over one row per range partition or file block.
    for first in re.findall(r"windowspecdefinition\(([^,]*)", text):
        assert not re.search(r" (ASC|DESC)", first) or re.match(r"(_segment|file)#", first)
    ours = ordered(df.columns, [tuple(r) for r in df.collect()])
    theirs = tables.sql(ORACLES[name])
    assert ours == ordered(theirs.columns, theirs.fetchall())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and ORACLES.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_peptide_strings_shuffle_calls_once(spark):
    from genoweave.plans import flows
    from genoweave.plans.inputs import Inputs
    from genoweave.plans.queries_sites import codes
    from genoweave.session import written

    x = Inputs(spark, FOLDER)
    calls, book = written(x.calls), written(codes(x))
    text = plan(flows.gene_peptides(flows.decode_genotypes(calls, book)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<patient:string,rsid:string,gt:string>" in text
