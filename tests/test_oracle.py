"""Every registered query against its SQL twin, on all rows."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from oracle.statements import statements

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("customer", "orders", "lineitem", "events")
SQL = statements()
QUERIES = {k: q for k, q in driver.queries().items() if k in SQL}
CORPUS = set(driver.corpus.queries()) if driver.corpus else set()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    yield con
    con.close()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order)
        for r in data
    )


def test_every_query_has_a_twin():
    assert set(driver.queries()) - CORPUS == set(SQL)
    assert set(driver.oracle_sql()) <= set(driver.queries())


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    kinds = {f.name: KINDS[f.dataType.simpleString()] for f in got.schema}
    assert kinds == {r[0]: r[1] for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}

    want = duck.execute(SQL[name])
    want_rows = rows([c[0] for c in want.description], want.fetchall())
    assert want_rows, "the check says nothing on empty results"
    assert rows(got.columns, map(tuple, got.collect())) == want_rows
