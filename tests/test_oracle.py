"""Every registered query against its SQL, run by DuckDB on the same tables."""

import datetime as dt
import decimal
import glob
import math
import os

import duckdb
import pytest

from tracewell.catalogue import shop, stores, streams, telemetry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {**telemetry.QUERIES, **shop.QUERIES, **streams.QUERIES, **stores.QUERIES}
ORACLE = {**telemetry.ORACLE, **shop.ORACLE, **streams.ORACLE, **stores.ORACLE}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLE[name])
    want = canonical([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert len(got[1]) > 0
    assert got[1] == want[1]
