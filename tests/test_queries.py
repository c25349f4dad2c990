"""Every registered query against its SQL: names, types, row count and values."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import __spark_entry__ as entry
import catalog
import duckdb
import pyarrow as pa
import pytest

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def text(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, Decimal) and value == int(value):
        return repr(int(value))
    return repr(value)


def rows(table, columns):
    return sorted(tuple(text(r[c]) for c in columns) for r in table.select(columns).to_pylist())


def test_every_query_has_sql():
    assert catalog.QUERIES.keys() == catalog.ORACLES.keys()
    assert catalog.QUERIES.keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toArrow()
    expected = duck.sql(entry.oracle_sql()[name]).arrow()
    if not isinstance(expected, pa.Table):
        expected = expected.read_all()
    columns = sorted(got.column_names)
    assert columns == sorted(expected.column_names)
    assert [got.schema.field(c).type for c in columns] == [
        expected.schema.field(c).type for c in columns
    ]
    assert rows(got, columns) == rows(expected, columns)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["location", "terminal", "sensor", "bucket"]
