"""Every query has a SQL twin and gives the same rows."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from odolake.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES.split():
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, sf_dir, duck, name):
    found = QUERIES[name](spark, sf_dir)
    cols = sorted(found.columns)
    ours = sorted(([plain(row[c]) for c in cols] for row in found.collect()), key=str)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    theirs = sorted(([plain(row[i]) for i in at] for row in cursor.fetchall()), key=str)
    assert ours == theirs


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
