"""Driver contract: entry runs, every query has an oracle, and agrees with it at sf0.001."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from strata.plans import registry
from strata.plans.tables import TABLES


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["event_id", "device_id", "facility_id", "event_date", "value"]


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def _canon(v):
    if v is None:
        return "∅"
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return "nan" if math.isnan(f) else f"{f:.9g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


EXACT = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
         "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz"}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_matches_oracle_sf0001(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    d_types = {c: EXACT.get(str(t), str(t).lower().replace(" ", "")) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in sdf.schema.fields} == d_types
    s_idx = sorted(range(len(sdf.columns)), key=lambda i: sdf.columns[i])
    d_idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    s = sorted(tuple(_canon(r[i]) for i in s_idx) for r in sdf.collect())
    d = sorted(tuple(_canon(r[i]) for i in d_idx) for r in rel.fetchall())
    assert s == d
