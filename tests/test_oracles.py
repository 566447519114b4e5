"""Every registered query equals its DuckDB oracle on the smallest driver tables.

The same comparison the driver makes: row count, column names, and the
order-insensitive multiset of normalised values.
"""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from conftest import SF_SMALL
from fieldwise.plans.registry_all import all_queries
from fieldwise.sources.tables import DRIVER_TABLES

QUERIES = all_queries()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.6g}"
    if isinstance(v, dt.datetime):
        return (v.astimezone(dt.timezone.utc).replace(tzinfo=None) if v.tzinfo else v).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    reg = QUERIES[name]
    assert reg.sql is not None
    df = reg.build(spark, SF_SMALL)
    srows = df.collect()
    res = duck.execute(reg.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, res.fetchall())


_SPARK_FAMILY = [("bigint", "int64"), ("int", "int32"), ("double", "float64"), ("float", "float32"),
                 ("decimal", "decimal"), ("string", "string"), ("boolean", "bool"), ("timestamp_ntz", "timestamp"),
                 ("timestamp", "timestamp_tz"), ("date", "date")]
_DUCK_FAMILY = [("BIGINT", "int64"), ("INTEGER", "int32"), ("DOUBLE", "float64"), ("FLOAT", "float32"),
                ("DECIMAL", "decimal"), ("VARCHAR", "string"), ("BOOLEAN", "bool"),
                ("TIMESTAMP WITH TIME ZONE", "timestamp_tz"), ("TIMESTAMP", "timestamp"), ("DATE", "date")]


def _family(t, table):
    for prefix, fam in table:
        if t.startswith(prefix):
            return fam
    return t


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    reg = QUERIES[name]
    df = reg.build(spark, SF_SMALL)
    rel = duck.sql(reg.sql)
    duck_types = {c: _family(str(t).upper(), _DUCK_FAMILY) for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        assert _family(f.dataType.simpleString(), _SPARK_FAMILY) == duck_types[f.name], (name, f.name)
