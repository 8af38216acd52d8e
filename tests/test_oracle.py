"""Every SQL-expressible registered query equals its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from compare import assert_same
from conftest import SF_SMALL

ORACLE = E.oracle_sql()


SPARK_T = {"int": "INT32", "bigint": "INT64", "double": "DOUBLE", "string": "STRING", "date": "DATE", "boolean": "BOOL",
           "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
DUCK_T = {"BOOLEAN": "BOOL", "INTEGER": "INT32", "BIGINT": "INT64", "DOUBLE": "DOUBLE", "VARCHAR": "STRING", "DATE": "DATE",
          "TIMESTAMP": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_matches_oracle(spark, duck, key):
    frame = E.queries()[key](spark, SF_SMALL)
    got = frame.toPandas()
    want = duck.execute(ORACLE[key]).df()
    assert_same(got, want)
    rel = duck.sql(ORACLE[key])
    dt = {c: DUCK_T.get(str(t).upper(), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_T.get(t, t) for c, t in frame.dtypes} == dt


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["series", "date", "target_date", "split"]
    assert df.count() > 0
