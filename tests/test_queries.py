"""Every query of the library against its SQL."""

import datetime
import math

import pytest

from lakevec.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA


def norm(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, oracle, name):
    df = QUERIES[name](spark, f"{DATA}/sf0.001")
    columns, want = oracle(ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(columns)
    order = [columns.index(c) for c in df.columns]
    got = sorted(tuple(map(norm, r)) for r in df.collect())
    assert got == sorted(tuple(norm(r[i]) for i in order) for r in want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
