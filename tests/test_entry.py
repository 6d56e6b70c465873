import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folium.plans import registry
from tests.conftest import TINY


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(TINY + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    df = registry.queries()[name](spark, TINY)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(x) for x in r) for r in df.select(*[F.col(f"`{c}`") for c in cols]).collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql:
        r = duck.execute(sql)
        names = [c[0] for c in r.description]
        order = sorted(range(len(names)), key=lambda i: names[i])
        assert sorted(names) == cols
        assert sorted((tuple(norm(x[i]) for i in order) for x in r.fetchall()), key=repr) == got


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
