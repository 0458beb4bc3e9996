"""Every changelog query against its SQL, on the smallest tables."""

import math
import os

import pytest

from tidemark.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return repr(v) if not hasattr(v, "isoformat") else v.isoformat()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = catalogue.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    got = duck.execute(catalogue.ORACLES[name])
    names = [d[0] for d in got.description]
    assert sorted(names) == columns
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall())
    assert ours == theirs


def test_entry(spark):
    import __spark_entry__

    got = __spark_entry__.entry(spark)
    assert got.columns == ["server_id", "trx", "gtid", "rows"] and got.count() > 0
