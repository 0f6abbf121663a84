"""Every registered query against its SQL, over the smallest tables."""

import math

import duckdb
import pytest

from inkspan import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="session")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got, "no rows"
    sql = registry.oracle_sql().get(name)
    if sql:
        rel = duck.sql(sql)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        assert got == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)


def test_entry(spark):
    import __spark_entry__ as E

    assert E.entry(spark).columns == ["source_key", "year", "item_count", "geocoded_item_count", "mention_count", "avg_best_confidence"]
    assert set(E.oracle_sql()) <= set(E.queries())
