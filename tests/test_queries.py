"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

from tollway.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        con.sql(f"create view {t} as select * from read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


def normal(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)].astype(object)
    return sorted(tuple(normal(v) for v in r) for r in pdf.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, duck, name):
    ours, theirs = catalog.queries()[name](spark, SF).toPandas(), duck.sql(catalog.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_others_have_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 8
    assert set(catalog.queries()) <= set(entry.queries())
    assert set(catalog.oracle_sql()) <= set(entry.oracle_sql())


def test_scan_is_pruned(spark):
    plan = catalog.queries()["gap_histogram"](spark, SF)._jdf.queryExecution().toString()
    assert "props" not in plan.split("Physical Plan")[-1] and "value#" not in plan.split("Physical Plan")[-1]
