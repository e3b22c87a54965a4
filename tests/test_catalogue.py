"""Every registered query of the main library against its SQL twin in DuckDB."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

from tapeworks.plans import catalogue
from tapeworks.plans.market import INPUTS, TABLES, needed

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def canonical(rows, columns):
    def plain(x):
        if isinstance(x, decimal.Decimal):
            x = float(x)
        if isinstance(x, dt.datetime):
            return x.replace(tzinfo=None)
        if isinstance(x, float):
            return None if math.isnan(x) else float(f"{x:.9g}")
        return x

    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@needs_tables
@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    got = canonical(df.collect(), df.columns)
    result = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert got == canonical(result.fetchall(), columns)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


def test_inputs_come_after_what_they_need():
    order = needed(INPUTS["metric_mixed"])
    assert order.index("metric_base") < order.index("metric")


@needs_tables
def test_the_stored_spine_follows_its_tables(spark, tmp_path):
    import shutil

    for t in "part nation region orders supplier lineitem customer".split():
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    spine = lambda: catalogue._spine(catalogue.Market(spark, str(tmp_path)))
    first = spine()
    assert spine().inputFiles() == first.inputFiles()
    half = spark.read.parquet(f"{SF}/part.parquet").where("p_partkey % 2 = 0").coalesce(1)
    half.write.parquet(str(tmp_path / "half"))
    shutil.copy(next((tmp_path / "half").glob("*.parquet")), tmp_path / "part.parquet")
    assert spine().count() == half.count() < first.count()
    shutil.rmtree(spine().inputFiles()[0].split("/part-")[0].removeprefix("file://"))
    assert spine().count() == half.count()
