"""Queries of the subpackage against their SQL twins."""

import os

import duckdb
import pytest

from tapeworks.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == columns
    rows = sorted((tuple(r[names.index(c)] for c in columns) for r in want.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == rows


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_held_out_languages(spark):
    got = registry.op3_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.95 * len(got)
