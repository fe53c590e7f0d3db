"""Every query on graphs against its DuckDB SQL on the smallest test tables."""

import os

import pytest

import __spark_entry__ as E
from linkrank.plans import catalog, oracle
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


NAMES = sorted(catalog.QUERIES)


@tables
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF, con)
    assert r["match"], r


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.statements())
    assert set(catalog.QUERIES) <= set(E.queries())


@tables
def test_queries_keep_no_state(spark, tmp_path):
    import shutil

    for name in ("part", "lineitem"):
        shutil.copyfile(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    first = catalog.q_graph_summary(spark, str(tmp_path)).collect()
    half = spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_orderkey % 2 = 0").toPandas()
    half.to_parquet(tmp_path / "lineitem.parquet", coerce_timestamps="us")
    second = catalog.q_graph_summary(spark, str(tmp_path)).collect()
    assert second[0].n_edges == len(half) < first[0].n_edges


@tables
def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert len(rows) == 10 and rows[0].position == 1
