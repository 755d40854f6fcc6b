"""Every registered query against its DuckDB oracle on the smallest scale factor
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as E
from helpers import canon, duck, duck_family, spark_family

from guestfold.plans import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES), sorted(set(QUERIES) ^ set(ORACLES))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, sf_dir, con, key):
    sdf = QUERIES[key](spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(ORACLES[key])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert canon(sdf.columns, s_rows) == canon(d_cols, d_rows)
    s_types = {f.name: spark_family(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {n: duck_family(t) for n, t in zip(d_cols, con.sql(ORACLES[key]).types)}
    assert s_types == d_types
