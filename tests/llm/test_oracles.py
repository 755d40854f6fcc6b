"""Queries with oracle SQL against DuckDB, on the whole small tables."""

import pytest

from guestfold.llm.queries import ORACLES, QUERIES
from helpers import canon, duck, duck_family, spark_family


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_its_oracle(spark, sf_dir, key):
    df = QUERIES[key](spark, sf_dir)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    con = duck(sf_dir)
    r = con.execute(ORACLES[key])
    cols = [d[0] for d in r.description]
    assert sorted(df.columns) == sorted(cols)
    assert {c: spark_family(t) for c, t in df.dtypes} == {d[0]: duck_family(d[1]) for d in r.description}
    assert got == canon(cols, r.fetchall())
