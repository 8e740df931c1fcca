import glob
import os

import duckdb
import pytest

import __spark_entry__ as E
from cefframe.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_registered():
    assert sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0])) == list(sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0])))
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted(tuple(str(r[i]) for i in order) for r in result.fetchall())
