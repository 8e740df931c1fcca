import os

import duckdb
import pytest

import __spark_entry__ as E
from cefframe.plans.catalogue import CATALOGUE

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["SignatureID", "n_events", "max_event_id", "first_rt_ms", "n_users"]
    assert df.count() > 0


def test_every_catalogue_query_has_an_oracle():
    assert set(CATALOGUE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["parse_typed", "parse_timestamps", "pivot_partial", "mode_corrupt_column",
                                  "encode_text_escapes", "infer_schema"])
def test_query_matches_oracle(spark, name):
    df = E.queries()[name](spark, SF)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    con = duckdb.connect()
    for t in ("events", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(str(r[i]) for i in order) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
