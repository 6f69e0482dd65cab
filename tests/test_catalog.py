import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from compare_oracle import digest  # noqa: E402
from corpusmill.session import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
#: training-data queries without SQL are tested against plain versions in their own folder
NO_ORACLE = {n for n in E.queries() if n.startswith("op") or n == "pipeline"} - set(E.oracle_sql())


def test_contract_keys():
    qs, oracle = E.queries(), E.oracle_sql()
    assert set(oracle) <= set(qs)
    assert set(qs) - set(oracle) == NO_ORACLE
    assert len(qs) >= 50


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"create or replace view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
