"""Every registered batch query against its DuckDB oracle on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.compare import TABLES, digest

# The llm queries have their own tests.
OWN = [n for n in E.queries() if not n.startswith("op") and n != "pipeline"] + ["orders_change_history"]
NAMES = sorted(set(OWN) - {"stream_resume", "stream_stateful"})


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    missing = set(OWN) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    o = duck.execute(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert len(s) == len(o)
    assert digest(s) == digest(o)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 667  # sf0.001: 951 deduplicated -> 667 kept


def test_fixture_anchors(spark):
    q = E.queries()
    assert q["dedup_earliest"](spark, SF_SMALL).count() == 951
