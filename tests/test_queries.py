"""Every registered query against its DuckDB oracle on the smallest tables,
and a plan check: no Python evaluation anywhere."""

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.check_oracle import TABLES, multiset
from strata.plans.inspect import python_nodes
from tests.conftest import SF_SMALL

from strata.plans.queries import QUERIES
from strata.plans.oracles import ORACLES


# Compares one merged schema of each source and day in Python, nothing per record.
SMALL_PYTHON = {"schema_drift"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert python_nodes(df) == [] or name in SMALL_PYTHON
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert rows
        return
    res = duck.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert multiset(df.columns, rows) == multiset(cols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["center_id", "event_timestamp"]


@pytest.mark.parametrize("name", ["dq_verdicts", "envelope_flights", "missing_hours",
                                  "traffic_curated"])
def test_query_independent_of_session_zone_and_ansi(spark, duck, name):
    """The driver's session may use another zone or ANSI off: results must
    not change (size(NULL) is -1 without ANSI, zones shift wall clocks)."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.session.timeZone")}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    res = duck.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert multiset(df.columns, rows) == multiset(cols, res.fetchall())
