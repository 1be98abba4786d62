"""Every query that has a DuckDB twin returns the same table (names, types, values)."""

import pytest

from clickspark.plans.queries import ORACLE_SQL, QUERIES
from conftest import SF_SMALL
from helpers import table_rows


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, con, name):
    sp = QUERIES[name](spark, SF_SMALL).toArrow()
    dk = con.sql(ORACLE_SQL[name]).to_arrow_table()
    assert sp.num_rows == dk.num_rows
    assert {f.name: str(f.type) for f in sp.schema} == {f.name: str(f.type) for f in dk.schema}
    assert table_rows(sp) == table_rows(dk)


def test_every_query_is_registered_in_entry():
    import __spark_entry__ as e
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 70


@pytest.mark.parametrize("tz", ["America/Los_Angeles", "Asia/Kolkata"])
def test_time_features_do_not_depend_on_session_time_zone(spark, con, tz):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        for name in ("ctr_by_category", "histogram_numeric", "ctr_stream_hourly"):
            sp = QUERIES[name](spark, SF_SMALL).toArrow()
            assert table_rows(sp) == table_rows(con.sql(ORACLE_SQL[name]).to_arrow_table()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
