import pytest

from clickspark.llm.queries import ORACLE_SQL, QUERIES
from helpers import table_rows
from llm_data import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_duckdb(spark, duck, name):
    got, want = QUERIES[name](spark, SF_SMALL).toArrow(), duck(SF_SMALL).sql(ORACLE_SQL[name]).to_arrow_table()
    assert {f.name: str(f.type) for f in got.schema} == {f.name: str(f.type) for f in want.schema}
    assert table_rows(got) == table_rows(want)


def test_every_operator_is_registered_once():
    import __spark_entry__ as e
    numbers = sorted(int(n[2:].split("_")[0]) for n in e.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14)) and "pipeline" in e.queries()
