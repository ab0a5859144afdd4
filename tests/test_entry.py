"""The driver contract: entry smoke check and every query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, duck_connection
from conftest import SMALL_DIR


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["sch_org_id", "org_id", "inv_item_id", "m"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.LLM_QUERIES) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE_SQL)


GATE_DIR = "/root/testdata/sf0.01"  # the scale of the driver's correctness gate


@pytest.fixture(scope="module")
def ducks():
    return {d: duck_connection(d) for d in (SMALL_DIR, GATE_DIR)}


@pytest.mark.parametrize("data_dir", [SMALL_DIR, GATE_DIR])
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, ducks, name, data_dir):
    ok, message = compare(spark, ducks[data_dir], data_dir, name)
    assert ok, message
