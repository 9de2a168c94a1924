import pytest

import __spark_entry__ as entry_mod
from tabelion.oracle import compare
from tabelion.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns[0] == "cnpj" and df.count() > 0


def test_registry_queries_have_an_oracle():
    assert set(QUERIES) <= set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    r = compare(entry_mod.queries()[name](spark, SF), entry_mod.oracle_sql()[name], SF)
    assert r["rows_match"] and r["schema_match"] and r["value_match"], r
