from __future__ import annotations

import pytest
from compare import connect, difference

import __spark_entry__ as entry_file

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    result = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert difference(result, duck, ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_entry(spark):
    assert entry_file.entry(spark).columns == [
        "qualite", "saison", "nb", "montant_fcfa", "tonnage_kg", "prix_moyen_pondere",
    ]
