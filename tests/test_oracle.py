"""Every registered query against its DuckDB oracle on the sf0.01 tables.

``TILLROLL_ORACLE_SF=/root/testdata/sf0.1`` runs the same comparison on
another scale.
"""

import os

import pytest

import __spark_entry__ as entry_mod
from tillroll.plans.catalog import QUERIES
from tests.conftest import SF01
from tests.oracle_util import compare, duck

ORACLE = {name: sql for name, sql in entry_mod.oracle_sql().items() if name in QUERIES}


SF = os.environ.get("TILLROLL_ORACLE_SF", SF01)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle_or_is_listed():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert set(missing) <= set(getattr(entry_mod, "NO_ORACLE", ())), missing


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    problems, n = compare(df, con, ORACLE[name])
    assert not problems, (name, problems)
