"""Every registered query against its SQL, over the whole sf0.01 tables."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from tests.conftest import SF
from verification import oracle, registry
from verification.compare import difference, duck, oracle_rows

QUERIES = registry.queries()
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    columns, expected = oracle_rows(con, SQL[name])
    assert expected, "the oracle must have something to say"
    assert difference(QUERIES[name](spark, SF), columns, expected) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "country_code"
    assert df.count() > 0


def test_entry_without_the_training_data_operators():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "from verification import registry; assert set(e.queries()) == set(registry.queries()) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
