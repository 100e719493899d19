"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402
from dimflow.plans.catalog import QUERIES  # noqa: E402
from tools.check_oracle import normal  # noqa: E402

TABLES = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_a_twin():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_twin(spark, db, name):
    got = contract.queries()[name](spark, str(TABLES)).toPandas()
    want = db.execute(contract.oracle_sql()[name]).fetchdf()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
