"""Every registered query against its DuckDB oracle on sf0.001 (the driver runs the
same comparison at sf0.01)."""

import pytest

from conftest import SF001
from oracle_compare import compare, duck
from strandline.plans.oracle import ORACLE_SQL
from strandline.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF001)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["bed_id", "ref_idx", "istart", "iend"]
    assert df.count() == 27
