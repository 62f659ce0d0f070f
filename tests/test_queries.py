import pytest

from oracle import compare, connect
from photospark.plans import registry


@pytest.fixture(scope="session")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(spark, con, sf, name):
    n, _ = compare(spark, con, registry.QUERIES[name], registry.ORACLES[name], sf)
    assert n > 0


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0
