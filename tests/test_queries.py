"""Every query of the library against its SQL on the small tables."""

import pytest

from tessera import plans
from tests.compare import connect, same

NAMES = sorted(plans.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(plans.oracle_sql()) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(name, spark, sf_dir, con):
    same(plans.queries()[name](spark, sf_dir), con, plans.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() >= 1
