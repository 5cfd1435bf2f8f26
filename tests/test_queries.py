"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import pytest
from compare import connect, differences

from workload.oracles import ORACLES
from workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, connection, name):
    assert differences(REGISTRY[name](spark, SF_DIR), connection, ORACLES[name]) is None
