"""Every query against its SQL twin."""

import os

import pytest

from conftest import DATA
from oracle import connect, same
from tideframe.plans import batches, jobs, registry  # noqa: F401

SF = os.environ.get("TEST_SF", "sf0.001")


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, name):
    df = registry.QUERIES[name](spark, f"{DATA}/{SF}")
    same(df, connect(f"{DATA}/{SF}"), registry.ORACLE[name])
