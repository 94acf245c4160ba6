"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import os

import oracle
import pytest

from assayline.registered import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_same_rows(spark, con, key):
    assert oracle.compare(spark, con, QUERIES[key], ORACLES[key], SF_DIR) == []
