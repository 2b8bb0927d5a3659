"""Every registered query against its SQL equivalent."""

import os

import pytest

import __spark_entry__ as driver
from ordertally.plans.oracles import ORACLES
from ordertally.plans.queries import QUERIES
from tests.compare import compare

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, name, SF_DIR) > 0


def test_entry(spark):
    assert driver.entry(spark).columns == ["source", "state", "total_sum_amount"]
