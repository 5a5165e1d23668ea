"""Every registered query against its check SQL, on the smallest scale."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tools.check import compare, duck
from workload.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_check_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, SF, name)
    assert verdict.startswith("ok"), verdict
