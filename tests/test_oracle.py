"""Every registered query against its SQL on the smallest data."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries  # noqa: E402
from leadlake.plans.oracles import ORACLES  # noqa: E402
from leadlake.plans.registry import QUERIES  # noqa: E402
from tests.oracle_check import compare, connect  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return connect(SMOKE_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["intent_level", "lead_count", "avg_score"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(spark, duck, QUERIES[name], ORACLES[name], SMOKE_DIR) == ""
