"""Every registered query against its SQL twin on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402
from conftest import TINY  # noqa: E402

from tapelake.queries import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    return compare.connect(TINY)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    verdict = compare.compare(spark, duck, TINY, name)
    assert verdict.startswith("ok" if name in ORACLES else "rows only"), verdict


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
