"""Every registered query against DuckDB on the small tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tidecast.queries import REGISTRY  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


def test_inventory_is_complete():
    sizes = {
        "SRC": 11, "SNK": 13, "PRJ": 28, "JN": 19, "AGG": 25, "WIN": 7, "TOP": 7, "SET": 3, "STR": 9, "ML": 19,
        "QA": 12, "RPT": 3,
    }
    want = {f"{p}-{i}" for p, n in sizes.items() for i in range(1, n + 1)}
    want |= {f"Q{i:02d}" for i in range(1, 36)}
    want |= {f"FN-{f}" for f in ("str", "date", "math", "json", "map", "hash", "cast", "cond")}
    assert want == set(REGISTRY) <= set(entry.queries())
    assert want <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("key", list(REGISTRY))
def test_against_duckdb(spark, con, sf, key):
    state, note = check.compare(spark, con, key, sf)
    assert state in ("exact", "EMPTY") and (state == "exact" or " 0 rows" in note), note
