"""Every registered query against its DuckDB twin on sf0.001 (rows, columns, values)."""

import os
import sys

import pytest

from recspark.plans import REGISTRY

from conftest import SMOKE

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from check_contract import compare  # noqa: E402

NAMES = sorted(REGISTRY)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    status, rows, _, info = compare(spark, duck, SMOKE, name)
    assert status in ("ok", "rows-only"), info
    assert rows > 0
