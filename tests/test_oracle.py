"""Every registered batch query against its DuckDB oracle on sf0.001
(the driver repeats this at sf0.01)."""

import pytest

from conftest import SF_SMALL
from lotguard.plans.oracle import SQL
from lotguard.plans.queries import QUERIES
from oracle_harness import compare, duck

KEYS = sorted(k for k in QUERIES if k in SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_batch_key_has_an_oracle():
    missing = [k for k in QUERIES if k not in SQL and not k.startswith("stream_")]
    assert missing == []


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, QUERIES[key], SQL[key], con)
    assert r["schema"] and r["hash"] and r["rows"] == r["oracle_rows"], r
