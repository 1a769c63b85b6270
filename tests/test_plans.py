"""Plan-shape checks: no Python in the hot path, no unpartitioned window,
column pruning and filter push-down reach the scan."""

import pytest

from conftest import SF_SMALL
from lotguard.plans.queries import QUERIES

BATCH_KEYS = [k for k in QUERIES if not k.startswith("stream_")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", BATCH_KEYS)
def test_no_python_and_no_global_window(spark, key):
    p = plan_of(QUERIES[key](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert node not in p, f"{key}: {node}"
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # Allowed only above a partial aggregate (one row per task moves).
            assert "HashAggregate(keys=[], functions=[partial_" in lines[i + 1], f"{key}: unpartitioned exchange"


def test_scan_prunes_columns(spark):
    df = QUERIES["fingerprint"](spark, SF_SMALL)
    p = plan_of(df)
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in p


def test_filter_reaches_scan(spark):
    df = QUERIES["run_events_window"](spark, SF_SMALL)
    p = plan_of(df)
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


@pytest.mark.parametrize("key", ["divergences", "valid_lots", "human_review", "not_valid_keys", "violations",
                                 "rule_distribution", "validation_summary", "item_state"])
def test_rules_are_evaluated_once_per_row(spark, key):
    """No filter may re-evaluate the rule expression below its projection."""
    p = plan_of(QUERIES[key](spark, SF_SMALL))
    filters = [line for line in p.splitlines() if "Filter" in line]
    assert not any("Campos obrigat" in line for line in filters), key
    assert p.count("Campos obrigat") <= 1, key


@pytest.mark.parametrize("key", ["readback_reconcile", "handoff_flat"])
def test_joins_on_hot_keys_can_be_split(spark, key):
    """The aggregated side of a join on a key that many rows can have (lot,
    batch) is a written table: a scan, not an aggregate whose partitioning the
    join would have to keep."""
    p = plan_of(QUERIES[key](spark, SF_SMALL))
    joins = [i for i, line in enumerate(p.splitlines()) if "LeftOuter" in line or "Inner" in line]
    assert joins
    text = p.split("Initial Plan")[-1]
    table = {"readback_reconcile": "latest-stored", "handoff_flat": "batch-totals"}[key]
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line and table in line)
    exchange = max(i for i in range(scan) if "Exchange" in lines[i])
    assert not any("Aggregate" in line for line in lines[exchange:scan])


def test_listing_opens_no_file(spark, tmp_path):
    from lotguard.sources.files import listing

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x.png").write_bytes(b"abc")
    df = listing(spark, str(tmp_path))
    assert "content" not in plan_of(df).split("ReadSchema")[-1]
    assert [(r["path"].rsplit("/", 1)[1], r["length"]) for r in df.collect()] == [("x.png", 3)]
