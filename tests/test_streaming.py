"""Streaming twins agree with the batch operators."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lotguard.plans.queries import QUERIES


def test_stream_validate_equals_batch_twin(spark):
    s = QUERIES["stream_validate"](spark, SF_SMALL)
    b = QUERIES["all_exceptions"](spark, SF_SMALL).where(F.col("origin") == "validador").select("item_id")
    assert s.select("item_id").exceptAll(b).count() == 0 and b.exceptAll(s.select("item_id")).count() == 0


def test_stream_dedupe_equals_batch_twin(spark):
    s = QUERIES["stream_dedupe"](spark, SF_SMALL).select("item_id")
    b = QUERIES["dedupe_items"](spark, SF_SMALL).select("item_id")
    assert s.count() == b.count() and s.exceptAll(b).count() == 0


def test_stream_completeness_flags_short_batches(spark):
    s = QUERIES["stream_completeness"](spark, SF_SMALL)
    states = {r[0]: r[1] for r in s.groupBy("state").count().collect()}
    assert states.get("incomplete", 0) > 0 and states.get("released", 0) > 0
    # Re-delivered copies were removed before counting.
    assert s.where(F.col("received") > F.col("expected")).count() == 0


def test_triggers_do_not_matter(spark, tmp_path):
    """One file per trigger and all at once: the same items and batches."""
    from lotguard.plans.queries import _landed
    from lotguard.streaming import stream as ST

    whole = QUERIES["stream_completeness"](spark, SF_SMALL)
    one = ST.run_to_parquet(ST.dedupe_stream(_landed(spark, SF_SMALL, with_copies=True, short_declared=True, files_per_trigger=1)), "one")
    again = ST.completeness(one, F.current_timestamp() + F.expr("interval 2 days"))
    assert one.count() == QUERIES["dedupe_items"](spark, SF_SMALL).count()
    assert whole.exceptAll(again).count() == 0 and again.exceptAll(whole).count() == 0
    assert whole.count() == QUERIES["batch_header"](spark, SF_SMALL).count()


def test_batches_are_released_pending_incomplete_or_late(spark, tmp_path):
    from lotguard.streaming import stream as ST

    schema = "batch_id string, item_id string, batch_total int"
    land = str(tmp_path / "land")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def rows(data, at):
        return ST.with_event_time(spark.createDataFrame(data, schema), at)

    first = rows([("A", "a1", 2), ("A", "a2", 2), ("A", "a2", 2), ("B", "b1", 2)], "2026-01-01 00:00:00")
    ST.land(first, land)
    src = lambda: ST.source(spark, land, first.schema)
    ST.run_to_parquet(ST.dedupe_stream(src()), "c", out=out, ckpt=ckpt)
    ST.land(rows([("C", "c1", 3), ("D", "d1", 1), ("B", "b1", 2)], "2026-01-01 12:00:00"), land)
    got = ST.run_to_parquet(ST.dedupe_stream(src()), "c", out=out, ckpt=ckpt)
    states = {r["batch_id"]: r["state"] for r in ST.completeness(got, F.lit("2026-01-02 06:00:00").cast("timestamp")).collect()}
    assert states == {"A": "released", "B": "incomplete", "C": "pending", "D": "released"}
    counted = ST.completeness(got).where("batch_id <> 'D'")
    ST.land(rows([("A", "a3", 2)], "2026-01-09 00:00:00"), land)
    acc = {r["batch_id"]: (r["arrived"], r["counted"], r["state"])
           for r in ST.completeness_accounting(spark.read.parquet(land), counted).collect()}
    assert acc["A"] == (3, 2, "late_items") and acc["B"] == (1, 1, "ok") and acc["D"] == (1, 0, "pending")
