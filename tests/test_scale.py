"""What moves and is written per row: narrow shuffles, tables that keep the
order of their batches, small tables broadcast, packed logs."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lotguard.functions import constants as K
from lotguard.operators import admission as A
from lotguard.operators import eventlog as EL
from lotguard.operators import queue as QU
from lotguard.operators import rules as R
from lotguard.operators import validate as VAL
from lotguard.operators.store import BatchTable, read_pending
from lotguard.plans import queries as Q
from lotguard.plans.materialize import landed
from lotguard.session import known_small
from lotguard.sources import testdata as td


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(spark, n=40):
    cols = {c: F.lit("x") for c in K.CONTRACT_COLUMNS} | {"lote_id": F.concat(F.lit("LG-"), F.col("id").cast("string"))}
    return spark.range(n).select(
        F.concat(F.lit("i-"), "id").alias("item_id"), F.concat(F.lit("b-"), F.col("id") % 3).alias("batch_id"), F.col("id").cast("int").alias("source_row"),
        *[F.lit("s").alias(c) for c in ("source_file", "source_hash")], F.lit("15/06/2026").alias("reference_date"), *[v.alias(k) for k, v in cols.items()])


def test_a_table_is_landed_without_a_shuffle(spark):
    got = landed(spark, SF_SMALL, "test-in-order", lambda: spark.range(0, 900, 1, 3))
    per = got.groupBy(F.input_file_name()).agg(F.min("id"), F.max("id")).collect()
    assert sorted((r[1], r[2]) for r in per) == [(0, 299), (300, 599), (600, 899)]


def test_texts_of_lots_are_made_behind_the_shuffles(spark):
    p = plan_of(td.lots(spark, SF_SMALL))
    assert "sha2" in p and p.rindex("sha2") < p.index("Exchange")


def test_reference_join_sorts_no_rows_and_carries_no_context(spark):
    ref = spark.createDataFrame([("LG-1",), ("LG-2",)], "lote_id string")
    df = R.evaluate(_rows(spark), ref)
    p = plan_of(df)
    assert "ShuffledHashJoin" in p and "SortMergeJoin" not in p
    assert "_status_canon" not in p[p.index("ShuffledHashJoin"):]
    found = df.where(~F.exists("violations", lambda v: v["regra"] == "RN03"))
    assert sorted(r[0] for r in found.select("lote_id").collect()) == ["LG-1", "LG-2"]


def test_totals_of_few_batches_are_broadcast(spark):
    rows = A.admit(_rows(spark))
    df = A.handoff(rows, spark.createDataFrame([("LG-1",)], "lote_id string"), published_only=False)
    assert len(re.findall("BroadcastHashJoin", plan_of(df))) == 1
    assert {r[0]: r[1] for r in df.select("batch_id", "batch_total").distinct().collect()} == {"b-0": 14, "b-1": 13, "b-2": 13}
    assert "broadcast" not in known_small(spark.range(5), rows=4)._jdf.queryExecution().analyzed().toString()


def test_batches_are_read_without_moving_their_rows(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"))
    rows = _rows(spark).select("batch_id", "item_id", "source_row")
    table.publish(rows)
    table.publish(rows.where("batch_id = 'b-1'").limit(5))
    for df in (table.rows(), read_pending(table, mode="all")):
        p = plan_of(df)  # the data's scan is under no exchange
        assert p.index("BroadcastHashJoin") < p.index("FileScan") < p.index("Exchange")
        assert {r[0]: r[1] for r in df.groupBy("batch_id").count().collect()} == {"b-0": 14, "b-1": 5, "b-2": 13}


def test_abort_states_move_no_items(spark):
    states = spark.createDataFrame([("i1", "b1", K.STATE_PROCESSING, "", ""), ("i2", "b2", K.STATE_PROCESSING, "", ""), ("i3", None, K.STATE_DONE, "", "")],
                                   "item_id string, batch_id string, datapool_state string, error_type string, finish_message string")
    df = VAL.abort_states(states, spark.createDataFrame([("b1", "broken"), ("b1", "broken")], "batch_id string, error string"))
    assert "SortMergeJoin" not in plan_of(df) and "BroadcastHashJoin" in plan_of(df)
    assert sorted((r["item_id"], r["datapool_state"], r["finish_message"]) for r in df.collect()) == [
        ("i1", K.STATE_ERROR, "broken"), ("i2", K.STATE_PROCESSING, ""), ("i3", K.STATE_DONE, "")]


def test_places_of_a_queue_are_found_once(spark):
    queue = spark.createDataFrame([("q", 1, "i1", "b1", 2), ("q", 2, "i2", "b2", 1), ("q", 3, "i3", "b1", 2)],
                                  "queue_id string, seq long, item_id string, batch_id string, batch_total int")
    df = QU.batch_integrity(queue)
    p = plan_of(df)
    assert p.count("row_number") == 0 and "placed" in p
    assert [(r["task_id"], r["problem"]) for r in df.collect()] == [("task-b1", "foreign_item")]


def test_session_totals_move_no_items(spark):
    queue = spark.range(20).select(F.lit("q").alias("queue_id"), F.concat(F.lit("i"), "id").alias("item_id"), F.lit("b").alias("batch_id"), (F.col("id") % 4 + 4).cast("int").alias("day"))
    df = td.taken_up_sessions(queue)
    assert "SortMergeJoin" not in plan_of(df)
    assert {r[0]: r[1] for r in df.select("task_id", "batch_total").distinct().collect()} == {"session-q-2": 5, "session-q-3": 11, "session-q-4": 5}


def test_log_lines_are_packed(spark, tmp_path):
    lines = EL.log_lines(_rows(spark).select("batch_id", "lote_id", "source_row", F.lit("INFO").alias("level"), F.lit("e").alias("event")), "x", "bot")
    EL.write_event_log(lines, str(tmp_path), "r")
    files = list(tmp_path.rglob("part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)
    assert EL.read_event_log(spark, str(tmp_path)).where("_corrupt is null").count() == 40


def test_streams_keep_only_what_is_asked_of_them(spark, monkeypatch):
    seen = []
    real = Q.ST.dedupe_stream
    monkeypatch.setattr(Q.ST, "dedupe_stream", lambda s, *a: seen.append(set(s.columns)) or real(s, *a))
    assert Q.QUERIES["stream_completeness"](spark, SF_SMALL).count() > 0
    assert seen == [{"item_id", "batch_id", "batch_total", "event_time"}]


def test_a_large_publication_has_more_files(spark, monkeypatch):
    want = sorted(map(tuple, Q.QUERIES["stream_ingest"](spark, SF_SMALL).collect()))
    landed_files, real = [], Q.ST.land
    monkeypatch.setattr(Q.ST, "land", lambda rows, path: landed_files.append(rows.rdd.getNumPartitions()) or real(rows, path))
    monkeypatch.setattr(Q, "PUBLISHED_ROWS", 100)
    assert sorted(map(tuple, Q.QUERIES["stream_ingest"](spark, SF_SMALL).collect())) == want
    assert max(landed_files) > 2
