"""Stream ingest: the same tables for any trigger size and after restarts."""

import random

import pytest
from pyspark.sql import functions as F

from lotguard.streaming import stream as ST
from lotguard.streaming.ingest import Ingest

SCHEMA = "item_id string, batch_id string, batch_total int"


def rows(spark, data, hour):
    at = f"2026-01-{1 + hour // 24:02d} {hour % 24:02d}:00:00"
    return ST.with_event_time(spark.createDataFrame(data, SCHEMA), at)


def states(ingest):
    return {r["batch_id"]: (r["received"], r["expected"], r["state"]) for r in ingest.batches().collect()}


#: (hour, items): A is released at once, B late and short, C late but whole
#: before its deadline, D amended by a further item, E waits.
PUBLICATIONS = [
    (0, [("a1", "A", 2), ("a2", "A", 2), ("a2", "A", 2), ("b1", "B", 3), ("b2", "B", 3)]),
    (5, [("c1", "C", 2), ("a1", "A", 2), ("d1", "D", 1)]),
    (20, [("c2", "C", 2), ("d2", "D", 1)]),
    (30, [("b3", "B", 3), ("b1", "B", 3)]),
    (80, [("a2", "A", 2), ("e1", "E", 2), ("c1", "C", 2)]),
]
WANT = {"A": (2, 2, "released"), "B": (2, 3, "incomplete"), "C": (2, 2, "released"), "D": (2, 1, "overfull"), "E": (1, 2, "pending")}


def check(ingest):
    assert states(ingest) == WANT
    assert sorted(r["item_id"] for r in ingest.items().collect()) == ["a1", "a2", "b1", "b2", "b3", "c1", "c2", "d1", "d2", "e1"]
    assert [(r["item_id"], r["batch_id"]) for r in ingest.late_items().collect()] == [("b3", "B")]


@pytest.mark.parametrize("files", [1, 3, None])
def test_trigger_sizes(spark, tmp_path, files):
    land = str(tmp_path / "land")
    for hour, data in PUBLICATIONS:
        ST.land(rows(spark, data, hour).repartition(2), land)
    ingest = Ingest(spark, str(tmp_path / "in"), buckets=4)
    ingest.run(ST.source(spark, land, rows(spark, PUBLICATIONS[0][1], 0).schema, files))
    check(ingest)
    last = ingest._state("open", None).agg(F.max("epoch")).first()[0]
    waiting = spark.read.parquet(f"{ingest.root}/open/epoch={last}")
    assert [r["batch_id"] for r in waiting.collect()] == ["E"]  # all others left the open table


def test_restarts_and_an_epoch_run_twice(spark, tmp_path):
    land = str(tmp_path / "land")
    schema = rows(spark, PUBLICATIONS[0][1], 0).schema
    for n, (hour, data) in enumerate(PUBLICATIONS):
        ST.land(rows(spark, data, hour), land)
        Ingest(spark, str(tmp_path / "in")).run(ST.source(spark, land, schema))
        if n == 1:
            assert states(Ingest(spark, str(tmp_path / "in")))["B"] == (2, 3, "pending")
    ingest = Ingest(spark, str(tmp_path / "in"))
    check(ingest)
    # the last epoch broke off and comes again
    last = spark.read.parquet(f"{ingest.root}/clock").agg(F.max("epoch")).first()[0]
    ingest.step(rows(spark, PUBLICATIONS[-1][1], 80), last)
    check(ingest)


def test_against_plain_counts(spark, tmp_path):
    rnd = random.Random(9)
    items = {f"{b}{i}": b for b in "ABCDEFGH" for i in range(rnd.randint(1, 9))}
    total = {b: sum(x == b for x in items.values()) + rnd.choice([0, 0, 1, -1]) for b in "ABCDEFGH"}
    base = {b: rnd.randrange(40) for b in total}
    events = [(base[b] + rnd.choice([0, 0, 3, 20, 24, 25, 40]), i, b) for i, b in items.items()]
    events += [(h + rnd.randrange(60), i, b) for h, i, b in events if rnd.random() < 0.5]
    events.sort()
    clock, first, seen = events[-1][0], {}, {}
    for h, i, b in events:
        first.setdefault(b, h)
        seen.setdefault(i, h)
    want = {}
    for b, t in total.items():
        n = sum(seen[i] <= first[b] + 24 for i, x in items.items() if x == b)
        want[b] = (n, t, "released" if n == t else "overfull" if n > t else "incomplete" if first[b] + 24 < clock else "pending")
    ingest = Ingest(spark, str(tmp_path / "in"), buckets=3)
    for epoch, start in enumerate(range(0, len(events), 7)):
        part = events[start : start + 7]
        df = None
        for h in sorted({h for h, *_ in part}):
            one = rows(spark, [(i, b, total[b]) for g, i, b in part if g == h], h)
            df = one if df is None else df.unionByName(one)
        ingest.step(df, epoch)
    assert states(ingest) == want
    # a copy alone moves the clock on, and with it what still waits
    ingest.step(rows(spark, [("A0", "A", total["A"])], 500), epoch + 1)
    assert states(ingest) == {b: (n, t, "incomplete" if s == "pending" else s) for b, (n, t, s) in want.items()}
    assert {r["item_id"] for r in ingest.late_items().collect()} == {i for i, b in items.items() if seen[i] > first[b] + 24}
