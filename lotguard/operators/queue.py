"""Hand-off consumption: a session's replay over a shared queue, batch
integrity, pending/processed batches and key uniqueness (S9, S10, K3, J5, G9,
G10).

A consumer task reads its queue in FIFO order from the place it starts at. Its
batch is the one its parameters name, else that of its first item; it reads as
many items as its parameters say, else as its first item's ``batch_total``. It
stops at the first item of another batch. Items of one batch that follow each
other are a *run*: places are numbered once, run boundaries found by comparing
neighbours, and all that tasks decide is then decided on runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import message_of, truncate_message
from lotguard.operators.sequence import DEFAULT_BLOCK_WIDTH, next_within
from lotguard.session import written

#: Places of a block: runs, tasks and items meet in blocks of their queue.
BLOCK = DEFAULT_BLOCK_WIDTH


def placed_items(queue: DataFrame) -> DataFrame:
    """Items (queue_id, seq, item_id, batch_id, batch_total) with ``place``,
    their position in the queue from 0 on, and ``begins``: the item before is
    of another batch, or there is none.

    One numbering: rows are numbered and compared inside blocks of ``seq``;
    a block's offset and the batch before it come from one row a block, so no
    queue is one task's."""
    items = queue.select(
        F.coalesce("queue_id", F.lit("")).alias("queue_id"), "seq", "item_id", F.coalesce("batch_id", F.lit("")).alias("batch_id"),
        F.coalesce("batch_total", F.lit(0)).cast("int").alias("batch_total"), F.floor(F.col("seq") / F.lit(BLOCK)).cast("long").alias("_blk"))
    order = Window.partitionBy("queue_id").orderBy("_blk")
    edges = items.groupBy("queue_id", "_blk").agg(F.count(F.lit(1)).alias("_n"), F.max_by("batch_id", "seq").alias("_last")).select(
        "queue_id", "_blk", F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_last").over(order).alias("_before"))
    local = Window.partitionBy("queue_id", "_blk").orderBy("seq")
    rows = items.withColumns({"_i": F.row_number().over(local), "_prev": F.lag("batch_id").over(local)}).join(edges, ["queue_id", "_blk"])
    before = F.when(F.col("_i") == 1, F.col("_before")).otherwise(F.col("_prev"))
    return rows.select("queue_id", "item_id", "batch_id", "batch_total", (F.col("_off") + F.col("_i") - 1).alias("place"),
                       (~before.eqNullSafe(F.col("batch_id"))).alias("begins"))


def queue_runs(placed: DataFrame) -> DataFrame:
    """Runs of a queue: queue_id, batch_id, batch_total (of the first item),
    the places from ``place`` to before ``end``, and the next run's batch."""
    starts = placed.where("begins").select("queue_id", "place", "batch_id", "batch_total")
    none = F.lit(None)
    ends = placed.groupBy("queue_id").agg((F.max("place") + 1).alias("place")).select(
        "queue_id", "place", none.cast("string").alias("batch_id"), none.cast("int").alias("batch_total"))
    runs = next_within(starts.unionByName(ends), ["queue_id"], "place", ["place", "batch_id"], block_width=BLOCK)
    return runs.where("next is not null").select(
        "queue_id", "batch_id", "batch_total", "place", F.col("next.place").alias("end"), F.col("next.batch_id").alias("next_batch"))


def batch_tasks(runs: DataFrame) -> DataFrame:
    """A task for each batch, without parameters, from the batch's first item on."""
    none = F.lit(None)
    return runs.groupBy("queue_id", "batch_id").agg(F.min("place").alias("start")).select(
        F.concat(F.lit("task-"), "batch_id").alias("task_id"), "queue_id", "start", none.cast("string").alias("batch_id"), none.cast("int").alias("batch_total"))


def _blocks(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / F.lit(BLOCK)), F.floor((end - 1) / F.lit(BLOCK))))


def replay(placed: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """G9 + S10: what each task's read comes to, a row per task.

    ``tasks``: task_id, queue_id, start (the place where it reads first), and
    the parameters batch_id ('' or null: none) and batch_total (0 or null:
    none). Without ``tasks`` there is one for each batch (``batch_tasks``).

    Returns task_id, queue_id, batch_id (the task's), start, own (items of its
    batch that it read), stop (before this place; a foreign item included), and
    problem with message: empty, foreign_item, incomplete, or null."""
    runs = queue_runs(placed)
    tasks = batch_tasks(runs) if tasks is None else tasks
    tasks = tasks.select("task_id", F.coalesce("queue_id", F.lit("")).alias("queue_id"), F.col("start").cast("long").alias("start"),
                         F.nullif("batch_id", F.lit("")).alias("_wanted"), F.coalesce("batch_total", F.lit(0)).cast("int").alias("_total"))
    spans = runs.select(F.col("queue_id").alias("_queue"), F.col("batch_id").alias("_run"), "batch_total", "place", "end", "next_batch",
                        _blocks(F.col("place"), F.col("end")).alias("_blk"))
    block = F.floor(F.col("start") / F.lit(BLOCK))
    at = tasks.join(spans, (F.col("queue_id") == F.col("_queue")) & (block == F.col("_blk")) & (F.col("start") >= F.col("place")) & (F.col("start") < F.col("end")), "left")
    target = F.coalesce("_wanted", "_run", F.lit(""))
    need = F.when(F.col("_total") > 0, F.col("_total")).otherwise(F.coalesce("batch_total", F.lit(0)))
    there = F.when(F.col("_run") == target, F.col("end") - F.col("start")).otherwise(F.lit(0))
    at = at.select("task_id", "queue_id", "start", "_run", "next_batch", target.alias("batch_id"), need.alias("need"), F.coalesce(there, F.lit(0)).cast("int").alias("_there"))
    at = at.withColumn("own", F.when(F.col("need") > 0, F.least("_there", "need")).otherwise(F.col("_there")))
    full = (F.col("need") > 0) & (F.col("own") == F.col("need"))
    foreign = F.when(~full, F.when(F.col("_run") == F.col("batch_id"), F.col("next_batch")).otherwise(F.col("_run")))
    at = at.withColumn("_foreign", foreign)
    problem = F.when(F.col("_foreign").isNotNull(), F.lit("foreign_item")) \
               .when(F.col("own") == 0, F.lit("empty")) \
               .when((F.col("need") != 0) & (F.col("own") != F.col("need")), F.lit("incomplete"))
    message = F.when(F.col("problem") == "foreign_item", message_of(K.MSG_FOREIGN_ITEM, "_foreign", "batch_id")) \
               .when(F.col("problem") == "empty", message_of(K.MSG_EMPTY, "queue_id")) \
               .when(F.col("problem") == "incomplete", message_of(K.MSG_INCOMPLETE, "need", "own"))
    stop = F.col("start") + F.col("own") + F.col("_foreign").isNotNull().cast("int")
    return at.withColumn("problem", problem).select("task_id", "queue_id", "batch_id", "start", "own", stop.alias("stop"), "problem", message.alias("message"))


def acquired_items(placed: DataFrame, sessions: DataFrame) -> DataFrame:
    """The items that the tasks of ``replay`` read: task_id, item_id, batch_id
    (the item's), foreign, and the task's start, problem and message."""
    reads = sessions.where("stop > start").select(
        "task_id", F.col("queue_id").alias("_queue"), "start", "own", "stop", "problem", "message", _blocks(F.col("start"), F.col("stop")).alias("_blk"))
    block = F.floor(F.col("place") / F.lit(BLOCK))
    on = (F.col("queue_id") == F.col("_queue")) & (block == F.col("_blk")) & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("stop"))
    return placed.join(reads, on).select(
        "task_id", "item_id", "batch_id", (F.col("place") >= F.col("start") + F.col("own")).alias("foreign"), "start", "problem", "message")


def bounded_read(queue: DataFrame, tasks: DataFrame | None = None) -> DataFrame:
    """One row per item that a task reads (task_id, item_id, batch_id,
    foreign). An item that tasks leave in the queue has no row."""
    placed = placed_items(queue)
    return acquired_items(placed, replay(placed, tasks)).select("task_id", "item_id", "batch_id", "foreign")


def mixed_sessions(acquired: DataFrame) -> DataFrame:
    """G9 for sessions whose items come without an order (task_id, item_id,
    batch_id, batch_total), as of a session taken up again: too few or too many
    items, or items of several batches. task_id, batch_id (the least), problem,
    message; sessions without a problem have no row."""
    per = acquired.groupBy("task_id", "batch_id").agg(F.count(F.lit(1)).alias("n"), F.max("batch_total").alias("total"))
    one = per.groupBy("task_id").agg(F.sum("n").alias("n"), F.max("total").alias("total"), F.sort_array(F.collect_list("batch_id")).alias("ids"))
    short = (F.col("total") != 0) & (F.col("n") != F.col("total"))
    said = F.concat(F.lit("['"), F.array_join("ids", "', '"), F.lit("']"))
    problem = F.when(short, F.lit("incomplete")).when(F.size("ids") > 1, F.lit("mixed"))
    message = F.when(short, message_of(K.MSG_INCOMPLETE, "total", "n")).when(F.size("ids") > 1, message_of(K.MSG_MIXED, said))
    return one.select("task_id", F.col("ids")[0].alias("batch_id"), problem.alias("problem"), message.alias("message")).where("problem is not null")


def batch_integrity(queue: DataFrame, tasks: DataFrame | None = None, sessions: DataFrame | None = None) -> DataFrame:
    """The problem of each session that has one (task_id, batch_id, problem,
    message): those of tasks over a queue, and of ``sessions`` without order."""
    placed = written(placed_items(queue).drop("item_id"), "placed")  # read for the runs and for the ends of queues
    found = replay(placed, tasks).where("problem is not null").select("task_id", "batch_id", "problem", "message")
    return found if sessions is None else found.unionByName(mixed_sessions(sessions))


def item_errors(acquired: DataFrame) -> DataFrame:
    """The items that a failed session had read, foreign ones included, with
    its error text (item_id, error). An item that several failed sessions read
    keeps the text of the first one."""
    return acquired.where("problem is not null").groupBy("item_id").agg(
        F.min(F.struct("start", "task_id", "message")).getField("message").alias("error"))


def count_errors(items: DataFrame) -> DataFrame:
    """G9 where batches come as files instead of a queue: batches that hold
    more or fewer items than their first item's ``batch_total`` says (batch_id,
    error)."""
    per = items.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min_by("batch_total", "source_row").alias("need"))
    short = per.where((F.coalesce("need", F.lit(0)) != 0) & (F.col("need") != F.col("n")))
    return short.select("batch_id", message_of(K.MSG_INCOMPLETE, "need", "n").alias("error"))


def processed_state(states: DataFrame, items: DataFrame) -> DataFrame:
    """K3: hand-off items (all their columns) with their final state columns.
    Items that no session has read have no state and no row."""
    final = states.select("item_id", "datapool_state", truncate_message(F.col("finish_message")).alias("finish_message"), "error_type")
    return items.join(final, "item_id")


def still_pending(pending_batches: DataFrame, processed_batches: DataFrame) -> DataFrame:
    """Pending minus processed, by batch_id (left anti join; nothing is
    deleted)."""
    return pending_batches.select("batch_id").distinct() \
        .join(processed_batches.select("batch_id"), "batch_id", "left_anti")


def dedupe_items(items: DataFrame) -> DataFrame:
    """One row per item_id (idempotent re-ingest)."""
    return items.dropDuplicates(["item_id"])


def duplicate_items(items: DataFrame) -> DataFrame:
    """item_ids that occur more than once, with their count."""
    return items.groupBy("item_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
