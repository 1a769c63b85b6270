"""Idempotent ingest with batch completeness as a stream.

Each micro-batch is handled as one epoch by DataFrame operations over tables
that earlier epochs left (``foreachBatch``):

    <root>/items/epoch=<n>/bucket=<b>/   items that are new: the ingest ledger
    <root>/late/epoch=<n>/               of them, those behind their batch's deadline
    <root>/open/epoch=<n>/               all batches that wait, after epoch n
    <root>/closed/epoch=<n>/             batches that epoch n closed or amended
    <root>/clock/epoch=<n>/              the greatest event time so far
    <root>/_checkpoint/                  the stream's own

An item is new if the ledger doesn't have its item_id, however long ago it
came: no watermark, and no state in memory. The ledger is asked by an anti-join
of the buckets that the micro-batch touches. Items of a batch count up to its
deadline, ``delay`` after its first one; later ones are late. A batch waits
until its declared total is reached (released) or the clock passes its deadline
(incomplete); then it leaves the open table, so what an epoch rewrites follows
the number of waiting batches. Items that a released batch gets before its
deadline amend it (overfull).

What is counted depends on event times only, so with input in their order the
tables say the same for any trigger size. An epoch that is run again (a restart)
reads only earlier epochs and overwrites its own folders.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.sources.files import exists
from lotguard.streaming.stream import EVENT_TIME

#: Folders of the ledger.
BUCKETS = 32
_STATE = "batch_id string, first timestamp, expected int, received long, state string"


class Ingest:
    """The tables of an ingest under ``root``."""

    def __init__(self, spark: SparkSession, root: str, delay: str = "1 day", buckets: int = BUCKETS):
        self.spark, self.root, self.delay, self.buckets = spark, root.rstrip("/"), delay, buckets

    def _write(self, df: DataFrame, table: str, epoch: int, *by: str) -> DataFrame:
        path = f"{self.root}/{table}/epoch={epoch}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- one epoch ------------------------------------------------------------

    def fresh(self, arrived: DataFrame, epoch: int) -> DataFrame:
        """The micro-batch's items that no earlier epoch has, once each (the
        copy that was published first), written to the ledger."""
        rest = [c for c in arrived.columns if c not in ("item_id", EVENT_TIME)]
        best = F.min(F.struct(EVENT_TIME, *rest)).alias("_v")
        bucket = F.pmod(F.xxhash64("item_id"), F.lit(self.buckets)).cast("int")
        rows = arrived.groupBy("item_id").agg(best).select("item_id", "_v.*", bucket.alias("bucket"))
        path = f"{self.root}/items"
        if exists(self.spark, path):
            # as many rows as buckets at most come to the driver
            touched = [r[0] for r in arrived.select(bucket.alias("b")).distinct().collect()]
            known = self.spark.read.parquet(path).where((F.col("epoch") < epoch) & F.col("bucket").isin(touched)).select("bucket", "item_id")
            rows = rows.join(known, ["bucket", "item_id"], "left_anti")
        return self._write(rows.select(*arrived.columns, "bucket"), "items", epoch, "bucket")

    def batches(self, epoch: int | None = None) -> DataFrame:
        """Each batch's state after all epochs, or those before ``epoch``."""
        opened, closed = (self._state(t, epoch) for t in ("open", "closed"))
        rows = opened.withColumn("_closed", F.lit(0)).unionByName(closed.withColumn("_closed", F.lit(1)))
        names = [c.split()[0] for c in _STATE.split(", ")]
        best = F.max_by(F.struct(*names), F.struct("epoch", "_closed")).alias("_b")
        return rows.groupBy("batch_id").agg(best).select("_b.*")

    def _state(self, table: str, epoch: int | None) -> DataFrame:
        path = f"{self.root}/{table}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], _STATE + ", epoch int")
        rows = self.spark.read.schema(_STATE + ", epoch int").parquet(path)
        rows = rows if epoch is None else rows.where(F.col("epoch") < epoch)
        if table == "open":  # the last epoch's folder has all batches that wait
            last = rows.agg(F.max("epoch")).first()[0] if epoch is None else epoch - 1
            rows = rows.where(F.col("epoch") == F.lit(last))
        return rows

    def _known(self, per: DataFrame, epoch: int) -> DataFrame:
        """What earlier epochs know of the waiting batches and of those that
        the micro-batch touches."""
        opened = self._state("open", epoch).drop("epoch")
        closed = self._state("closed", epoch)
        names = [c.split()[0] for c in _STATE.split(", ")]
        again = closed.join(per.select("batch_id").distinct(), "batch_id", "left_semi")
        again = again.groupBy("batch_id").agg(F.max_by(F.struct(*names), "epoch").alias("_b")).select("_b.*")
        return opened.unionByName(again)

    def step(self, arrived: DataFrame, epoch: int) -> None:
        """Handle a micro-batch (item_id, batch_id, batch_total, event_time and
        further columns) as ``epoch``."""
        items = self.fresh(arrived, epoch)
        # counts by batch and publication, so that no batch's items meet in one place
        per = items.groupBy("batch_id", EVENT_TIME).agg(F.count(F.lit(1)).alias("n"), F.max("batch_total").cast("int").alias("total"))
        per = self._write(per, "_counts", epoch)
        known = self._write(self._known(per, epoch), "_known", epoch)
        firsts = per.groupBy("batch_id").agg(F.min(EVENT_TIME).alias("_first"), F.max("total").alias("_total"))
        both = known.join(firsts, "batch_id", "full_outer")
        both = both.select("batch_id", F.least("first", "_first").alias("first"), F.greatest("expected", "_total").alias("expected"),
                           F.coalesce("received", F.lit(0)).alias("received"), F.col("state").alias("_was"))
        deadline = F.col("first") + F.expr(f"interval {self.delay}")
        timed = per.join(both.select("batch_id", deadline.alias("deadline")), "batch_id").withColumn("late", F.col(EVENT_TIME) > F.col("deadline"))
        timed = self._write(timed, "_timed", epoch)
        late = timed.where("late").select("batch_id", EVENT_TIME, "deadline")
        self._write(items.drop("bucket").join(late, ["batch_id", EVENT_TIME]), "late", epoch)
        counted = timed.groupBy("batch_id").agg(F.coalesce(F.sum(F.when(~F.col("late"), F.col("n"))), F.lit(0)).alias("_n"))
        now = both.join(counted, "batch_id", "left").withColumn("received", F.col("received") + F.coalesce("_n", F.lit(0)))
        clock = self._clock(arrived, epoch)
        state = F.when(F.col("received") == F.col("expected"), F.lit("released")).when(F.col("received") > F.col("expected"), F.lit("overfull")) \
                 .when(deadline < clock, F.lit("incomplete")).otherwise(F.lit("pending"))
        now = now.select("batch_id", "first", "expected", "received", state.alias("state"))
        now = self._write(now, "_now", epoch)
        self._write(now.where("state <> 'pending'"), "closed", epoch)
        self._write(now.where("state = 'pending'"), "open", epoch)

    def _clock(self, arrived: DataFrame, epoch: int) -> Column:
        """The greatest event time up to this epoch, copies included (one value)."""
        here = arrived.agg(F.max(EVENT_TIME)).first()[0]
        before = None
        if exists(self.spark, f"{self.root}/clock"):
            before = self.spark.read.parquet(f"{self.root}/clock").where(F.col("epoch") < epoch).agg(F.max("at")).first()[0]
        at = max((t for t in (here, before) if t is not None), default=None)
        moment = F.lit(at).cast("timestamp")
        self._write(self.spark.range(1).select(moment.alias("at")), "clock", epoch)
        return moment

    # --- the stream and its tables ----------------------------------------------

    def run(self, stream: DataFrame) -> None:
        """Ingest what has arrived, then stop; called again, go on from there."""
        step: Callable[[DataFrame, int], None] = self.step
        query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{self.root}/_checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()

    def items(self) -> DataFrame:
        """All distinct items that came."""
        return self.spark.read.parquet(f"{self.root}/items").drop("epoch", "bucket")

    def late_items(self) -> DataFrame:
        """Items behind their batch's deadline: ERROR/SYSTEM for whoever consumes."""
        return self.spark.read.parquet(f"{self.root}/late").drop("epoch")
