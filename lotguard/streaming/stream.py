"""Structured Streaming forms of validation, idempotent ingest and batch
completeness (T1-T3).

Sources are hand-off files landing in a directory; sinks are parquet file
sinks with a checkpoint, so a restarted query (or a lost executor) resumes
exactly once. Runs use ``trigger(availableNow=True)``: process what has
arrived, then stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.operators.rules import consolidate, evaluate
from lotguard.session import scratch_dir

EVENT_TIME = "event_time"


def with_event_time(handoff_rows: DataFrame, published_at: str | None = None) -> DataFrame:
    """Event time of a hand-off item = the time of its publication (now, or as
    given). Publications come in the order of time, so the watermark drops
    nothing of a backlog, in however many triggers it is read."""
    when = F.current_timestamp() if published_at is None else F.lit(published_at).cast("timestamp")
    return handoff_rows.withColumn(EVENT_TIME, when)


def land(rows: DataFrame, path: str) -> str:
    """Write rows as arriving files (append; the source discovers new files)."""
    rows.write.mode("append").parquet(path)
    return path


def source(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def validate_stream(items: DataFrame, reference: DataFrame) -> DataFrame:
    """Stateless rule projection per micro-batch; RN03 is a stream-static
    left join against the reference list."""
    return consolidate(evaluate(items, reference), keys=["item_id", "batch_id", "lote_id"])


def dedupe_stream(items: DataFrame, delay: str = "1 day") -> DataFrame:
    """Idempotent ingest on item_id; state is dropped once the watermark
    passes, so it stays bounded."""
    return items.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(["item_id"])


def completeness(ingested: DataFrame, now: Column | None = None, delay: str = "1 day") -> DataFrame:
    """T3 over the table that the ingest stream keeps (distinct items): per
    batch, received against declared total. A batch is released as soon as
    its count is reached; short of it, it is pending until its deadline (first
    publication + ``delay``) and incomplete from then on. Every batch has a
    row, whatever the triggers were."""
    now = F.current_timestamp() if now is None else now
    agg = ingested.groupBy("batch_id").agg(
        F.count_distinct("item_id").alias("received"),
        F.max("batch_total").alias("expected"),
        F.min(EVENT_TIME).alias("_first"),
    )
    state = F.when(F.col("received") == F.col("expected"), F.lit("released")) \
             .when(F.col("received") > F.col("expected"), F.lit("overfull")) \
             .when(F.col("_first") + F.expr(f"interval {delay}") <= now, F.lit("incomplete")).otherwise(F.lit("pending"))
    return agg.select("batch_id", "received", "expected", state.alias("state"))


def completeness_accounting(arrived: DataFrame, emitted: DataFrame) -> DataFrame:
    """Companion of ``completeness`` (a batch query over the landing folder
    and its result): per batch, how many distinct items arrived against how
    many were counted: 'pending' (not read yet), 'late_items' (arrived >
    counted: later than the watermark) or 'ok'."""
    got = arrived.groupBy("batch_id").agg(F.count_distinct("item_id").alias("arrived"))
    out = got.join(emitted.select("batch_id", "received"), "batch_id", "left")
    return out.select(
        "batch_id", "arrived", F.coalesce("received", F.lit(0)).alias("counted"),
        F.when(F.col("received").isNull(), F.lit("pending"))
         .when(F.col("arrived") > F.col("received"), F.lit("late_items")).otherwise(F.lit("ok")).alias("state"),
    )


def run_to_parquet(stream: DataFrame, name: str, output_mode: str = "append",
                   out: str | None = None, ckpt: str | None = None) -> DataFrame:
    """Run a streaming DataFrame to completion over the available input into
    a parquet file sink; return the sink's contents as a batch DataFrame.
    Pass the same ``out``/``ckpt`` to resume a query where it stopped."""
    spark = stream.sparkSession
    out = out or scratch_dir(spark, f"{name}-out")
    ckpt = ckpt or scratch_dir(spark, f"{name}-ckpt")
    q = (stream.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover
        raise q.exception()
    return spark.read.parquet(out)
