"""Batch tables: many batches in shared files, published as a whole (K1, S9,
K3, J5, W7).

A publish writes its rows, a manifest (a row per batch) and, if given, the
reference list into a staging folder, moves them to their places under a new
publish id, and commits by creating a file of that name. Readers start from
the commits: what an unfinished or failed publish left is never seen. Nothing
is overwritten; a batch that is published again counts by its latest publish.

    <root>/data/publish=<id>/       rows, ranged by batch and source row
    <root>/manifest/publish=<id>/   batch_id, total, files and further figures
    <root>/reference/publish=<id>/  batch_id (null: of all batches), lote_id, sorted
    <root>/commits/<id>             one small file a publish
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import base_name
from lotguard.operators.rules import reference_keys
from lotguard.session import known_small
from lotguard.sources.files import create_if_absent, exists, listing, move


def reference_snapshot(reference: DataFrame) -> DataFrame:
    """The reference list as published: distinct stripped ids, sorted, once
    a publish, or once a batch where the list is per batch."""
    ids = reference_keys(reference)
    batch = F.col("batch_id") if "batch_id" in ids.columns else F.lit(None).cast("string")
    rows = ids.select(batch.alias("batch_id"), "lote_id")
    return rows.repartitionByRange("batch_id", "lote_id").sortWithinPartitions("batch_id", "lote_id")


class BatchTable:
    """A batch table under ``root``. Rows carry ``batch_id``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def stage(self, rows: DataFrame, publish: str, reference: DataFrame | None = None, figures: dict[str, Column] | None = None) -> None:
        """Write a publish as far as its commit: no reader sees it yet."""
        staging = f"{self.root}/_staging/{publish}"
        order = ["batch_id", *(["source_row"] if "source_row" in rows.columns else [])]
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{staging}/data")
        data = self.spark.read.parquet(f"{staging}/data")
        per = data.groupBy("batch_id").agg(
            F.count(F.lit(1)).alias("total"), F.count_distinct(F.col("_metadata.file_name")).alias("files"), *[c.alias(n) for n, c in (figures or {}).items()])
        per.withColumn("published_at", F.current_timestamp()).write.parquet(f"{staging}/manifest")
        parts = ["data", "manifest"]
        if reference is not None:
            reference_snapshot(reference).write.parquet(f"{staging}/reference")
            parts.append("reference")
        for part in parts:
            move(self.spark, f"{staging}/{part}", f"{self.root}/{part}/publish={publish}")

    def publish(self, rows: DataFrame, reference: DataFrame | None = None, **figures: Column) -> str:
        """K1: publish ``rows`` as one commit; ``figures`` are aggregates kept per
        batch in the manifest. Returns the publish id; later ids are greater.
        An empty publish commits nothing to any batch."""
        publish = f"p{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.stage(rows, publish, reference, figures)
        if not create_if_absent(self.spark, f"{self.root}/commits/{publish}", publish):
            raise FileExistsError(publish)
        return publish

    def commits(self) -> DataFrame:
        """(publish) of all committed publishes, from the names of their files."""
        return listing(self.spark, f"{self.root}/commits").select(base_name("path").alias("publish"))

    def _part(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}").join(self.commits(), "publish", "left_semi")

    def is_empty(self) -> bool:
        return not exists(self.spark, f"{self.root}/commits")

    def manifest(self) -> DataFrame:
        """A row per batch: its latest committed publish, total, files, figures."""
        rows = self._part("manifest")
        rest = [c for c in rows.columns if c not in ("batch_id", "publish")]
        best = rows.groupBy("batch_id").agg(F.max("publish").alias("publish"), F.max_by(F.struct(*rest), "publish").alias("_m"))
        return best.select("batch_id", "publish", "_m.*")

    def rows(self) -> DataFrame:
        """The rows of all batches, each by its latest publish."""
        now = known_small(self.manifest().select("batch_id", "publish"))
        return self.spark.read.parquet(f"{self.root}/data").join(now, ["batch_id", "publish"], "left_semi").drop("publish")

    def reference(self) -> DataFrame:
        """The committed reference ids: publish, batch_id, lote_id."""
        return self._part("reference")


def open_batches(pending: BatchTable, processed: BatchTable | None = None) -> DataFrame:
    """The manifest rows of pending batches that haven't been processed since
    they were published (left anti join; nothing is deleted)."""
    now = pending.manifest()
    if processed is None or processed.is_empty():
        return now
    done = processed.manifest().select("batch_id", F.col("pending_publish").alias("_done"))
    return now.join(done, (now["batch_id"] == done["batch_id"]) & (done["_done"] >= now["publish"]), "left_anti")


def pending_check(pending: BatchTable) -> DataFrame:
    """Rows found of each batch against its manifest: batch_id, total, received, ok."""
    got = pending.rows().groupBy("batch_id").agg(F.count(F.lit(1)).alias("received"))
    both = pending.manifest().select("batch_id", "total").join(got, "batch_id", "left").withColumn("received", F.coalesce("received", F.lit(0)))
    return both.withColumn("ok", F.col("total") == F.col("received"))


def read_pending(pending: BatchTable, processed: BatchTable | None = None, mode: str = "newest") -> DataFrame:
    """The rows of the open batch that was published last (ties of one
    publish by the greater batch id), or with ``all`` of every open batch, with
    their ``publish``. No open batch is an error, as is a newest batch that
    doesn't hold the manifest's number of rows."""
    missing = FileNotFoundError(K.NO_PENDING.format(path=pending.root))
    if pending.is_empty():
        raise missing
    batches = open_batches(pending, processed)
    data = pending.spark.read.parquet(f"{pending.root}/data")
    # one row comes to the driver
    newest = batches.orderBy(F.desc("publish"), F.desc("batch_id")).select("batch_id", "publish", "total").first()
    if newest is None:
        raise missing
    if mode == "all":
        return data.join(known_small(batches.select("batch_id", "publish")), ["batch_id", "publish"], "left_semi")
    rows = data.where((F.col("publish") == newest["publish"]) & F.col("batch_id").eqNullSafe(F.lit(newest["batch_id"])))
    received = rows.count()
    if received != newest["total"]:
        raise ValueError(K.MSG_INCOMPLETE.format(expected=newest["total"], received=received))
    return rows


def commit_processed(processed: BatchTable, rows: DataFrame) -> str:
    """K3: the processed items of one or many batches (with the ``publish`` they
    were read from and their state columns) as one commit; with it the batches
    stop being pending. Batches processed earlier stay; one processed again
    counts by its latest commit."""
    return processed.publish(rows.withColumnRenamed("publish", "pending_publish"), pending_publish=F.max("pending_publish"))


ENVELOPE = "batch_id string, reference_lote_ids array<string>, total long, items array<struct<{items}>>"


def read_envelope_files(spark: SparkSession, folder: str, fields: tuple[str, ...] = K.HANDOFF_FIELDS, mode: str = "newest") -> DataFrame:
    """S9 for hand-offs that lie as one JSON envelope a batch (``*.pending.json``:
    batch_id, reference_lote_ids, total, items): the items, all fields as text
    (missing ones null), with ``envelope_total``. ``newest`` opens only the file
    that was changed last; ``all`` reads every file. No file is an error."""
    files = listing(spark, folder, "*.pending.json", recursive=False)
    newest = files.orderBy(F.desc("modified"), F.desc("path")).select("path").first()
    if newest is None:
        raise FileNotFoundError(K.NO_PENDING.format(path=folder))
    reader = spark.read.schema(ENVELOPE.format(items=", ".join(f"{f}: string" for f in fields))).option("multiLine", True)
    said = reader.json(newest["path"]) if mode == "newest" else reader.option("pathGlobFilter", "*.pending.json").json(folder)
    return said.select(F.col("total").alias("envelope_total"), F.inline("items"))
