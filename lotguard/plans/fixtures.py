"""Shared derived inputs for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.operators import admission as A
from lotguard.plans import jobs
from lotguard.plans.materialize import landed, landed_run
from lotguard.operators.rules import evaluate
from lotguard.operators.validate import validate_handoff
from lotguard.sources import testdata as td


def lots(spark: SparkSession, d: str) -> DataFrame:
    """D1, landed once."""
    return landed(spark, d, "lots", lambda: td.lots(spark, d))


def reference(spark: SparkSession, d: str) -> DataFrame:
    """D2, landed once."""
    return landed(spark, d, "reference", lambda: td.reference_lots(spark, d))


def evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Direct path: raw D1 rows against D2, reference date per batch."""
    return evaluate(lots(spark, d), reference(spark, d))


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """D3: admission outcome over D1 (the producer's result table)."""
    return landed(spark, d, "outcomes", lambda: A.admit(lots(spark, d)))


def by_batch(rows: DataFrame) -> DataFrame:
    """Rows of a partition in the order of batches: their long texts repeat, so
    the table and the shuffles that read it are a fraction of the size."""
    return rows.sortWithinPartitions("batch_id", "source_row")


def handoff(spark: SparkSession, d: str) -> DataFrame:
    """Published hand-off rows (the hand-off table)."""
    return landed(spark, d, "handoff", lambda: by_batch(A.handoff(outcomes(spark, d), reference(spark, d))))


def handoff_all(spark: SparkSession, d: str) -> DataFrame:
    """Every admission outcome in hand-off form (rejected and failed
    registrations included, as in the exclusion scenario)."""
    return landed(spark, d, "handoff_all",
                  lambda: by_batch(A.handoff(outcomes(spark, d), reference(spark, d), published_only=False)))


def consumer_evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Two-stage path: validation of D4b with the reference it carries."""
    return validate_handoff(handoff_all(spark, d))


def published_evaluated(spark: SparkSession, d: str) -> DataFrame:
    """Two-stage path on the published hand-off only."""
    return validate_handoff(handoff(spark, d))


def land_all(spark: SparkSession, d: str) -> None:
    """Land every shared input table."""
    for fn in (lots, reference, outcomes, handoff, handoff_all):
        fn(spark, d)


def grid(spark: SparkSession, d: str) -> DataFrame:
    """Raw sheet grid."""
    return landed(spark, d, "sheet_grid", lambda: td.sheet_grid(lots(spark, d)), even_by="batch_id")


def headers(spark: SparkSession, d: str) -> DataFrame:
    """Header row per sheet."""
    return landed(spark, d, "headers", lambda: td.headers(lots(spark, d)))


def queue(spark: SparkSession, d: str) -> DataFrame:
    """The shared queue session."""
    return landed(spark, d, "queue_session", lambda: td.queue_session(handoff(spark, d)))


def queue_tasks(spark: SparkSession, d: str) -> DataFrame:
    """The consumer tasks of the queue session."""
    return landed(spark, d, "queue_tasks", lambda: td.queue_tasks(queue(spark, d)))


def taken_up_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions without an order."""
    return landed(spark, d, "taken_up_sessions", lambda: td.taken_up_sessions(queue(spark, d)))


def stored(spark: SparkSession, d: str) -> DataFrame:
    """Stored copies in the target system."""
    return landed(spark, d, "stored", lambda: td.stored(handoff(spark, d)))


def stored_json(spark: SparkSession, d: str) -> DataFrame:
    """D5, JSON document form."""
    return landed(spark, d, "stored_json", lambda: td.stored_json(stored(spark, d)))


def loose(spark: SparkSession, d: str) -> DataFrame:
    """Loose divergence records."""
    return landed(spark, d, "loose_divergences", lambda: td.loose_divergences(evaluated(spark, d)))




def expected_files(spark: SparkSession, d: str) -> DataFrame:
    """The sheets that should be there."""
    return landed(spark, d, "expected_files", lambda: td.expected_files(lots(spark, d)))


def job_runs(spark: SparkSession, d: str) -> tuple[dict[str, str], dict[str, str]]:
    """A producer and a consumer run over D1 and D2, written once."""

    def run(folder: str) -> dict:
        prod = jobs.producer_job(spark, lots(spark, d), reference(spark, d), f"{folder}/producer")
        return {"producer": prod, "consumer": jobs.consumer_job(spark, prod["handoff"], f"{folder}/consumer")}

    both = landed_run(spark, d, "job_runs", run)
    return both["producer"], both["consumer"]


def run_outputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The written tables of ``job_runs``, with a file for each evidence path."""
    producer, consumer = job_runs(spark, d)
    evidence = spark.read.parquet(producer["outcomes"]).select(F.col("evidence_path").alias("path"))
    return jobs.written_outputs(spark, producer, consumer, evidence)


def run_events(spark: SparkSession, d: str) -> DataFrame:
    """Log events of many runs."""
    return td.run_events(spark, d)


def run_starts(spark: SparkSession, d: str) -> DataFrame:
    """The runs' starts and execution ids."""
    return landed(spark, d, "run_starts", lambda: td.run_starts(run_events(spark, d)))


def land_fixtures(spark: SparkSession, d: str) -> None:
    """Land every input fixture."""
    land_all(spark, d)
    for fn in (grid, headers, queue, queue_tasks, taken_up_sessions, stored, stored_json, loose, expected_files, run_starts, job_runs):
        fn(spark, d)
