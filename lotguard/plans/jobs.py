"""End-to-end jobs composed from the operators.

* ``producer_job``: typed sheet rows -> admission outcome -> published
  hand-off, flow-error report, producer summary and event log.
* ``consumer_job``: hand-off -> sessions and their integrity -> validation ->
  item states (processed batches), six-table report, summary and event log.
* ``direct_check_job``: raw sheet grid -> contract check -> rules -> report
  and run records.
* ``verify_job``: post-run checks over what the two jobs wrote.

Each job writes every table once, into a folder of its own run, and reads
written tables for the next step: a lost executor recomputes from written
data, and no run overwrites another's output.

    <out>/runs/<run>/<table>    tables of a run
    <out>/handoff, processed    batch tables of all runs (``operators.store``)
    <out>/report, <out>/log     reports and event log of all runs
"""

from __future__ import annotations

import time
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.operators import admission as A
from lotguard.operators import eventlog as EL
from lotguard.operators import landing as L
from lotguard.operators import queue as QU
from lotguard.operators import report as RP
from lotguard.operators import rules as R
from lotguard.operators import runs as RU
from lotguard.operators import validate as VAL
from lotguard.operators import verify as VF
from lotguard.operators.store import BatchTable, commit_processed, open_batches, read_pending
from lotguard.sources.files import create_if_absent

PRODUCER_BOT, CONSUMER_BOT = "bot-produtor", "bot-validador"


def new_run(spark: SparkSession, out: str, run: str | None = None) -> str:
    """The folder of a new run; a run of that name must not be there yet."""
    run = run or f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if not create_if_absent(spark, f"{out}/runs/_names/{run}", run):
        raise FileExistsError(f"run {run} is already under {out}")
    return f"{out}/runs/{run}"


def _write(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").parquet(path)
    return path


def producer_job(spark: SparkSession, lots: DataFrame, reference: DataFrame, out: str,
                 stored: DataFrame | None = None, execution_id: str = "exec-1",
                 evidence_root: str = "/evidence", bot_id: str = PRODUCER_BOT, run: str | None = None) -> dict[str, str]:
    """Producer stage. ``lots`` carries lineage columns (batch_id, item_id,
    source_row, source_file, source_hash, reference_date) and the 8 contract
    columns. The hand-off is one publish of all batches of the run, with the
    reference list once."""
    out = out.rstrip("/")
    here = new_run(spark, out, run)
    started = datetime.now(UTC)
    paths = {"run": here, "started_at": started.isoformat(), "execution_id": execution_id, "bot_id": bot_id}
    paths["outcomes"] = _write(A.admit(lots, stored, evidence_root), f"{here}/outcomes")
    outcomes = spark.read.parquet(paths["outcomes"])
    paths["handoff"] = f"{out}/handoff"
    paths["publish"] = BatchTable(spark, paths["handoff"]).publish(A.handoff(outcomes, reference, execution_id), reference)
    paths["flow_errors"] = _write(A.flow_errors(outcomes, by_batch=True), f"{here}/flow_errors")
    errors = spark.read.parquet(paths["flow_errors"])
    if not errors.isEmpty():  # no report without an error (K5)
        tables = {"resumo": A.flow_errors_summary(errors), "erros_fluxo": errors}
        paths.update({f"flow_report/{k}": v for k, v in RP.write_flow_errors(tables, f"{out}/report", started).items()})
    summary = A.producer_summary(outcomes).withColumn("status", RU.producer_run_status())
    paths["producer_summary"] = _write(summary, f"{here}/producer_summary")
    lines = EL.log_lines(EL.producer_events(outcomes), execution_id, bot_id)
    paths["log"] = EL.write_event_log(lines, f"{out}/log", here.rpartition("/")[2])
    return paths


def _sessions(items: DataFrame, queue: DataFrame | None, tasks: DataFrame | None, here: str) -> tuple[DataFrame, DataFrame, dict[str, str]]:
    """The items that sessions read, their errors (item_id, error), and what
    was written of the sessions."""
    spark = items.sparkSession
    bad = R.bad_reference_dates(items)
    if queue is None:  # a session a batch, over the whole batch
        errors = QU.count_errors(items).withColumn("_first", F.lit(0)).unionByName(bad.withColumn("_first", F.lit(1)))
        per_batch = errors.groupBy("batch_id").agg(F.min_by("error", "_first").alias("error"))
        failed = spark.read.parquet(_write(per_batch, f"{here}/batch_errors"))
        return items, items.select("item_id", "batch_id").join(failed, "batch_id").select("item_id", "error"), {"batch_errors": f"{here}/batch_errors"}
    paths = {"placed": f"{here}/placed", "sessions": f"{here}/sessions", "acquired": f"{here}/acquired"}
    placed = spark.read.parquet(_write(QU.placed_items(queue), paths["placed"]))
    sessions = spark.read.parquet(_write(QU.replay(placed, tasks), paths["sessions"]))
    acquired = spark.read.parquet(_write(QU.acquired_items(placed, sessions), paths["acquired"]))
    read = items.join(acquired.select("item_id").distinct(), "item_id", "left_semi")
    errors = QU.item_errors(acquired).withColumn("_first", F.lit(0)).unionByName(
        read.select("item_id", "batch_id").join(bad, "batch_id").select("item_id", "error", F.lit(1).alias("_first")))
    return read, errors.groupBy("item_id").agg(F.min_by("error", "_first").alias("error")), paths


def consumer_job(spark: SparkSession, handoff_path: str, out: str, run: str | None = None,
                 reference: DataFrame | None = None, queue: DataFrame | None = None, tasks: DataFrame | None = None,
                 execution_id: str = "exec-1", bot_id: str = CONSUMER_BOT) -> dict[str, str]:
    """Consumer stage over all open batches of a published hand-off.

    With a ``queue`` (queue_id, seq, item_id, batch_id, batch_total) the items
    are those that consumer tasks read from it (``tasks``; one a batch if not
    given), else every batch is read whole. A session that fails (a foreign
    item, an incomplete batch, a reference date that is no date) leaves the
    items it had read, foreign ones included, ERROR/SYSTEM with its error text;
    other sessions go on. Items that nobody read have no state, and a batch of
    which nothing was read stays open.

    ``status`` is COMPLETED, PARTIALLY_COMPLETED or FAILED (no item could be
    validated; ``error`` then has one of the texts). Errors of the platform are
    raised: they say nothing about the items."""
    out = out.rstrip("/")
    pending, processed = BatchTable(spark, handoff_path), BatchTable(spark, f"{out}/processed")
    items = read_pending(pending, processed, mode="all")
    here = new_run(spark, out, run)
    started = datetime.now(UTC)
    paths = {"run": here, "started_at": started.isoformat(), "handoff": handoff_path, "processed": processed.root, "execution_id": execution_id, "bot_id": bot_id}
    read, errors, more = _sessions(items, queue, tasks, here)
    paths |= more
    paths["item_errors"] = _write(errors, f"{here}/item_errors")
    errors = spark.read.parquet(paths["item_errors"])
    good = read.join(errors.select("item_id"), "item_id", "left_anti")
    paths["evaluated"] = _write(VAL.validate_handoff(good, reference), f"{here}/evaluated")
    ev = spark.read.parquet(paths["evaluated"])
    keep = ("cadastro_status", "lote_id", "source_row")
    failed = read.select("item_id", "batch_id", *keep).join(VAL.error_states(errors), "item_id")
    paths["states"] = _write(VAL.item_state(ev, keep=keep).unionByName(failed), f"{here}/states")
    st = spark.read.parquet(paths["states"])
    paths["processed_publish"] = commit_processed(processed, QU.processed_state(st, read))
    paths.update({f"report/{k}": v for k, v in RP.write_report(VAL.report_tables(ev), f"{out}/report", K.DIVERGENCE_REPORT, started).items()})
    checked = VAL.validation_summary(ev)
    summary = checked.join(VAL.item_metrics(st), "batch_id").join(VAL.consumer_run_status(checked), "batch_id")
    paths["consumer_summary"] = _write(summary, f"{here}/consumer_summary")
    paths["log"] = EL.write_event_log(EL.log_lines(EL.consumer_events(st), execution_id, bot_id), f"{out}/log", here.rpartition("/")[2])
    wrong = errors.select("error").first()  # one row
    paths["status"] = "COMPLETED" if wrong is None else "FAILED" if ev.isEmpty() else "PARTIALLY_COMPLETED"
    if wrong is not None:
        paths["error"] = wrong["error"][:K.MESSAGE_LIMIT]
    return paths


def direct_check_job(spark: SparkSession, grid: DataFrame, reference: DataFrame | None, out: str,
                     reference_date: str = K.DEFAULT_REFERENCE_DATE, run: str | None = None,
                     expected: DataFrame | None = None, files: DataFrame | None = None, reference_dates: DataFrame | None = None) -> dict[str, str]:
    """Direct path: a record for each sheet, read or not.

    ``expected`` (batch_id, arquivo_processado) are the files that should be
    there (those of the grid if not given), ``files`` (batch_id, hash_md5,
    unreadable) those that are. Sheets whose header breaks the contract end in
    ERRO_ESTRUTURA, those with a reference date that is no date in
    ERRO_PROCESSAMENTO; both are left out of the report. The date is
    ``reference_date`` (the original always uses the default here), or by batch
    that of ``reference_dates`` (batch_id, reference_date). Without ``reference``
    a workbook's own list counts (S4)."""
    out = out.rstrip("/")
    here = new_run(spark, out, run)
    started = datetime.now(UTC)
    headers = L.first_sheet(grid).where(F.col("row_no") == K.HEADER_ROW).select("batch_id", F.col("cells").alias("header"))
    check = spark.read.parquet(_write(L.structure_check(headers), f"{here}/structure"))
    rows = L.sheet_to_table(grid).join(check.where("ok").select("batch_id"), "batch_id", "left_semi")
    if reference_dates is None:
        rows = rows.withColumn("reference_date", F.lit(reference_date or K.DEFAULT_REFERENCE_DATE))
    else:
        rows = rows.join(reference_dates.select("batch_id", "reference_date"), "batch_id", "left")
    lots = spark.read.parquet(_write(L.lineage(rows.withColumn("source_hash", F.sha2("batch_id", 256))), f"{here}/lots"))
    errors = spark.read.parquet(_write(R.bad_reference_dates(lots), f"{here}/batch_errors"))
    good = lots.join(errors.select("batch_id"), "batch_id", "left_anti")
    paths = {"run": here, "started_at": started.isoformat()}
    paths["evaluated"] = _write(R.evaluate(good, L.reference_list(grid) if reference is None else reference), f"{here}/evaluated")
    ev = spark.read.parquet(paths["evaluated"])
    if not ev.isEmpty():  # a run without a sheet that could be checked has no report
        paths.update({f"report/{k}": v for k, v in RP.write_report(VAL.report_tables(ev), f"{out}/report", K.DIVERGENCE_REPORT, started).items()})
    per = ev.groupBy("batch_id").agg(F.count_if(F.size("violations") > 0).alias("n_divergent"))
    totals = lots.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows")).join(per, "batch_id", "left")
    there = grid.select("batch_id").distinct()
    expected = there.withColumn("arquivo_processado", F.col("batch_id")) if expected is None else expected
    files = there.select("batch_id", F.lit(None).cast("string").alias("hash_md5"), F.lit(None).cast("string").alias("unreadable")) if files is None else files
    stamped = expected.select("batch_id", _at(started).alias("timestamp_inicio"), _at(datetime.now(UTC)).alias("timestamp_fim"), "arquivo_processado")
    paths["run_records"] = _write(RU.run_records(stamped, files, check, errors, totals), f"{here}/run_records")
    return paths


def _at(moment: datetime) -> Column:
    return F.lit(moment.isoformat()).cast("timestamp")


def verify_job(spark: SparkSession, producer: dict[str, str], consumer: dict[str, str], evidence: DataFrame) -> DataFrame:
    """G11 over what two runs wrote: one row per (batch, check). ``evidence`` is
    a listing (path) of the evidence files (``sources.files.listing``)."""
    return VF.verify(written_outputs(spark, producer, consumer, evidence))


def written_outputs(spark: SparkSession, producer: dict[str, str], consumer: dict[str, str], evidence: DataFrame) -> dict[str, DataFrame]:
    """The tables that ``verify`` asks for, as the two runs wrote them."""
    processed = BatchTable(spark, consumer["processed"])
    lines = [
        EL.read_event_log(spark, run["log"], run["started_at"]).select(
            "batch_id", F.lit(stage).alias("stage"),
            (F.col("_corrupt").isNull() & (F.col("execution_id") == run["execution_id"]) & (F.col("bot_id") == run["bot_id"])).alias("ok"))
        for stage, run in (("produtor", producer), ("validador", consumer))
    ]
    tables = {t: spark.read.parquet(consumer[t]) for t in ("consumer_summary", *(f"report/{t}" for t in K.REPORT_TABLES))}
    tables |= {t: spark.read.parquet(producer[t]) for t in ("outcomes", "producer_summary", "flow_errors")}
    return tables | {
        "processed": processed.rows(),
        "open_batches": open_batches(BatchTable(spark, consumer["handoff"]), processed),
        "evidence": VF.evidence_files(evidence),
        "log": lines[0].unionByName(lines[1]),
    }
