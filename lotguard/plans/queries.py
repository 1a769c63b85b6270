"""Registered queries: one per operator key. Each takes (spark, sf_dir) and
returns a DataFrame over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import strip
from lotguard.operators import admission as A
from lotguard.operators import eventlog as EL
from lotguard.operators import landing as L
from lotguard.operators import queue as QU
from lotguard.operators import report as RP
from lotguard.operators import rules as R
from lotguard.operators import runs as RU
from lotguard.operators import validate as VAL
from lotguard.operators import verify as VF
from lotguard.operators.store import BatchTable, commit_processed, open_batches, pending_check, read_pending
from lotguard.plans import fixtures as FX
from lotguard.plans import jobs
from lotguard.session import known_small, scratch_dir, written
from lotguard.sources import testdata as td
from lotguard.sources.tables import read_table
from lotguard.streaming import stream as ST
from lotguard.streaming.ingest import Ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# --- rules on the direct path (D1 x D2) ------------------------------------

@register("divergences")
def q_divergences(spark, d):
    return R.consolidate(FX.evaluated(spark, d))


@register("violations")
def q_violations(spark, d):
    return R.violations_long(FX.evaluated(spark, d), keys=["item_id"])


def _rule_query(rule_fn):
    def q(spark, d):
        return R.rule_hits(FX.lots(spark, d), FX.reference(spark, d), rule_fn())
    return q


for _key, _fn in (("rn01_date", R.rn01), ("rn02_required", R.rn02), ("rn03_reference", R.rn03),
                  ("rn05_normalise", R.rn05), ("rn06_domain", R.rn06), ("rn07_remark", R.rn07)):
    QUERIES[_key] = _rule_query(_fn)


@register("known_lots")
def q_known_lots(spark, d):
    """Rows whose lot is in the reference list (left semi join)."""
    lots = FX.lots(spark, d).withColumn("_k", strip("lote_id"))
    keys = R.reference_keys(FX.reference(spark, d)).withColumnRenamed("lote_id", "_k")
    return lots.join(keys, "_k", "left_semi").select("item_id", "lote_id")


@register("reference_ids")
def q_reference_ids(spark, d):
    return R.reference_keys(FX.reference(spark, d))


@register("lineage")
def q_lineage(spark, d):
    rows = FX.lots(spark, d).select("batch_id", "row_idx", "source_hash")
    return L.lineage(rows).select("item_id", "batch_id", "source_row", "source_hash")


@register("serialise")
def q_serialise(spark, d):
    return A.serialise(FX.lots(spark, d)).select("item_id", *K.CONTRACT_COLUMNS)


@register("valid_lots")
def q_valid_lots(spark, d):
    return VAL.valid_lots(FX.evaluated(spark, d))


@register("human_review")
def q_human_review(spark, d):
    return VAL.human_review(FX.evaluated(spark, d)).drop("item_id")


@register("rule_distribution")
def q_rule_distribution(spark, d):
    return VAL.rule_distribution(FX.evaluated(spark, d))


@register("exception_rate")
def q_exception_rate(spark, d):
    return VAL.exception_rate(FX.evaluated(spark, d))


# --- admission (D1 -> D3, D4) -------------------------------------------------

@register("admission_rules")
def q_admission_rules(spark, d):
    rows = A.serialise(FX.lots(spark, d))
    return rows.select("item_id", A.form_message().alias("mensagem")).where(F.col("mensagem") != "")


@register("catalogue_check")
def q_catalogue_check(spark, d):
    rows = A.serialise(FX.lots(spark, d))
    return rows.where(A.off_catalogue()).select("item_id", "produto")


@register("admission_outcome")
def q_admission_outcome(spark, d):
    return A.admit(FX.lots(spark, d)).select("item_id", "cadastro_status", "cadastro_error", "cadastro_error_type")


@register("admitted")
def q_admitted(spark, d):
    return A.admitted(FX.outcomes(spark, d)).select("item_id", "batch_id")


@register("flow_errors")
def q_flow_errors(spark, d):
    return A.flow_errors(FX.outcomes(spark, d))


@register("flow_errors_summary")
def q_flow_errors_summary(spark, d):
    return A.flow_errors_summary(FX.outcomes(spark, d))


@register("producer_summary")
def q_producer_summary(spark, d):
    return A.producer_summary(FX.outcomes(spark, d))


@register("handoff_flat")
def q_handoff_flat(spark, d):
    return A.handoff(A.admit(FX.lots(spark, d)), FX.reference(spark, d))


@register("handoff_envelope")
def q_handoff_envelope(spark, d):
    return A.handoff_envelope(FX.handoff(spark, d))


@register("batch_header")
def q_batch_header(spark, d):
    """First item's values per batch."""
    h = FX.handoff(spark, d)
    return h.groupBy("batch_id").agg(
        F.min_by("reference_date", "source_row").alias("reference_date"),
        F.min_by("source_file", "source_row").alias("source_file"),
    )


# --- consumer validation (D4b) -------------------------------------------------

@register("registration_rejections")
def q_registration_rejections(spark, d):
    return VAL.registration_table(FX.consumer_evaluated(spark, d), "rejected")


@register("technical_failures")
def q_technical_failures(spark, d):
    return VAL.registration_table(FX.consumer_evaluated(spark, d), "technical")


@register("item_state")
def q_item_state(spark, d):
    return VAL.item_state(FX.consumer_evaluated(spark, d)).drop("batch_id")


@register("validation_summary")
def q_validation_summary(spark, d):
    return VAL.validation_summary(FX.consumer_evaluated(spark, d))


@register("item_metrics")
def q_item_metrics(spark, d):
    return VAL.item_metrics(VAL.item_state(FX.consumer_evaluated(spark, d)))


@register("metrics_long")
def q_metrics_long(spark, d):
    return VAL.metrics_long(VAL.validation_summary(FX.consumer_evaluated(spark, d)))


@register("not_valid_keys")
def q_not_valid_keys(spark, d):
    return VAL.not_valid_keys(FX.consumer_evaluated(spark, d))


# --- landing (D6, D9, documents) ------------------------------------------------



@register("sheet_to_table")
def q_sheet_to_table(spark, d):
    return L.sheet_to_table(FX.grid(spark, d)).drop("sheet_row")


@register("declared_total_cap")
def q_declared_total_cap(spark, d):
    grid = FX.grid(spark, d)
    kept = L.sheet_to_table(grid).groupBy("batch_id").agg(F.count(F.lit(1)).alias("kept_rows"))
    return L.declared_totals(grid).join(kept, "batch_id", "left") \
        .select("batch_id", "declared", F.coalesce("kept_rows", F.lit(0)).alias("kept_rows"))


@register("reference_date")
def q_reference_date(spark, d):
    return L.sheet_reference_dates(FX.grid(spark, d))


@register("structure_check")
def q_structure_check(spark, d):
    return L.structure_check(FX.headers(spark, d))


@register("fingerprint")
def q_fingerprint(spark, d):
    docs = read_table(spark, d, "documents", ["doc_id", "text"])
    return docs.select("doc_id", *L.fingerprint("text"))


# --- queue, pending, uniqueness (D4, D8) ------------------------------------------

def _queue(spark, d):
    return FX.queue(spark, d)


@register("bounded_queue_read")
def q_bounded_queue_read(spark, d):
    return QU.bounded_read(_queue(spark, d), FX.queue_tasks(spark, d)).select("task_id", "item_id", "foreign")


@register("batch_integrity")
def q_batch_integrity(spark, d):
    return QU.batch_integrity(_queue(spark, d), FX.queue_tasks(spark, d), FX.taken_up_sessions(spark, d))


def _session(spark, d):
    """The items that the tasks of the queue session read, written once."""
    placed = written(QU.placed_items(_queue(spark, d)), "placed")
    return written(QU.acquired_items(placed, QU.replay(placed, FX.queue_tasks(spark, d))), "acquired")


def _session_states(spark, d):
    """Items of failed sessions are ERROR/SYSTEM, others have their own state."""
    got = _session(spark, d)
    failed = QU.item_errors(got)
    good = got.where("problem is null").select("item_id").distinct().join(failed.select("item_id"), "item_id", "left_anti")
    states = VAL.item_state(FX.published_evaluated(spark, d)).join(good, "item_id", "left_semi")
    return states.select("item_id", "datapool_state", "error_type", "finish_message").unionByName(VAL.error_states(failed))


@register("processed_state")
def q_processed_state(spark, d):
    """K3: all columns of the items that sessions read, with their final state."""
    return QU.processed_state(_session_states(spark, d), FX.handoff(spark, d))


@register("still_pending")
def q_still_pending(spark, d):
    """Batches of which no item has been read."""
    read = FX.handoff(spark, d).join(_session(spark, d).select("item_id").distinct(), "item_id", "left_semi")
    return QU.still_pending(FX.handoff(spark, d), read.select("batch_id").distinct())


@register("abort_states")
def q_abort_states(spark, d):
    """A failed consumer run (structure error of the sheet) turns the
    items of its batch that are still PROCESSING (here those of even rows)
    into ERROR/SYSTEM with the run's error text; final states stay."""
    final = VAL.item_state(FX.consumer_evaluated(spark, d), keep=("source_row",))
    going = F.col("source_row") % 2 == 0
    states = final.select(
        "item_id", "batch_id", F.when(going, F.lit(K.STATE_PROCESSING)).otherwise(F.col("datapool_state")).alias("datapool_state"),
        *[F.when(going, F.lit("")).otherwise(F.col(c)).alias(c) for c in ("error_type", "finish_message")])
    errors = L.structure_check(FX.headers(spark, d)).where(~F.col("ok")) \
        .select("batch_id", F.col("message").alias("error"))
    return VAL.abort_states(states, errors).drop("batch_id")


def _with_copies(spark, d):
    h = FX.handoff(spark, d)
    return h.unionByName(h.where(F.col("source_row") % 5 == 0))


@register("dedupe_items")
def q_dedupe_items(spark, d):
    return QU.dedupe_items(_with_copies(spark, d)).select("item_id", "batch_id", "source_row")


@register("duplicate_items")
def q_duplicate_items(spark, d):
    return QU.duplicate_items(_with_copies(spark, d))


def _published(spark, d):
    """The hand-off in two publishes, that of the greatest batch last; a third
    one breaks off before its commit."""
    rows = FX.handoff(spark, d)
    last = rows.agg(F.max("batch_id")).first()[0]
    pending = BatchTable(spark, scratch_dir(spark, "pending"))
    pending.publish(rows.where(F.col("batch_id") != last), FX.reference(spark, d))
    pending.publish(rows.where(F.col("batch_id") == last).repartition(3), FX.reference(spark, d))
    pending.stage(rows.withColumn("batch_id", F.lit("broken-off")), "p9-broken-off")
    return pending


@register("read_pending")
def q_read_pending(spark, d):
    """S9 over the whole backlog."""
    return read_pending(_published(spark, d), mode="all").select("batch_id", "item_id")


@register("read_pending_newest")
def q_read_pending_newest(spark, d):
    """The batch published last, whole."""
    return read_pending(_published(spark, d)).select("batch_id", "item_id")


@register("pending_envelope")
def q_pending_envelope(spark, d):
    """Each committed batch with its total, what is there of it, and the
    reference list of its publish (count, first and last of the sorted ids)."""
    pending = _published(spark, d)
    ids = pending.reference().groupBy("publish").agg(
        F.count(F.lit(1)).alias("n_reference"), F.min("lote_id").alias("first_reference"), F.max("lote_id").alias("last_reference"))
    both = pending_check(pending).join(pending.manifest().select("batch_id", "publish"), "batch_id")
    return both.join(ids, "publish").drop("publish")


@register("processed_batches")
def q_processed_batches(spark, d):
    """Batches of odd days are processed in one commit and are no longer
    open; those of day 7 are published again afterwards and are open again."""
    rows, day = FX.handoff(spark, d), F.substring("reference_date", 1, 2).cast("int")
    folder = scratch_dir(spark, "batches")
    pending, processed = BatchTable(spark, f"{folder}/pending"), BatchTable(spark, f"{folder}/processed")
    pending.publish(rows)
    states = VAL.item_state(FX.published_evaluated(spark, d)).drop("batch_id")
    read = read_pending(pending, processed, mode="all").where(day % 2 == 1)
    commit_processed(processed, QU.processed_state(states, read))
    pending.publish(rows.where(day == 7))
    still = open_batches(pending, processed).select("batch_id", F.lit(True).alias("open"))
    done = processed.rows().groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_processed"), F.count_if(F.col("datapool_state") == K.STATE_ERROR).alias("n_error"))
    both = pending.manifest().select("batch_id", "total").join(still, "batch_id", "left").join(done, "batch_id", "left")
    zero = F.lit(0).cast("long")
    return both.select("batch_id", "total", F.coalesce("open", F.lit(False)).alias("open"),
                       F.coalesce("n_processed", zero).alias("n_processed"), F.coalesce("n_error", zero).alias("n_error"))


# --- stored copies and read-back (D4, D5) ---------------------------------------

def _stored(spark, d):
    return FX.stored(spark, d)


@register("readback_reconcile")
def q_readback_reconcile(spark, d):
    return A.reconcile(FX.handoff(spark, d), _stored(spark, d))


@register("latest_stored")
def q_latest_stored(spark, d):
    return A.latest_stored(_stored(spark, d).select("lote_id", "criadoEm", "linha"))


@register("stored_lots")
def q_stored_lots(spark, d):
    from lotguard.sources.stored import parse_stored

    return parse_stored(FX.stored_json(spark, d)).drop("doc_id", "position")


# --- runs, events, reports -------------------------------------------------------

def _events(spark, d):
    """Each run's events since its own start."""
    events = FX.run_events(spark, d)
    return EL.events_of_runs(EL.events_since(events, td.RUN_STARTED_AT), FX.run_starts(spark, d))


@register("run_events_window")
def q_run_events_window(spark, d):
    return _events(spark, d).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"))


@register("verify_log_context")
def q_verify_log_context(spark, d):
    """Runs with another bot, another execution or no event fail."""
    return EL.log_context(_events(spark, d), "bot-a", FX.run_starts(spark, d))


@register("event_log")
def q_event_log(spark, d):
    """The producer's events as JSON lines over three days, and the lines
    since a moment of the second one."""
    row = F.col("source_row")
    at = F.timestamp_seconds(F.lit(1704844800) + 86400 * (row % 3) + row)
    lines = EL.log_lines(EL.producer_events(FX.outcomes(spark, d)), "exec-1", jobs.PRODUCER_BOT, at)
    root = scratch_dir(spark, "log")
    EL.write_event_log(lines, root, "1")
    got = EL.read_event_log(spark, root, "2024-01-11 00:00:07.5")
    return got.groupBy("run", "day", "level", F.split("message", " ").getItem(0).alias("code"), "bot_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("source_row").cast("long").alias("rows"), F.count("lote_id").alias("n_lote"),
        F.min(F.date_format("timestamp", "HH:mm:ss")).alias("first_time"))


@register("report_versions")
def q_report_versions(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "ts", "event_type"])
    runs = ev.select(
        F.col("event_id").alias("run_key"),
        F.when(F.col("event_type") == "error", F.lit("relatorio_erros_fluxo_produtor"))
         .otherwise(F.lit("relatorio_divergencias")).alias("report"),
        F.col("ts").alias("started_at"),
    )
    return RP.report_versions(runs)


@register("report_claims")
def q_report_claims(spark, d):
    """K6/K4: three runs, two of them on one local day; each leaves its report."""
    tables = VAL.report_tables(FX.published_evaluated(spark, d))
    tables = {t: tables[t] for t in ("resumo", "divergencias", "falhas_tecnicas")}
    root, parts = scratch_dir(spark, "reports"), []
    for moment in (datetime(2026, 6, 14, 12), datetime(2026, 6, 15, 3), datetime(2026, 6, 15, 4)):
        for table, path in RP.write_report(tables, root, K.DIVERGENCE_REPORT, moment).items():
            name = path.split("/file=")[1].split("/")[0]
            parts.append(spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("file_name"), F.lit(table).alias("sheet"), "n"))
    return reduce(DataFrame.unionByName, parts)


@register("normalise_report_rows")
def q_normalise_report_rows(spark, d):
    return RP.normalise_report_rows(FX.loose(spark, d))


@register("audit_events")
def q_audit_events(spark, d):
    states = VAL.item_state(FX.consumer_evaluated(spark, d), keep=("cadastro_status", "lote_id", "source_row"))
    return EL.audit_events(FX.outcomes(spark, d), states)


@register("run_status")
def q_run_status(spark, d):
    prod = A.producer_summary(FX.outcomes(spark, d)).select("batch_id", RU.producer_run_status().alias("producer_status"))
    cons = VAL.consumer_run_status(VAL.validation_summary(FX.consumer_evaluated(spark, d))) \
        .withColumnRenamed("status", "consumer_status")
    return prod.join(cons, "batch_id", "full_outer")


_PRODUCER_KEYS = ["total", "itens_publicados_datapool", "erros_fluxo", "cadastros_sucesso",
                  "cadastros_rejeitados", "cadastros_falha_tecnica", "cadastros_falha"]


@register("run_totals")
def q_run_totals(spark, d):
    prod = A.producer_summary(FX.outcomes(spark, d))
    prod_m = prod.select("batch_id", F.lit("produtor").alias("stage"),
                         RU.summary_map(prod, _PRODUCER_KEYS).alias("summary"))
    ev = FX.consumer_evaluated(spark, d)
    cons = VAL.validation_summary(ev).join(VAL.item_metrics(VAL.item_state(ev)), "batch_id")
    keys = list(K.SUMMARY_METRICS) + ["total_items", "processed_items", "failed_items"]
    cons_m = cons.select("batch_id", F.lit("validador").alias("stage"), RU.summary_map(cons, keys).alias("summary"))
    return RU.run_totals(prod_m.unionByName(cons_m))


@register("run_records")
def q_run_records(spark, d):
    """K7/G6 direct path: one record per expected file: files that are missing or
    no workbook, sheets without a header or with a broken one, reference dates
    that are no date."""
    expected = FX.expected_files(spark, d)
    dated = td.with_bad_reference(FX.lots(spark, d))
    errors = known_small(written(R.bad_reference_dates(dated), "bad-references"))
    ev = R.evaluate(dated.join(errors.select("batch_id"), "batch_id", "left_anti"), FX.reference(spark, d))
    per = ev.groupBy("batch_id").agg(F.count_if(F.size("violations") > 0).alias("n_divergent"))
    totals = dated.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows")).join(per, "batch_id", "left")
    check = L.structure_check(FX.headers(spark, d)).join(expected.where(F.col("day") == 17).select("batch_id"), "batch_id", "left_anti")
    return RU.run_records(expected, td.found_files(expected), check, errors, totals)


@register("all_exceptions")
def q_all_exceptions(spark, d):
    prod = A.flow_errors(FX.outcomes(spark, d)).select("item_id", F.lit("produtor").alias("origin"))
    cons = R.consolidate(FX.published_evaluated(spark, d), keys=["item_id"]) \
        .select("item_id", F.lit("validador").alias("origin"))
    return prod.unionByName(cons)


@register("verify_run")
def q_verify_run(spark, d):
    """G11 over the written outputs of a producer and a consumer run."""
    return VF.verify(FX.run_outputs(spark, d))


@register("verify_faults")
def q_verify_faults(spark, d):
    """G11 over the same outputs with a fault for each check: the checks that
    found one."""
    outputs = FX.run_outputs(spark, d)
    days = FX.expected_files(spark, d).select("batch_id", "day")
    return VF.verify(td.faulty_outputs(outputs, days)).where(~F.col("ok")).drop("ok")


@register("guarded_rule")
def q_guarded_rule(spark, d):
    """A user rule whose predicate cannot be evaluated for a row yields
    the controlled-failure violation instead of aborting."""
    rule = R.Rule("RN01_FUTURA", 7, F.try_to_date("data", "d/M/yyyy") > F.col("_ref_day"),
                  F.lit("Data posterior à referência."), K.RN01_ACTION, K.SEV_MEDIUM, guarded=True)
    ev = R.evaluate(FX.lots(spark, d), None, rules=[rule])
    return R.violations_long(ev, keys=["item_id"]).select("item_id", "regra_violada")


@register("evidence_coverage")
def q_evidence_coverage(spark, d):
    out = FX.outcomes(spark, d)
    return A.evidence_coverage(out, td.evidence_listing(out))


@register("normalise_status")
def q_normalise_status(spark, d):
    """P4, table form: every row, mapped or not."""
    return R.normalise_status(FX.lots(spark, d)).select("item_id", "status_original", "status", "divergencia_rn05")


@register("review_routing")
def q_review_routing(spark, d):
    """P5: rows on their way to the review queue."""
    return R.review_routing(FX.evaluated(spark, d)).select(
        "item_id", "lote_id", "status", "divergencia_rn04", "status_ambiguo", "fila_destino")


@register("serialise_typed")
def q_serialise_typed(spark, d):
    """S8 with typed date cells."""
    lots = FX.lots(spark, d)
    typed = lots.withColumns({"data": F.try_to_date("data", "d/M/yyyy"), "observacao": F.try_to_date("reference_date", "d/M/yyyy").cast("timestamp_ntz")})
    return A.serialise(typed).select("item_id", "data", "observacao")


@register("reference_sheet_ids")
def q_reference_sheet_ids(spark, d):
    """S4 from the workbooks' reference sheets."""
    return L.reference_list(FX.grid(spark, d))


@register("reference_layout")
def q_reference_layout(spark, d):
    return L.reference_layout_check(FX.grid(spark, d))


@register("admission_readback")
def q_admission_readback(spark, d):
    """A3 with A5: outcomes of rows that were looked up in the target system."""
    return A.admit(FX.lots(spark, d), FX.stored(spark, d)).select("item_id", "cadastro_status", "cadastro_error", "cadastro_error_type", "evidence_name")


@register("latest_stored_listed")
def q_latest_stored_listed(spark, d):
    """W6 over the listed documents: of records of one time the first counts."""
    from lotguard.sources.stored import parse_stored

    rows = parse_stored(FX.stored_json(spark, d)).select("lote_id", "criadoEm", "linha", "doc_id", "position")
    return A.latest_stored(rows)


# --- streaming (oracles are the batch twins) -------------------------------------



def _landed(spark, d, with_copies: bool = False, short_declared: bool = False, files_per_trigger: int | None = None):
    rows = _with_copies(spark, d) if with_copies else FX.handoff(spark, d)
    if short_declared:
        # Sheets of day-of-month 13 declare one item more than they deliver.
        day13 = F.substring("reference_date", 1, 2) == "13"
        rows = rows.withColumn("batch_total", F.when(day13, F.col("batch_total") + 1).otherwise(F.col("batch_total")))
    rows = ST.with_event_time(rows)
    path = ST.land(rows, scratch_dir(spark, "handoff-landing"))
    return ST.source(spark, path, rows.schema, files_per_trigger)


@register("stream_validate")
def q_stream_validate(spark, d):
    s = ST.validate_stream(_landed(spark, d), FX.reference(spark, d))
    return ST.run_to_parquet(s, "stream-validate").select("item_id", "regra_violada", "descricao_do_erro")


@register("stream_dedupe")
def q_stream_dedupe(spark, d):
    s = ST.dedupe_stream(_landed(spark, d, with_copies=True).select("item_id", "batch_id", ST.EVENT_TIME))
    return ST.run_to_parquet(s, "stream-dedupe").select("item_id", "batch_id")


@register("stream_completeness")
def q_stream_completeness(spark, d):
    """T3 after the deadline of all batches."""
    landed = _landed(spark, d, with_copies=True, short_declared=True)
    s = ST.dedupe_stream(landed.select("item_id", "batch_id", "batch_total", ST.EVENT_TIME))
    return ST.completeness(ST.run_to_parquet(s, "stream-ingest"), F.current_timestamp() + F.expr("interval 2 days"))


#: Rows of a published file; more of them in a publication make more files.
PUBLISHED_ROWS = 500_000


def _publications(spark, d, files_per_trigger: int | None = None):
    """D4 as it is published over days: a batch's items on the day of its day of
    the month (modulo 4), copies of every fifth row two days later; items of
    even rows come three days late for day 13, half a day late for day 14. Short
    batches of days 6 and 13 declare one item more."""
    rows = FX.handoff(spark, d)
    day = F.substring("reference_date", 1, 2).cast("int")
    even = F.col("source_row") % 2 == 0
    hours = F.col("_day") % 4 * 24 + F.when((F.col("_day") == 13) & even, 72).when((F.col("_day") == 14) & even, 12).otherwise(0)
    rows = rows.withColumn("_day", day).withColumn("batch_total", F.col("batch_total") + F.when(day.isin(6, 13), 1).otherwise(0))
    both = rows.withColumn("_h", hours).unionByName(rows.where(F.col("source_row") % 5 == 0).withColumn("_h", hours + 48))
    both = both.select("item_id", "batch_id", "batch_total", "source_row", F.timestamp_seconds(F.lit(1704844800) + 3600 * F.col("_h")).alias(ST.EVENT_TIME))
    both = written(both, "publications")
    path = scratch_dir(spark, "publications-landing")
    moments = both.groupBy(ST.EVENT_TIME).agg(F.count(F.lit(1)).alias("n")).orderBy(ST.EVENT_TIME).collect()  # a handful
    # Two files a publication, more where it is large; a trigger takes as many
    # publications as before.
    files = max(2, ceil(max([m["n"] for m in moments], default=0) / PUBLISHED_ROWS))
    for moment in moments:
        ST.land(both.where(F.col(ST.EVENT_TIME) == F.lit(moment[ST.EVENT_TIME])).coalesce(files), path)
    return ST.source(spark, path, both.schema, files_per_trigger and files_per_trigger * files // 2)


def _ingested(spark, d):
    """T2/T3 in several triggers."""
    ingest = Ingest(spark, scratch_dir(spark, "ingest"))
    ingest.run(_publications(spark, d, files_per_trigger=4))
    return ingest


@register("stream_ingest")
def q_stream_ingest(spark, d):
    """Copies that come days later are not ingested again."""
    return _ingested(spark, d).items().select("item_id", "batch_id", F.date_format(ST.EVENT_TIME, "yyyy-MM-dd HH:mm").alias("published"))


@register("stream_batches")
def q_stream_batches(spark, d):
    """What each batch came to, with its late items."""
    ingest = _ingested(spark, d)
    late = ingest.late_items().groupBy("batch_id").agg(F.count(F.lit(1)).alias("late"))
    return ingest.batches().join(late, "batch_id", "left").select("batch_id", "received", "expected", "state", F.coalesce("late", F.lit(0)).alias("late"))
