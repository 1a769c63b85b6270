"""Validation outputs (consumer side): routing, item states, summaries
(C1-C8, G1, G2, G5, G6, U2, U4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import or_default, strip, truncate_message
from lotguard.operators.rules import consolidate, evaluate, select_where
from lotguard.session import known_small, written


def _v() -> Column:
    return F.col("violations")


def rejected() -> Column:
    return F.coalesce(F.col("cadastro_status") == K.OUTCOME_REJECTED, F.lit(False))


def technical() -> Column:
    return F.coalesce(F.col("cadastro_status").isin(K.OUTCOME_TECHNICAL, K.OUTCOME_TECHNICAL_LEGACY), F.lit(False))


def with_exclusion(evaluated: DataFrame) -> DataFrame:
    """excluded = registration rejected or failed; still validated."""
    if "cadastro_status" not in evaluated.columns:  # direct path: nothing was registered
        evaluated = evaluated.withColumn("cadastro_status", F.lit(None).cast("string"))
    return evaluated.withColumn("_excluded", rejected() | technical())


def validate_handoff(items: DataFrame, reference: DataFrame | None = None) -> DataFrame:
    """Consumer validation of hand-off rows.

    Without an explicit reference list, RN03 uses the reference each record
    carries (``reference_lotes_json``): a record's list always holds its own
    lot when that lot is known, whether it carries the whole batch list or
    only its own entry, so the check is row-local - no join, no shuffle."""
    if reference is None:
        carried = F.from_json("reference_lotes_json", "array<string>")
        known = F.array_contains(carried, strip("lote_id"))
        return with_exclusion(evaluate(items, None, known=known))
    return with_exclusion(evaluate(items, reference))


def valid_lots(evaluated: DataFrame) -> DataFrame:
    """Rows without violations that were not excluded; status normalised."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    return select_where(ev, (F.size(_v()) == 0) & ~F.col("_excluded"),
                        "item_id", *K.CONTRACT_COLUMNS, "status_original", "divergencia_rn05")


def not_valid_keys(evaluated: DataFrame) -> DataFrame:
    """Divergent or excluded row keys (a boolean OR on the fused row)."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    return select_where(ev, (F.size(_v()) > 0) | F.col("_excluded"), "item_id")


def human_review(evaluated: DataFrame, by_batch: bool = False) -> DataFrame:
    """One row per RN06 row (behind batch_id, ``by_batch``)."""
    rules = _v().getField("regra")
    return select_where(
        evaluated, F.array_contains(rules, "RN06"),
        *(["batch_id"] if by_batch else []),
        "item_id",
        "lote_id",
        "status_original",
        "status",
        "data",
        F.element_at(_v().getField("descricao"), F.array_position(rules, "RN06").cast("int")).alias("descricao_do_erro"),
        F.lit("").alias("observacao_analista"),
    )


def registration_table(evaluated: DataFrame, which: str, by_batch: bool = False) -> DataFrame:
    """Registration rejections or technical failures, 7 columns,
    missing values as '' (behind batch_id, ``by_batch``)."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    rows = ev.where(rejected() if which == "rejected" else technical())
    return rows.select(*(["batch_id"] if by_batch else []), *[
        F.coalesce(F.col(c).cast("string") if c in rows.columns else F.lit(None).cast("string"), F.lit("")).alias(c)
        if c != "source_row" else F.col(c)
        for c in K.REGISTRATION_COLUMNS
    ])


def item_state(evaluated: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Final state per item (technical, rejected, ok, divergent)."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    # The consolidated text is a projection of the same row (no join needed).
    first = F.array_join(F.array_distinct(_v().getField("regra")), "; ")
    descs = F.array_join(_v().getField("descricao"), " | ")
    err = F.coalesce(F.col("cadastro_error").cast("string"), F.lit("")) if "cadastro_error" in ev.columns else F.lit("")
    state = F.when(technical() | rejected() | (F.size(_v()) > 0), F.lit(K.STATE_ERROR)).otherwise(F.lit(K.STATE_DONE))
    etype = F.when(technical(), F.lit(K.ERROR_SYSTEM)) \
             .when(rejected() | (F.size(_v()) > 0), F.lit(K.ERROR_BUSINESS)).otherwise(F.lit(""))
    msg = F.when(technical(), truncate_message(or_default(err, K.MSG_TECHNICAL_DEFAULT))) \
           .when(rejected(), truncate_message(or_default(err, K.MSG_REJECTED_DEFAULT))) \
           .when(F.size(_v()) == 0, F.lit(K.MSG_DONE)) \
           .otherwise(truncate_message(F.concat(first, F.lit(": "), descs)))
    return ev.select("item_id", "batch_id", state.alias("datapool_state"), etype.alias("error_type"),
                     msg.alias("finish_message"), *keep)


def abort_states(states: DataFrame, batch_errors: DataFrame) -> DataFrame:
    """In a batch whose run failed, items still PROCESSING become
    ERROR/SYSTEM with the run's error text.

    ``states`` has datapool_state per item; ``batch_errors`` (batch_id, error)
    lists failed runs. Items of a failed batch that had not been given a state
    before the failure are PROCESSING; a failure found before the item loop
    (structure, integrity) leaves every item PROCESSING. Final states are never
    overwritten, nor items of other batches."""
    failed = known_small(written(batch_errors.select("batch_id", F.col("error").alias("_run_error")).distinct(), "failed-batches"))
    j = states.join(failed, "batch_id", "left")
    hit = F.col("_run_error").isNotNull() & (F.col("datapool_state") == K.STATE_PROCESSING)
    kept = [c for c in states.columns if c not in ("datapool_state", "error_type", "finish_message")]
    return j.select(
        *kept,
        F.when(hit, F.lit(K.STATE_ERROR)).otherwise(F.col("datapool_state")).alias("datapool_state"),
        F.when(hit, F.lit(K.ERROR_SYSTEM)).otherwise(F.col("error_type")).alias("error_type"),
        F.when(hit, truncate_message(F.col("_run_error"))).otherwise(F.col("finish_message")).alias("finish_message"),
    )


def error_states(errors: DataFrame) -> DataFrame:
    """ERROR/SYSTEM states of items (item_id, error) that a failed session
    had read."""
    return errors.select("item_id", F.lit(K.STATE_ERROR).alias("datapool_state"), F.lit(K.ERROR_SYSTEM).alias("error_type"),
                         truncate_message(F.col("error")).alias("finish_message"))


def validation_summary(evaluated: DataFrame) -> DataFrame:
    """G1 per batch in one pass (partial + final aggregate)."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    n = F.size(_v())
    has_rn06 = F.array_contains(_v().getField("regra"), "RN06")
    return ev.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(n > 0).alias("total_divergencias"),
        F.sum(n).cast("long").alias("total_regras_violadas"),
        F.count_if((n == 0) & ~F.col("_excluded")).alias("total_lotes_validados"),
        F.count_if(has_rn06).alias("total_revisao_humana"),
        F.count_if(rejected()).alias("total_rejeicoes_cadastro"),
        F.count_if(technical()).alias("total_falhas_tecnicas"),
    )


def item_metrics(states: DataFrame) -> DataFrame:
    """G2 per batch."""
    done = F.count_if(F.col("datapool_state") == K.STATE_DONE)
    return states.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        done.alias("processed_items"),
    ).withColumn("failed_items", F.col("total_items") - F.col("processed_items"))


def metrics_long(summary: DataFrame, metrics: tuple[str, ...] = K.SUMMARY_METRICS) -> DataFrame:
    """Unpivot a per-batch summary into (batch_id, metrica, valor)."""
    return summary.select("batch_id", *[F.col(m).cast("long").alias(m) for m in metrics]) \
        .unpivot(["batch_id"], list(metrics), "metrica", "valor")


def consumer_run_status(summary: DataFrame) -> DataFrame:
    """G6 consumer: partial when any technical failure, else success."""
    return summary.select(
        "batch_id",
        F.when(F.col("total_falhas_tecnicas") > 0, F.lit(K.RUN_PARTIAL)).otherwise(F.lit(K.RUN_SUCCESS)).alias("status"),
    )


def exception_rate(evaluated: DataFrame) -> DataFrame:
    """Exceptions (divergent rows) over input rows per batch."""
    g = evaluated.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.size(_v()) > 0).alias("exceptions"),
    )
    return g.withColumn("rate", F.round(F.try_divide(F.col("exceptions").cast("double"), F.col("total")), 6))


def rule_distribution(evaluated: DataFrame) -> DataFrame:
    """Violations per rule; the explode feeds a partial aggregate, so the
    shuffle carries one row per (task, rule)."""
    return evaluated.select(F.explode_outer(_v().getField("regra")).alias("regra")).where(F.col("regra").isNotNull()) \
        .groupBy("regra").agg(F.count(F.lit(1)).alias("n"))


def report_tables(evaluated: DataFrame) -> dict[str, DataFrame]:
    """K4: the six tables of the validation report, keyed by batch. Empty
    tables keep their columns (fixed projections)."""
    ev = evaluated if "_excluded" in evaluated.columns else with_exclusion(evaluated)
    keep = ["batch_id", "item_id"]
    return {
        "resumo": metrics_long(validation_summary(ev)),
        "divergencias": consolidate(ev, keys=["batch_id", "item_id", "lote_id"]),
        "lotes_validados": select_where(ev, (F.size(_v()) == 0) & ~F.col("_excluded"),
                                        *keep, *K.CONTRACT_COLUMNS, "status_original", "divergencia_rn05"),
        "rejeicoes_cadastro": registration_table(ev, "rejected", by_batch=True),
        "falhas_tecnicas": registration_table(ev, "technical", by_batch=True),
        "revisao_humana": human_review(ev, by_batch=True),
    }
