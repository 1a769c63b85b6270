"""Run records, run status and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import message_of


def producer_run_status() -> Column:
    """G6 producer: FAILED when nothing was published, PARTIALLY_COMPLETED
    when any flow error, else SUCCESS."""
    return F.when(F.col("itens_publicados_datapool") == 0, F.lit(K.RUN_FAILED)) \
            .when(F.col("erros_fluxo") > 0, F.lit(K.RUN_PARTIAL)).otherwise(F.lit(K.RUN_SUCCESS))


def run_totals(summary: DataFrame) -> DataFrame:
    """Totals ladder over a summary map (batch_id, stage, summary)."""
    m = F.col("summary")

    def g(key: str) -> Column:
        return F.try_element_at(m, F.lit(key)).cast("long")

    total = F.coalesce(g("total_items"), g("total"), g("total_registros"), F.lit(0).cast("long"))
    failed = F.coalesce(g("failed_items"), g("cadastros_falha"), g("cadastros_falha_tecnica"),
                        g("total_falhas_tecnicas"), F.lit(0).cast("long"))
    processed = F.coalesce(g("processed_items"), total - failed)
    return summary.select("batch_id", "stage", total.alias("total_items"), failed.alias("failed_items"),
                          processed.alias("processed_items"))


def summary_map(df: DataFrame, keys: list[str]) -> Column:
    return F.create_map(*[x for k in keys for x in (F.lit(k), F.col(k).cast("string"))])


def run_records(expected: DataFrame, files: DataFrame, structure: DataFrame, errors: DataFrame, totals: DataFrame) -> DataFrame:
    """K7/G6 of the direct path: one record per expected file, read or not.

    ``expected``: batch_id, arquivo_processado, timestamp_inicio, timestamp_fim;
    ``files``: batch_id, hash_md5 and, where a file is there but can't be read as
    a sheet, ``unreadable`` (the error's text); ``structure``: batch_id, ok,
    message (P0); ``errors``: batch_id, error of batches whose rules couldn't
    run; ``totals``: batch_id, n_rows, n_divergent. A record's status is that of
    the first step that failed; only a record of a run that succeeded counts
    divergences, and one that failed before its rows were read counts no rows."""
    found = files.select("batch_id", "hash_md5", F.col("unreadable").alias("_unreadable"), F.lit(True).alias("_there"))
    checks = structure.select("batch_id", F.col("ok").alias("_ok"), F.col("message").alias("_structure"))
    j = expected.join(found, "batch_id", "left").join(checks, "batch_id", "left") \
        .join(errors.select("batch_id", F.col("error").alias("_error")), "batch_id", "left").join(totals, "batch_id", "left")
    missing, unreadable = F.col("_there").isNull(), F.col("_unreadable").isNotNull() | F.col("_ok").isNull()
    status = F.when(missing | unreadable, F.lit(K.RECORD_FILE_ERROR)).when(~F.col("_ok"), F.lit(K.RECORD_STRUCTURE_ERROR)) \
              .when(F.col("_error").isNotNull(), F.lit(K.RECORD_PROCESSING_ERROR)).otherwise(F.lit(K.RECORD_SUCCESS))
    text = F.when(missing, message_of(K.MSG_FILE_MISSING, "arquivo_processado")) \
            .when(unreadable, F.coalesce("_unreadable", message_of(K.MSG_FILE_EMPTY, "arquivo_processado"))) \
            .when(~F.col("_ok"), F.col("_structure")).otherwise(F.col("_error"))
    n = lambda c, *of: F.when(F.col("status_execucao").isin(*of), F.coalesce(c, F.lit(0))).otherwise(F.lit(0)).cast("long")
    return j.withColumns({"status_execucao": status, "erro": text}).select(
        "batch_id", "timestamp_inicio", "timestamp_fim", "arquivo_processado", "hash_md5",
        n("n_rows", K.RECORD_SUCCESS, K.RECORD_PROCESSING_ERROR).alias("total_registros"), n("n_divergent", K.RECORD_SUCCESS).alias("total_divergencias"),
        "status_execucao", "erro")
