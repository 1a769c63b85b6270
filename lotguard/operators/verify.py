"""Verification of what a run has written.

Measures are aggregates by batch over the written tables; checks compare two
expressions of measures. Each table is read once, its measures are partial
aggregates, and the rows of all tables meet in one grouping by batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import base_name


def _rows() -> Column:
    return F.count(F.lit(1))


def _is(column: str, value: str) -> Column:
    return F.count_if(F.col(column) == value)


def evidence_files(listing: DataFrame) -> DataFrame:
    """The files of a listing (path) of <root>/<batch>/produtor/<name>."""
    return listing.select(F.regexp_extract("path", r"([^/]+)/produtor/[^/]+$", 1).alias("batch_id"), base_name("path").alias("name"))


def measures() -> dict[str, dict[str, Column]]:
    """Per table (its name in ``verify``) the measures taken of it by batch."""
    named = (F.col("evidence_name") != "") & (F.col("evidence_path") != "")
    return {
        "outcomes": {"rows": _rows(), "published": _is("cadastro_status", K.OUTCOME_SUCCESS), "rejected": _is("cadastro_status", K.OUTCOME_REJECTED)},
        "producer_summary": {"p_published": F.sum("itens_publicados_datapool"), "p_flow_errors": F.sum("erros_fluxo")},
        "flow_errors": {"flow_errors": _rows()},
        "processed": {
            "states": _rows(), "processing": _is("datapool_state", K.STATE_PROCESSING), "done": _is("datapool_state", K.STATE_DONE),
            "error": _is("datapool_state", K.STATE_ERROR), "business": _is("error_type", K.ERROR_BUSINESS), "named": F.count_if(named)},
        "open_batches": {"open": _rows()},
        "consumer_summary": {"s_total": F.sum("total_registros"), **{f"s_{m}": F.sum(m) for m in K.SUMMARY_METRICS[1:]}},
        **{f"report/{t}": {f"r_{t}": _rows()} for t in K.REPORT_TABLES},
        "evidence": {
            "files": _rows(), "files_ok": F.count_if(F.col("name").startswith(K.EVIDENCE_OK)), "files_rejected": F.count_if(F.col("name").startswith(K.EVIDENCE_REJECTED))},
        "log": {"log_bad": F.count_if(~F.col("ok")),
                **{f"log_{s}": F.max(F.when(F.col("stage") == s, 1).otherwise(0)) for s in ("produtor", "validador")}},
    }


#: (check, expected, actual) over the measures of a batch; absent ones are 0.
CHECKS = [
    ("publicados_processados", "published", "states"),
    ("sem_processing", "0", "processing"),
    ("done_mais_error", "states", "done + error"),
    ("divergentes_business", "r_divergencias", "business"),
    ("pendente_removido", "0", "open"),
    ("resumo_produtor", "published", "p_published"),
    ("erros_fluxo", "p_flow_errors", "flow_errors"),
    ("resumo_validador", "states", "s_total"),
    ("evidencias_nomeadas", "states", "named"),
    ("evidencias_arquivos", "rows", "files"),
    ("evidencias_comprovante", "published", "files_ok"),
    ("evidencias_rejeicao", "rejected", "files_rejected"),
    ("relatorio_resumo", str(len(K.SUMMARY_METRICS)), "r_resumo"),
    ("relatorio_divergencias", "s_total_divergencias", "r_divergencias"),
    ("relatorio_lotes_validados", "s_total_lotes_validados", "r_lotes_validados"),
    ("relatorio_rejeicoes_cadastro", "s_total_rejeicoes_cadastro", "r_rejeicoes_cadastro"),
    ("relatorio_falhas_tecnicas", "s_total_falhas_tecnicas", "r_falhas_tecnicas"),
    ("relatorio_revisao_humana", "s_total_revisao_humana", "r_revisao_humana"),
    ("log_contexto", "0", "log_bad"),
    ("log_produtor", "1", "log_produtor"),
    ("log_validador", "1", "log_validador"),
]


def verify(tables: dict[str, DataFrame]) -> DataFrame:
    """(batch_id, check, expected, actual, ok) for every batch that any of
    the written tables knows, all of which carry ``batch_id``. ``log`` has a row
    per event or per group of equal ones: stage, and ok (its ids are the run's).
    A missing table is an error: its checks can't pass."""
    known = measures()
    lacking = sorted(set(known) - set(tables))
    if lacking:
        raise KeyError(f"tables not given: {', '.join(lacking)}")
    taken = [tables[t].groupBy("batch_id").agg(*[c.cast("long").alias(f"m_{n}") for n, c in ms.items()]) for t, ms in known.items()]
    columns = [f"m_{n}" for ms in known.values() for n in ms]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), taken)
    one = rows.groupBy("batch_id").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c.removeprefix("m_")) for c in columns])
    return stacked(one, CHECKS)


def stacked(per_batch: DataFrame, checks: list[tuple[str, str, str]]) -> DataFrame:
    """A row for each batch and check, without a shuffle."""
    parts = ", ".join(f"'{name}', CAST({e} AS BIGINT), CAST({a} AS BIGINT)" for name, e, a in checks)
    long = per_batch.selectExpr("batch_id", f"stack({len(checks)}, {parts}) AS (check, expected, actual)")
    return long.withColumn("ok", F.col("expected") == F.col("actual"))
