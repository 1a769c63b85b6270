"""End-to-end jobs on the original 25-row sheet, checked like the original
post-run verification."""

import pytest
from pyspark.sql import functions as F

from golden import golden_df, reference_df, reference_ids
from lotguard.functions import constants as K
from lotguard.operators import verify as VF
from lotguard.operators.store import BatchTable
from lotguard.plans import jobs
from lotguard.sources.files import listing


def test_producer_consumer_verify(spark, tmp_path):
    prod = jobs.producer_job(spark, golden_df(spark), reference_df(spark), str(tmp_path / "p"))
    summary = spark.read.parquet(prod["producer_summary"]).first()
    assert (summary["total"], summary["itens_publicados_datapool"], summary["erros_fluxo"]) == (25, 24, 1)
    assert (summary["cadastros_rejeitados"], summary["cadastros_falha_tecnica"]) == (1, 0)
    assert summary["status"] == "PARTIALLY_COMPLETED"
    flow = spark.read.parquet(prod["flow_errors"]).collect()
    assert [(r["source_row"], r["cadastro_status"]) for r in flow] == [(27, "REJEITADO_NEGOCIO")]
    assert BatchTable(spark, prod["handoff"]).rows().count() == 24
    assert BatchTable(spark, prod["handoff"]).reference().where("batch_id is null").count() == len(reference_ids())
    assert "relatorio_erros_fluxo_produtor_" in prod["flow_report/erros_fluxo"]

    cons = jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"))
    cs = spark.read.parquet(cons["consumer_summary"]).first()
    assert (cs["total_registros"], cs["total_divergencias"], cs["total_regras_violadas"],
            cs["total_lotes_validados"], cs["total_rejeicoes_cadastro"], cs["total_falhas_tecnicas"]) == \
        (24, 8, 9, 16, 0, 0)
    assert cs["status"] == "SUCCESS"
    processed = BatchTable(spark, cons["processed"]).rows()
    assert set(K.HANDOFF_FIELDS) < set(processed.columns)
    by = {(r[0], r[1]): r[2] for r in processed.groupBy("datapool_state", "error_type").count().collect()}
    assert by == {("DONE", ""): 16, ("ERROR", "BUSINESS"): 8}
    assert processed.where(F.col("evidence_name") == "").count() == 0
    report = {k.split("/", 1)[1]: spark.read.parquet(v) for k, v in cons.items() if k.startswith("report/")}
    assert {k: v.count() for k, v in report.items()} == {
        "resumo": 7, "divergencias": 8, "lotes_validados": 16, "rejeicoes_cadastro": 0,
        "falhas_tecnicas": 0, "revisao_humana": 2}
    assert report["falhas_tecnicas"].columns == ["batch_id", *K.REGISTRATION_COLUMNS]

    evidence = tmp_path / "evidence"
    for r in spark.read.parquet(prod["outcomes"]).collect():
        file = evidence / r["batch_id"] / "produtor" / r["evidence_name"]
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"png")
    checks = jobs.verify_job(spark, prod, cons, listing(spark, str(evidence))).collect()
    assert [r["check"] for r in checks if not r["ok"]] == [] and len(checks) == len(VF.CHECKS)
    file.unlink()
    checks = jobs.verify_job(spark, prod, cons, listing(spark, str(evidence))).collect()
    assert "evidencias_arquivos" in {r["check"] for r in checks if not r["ok"]}

    # nothing is pending any more, and nothing is overwritten
    with pytest.raises(FileNotFoundError, match="Nenhum lote pendente"):
        jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"))
    again = jobs.producer_job(spark, golden_df(spark), reference_df(spark), str(tmp_path / "p"))
    assert again["flow_report/resumo"] != prod["flow_report/resumo"]
    second = jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"))
    assert "_2.xlsx" in second["report/resumo"] and spark.read.parquet(cons["report/divergencias"]).count() == 8
    with pytest.raises(FileExistsError):
        jobs.producer_job(spark, golden_df(spark), reference_df(spark), str(tmp_path / "p"), run=again["run"].rpartition("/")[2])


def test_direct_check_job(spark, tmp_path):
    rows = golden_df(spark)
    cells = F.array(*[F.col(c) for c in K.CONTRACT_COLUMNS])
    data = rows.select("batch_id", F.lit("Inspecao_14_06_2026").alias("sheet_name"),
                       (F.col("row_idx") + 4).alias("row_no"), cells.alias("cells"))
    head = spark.createDataFrame(
        [("g", "Inspecao_14_06_2026", 3, list(K.CONTRACT_COLUMNS)),
         ("bad", "Plan1", 3, [c for c in K.CONTRACT_COLUMNS if c != "status"])],
        "batch_id string, sheet_name string, row_no int, cells array<string>")
    grid = data.withColumn("batch_id", F.lit("g")).unionByName(head)
    out = jobs.direct_check_job(spark, grid, reference_df(spark), str(tmp_path / "d"))
    rec = {r["batch_id"]: r for r in spark.read.parquet(out["run_records"]).collect()}
    assert (rec["g"]["total_registros"], rec["g"]["total_divergencias"], rec["g"]["status_execucao"]) == \
        (25, 9, "SUCESSO")
    assert rec["bad"]["status_execucao"] == "ERRO_ESTRUTURA"
    assert rec["bad"]["erro"] == "[RN01] Estrutura inválida. Colunas ausentes: status"
    assert spark.read.parquet(out["report/divergencias"]).count() == 9
    assert spark.read.parquet(out["report/lotes_validados"]).count() == 16
    assert spark.read.parquet(out["report/revisao_humana"]).count() == 2


def test_consumer_failure_marks_items_as_system_errors(spark, tmp_path):
    prod = jobs.producer_job(spark, golden_df(spark).withColumn("reference_date", F.lit("99/99/2026")),
                             reference_df(spark), str(tmp_path / "p"))
    cons = jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"))
    assert cons["status"] == "FAILED" and cons["error"]
    states = spark.read.parquet(cons["states"])
    by = {(r[0], r[1]): r[2] for r in states.groupBy("datapool_state", "error_type").count().collect()}
    assert by == {("ERROR", "SYSTEM"): 24}
    assert states.where(F.length("finish_message") > 1000).count() == 0


def test_a_bad_batch_fails_alone(spark, tmp_path):
    rows = golden_df(spark)
    bad = rows.withColumns({"batch_id": F.lit("bad"), "item_id": F.concat(F.lit("bad-"), "item_id"), "reference_date": F.lit("99/99/2026")})
    prod = jobs.producer_job(spark, rows.unionByName(bad), reference_df(spark), str(tmp_path / "p"))
    cons = jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"))
    assert cons["status"] == "PARTIALLY_COMPLETED" and "99/99/2026" in cons["error"]
    states, processed = spark.read.parquet(cons["states"]), BatchTable(spark, cons["processed"]).rows()
    both = ["item_id", "datapool_state", "error_type", "finish_message"]
    assert states.select(both).exceptAll(processed.select(both)).count() == 0 and states.count() == processed.count() == 48
    by = {tuple(r)[:3]: r["count"] for r in states.groupBy("batch_id", "datapool_state", "error_type").count().collect()}
    assert by.pop(("bad", "ERROR", "SYSTEM")) == 24 and sorted(by.values()) == [8, 16]


def test_platform_errors_are_raised(spark, tmp_path):
    with pytest.raises(Exception):
        jobs.consumer_job(spark, str(tmp_path / "nothing"), str(tmp_path / "c"))


def test_sessions_over_a_queue(spark, tmp_path):
    """A short batch, a foreign item and a task of another batch: the items that
    were read are ERROR/SYSTEM, the others as always, the unread stay open."""
    rows = golden_df(spark)
    four = rows.where("row_idx < 5").select("*").crossJoin(spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "b string"))
    four = four.withColumns({"batch_id": F.col("b"), "item_id": F.concat("b", F.lit("-"), "item_id")}).drop("b")
    prod = jobs.producer_job(spark, four, reference_df(spark), str(tmp_path / "p"))
    items = BatchTable(spark, prod["handoff"]).rows()
    total = F.when(F.col("batch_id") == "B", 6).otherwise(F.col("batch_total"))
    queue = items.select(F.lit("q").alias("queue_id"), (F.ascii("batch_id") * 100 + F.col("source_row")).alias("seq"), "item_id", "batch_id", total.alias("batch_total"))
    tasks = spark.createDataFrame([("t1", "q", 0, "A", 5), ("t2", "q", 5, None, None), ("t3", "q", 12, "A", 2), ("t4", "q", 99, None, 0)],
                                  "task_id string, queue_id string, start long, batch_id string, batch_total int")
    cons = jobs.consumer_job(spark, prod["handoff"], str(tmp_path / "c"), queue=queue, tasks=tasks)
    found = {r["task_id"]: (r["problem"], r["message"]) for r in spark.read.parquet(cons["sessions"]).collect()}
    foreign = "Item do lote 'C' recebido durante o lote '{}'."
    assert found == {"t1": (None, None), "t2": ("foreign_item", foreign.format("B")), "t3": ("foreign_item", foreign.format("A")),
                     "t4": ("empty", "DataPool 'q' sem itens pendentes.")}
    states = {(r["batch_id"], r["error_type"], r["finish_message"] if r["error_type"] == "SYSTEM" else ""): r["count"] for r in
              spark.read.parquet(cons["states"]).groupBy("batch_id", "error_type", "finish_message").count().collect()}
    assert states[("B", "SYSTEM", foreign.format("B"))] == 5
    assert states[("C", "SYSTEM", foreign.format("B"))] == 1 and states[("C", "SYSTEM", foreign.format("A"))] == 1
    assert {b for b, *_ in states} == {"A", "B", "C"} and cons["status"] == "PARTIALLY_COMPLETED"
    from lotguard.operators.store import open_batches

    assert [r["batch_id"] for r in open_batches(BatchTable(spark, prod["handoff"]), BatchTable(spark, cons["processed"])).collect()] == ["D"]


def test_incomplete_batch_is_not_validated(spark, tmp_path):
    pending = BatchTable(spark, str(tmp_path / "h"))
    prod = jobs.producer_job(spark, golden_df(spark), reference_df(spark), str(tmp_path / "p"))
    rows = BatchTable(spark, prod["handoff"]).rows()
    pending.publish(rows.where("source_row > 6"))
    cons = jobs.consumer_job(spark, pending.root, str(tmp_path / "c"))
    n = rows.where("source_row > 6").count()
    assert cons["status"] == "FAILED" and cons["error"] == f"Lote incompleto: esperados 24, recebidos {n}."
    states = spark.read.parquet(cons["states"])
    assert states.where("error_type = 'SYSTEM'").count() == states.count() == n


def test_direct_check_records_every_file(spark, tmp_path):
    head, day = list(K.CONTRACT_COLUMNS), "14/06/2026"
    line = ["LG-2026-00101", "TV43-FHD", "L1", "A", "APROVADO", "Ana", day, None]
    grid = [(b, 0, "Plan", 3, head) for b in ("ok", "late")] + [(b, 0, "Plan", 4, line) for b in ("ok", "late")]
    grid += [("ok", 1, K.REFERENCE_SHEET, 2, ["lote_id"]), ("ok", 1, K.REFERENCE_SHEET, 3, ["LG-2026-00101"]), ("broken", 0, "Plan", 3, ["x"]), ("headless", 0, "Plan", 1, ["t"])]
    grid = spark.createDataFrame(grid, "batch_id string, sheet_no int, sheet_name string, row_no int, cells array<string>")
    names = ["ok", "late", "broken", "headless", "absent", "zip"]
    expected = spark.createDataFrame([(b, f"{b}.xlsx") for b in names], "batch_id string, arquivo_processado string")
    files = spark.createDataFrame([(b, f"md5-{b}", "File is not a zip file" if b == "zip" else None) for b in names if b != "absent"], "batch_id string, hash_md5 string, unreadable string")
    dates = spark.createDataFrame([("ok", day), ("late", "99/99/2026")], "batch_id string, reference_date string")
    out = jobs.direct_check_job(spark, grid, None, str(tmp_path / "d"), expected=expected, files=files, reference_dates=dates)
    got = {r["batch_id"]: (r["status_execucao"], r["total_registros"], r["total_divergencias"], r["erro"], r["hash_md5"]) for r in spark.read.parquet(out["run_records"]).collect()}
    assert got == {
        "ok": ("SUCESSO", 1, 0, None, "md5-ok"),
        "late": ("ERRO_PROCESSAMENTO", 1, 0, "time data '99/99/2026' does not match format '%d/%m/%Y'", "md5-late"),
        "broken": ("ERRO_ESTRUTURA", 0, 0, got["broken"][3], "md5-broken"),
        "headless": ("ERRO_ARQUIVO", 0, 0, "Planilha sem cabeçalho: headless.xlsx", "md5-headless"),
        "absent": ("ERRO_ARQUIVO", 0, 0, "Arquivo não encontrado: absent.xlsx", None),
        "zip": ("ERRO_ARQUIVO", 0, 0, "File is not a zip file", "md5-zip"),
    }
    assert got["broken"][3].startswith(K.STRUCTURE_PREFIX)
    bad = jobs.direct_check_job(spark, grid, None, str(tmp_path / "d"), reference_date="99/99/2026")
    assert "report/resumo" not in bad
    assert {r["status_execucao"] for r in spark.read.parquet(bad["run_records"]).collect()} == {"ERRO_PROCESSAMENTO", "ERRO_ESTRUTURA", "ERRO_ARQUIVO"}
