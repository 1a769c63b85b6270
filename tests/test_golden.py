"""Golden end-to-end figures of the original process on its 25-row sheet."""

from pyspark.sql import functions as F

from golden import golden_df, reference_df
from lotguard.functions import constants as K
from lotguard.operators import admission as A
from lotguard.operators import rules as R
from lotguard.operators import validate as VAL


def _rows(df):
    return [r.asDict() for r in df.collect()]


def test_direct_path_counts(spark):
    ev = R.evaluate(golden_df(spark), reference_df(spark), reference_date=K.DEFAULT_REFERENCE_DATE)
    div = R.consolidate(ev)
    assert ev.count() == 25
    assert div.count() == 9
    assert R.violations_long(ev).count() == 10
    assert VAL.valid_lots(ev).count() == 16
    assert VAL.human_review(ev).count() == 2
    assert div.where(F.col("lote_id") == "LG-2026-00115").count() == 1


def test_direct_path_texts(spark):
    ev = R.evaluate(golden_df(spark), reference_df(spark), reference_date=K.DEFAULT_REFERENCE_DATE)
    div = {r["lote_id"]: r for r in _rows(R.consolidate(ev))}
    r107 = div["LG-2026-00107"]
    assert r107["regra_violada"] == "RN05; RN07"
    assert r107["descricao_do_erro"] == (
        "[RN05] Status 'NOK' normalizado para 'REPROVADO'. | "
        "Status REPROVADO exige preenchimento da observação."
    )
    assert r107["acao_recomendada"] == (
        "Registrar a normalização e seguir o fluxo automático. | Encaminhar ao analista para preenchimento"
    )
    assert r107["severidade"] == "Alta"
    # A lone Baixa is reported as Média.
    assert div["LG-2026-00105"]["severidade"] == "Média"
    assert div["LG-2026-00103"]["descricao_do_erro"] == (
        "[RN03] lote_id 'LG-2026-00103' não encontrado na base de referência."
    )
    assert div["LG-2026-00109"]["descricao_do_erro"] == "Campos obrigatórios vazios: responsavel."
    assert div[""]["descricao_do_erro"] == "Campos obrigatórios vazios: lote_id."
    assert div["LG-2026-00115"]["descricao_do_erro"] == (
        "[RN01] Data '15/06/2026' fora da referência '14/06/2026'."
    )
    assert div["LG-2026-00112"]["descricao_do_erro"] == "[RN04] Status 'REPROV.' fora do domínio permitido."
    review = _rows(VAL.human_review(ev))
    assert sorted(r["status_original"] for r in review) == ["APROVADO PARCIAL", "REPROV."]
    assert all(r["observacao_analista"] == "" for r in review)


def test_two_stage_path(spark):
    outcomes = A.admit(golden_df(spark))
    counts = {r["cadastro_status"]: r["count"] for r in outcomes.groupBy("cadastro_status").count().collect()}
    assert counts == {"SUCESSO": 24, "REJEITADO_NEGOCIO": 1}
    flow = _rows(A.flow_errors(outcomes))
    assert len(flow) == 1 and flow[0]["source_row"] == 27
    assert flow[0]["cadastro_error"] == "Informe o número do lote."
    assert flow[0]["evidence_name"] == "rejeicao_linha-27_linha-27.png"
    handoff = A.handoff(outcomes, reference_df(spark))
    assert handoff.columns == list(K.HANDOFF_FIELDS)
    assert {r["batch_total"] for r in handoff.collect()} == {24}
    ev = VAL.validate_handoff(handoff)
    summary = _rows(VAL.validation_summary(ev))[0]
    assert summary["total_registros"] == 24
    assert summary["total_divergencias"] == 8
    assert summary["total_regras_violadas"] == 9
    assert summary["total_lotes_validados"] == 16
    assert summary["total_revisao_humana"] == 2
    assert summary["total_rejeicoes_cadastro"] == 0
    assert summary["total_falhas_tecnicas"] == 0
    per_rule = {r["regra"]: r["n"] for r in VAL.rule_distribution(ev).collect()}
    assert per_rule == {"RN01": 1, "RN02": 1, "RN03": 1, "RN05": 2, "RN06": 2, "RN07": 2}
    states = VAL.item_state(ev)
    by = {(r["datapool_state"], r["error_type"]): r["count"]
          for r in states.groupBy("datapool_state", "error_type").count().collect()}
    assert by == {("DONE", ""): 16, ("ERROR", "BUSINESS"): 8}
    assert states.where(F.col("datapool_state") == "PROCESSING").count() == 0


def test_exclusion_variant(spark):
    base = golden_df(spark)
    outcomes = A.admit(base).withColumn(
        "cadastro_status",
        F.when(F.col("source_row") == 4, F.lit("REJEITADO_NEGOCIO"))
         .when(F.col("source_row") == 5, F.lit("FALHA_TECNICA")).otherwise(F.lit("SUCESSO")),
    ).withColumn("cadastro_error", F.lit(""))
    ev = VAL.validate_handoff(A.handoff(outcomes, reference_df(spark), published_only=False))
    summary = _rows(VAL.validation_summary(ev))[0]
    assert summary["total_rejeicoes_cadastro"] == 1
    assert summary["total_falhas_tecnicas"] == 1
    assert _rows(VAL.consumer_run_status(VAL.validation_summary(ev)))[0]["status"] == "PARTIALLY_COMPLETED"
    states = {r["item_id"][-2:]: r for r in _rows(VAL.item_state(ev))}
    assert (states[":4"]["datapool_state"], states[":4"]["error_type"]) == ("ERROR", "BUSINESS")
    assert states[":4"]["finish_message"] == "Cadastro rejeitado pelo formulário."
    assert (states[":5"]["datapool_state"], states[":5"]["error_type"]) == ("ERROR", "SYSTEM")
    assert states[":5"]["finish_message"] == "Falha técnica durante o cadastro web."
    # Excluded rows still run through the rules but never reach valid lots.
    valid_ids = {r["item_id"] for r in VAL.valid_lots(ev).collect()}
    assert not any(i.endswith((":4", ":5")) for i in valid_ids)


def test_report_tables_of_two_stage_run(spark):
    outcomes = A.admit(golden_df(spark))
    ev = VAL.validate_handoff(A.handoff(outcomes, reference_df(spark)))
    tables = VAL.report_tables(ev)
    assert set(tables) == set(K.REPORT_TABLES)
    counts = {k: v.count() for k, v in tables.items()}
    assert counts["divergencias"] == 8
    assert counts["lotes_validados"] == 16
    assert counts["rejeicoes_cadastro"] == 0 and counts["falhas_tecnicas"] == 0
    assert counts["revisao_humana"] == 2
    assert tables["falhas_tecnicas"].columns == ["batch_id", *K.REGISTRATION_COLUMNS]
    resumo = {r["metrica"]: r["valor"] for r in tables["resumo"].collect()}
    assert resumo["total_regras_violadas"] == 9


def test_landing_contract_of_the_sample_sheet(spark):
    """25 rows, source rows 4..28, deterministic unique item ids, 23
    reference IDs read from a capped reference sheet."""
    from lotguard.operators import landing as L

    rows = golden_df(spark)
    cells = F.array(*[F.col(c) for c in K.CONTRACT_COLUMNS])
    grid = rows.select(F.lit("g").alias("batch_id"), F.lit("Inspecao_14_06_2026").alias("sheet_name"),
                       (F.col("row_idx") + 4).alias("row_no"), cells.alias("cells")).unionByName(
        spark.createDataFrame([
            ("g", "Inspecao_14_06_2026", 1, ["Inspeção de lotes", None]),
            ("g", "Inspecao_14_06_2026", 2, ["Registros: 25", None]),
            ("g", "Inspecao_14_06_2026", 3, list(K.CONTRACT_COLUMNS)),
            ("g", "Inspecao_14_06_2026", 29, ["Total", "25", None, None, None, None, None, None]),
        ], "batch_id string, sheet_name string, row_no int, cells array<string>"))
    table = L.lineage(L.sheet_to_table(grid).withColumn("source_hash", F.lit("h" * 64)))
    got = table.select("source_row", "item_id").collect()
    assert len(got) == 25
    assert sorted(r["source_row"] for r in got) == list(range(4, 29))
    assert len({r["item_id"] for r in got}) == 25
    again = L.lineage(L.sheet_to_table(grid).withColumn("source_hash", F.lit("h" * 64)))
    assert again.select("item_id").exceptAll(table.select("item_id")).count() == 0
    assert L.sheet_reference_dates(grid).first()["reference_date"] == "14/06/2026"

    ids = [f"LG-2026-00{n}" for n in range(101, 126) if n not in (103, 124)]
    ref_grid = spark.createDataFrame(
        [("g", "Base_Referencia", 1, ["Base de referência - Registros: 23"]),
         ("g", "Base_Referencia", 2, ["lote_id", "descricao"])]
        + [("g", "Base_Referencia", 3 + i, [f"  {x} ", "ok"]) for i, x in enumerate(ids)]
        + [("g", "Base_Referencia", 26, ["LG-2026-00124", "beyond the declared total"]),
           ("bad", "Base_Referencia", 2, ["codigo"])],
        "batch_id string, sheet_name string, row_no int, cells array<string>")
    ref = L.reference_list(ref_grid)
    assert sorted(r["lote_id"] for r in ref.collect()) == ids
    layout = {r["batch_id"]: (r["ok"], r["message"]) for r in L.reference_layout_check(ref_grid).collect()}
    assert layout["g"] == (True, "")
    assert layout["bad"] == (False, K.REFERENCE_MISSING_COLUMN)


def test_consumer_rn03_is_row_local_for_both_handoff_formats(spark, tmp_path):
    outcomes = A.admit(golden_df(spark))
    A.handoff(outcomes, reference_df(spark)).write.parquet(str(tmp_path / "h"))
    ours = spark.read.parquet(str(tmp_path / "h"))
    # The original format: every record carries the whole sorted batch list.
    full = ours.withColumn("reference_lotes_json",
                           F.to_json(F.array_sort(F.array(*[F.lit(x) for x in sorted(
                               r["lote_id"] for r in reference_df(spark).collect())]))))
    a = R.consolidate(VAL.validate_handoff(ours))
    b = R.consolidate(VAL.validate_handoff(full))
    assert a.count() == 8 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = VAL.validate_handoff(ours)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
