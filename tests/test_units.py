"""Operator-level tests modelled on the original unit tests."""

import pytest
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import blank, safe_name, strip
from lotguard.operators import admission as A
from lotguard.operators import landing as L
from lotguard.operators import queue as QU
from lotguard.operators import report as RP
from lotguard.operators import rules as R
from lotguard.operators.sequence import number_within

LOT_COLS = ", ".join(f"{c} string" for c in K.CONTRACT_COLUMNS)


def lots(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = {c: None for c in K.CONTRACT_COLUMNS}
        base.update(r)
        full.append((f"i{i}", "b1", *[base[c] for c in K.CONTRACT_COLUMNS]))
    return spark.createDataFrame(full, f"item_id string, batch_id string, {LOT_COLS}")


def msgs(df):
    return {r["item_id"]: r["message"] for r in df.collect()}


CLEAN = dict(lote_id="LG-1", produto="TV43-FHD", linha="L1", turno="A", status="APROVADO",
             responsavel="Ana", data="14/06/2026", observacao=None)


def test_strip_is_unicode_aware(spark):
    df = spark.createDataFrame([("\t a  ",), (None,), ("   ",)], "v string")
    got = [tuple(r) for r in df.select(strip("v"), blank("v")).collect()]
    assert got == [("a", False), (None, True), ("", True)]


def test_safe_name_keeps_unicode_letters(spark):
    df = spark.createDataFrame([("__inspeção / lote #1__",)], "v string")
    assert df.select(safe_name("v")).first()[0] == "inspeção_lote_1"


def test_rn02_lists_blank_columns_in_contract_order(spark):
    df = lots(spark, [CLEAN, {**CLEAN, "responsavel": "  ", "lote_id": None, "status": None}])
    out = msgs(R.rule_hits(df, None, R.rn02()))
    assert out == {"i1": "Campos obrigatórios vazios: lote_id, status, responsavel."}


def test_rn01_date_rules(spark):
    rows = [{**CLEAN, "data": d} for d in ["14/06/2026", "14/6/2026", "15/06/2026", "n/d", "", None,
                                          "2026-06-14", "31/02/2026"]]
    out = msgs(R.rule_hits(lots(spark, rows), None, R.rn01(), reference_date="14/06/2026"))
    assert set(out) == {"i2", "i3", "i6", "i7"}
    assert out["i3"] == "[RN01] Data 'n/d' fora da referência '14/06/2026'."


def test_rn03_reference(spark):
    df = lots(spark, [{**CLEAN, "lote_id": x} for x in ["LG-1", " LG-2 ", "LG-3", "", None]])
    ref = spark.createDataFrame([("LG-1",), ("LG-2",)], "lote_id string")
    assert set(msgs(R.rule_hits(df, ref, R.rn03()))) == {"i2"}
    empty = spark.createDataFrame([], "lote_id string")
    assert set(msgs(R.rule_hits(df, empty, R.rn03()))) == {"i0", "i1", "i2"}


def test_rn05_rn06_status(spark):
    df = lots(spark, [{**CLEAN, "status": s} for s in ["OK", " nok ", "PENDENTE", "APROVADO PARCIAL", "", None]])
    ev = R.evaluate(df, None, rules=[R.rn05(), R.rn06()], reference_date="14/06/2026")
    got = {r["item_id"]: (r["status"], r["status_original"], r["divergencia_rn05"],
                          [v["regra"] for v in r["violations"]]) for r in ev.collect()}
    assert got["i0"] == ("APROVADO", "OK", K.RN05_OK_DESC, ["RN05"])
    assert got["i1"] == ("REPROVADO", " nok ", K.RN05_NOK_DESC, ["RN05"])
    assert got["i2"] == ("PENDENTE", "PENDENTE", None, [])
    assert got["i3"][3] == ["RN06"]
    assert got["i4"][3] == ["RN06"] and got["i5"][3] == ["RN06"]
    desc = {r["item_id"]: r["message"] for r in R.rule_hits(df, None, R.rn06()).collect()}
    assert desc["i4"] == "[RN04] Status '' fora do domínio permitido."
    assert desc["i5"] == "[RN04] Status 'nan' fora do domínio permitido."


def test_rn07_remark(spark):
    df = lots(spark, [{**CLEAN, "status": "REPROVADO", "observacao": o} for o in [None, "  ", "ok"]]
              + [{**CLEAN, "status": "NOK"}])
    # RN07 looks at the normalised status, so NOK counts as REPROVADO.
    assert set(msgs(R.rule_hits(df, None, R.rn07()))) == {"i0", "i1", "i3"}
    ev = R.evaluate(df, None, rules=[R.rn07()], reference_date="14/06/2026")
    assert {r["item_id"] for r in ev.where(F.size("violations") > 0).collect()} == {"i0", "i1", "i3"}


def test_guarded_rule_yields_controlled_failure(spark):
    df = lots(spark, [{**CLEAN, "data": "n/d"}, CLEAN])
    rule = R.Rule("RX", 7, F.try_to_date("data", "d/M/yyyy") > F.col("_ref_day"), F.lit("x"), "a", "Alta",
                  guarded=True)
    out = R.violations_long(R.evaluate(df, None, rules=[rule], reference_date="14/06/2026"), keys=["item_id"])
    got = {r["item_id"]: (r["regra_violada"], r["descricao_do_erro"], r["acao_recomendada"]) for r in out.collect()}
    assert got == {"i0": (K.GUARD_RULE, K.GUARD_DESC, K.GUARD_ACTION)}


def test_structure_check_messages(spark):
    heads = spark.createDataFrame([
        ("ok", list(K.CONTRACT_COLUMNS)),
        ("miss", [c for c in K.CONTRACT_COLUMNS if c not in ("status", "data")]),
        ("both", [c for c in K.CONTRACT_COLUMNS if c != "turno"] + ["zeta", "alpha"]),
        ("none", []),
    ], "batch_id string, header array<string>")
    got = {r["batch_id"]: (r["ok"], r["message"]) for r in L.structure_check(heads).collect()}
    assert got["ok"] == (True, "")
    assert got["miss"] == (False, "[RN01] Estrutura inválida. Colunas ausentes: data, status")
    assert got["both"] == (False, "[RN01] Estrutura inválida. Colunas ausentes: turno; Colunas extras: alpha, zeta")
    assert got["none"][1].startswith("[RN01] Estrutura inválida. Colunas ausentes: data, linha, lote_id")


def test_sheet_grid_cap_and_blank_rows(spark):
    null8 = [None] * 8
    grid = spark.createDataFrame([
        ("b", "S", 1, ["Titulo", None]),
        ("b", "S", 2, ["registros: 3", None]),
        ("b", "S", 3, list(K.CONTRACT_COLUMNS)),
        ("b", "S", 4, ["A", "P", None, None, None, None, None, None]),
        ("b", "S", 5, null8),
        ("b", "S", 6, ["", "", "", "", "", "", "", ""]),
        ("b", "S", 7, ["Total", "2", None, None, None, None, None, None]),
    ], "batch_id string, sheet_name string, row_no int, cells array<string>")
    table = L.sheet_to_table(grid).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["sheet_row"], r["lote_id"]) for r in table] == [(0, 4, "A"), (1, 6, "")]
    assert L.declared_totals(grid).first()["declared"] == 3


def test_reference_date_from_sheet_name(spark):
    df = spark.createDataFrame([("Inspecao_14_06_2026",), ("Plan1",)], "s string")
    assert [r[0] for r in df.select(L.reference_date_of(F.col("s"))).collect()] == ["14/06/2026", ""]


def test_number_within_matches_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 100003).alias("k"))
    got = number_within(df, ["g"], "k", block_width=64)
    from pyspark.sql import Window
    want = df.withColumn("row_idx", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.select("g", "k", "row_idx").exceptAll(want).count() == 0
    assert got.count() == 5000


def test_admission_precedence(spark):
    df = lots(spark, [CLEAN, {**CLEAN, "produto": "XX"}, {**CLEAN, "lote_id": " "},
                      {**CLEAN, "produto": ""}, {**CLEAN, "lote_id": None, "produto": "XX"},
                      {**CLEAN, "lote_id": "", "produto": ""}]).withColumn("source_row", F.lit(4))
    got = {r["item_id"]: (r["cadastro_status"], r["cadastro_error"], r["cadastro_error_type"])
           for r in A.admit(df).collect()}
    assert got["i0"] == ("SUCESSO", "", "")
    assert got["i1"][0] == "FALHA_TECNICA" and got["i1"][1].startswith("TIMEOUT: ")
    assert got["i2"] == ("REJEITADO_NEGOCIO", "Informe o número do lote.", "BUSINESS")
    assert got["i3"] == ("REJEITADO_NEGOCIO", "Selecione um produto.", "BUSINESS")
    assert got["i4"][0] == "FALHA_TECNICA"
    assert got["i5"][1] == "Informe o número do lote. | Selecione um produto."


def test_readback_reconcile(spark):
    sent = lots(spark, [CLEAN, {**CLEAN, "lote_id": "LG-2"}, {**CLEAN, "lote_id": "LG-3"}])
    stored = spark.createDataFrame([
        ("LG-1", "TV43-FHD", "L9", "A", "APROVADO", "Ana", "14/06/2026", "", "2026-06-14T10:00:00"),
        ("LG-1", "TV43-FHD", "L1", "A", "APROVADO", "Ana", "14/06/2026", "", "2026-06-13T10:00:00"),
        ("LG-2", "TV43-FHD", "L1", "A", "APROVADO", "Ana", "14/06/2026", "", "2026-06-14T10:00:00"),
        ("LG-9", "TV43-FHD", "L1", "A", "APROVADO", "Ana", "14/06/2026", "", "2026-06-14T10:00:00"),
    ], f"{LOT_COLS}, criadoEm string")
    got = sorted(tuple(r) for r in A.reconcile(sent, stored).collect())
    assert got == [("LG-1", "diff", "linha", "L1", "L9"), ("LG-3", "missing", "*", None, None),
                   ("LG-9", "extra", "*", None, None)]
    msg = {r["item_id"]: r["readback_error"] for r in A.readback_message(sent, stored).collect()}
    assert msg == {"i0": "Cadastro web divergente da planilha: linha={'esperado': 'L1', 'salvo': 'L9'}",
                   "i2": "Cadastro não encontrado no armazenamento local."}
    # The read-back failure turns an otherwise valid row into a technical failure.
    out = {r["item_id"]: (r["cadastro_status"], r["evidence_name"])
           for r in A.admit(sent.withColumn("source_row", F.lit(4)), stored=stored).collect()}
    assert out["i0"] == ("FALHA_TECNICA", "erro_linha-4_LG-1.png")
    assert out["i1"][0] == "SUCESSO"


def test_normalise_report_rows_ladders(spark):
    schema = ", ".join(f"{c} string" for c in RP.LOOSE_FIELDS) + ", " + \
        ", ".join(f"{c} string" for c in ("divergencia_rn01",) + K.DIVERGENCE_COLUMNS) + \
        f", campos_vazios string, divergencias {RP.NESTED_TYPE}"
    n = len(RP.LOOSE_FIELDS) + 7 + 1
    def row(**kw):
        names = list(RP.LOOSE_FIELDS) + ["divergencia_rn01", *K.DIVERGENCE_COLUMNS, "campos_vazios"]
        return tuple(kw.get(c) for c in names) + (kw.get("divergencias"),)
    df = spark.createDataFrame([
        row(lote_id="A", regra="RN03", descricao="d3"),
        row(lote_id="B", divergencia_rn05="d5"),
        row(lote_id="C", campos_vazios="linha"),
        row(lote_id="D"),
        row(lote_id="E", divergencia_rn01="x"),
        row(lote_id="F", divergencias=[("G", "RN07", None, "d7", None, None, None), (None, None, None, None, None, None, "Alta")]),
    ], schema)
    assert n > 0
    got = sorted(tuple(r) for r in RP.normalise_report_rows(df).collect())
    assert got == [
        ("A", "RN03", "d3", "Encaminhar ao analista", "Média"),
        ("B", "RN05", "d5", "Encaminhar ao analista", "Média"),
        ("C", "RN02", "Campos obrigatórios vazios: linha", "Encaminhar ao analista", "Média"),
        ("D", "NÃO CLASSIFICADA", "Divergência sem descrição informada.", "Encaminhar ao analista", "Média"),
        ("E", "NÃO CLASSIFICADA", "Divergência sem descrição informada.", "Encaminhar ao analista", "Média"),
        ("F", "NÃO CLASSIFICADA", "Divergência sem descrição informada.", "Encaminhar ao analista", "Alta"),
        ("G", "RN07", "d7", "Encaminhar ao analista", "Média"),
    ]


def test_report_versions_never_overwrite(spark):
    runs = spark.createDataFrame([
        (1, "r", "2026-06-14 12:00:00"), (2, "r", "2026-06-14 13:00:00"), (3, "r", "2026-06-15 03:00:00"),
        (4, "r", "2026-06-15 05:00:00"), (5, "s", "2026-06-14 12:00:00"),
    ], "run_key int, report string, started_at string").withColumn("started_at", F.to_timestamp("started_at"))
    got = {r["run_key"]: r["file_name"] for r in RP.report_versions(runs).collect()}
    # 03:00 UTC on the 15th is still the 14th in the operational zone (UTC-4).
    assert got == {1: "r_14062026.xlsx", 2: "r_14062026_2.xlsx", 3: "r_14062026_3.xlsx",
                   4: "r_15062026.xlsx", 5: "s_14062026.xlsx"}


def test_bounded_read_and_integrity(spark):
    q = spark.createDataFrame([
        ("Q", 1, "a1", "A", 2), ("Q", 2, "a2", "A", 2),
        ("Q", 3, "b1", "B", 3), ("Q", 4, "b2", "B", 3),
        ("Q", 5, "c1", "C", 2),
        ("R", 1, "d1", "D", 2),
    ], "queue_id string, seq long, item_id string, batch_id string, batch_total int").withColumn("source_row", F.lit(4))
    reads = sorted(tuple(r) for r in QU.bounded_read(q).select("task_id", "item_id", "foreign").collect())
    assert ("task-B", "c1", True) in reads and ("task-A", "b1", True) not in reads
    got = {r["batch_id"]: (r["problem"], r["message"]) for r in QU.batch_integrity(q).collect()}
    assert got["B"] == ("foreign_item", "Item do lote 'C' recebido durante o lote 'B'.")
    assert got["C"] == ("incomplete", "Lote incompleto: esperados 2, recebidos 1.")
    assert got["D"] == ("incomplete", "Lote incompleto: esperados 2, recebidos 1.")
    assert "A" not in got


@pytest.mark.parametrize("doc,expect", [("[{\"numero\": \"N1\", \"linha\": \"L1\"}]", [("N1", "L1")]),
                                        ("{\"lote_id\": \"x\"}", []), ("[{bad", []), ("[null]", []),
                                        ("[{\"lote_id\":\"x\"},5,[1],\"t\",null,{\"linha\":\"L2\"}]", [("x", ""), ("", "L2")])])
def test_stored_reader_is_lenient(spark, doc, expect):
    from lotguard.sources.stored import parse_stored

    df = spark.createDataFrame([(doc,)], "raw string")
    assert [(r["lote_id"], r["linha"]) for r in parse_stored(df).collect()] == expect


def test_interleaved_and_short_batches(spark):
    rows = [("q", "A", "a1", 10, 2), ("q", "B", "b1", 20, 1), ("q", "A", "a2", 35, 2), ("q", "C", "c1", 40, 3), ("r", "D", "d1", 1, 1), ("r", "D", "d2", 2, 1),
            ("r", "E", "e1", 3, 2), ("r", "E", "e2", 9, 2)]
    q = spark.createDataFrame(rows, "queue_id string, batch_id string, item_id string, seq long, batch_total int")
    reads = sorted((r["task_id"], r["item_id"], r["foreign"]) for r in QU.bounded_read(q).collect())
    assert reads == [("task-A", "a1", False), ("task-A", "b1", True), ("task-B", "b1", False), ("task-C", "c1", False), ("task-D", "d1", False),
                     ("task-E", "e1", False), ("task-E", "e2", False)]
    found = {r["batch_id"]: (r["problem"], r["message"]) for r in QU.batch_integrity(q).collect()}
    assert {b: p for b, (p, _) in found.items()} == {"A": "foreign_item", "C": "incomplete"} and all(m for _, m in found.values())


def test_tasks_with_parameters(spark):
    """A parameter overrides the first item's batch and total; a read stops at a
    foreign item, at its total, or where the queue ends."""
    rows = [("q", i, f"i{i}", b, t) for i, (b, t) in enumerate([("A", 3), ("A", 3), ("A", 3), ("B", 1), ("A", 9), ("C", 0), ("C", 0), ("D", -1), (None, None)])]
    q = spark.createDataFrame(rows, "queue_id string, seq long, item_id string, batch_id string, batch_total int")
    tasks = spark.createDataFrame([
        ("whole", "q", 0, None, None), ("half", "q", 0, "A", 2), ("rest", "q", 2, "", 0), ("more", "q", 0, "A", 5), ("other", "q", 3, "A", 1),
        ("free", "q", 5, None, 0), ("negative", "q", 7, None, 0), ("last", "q", 8, None, 0), ("behind", "q", 9, "Z", 4), ("nowhere", "x", 0, None, 0)],
        "task_id string, queue_id string, start long, batch_id string, batch_total int")
    placed = QU.placed_items(q)
    got = {r["task_id"]: (r["batch_id"], r["own"], r["stop"] - r["start"], r["problem"]) for r in QU.replay(placed, tasks).collect()}
    assert got == {
        "whole": ("A", 3, 3, None), "half": ("A", 2, 2, None), "rest": ("A", 1, 2, "foreign_item"), "more": ("A", 3, 4, "foreign_item"),
        "other": ("A", 0, 1, "foreign_item"), "free": ("C", 2, 3, "foreign_item"), "negative": ("D", 1, 2, "foreign_item"), "last": ("", 1, 1, None),
        "behind": ("Z", 0, 0, "empty"), "nowhere": ("", 0, 0, "empty")}
    reads = QU.bounded_read(q, tasks).where("task_id in ('rest', 'more')").orderBy("task_id", "item_id").collect()
    assert [(r["task_id"], r["item_id"], r["foreign"]) for r in reads] == [
        ("more", "i0", False), ("more", "i1", False), ("more", "i2", False), ("more", "i3", True), ("rest", "i2", False), ("rest", "i3", True)]
    errors = {r["item_id"]: r["error"] for r in QU.item_errors(QU.acquired_items(placed, QU.replay(placed, tasks))).collect()}
    assert set(errors) == {"i0", "i1", "i2", "i3", "i5", "i6", "i7", "i8"}
    assert errors["i3"] == K.MSG_FOREIGN_ITEM.format(item="B", target="A") and errors["i7"] == K.MSG_FOREIGN_ITEM.format(item="D", target="C")
    empty = QU.placed_items(q.where("false"))
    assert QU.replay(empty, tasks).where("problem <> 'empty'").count() == 0 and QU.replay(empty).count() == 0


def test_replay_over_block_borders(spark, monkeypatch):
    """Blocks of four places: a plain replay in Python says the same."""
    import random

    monkeypatch.setattr(QU, "BLOCK", 4)
    rnd = random.Random(2)
    rows, batch = [], "A"
    for queue in ("q", "r"):
        for i in range(60):
            batch = rnd.choice([batch, batch, batch, "A", "B", "C"])
            rows.append((queue, 3 * i + (queue == "r"), f"{queue}{i}", batch, 5))
    tasks = [(f"t{n}", rnd.choice("qr"), rnd.randrange(64), rnd.choice([None, "A", "B"]), rnd.choice([0, 2, 9])) for n in range(80)]
    want = {}
    for task, queue, start, named, total in tasks:
        own, target, stop = 0, named, start
        for _, _, _, b, t in [r for r in rows if r[0] == queue][start:]:
            target = target or b
            if own == (total or t):
                break
            stop += 1
            if b != target:
                break
            own += 1
        want[task] = (own, stop)
    q = spark.createDataFrame(rows, "queue_id string, seq long, item_id string, batch_id string, batch_total int")
    t = spark.createDataFrame(tasks, "task_id string, queue_id string, start long, batch_id string, batch_total int")
    placed = QU.placed_items(q)
    assert {r["task_id"]: (r["own"], r["stop"]) for r in QU.replay(placed, t).collect()} == want
    got = {r[0]: r[1] for r in QU.acquired_items(placed, QU.replay(placed, t)).groupBy("task_id").count().collect()}
    assert got == {x: stop - start for x, _, start, _, _ in tasks for _, stop in [want[x]] if stop > start}


def test_sessions_without_order(spark):
    rows = [("s1", "a", "A", 2), ("s1", "b", "B", 2), ("s2", "c", "C", 3), ("s3", "d", "D", 1), ("s4", "e", "E", 0), ("s4", "f", "E", 0)]
    df = spark.createDataFrame(rows, "task_id string, item_id string, batch_id string, batch_total int")
    got = {r["task_id"]: (r["problem"], r["message"]) for r in QU.mixed_sessions(df).collect()}
    assert got == {"s1": ("mixed", "Foram consumidos lotes mistos: ['A', 'B']"), "s2": ("incomplete", "Lote incompleto: esperados 3, recebidos 1.")}


def _table(spark, path):
    from lotguard.operators.store import BatchTable

    return BatchTable(spark, str(path))


def test_batch_table_commits(spark, tmp_path):
    from lotguard.operators import store as S

    schema = "batch_id string, source_row int, item_id string"
    rows = lambda *data: spark.createDataFrame(list(data), schema)
    pending, processed = _table(spark, tmp_path / "p"), _table(spark, tmp_path / "d")
    with pytest.raises(FileNotFoundError, match="Nenhum lote pendente"):
        S.read_pending(pending, processed)
    reference = spark.createDataFrame([(" L2 ",), ("L1",), ("L1",), ("",), (None,)], "lote_id string")
    pending.publish(rows(("A", 4, "a1"), ("A", 5, "a2"), ("B", 4, "b1")), reference)
    pending.publish(rows(("C", 4, "c1")))
    pending.stage(rows(("D", 4, "d1"), ("A", 4, "half")), "p9-not-committed")
    assert [tuple(r) for r in S.read_pending(pending).select("batch_id", "item_id").collect()] == [("C", "c1")]
    assert sorted(r["item_id"] for r in S.read_pending(pending, mode="all").collect()) == ["a1", "a2", "b1", "c1"]
    assert [r["lote_id"] for r in pending.reference().orderBy("lote_id").collect()] == ["L1", "L2"]
    assert all(r["ok"] for r in S.pending_check(pending).collect())
    # a batch is processed: it is no longer pending, nothing is deleted
    done = S.read_pending(pending, processed, mode="all").where("batch_id in ('A', 'C')").withColumn("datapool_state", F.lit("DONE"))
    S.commit_processed(processed, done)
    assert [r["batch_id"] for r in S.open_batches(pending, processed).collect()] == ["B"]
    # published again, it is pending again, by its latest rows only
    pending.publish(rows(("A", 4, "a9")))
    assert sorted(r["batch_id"] for r in S.open_batches(pending, processed).collect()) == ["A", "B"]
    assert [r["item_id"] for r in S.read_pending(pending, processed).collect()] == ["a9"]
    assert sorted(r["item_id"] for r in pending.rows().collect()) == ["a9", "b1", "c1"]
    S.commit_processed(processed, S.read_pending(pending, processed, mode="all").withColumn("datapool_state", F.lit("ERROR")))
    got = {(r["batch_id"], r["item_id"]): r["datapool_state"] for r in processed.rows().collect()}
    assert got == {("A", "a9"): "ERROR", ("B", "b1"): "ERROR", ("C", "c1"): "DONE"}


def test_lost_rows_of_a_batch_are_noticed(spark, tmp_path):
    from lotguard.operators import store as S

    pending = _table(spark, tmp_path / "p")
    publish = pending.publish(spark.createDataFrame([("A", i, f"a{i}") for i in range(50)], "batch_id string, source_row int, item_id string"))
    some = pending.rows().where("source_row <> 7").persist()
    assert some.count() == 49
    some.write.mode("overwrite").parquet(f"{pending.root}/data/publish={publish}")
    some.unpersist()
    with pytest.raises(ValueError, match="Lote incompleto: esperados 50, recebidos 49"):
        S.read_pending(pending)
    assert [r["ok"] for r in S.pending_check(pending).collect()] == [False]


def test_envelope_files(spark, tmp_path):
    import json
    import os

    from lotguard.operators import store as S

    for n, batch in enumerate(["batch-2", "batch-1"]):
        items = [{"item_id": f"{batch}:{i}", "batch_id": batch, "lote_id": "L", "source_file": "s.xlsx"} for i in range(2 + n)]
        path = tmp_path / f"{batch}.pending.json"
        path.write_text(json.dumps({"batch_id": batch, "reference_lote_ids": ["L"], "total": len(items), "items": items}, indent=2))
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))
    (tmp_path / "batch-0.processed.json").write_text("{}")
    got = S.read_envelope_files(spark, str(tmp_path))
    assert {(r["batch_id"], r["envelope_total"], r["linha"]) for r in got.collect()} == {("batch-1", 3, None)} and got.count() == 3
    assert S.read_envelope_files(spark, str(tmp_path), mode="all").count() == 5
    with pytest.raises(FileNotFoundError, match="Nenhum lote pendente"):
        S.read_envelope_files(spark, str(tmp_path / "none"))


def test_report_claims(spark, tmp_path):
    from datetime import datetime
    from threading import Thread

    root = str(tmp_path / "r")
    noon = datetime(2026, 6, 14, 12)
    assert [RP.claim_report(spark, root, "r", noon) for _ in range(3)] == ["r_14062026.xlsx", "r_14062026_2.xlsx", "r_14062026_3.xlsx"]
    assert RP.claim_report(spark, root, "r", datetime(2026, 6, 15, 3)) == "r_14062026_4.xlsx"  # still the 14th there
    names: list[str] = []
    writers = [Thread(target=lambda: names.append(RP.claim_report(spark, root, "s", noon))) for _ in range(6)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert len(set(names)) == 6
    old = RP.existing_reports(spark, root)
    runs = spark.createDataFrame([(1, "r", noon)], "k int, report string, started_at timestamp_ntz").withColumnRenamed("k", "run_key")
    assert RP.report_versions(runs, existing=old).first()["file_name"] == "r_14062026_5.xlsx"


def test_flow_error_report_refuses_empty_input(spark, tmp_path):
    empty = spark.createDataFrame([], "item_id string")
    with pytest.raises(ValueError, match="exige ao menos um item"):
        RP.write_flow_errors({"resumo": empty, "erros_fluxo": empty}, str(tmp_path))


def test_bad_reference_date_fails_the_run(spark):
    df = lots(spark, [CLEAN])
    with pytest.raises(ValueError, match="99/99/2026"):
        R.evaluate(df, None, reference_date="99/99/2026")
    assert R.evaluate(df, None, reference_date="").count() == 1
    two = df.withColumn("reference_date", F.lit("x")).unionByName(df.withColumns({"reference_date": F.lit(""), "batch_id": F.lit("b2")}))
    assert [tuple(r) for r in R.bad_reference_dates(two).collect()] == [("b1", K.BAD_REFERENCE_DATE.format(text="x"))]


def test_event_log_lines(spark, tmp_path):
    from lotguard.operators import eventlog as EL

    root = str(tmp_path / "log")
    events = spark.createDataFrame([("INFO", "CADASTRO_WEB_INICIADO", "b", "L1", 4, "2026-08-03 01:52:35.9")], "level string, event string, batch_id string, lote_id string, source_row int, at string")
    lines = EL.log_lines(events.withColumn("at", F.to_timestamp("at")), "exec-1", "bot-a", "at")
    path = EL.write_event_log(lines, root, "r1")
    with pytest.raises(Exception, match="already exists"):
        EL.write_event_log(lines, root, "r1")
    more = tmp_path / "log" / "run=r1" / "day=2026-08-03" / "x.json"
    more.write_text('\n{"timestamp": "2026-08-02T21:52:35-0400", "bot_id": "bot-b"}\n\nno json\n{"bot_id": "bot-c"}\n{"timestamp": "2026-08-02T21:52:34-0400"}\n')
    got = EL.read_event_log(spark, root, "2026-08-03 01:52:35.956434").collect()
    fine = sorted((r["bot_id"], str(r["timestamp"])) for r in got if r["_corrupt"] is None)
    assert fine == [("bot-a", "2026-08-03 01:52:35"), ("bot-b", "2026-08-03 01:52:35")]
    assert sorted(r["_corrupt"] for r in got if r["_corrupt"] is not None) == ["", "no json"]
    own = [r for r in got if r["bot_id"] == "bot-a"][0]
    assert (own["execution_id"], own["batch_id"], own["lote_id"], own["source_row"], own["message"], own["run"]) == ("exec-1", "b", "L1", 4, "CADASTRO_WEB_INICIADO", "r1")
    assert "day=2026-08-03" in [r["path"] for r in __import__("lotguard.sources.files", fromlist=["x"]).listing(spark, path).collect()][0]


def test_log_context_of_runs(spark):
    from lotguard.operators import eventlog as EL

    events = spark.createDataFrame([("r1", "e1", "bot-a"), ("r1", "e1", "bot-a"), ("r2", "e2", "bot-a"), ("r2", "e9", "bot-a"), ("r3", "e3", "bot-b"), ("r4", None, "bot-a")],
                                   "run_id string, execution_id string, bot_id string")
    runs = spark.createDataFrame([(f"r{i}", f"e{i}") for i in range(1, 6)], "run_id string, execution_id string")
    got = {r["run_id"]: (r["n"], r["ok"]) for r in EL.log_context(events, "bot-a", runs).collect()}
    assert got == {"r1": (2, True), "r2": (2, False), "r3": (1, False), "r4": (1, False), "r5": (0, False)}


def test_verify_needs_every_table(spark):
    from lotguard.operators import verify as VF

    with pytest.raises(KeyError, match="processed"):
        VF.verify({"outcomes": spark.createDataFrame([], "batch_id string")})


def test_next_within(spark):
    from lotguard.operators.sequence import next_within

    df = spark.createDataFrame([("a", 1), ("a", 9), ("a", 10), ("b", 3), ("a", 40)], "g string, o long")
    got = {(r["g"], r["o"]): r["next"] and r["next"]["o"] for r in next_within(df, ["g"], "o", ["o"], block_width=4).collect()}
    assert got == {("a", 1): 9, ("a", 9): 10, ("a", 10): 40, ("a", 40): None, ("b", 3): None}


def test_workbook_sheets_totals_and_dates(spark):
    import datetime as dt

    head = list(K.CONTRACT_COLUMNS)
    rows = [("b", 0, "Inspecao_14_06_2026", 1, ["Registros: 99999999999"]), ("b", 0, "Inspecao_14_06_2026", 3, head),
            ("b", 0, "Inspecao_14_06_2026", 4, ["LG-1"] + ["x"] * 7), ("b", 1, K.REFERENCE_SHEET, 1, ["Registros: 1"]),
            ("b", 1, K.REFERENCE_SHEET, K.REFERENCE_HEADER_ROW, ["lote_id", "z"]),
            ("b", 1, K.REFERENCE_SHEET, K.REFERENCE_HEADER_ROW + 1, [" LG-1 ", "z"]),
            ("b", 1, K.REFERENCE_SHEET, K.REFERENCE_HEADER_ROW + 2, ["LG-2", "z"]),
            ("c", 0, "Plan", 1, ["Registros: 99999999999999999999"]), ("c", 0, "Plan", 3, head), ("c", 0, "Plan", 4, ["LG-9"] * 8)]
    grid = spark.createDataFrame(rows, "batch_id string, sheet_no int, sheet_name string, row_no int, cells array<string>")
    assert [(r["batch_id"], r[K.CONTRACT_COLUMNS[0]]) for r in L.sheet_to_table(grid).orderBy("batch_id").collect()] == [("b", "LG-1"), ("c", "LG-9")]
    assert {r[0]: r[1] for r in L.declared_totals(grid).collect()} == {"b": 99999999999, "c": None}
    assert [tuple(r) for r in L.reference_list(grid).collect()] == [("b", "LG-1")]
    assert {r[0]: r[1] for r in L.sheet_reference_dates(grid).collect()} == {"b": "14/06/2026", "c": ""}
    twice = spark.createDataFrame([("b", head + ["lote_id", "x", "x"])], "batch_id string, header array<string>")
    check = L.structure_check(twice).first()
    assert not check["ok"] and check["message"].endswith("lote_id.1, x, x.1")
    typed = spark.createDataFrame([(dt.date(2026, 6, 3), dt.datetime(2026, 1, 2, 3, 4), *["v"] * 6)],
                                  "data date, lote_id timestamp, " + ", ".join(f"{c} string" for c in K.CONTRACT_COLUMNS if c not in ("data", "lote_id")))
    got = A.serialise(typed).first()
    assert (got["data"], got["lote_id"]) == ("03/06/2026", "02/01/2026")


def test_latest_stored_strips_keys_and_breaks_ties(spark):
    rows = [(" LG-1", "2026-01-01", "L1", 0), ("LG-1 ", "2026-01-02", "L2", 1), ("LG-1", "2026-01-02", "L3", 2)]
    df = spark.createDataFrame(rows, "lote_id string, criadoEm string, linha string, position int")
    assert [tuple(r) for r in A.latest_stored(df).collect()] == [("LG-1", "2026-01-02", "L2")]


def test_report_sink_keeps_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], ", ".join(f"{c} string" for c in K.REGISTRATION_COLUMNS))
    out = RP.write_report({"rejeicoes_cadastro": empty}, str(tmp_path), "relatorio_divergencias")
    back = spark.read.parquet(out["rejeicoes_cadastro"])
    assert back.count() == 0 and back.columns == list(K.REGISTRATION_COLUMNS)


def test_fingerprint_files(spark, tmp_path):
    import hashlib

    (tmp_path / "a.xlsx").write_bytes(b"abc")
    (tmp_path / "b.txt").write_bytes(b"zzz")
    got = L.fingerprint_files(spark, str(tmp_path), glob="*.xlsx").collect()
    assert len(got) == 1
    assert got[0]["source_file"] == "a.xlsx"
    assert got[0]["sha256"] == hashlib.sha256(b"abc").hexdigest()
    assert got[0]["md5"] == hashlib.md5(b"abc").hexdigest()
    assert got[0]["batch_id"] == "batch-" + hashlib.sha256(b"abc").hexdigest()[:16]


def test_events_since_truncates_start_to_the_second(spark):
    from lotguard.operators import eventlog as EL

    ev = spark.createDataFrame([
        ("exec-1", "bot-a", "2024-01-10 00:00:00"),
        ("exec-1", "bot-a", "2024-01-09 23:59:59"),
        ("exec-1", "bot-b", "2024-01-10 00:00:01"),
    ], "execution_id string, bot_id string, timestamp string") \
        .withColumn("timestamp", F.to_timestamp_ntz("timestamp"))
    win = EL.events_since(ev, "2024-01-10 00:00:00.5")
    assert win.count() == 2
    ctx = EL.log_context(win, "bot-a").first()
    assert (ctx["n"], ctx["ok"]) == (2, False)


def test_run_status_and_totals_ladder(spark):
    from lotguard.operators import runs as RU

    prod = spark.createDataFrame([("a", 25, 24, 1), ("b", 3, 0, 3), ("c", 2, 2, 0)],
                                 "batch_id string, total long, itens_publicados_datapool long, erros_fluxo long")
    got = {r[0]: r[1] for r in prod.select("batch_id", RU.producer_run_status()).collect()}
    assert got == {"a": "PARTIALLY_COMPLETED", "b": "FAILED", "c": "SUCCESS"}
    summaries = spark.createDataFrame([
        ("a", "produtor", {"total": "25", "cadastros_falha": "1"}),
        ("b", "validador", {"total_registros": "24", "total_falhas_tecnicas": "2"}),
        ("c", "validador", {"total_items": "5", "failed_items": "1", "processed_items": "3"}),
        ("d", "x", {}),
    ], "batch_id string, stage string, summary map<string,string>")
    tot = {r["batch_id"]: (r["total_items"], r["failed_items"], r["processed_items"])
           for r in RU.run_totals(summaries).collect()}
    assert tot == {"a": (25, 1, 24), "b": (24, 2, 22), "c": (5, 1, 3), "d": (0, 0, 0)}


def test_nested_children_keep_rule_columns(spark):
    fields = [*RP.LOOSE_FIELDS, *K.DIVERGENCE_COLUMNS, "campos_vazios"]
    text = ", ".join(f"{f} string" for f in fields)
    child = lambda **kw: tuple(kw.get(f) for f in fields)
    kids = [child(divergencia_rn03="fora da base"), child(lote_id="L2", campos_vazios="turno"), child(regra_violada="RN07", divergencia_rn03="x")]
    df = spark.createDataFrame([(*child(lote_id="P"), kids)], f"{text}, divergencias array<struct<{text.replace(' string', ':string')}>>")
    got = sorted((r["lote_id"], r["regra_violada"], r["descricao_do_erro"]) for r in RP.normalise_report_rows(df).collect())
    assert got == [("L2", "RN02", K.RN02_DESC_PREFIX + "turno"), ("P", "RN03", "fora da base"), ("P", "RN07", "x")]
