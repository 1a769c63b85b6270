"""DuckDB oracle SQL for the registered queries.

Each statement rebuilds the derived tables from the pre-registered parquet
views with a CTE prefix and computes the key's result independently of Spark.
"""

from __future__ import annotations

from lotguard.functions import constants as K


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def bl(c: str) -> str:
    return f"(coalesce(trim({c}), '') = '')"


def fl(c: str) -> str:
    return f"(NOT {bl(c)})"


CATALOGUE_SQL = "[" + ", ".join(q(p) for p in K.CATALOGUE) + "]"
CATALOGUE_IN = "(" + ", ".join(q(p) for p in K.CATALOGUE) + ")"

LOTS = f"""
d1_src AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderstatus AS ost, o.o_orderdate AS od,
         o.o_orderpriority AS opr, c.c_name AS cname,
         sha256(strftime(o.o_orderdate, '%Y-%m-%d')) AS source_hash
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
d1_num AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY source_hash ORDER BY k) - 1 AS INTEGER) AS row_idx
  FROM d1_src
),
lots AS (
  SELECT 'batch-' || substr(source_hash, 1, 16) AS batch_id,
    row_idx,
    CAST(row_idx + 4 AS INTEGER) AS source_row,
    source_hash || ':' || CAST(row_idx + 4 AS VARCHAR) AS item_id,
    source_hash,
    'inspecao_' || strftime(od, '%d_%m_%Y') || '.xlsx' AS source_file,
    strftime(od, '%d/%m/%Y') AS reference_date,
    CASE WHEN k % 97 = 13 THEN NULL WHEN k % 101 = 17 THEN '  '
         ELSE 'LG-' || printf('%08d', k) END AS lote_id,
    CASE WHEN k % 43 = 9 THEN 'XX-LEGACY' WHEN k % 47 = 10 THEN ''
         ELSE {CATALOGUE_SQL}[CAST(ck % 10 + 1 AS INTEGER)] END AS produto,
    CASE WHEN k % 59 = 11 THEN NULL ELSE 'L' || CAST(ck % 3 + 1 AS VARCHAR) END AS linha,
    substr('ABC', CAST(k % 3 + 1 AS INTEGER), 1) AS turno,
    CASE WHEN k % 20 = 0 THEN 'OK' WHEN k % 20 = 1 THEN ' nok ' WHEN k % 50 = 2 THEN 'REPROV.'
         WHEN k % 50 = 3 THEN 'APROVADO PARCIAL' WHEN k % 89 = 4 THEN ''
         WHEN ost = 'F' THEN 'APROVADO' WHEN ost = 'O' THEN 'pendente' WHEN ost = 'P' THEN 'REPROVADO'
    END AS status,
    CASE WHEN k % 30 = 7 THEN '' WHEN k % 11 = 0 THEN '  ' || cname || '  ' ELSE cname END AS responsavel,
    CASE WHEN k % 37 = 5 THEN strftime(od + INTERVAL 1 DAY, '%d/%m/%Y') WHEN k % 41 = 6 THEN ''
         WHEN k % 53 = 7 THEN 'n/d' ELSE strftime(od, '%d/%m/%Y') END AS data,
    CASE WHEN k % 7 < 3 THEN NULL WHEN k % 7 = 3 THEN '   ' ELSE 'obs ' || opr END AS observacao,
    k AS lot_key
  FROM d1_num
),
ref AS (SELECT DISTINCT 'LG-' || printf('%08d', l_orderkey) AS lote_id FROM lineitem)"""

_SER_COLS = ", ".join(f"coalesce(trim({c}), '') AS {c}" for c in K.CONTRACT_COLUMNS)
_CAT_FAIL = f"(produto <> '' AND produto NOT IN {CATALOGUE_IN})"
_FORM = (f"concat_ws(' | ', CASE WHEN lote_id = '' THEN {q(K.FORM_MISSING_LOT)} END, "
         f"CASE WHEN produto = '' THEN {q(K.FORM_MISSING_PRODUCT)} END)")

OUTCOMES = f"""
ser AS (
  SELECT batch_id, row_idx, source_row, item_id, source_hash, source_file, reference_date, lot_key, {_SER_COLS}
  FROM lots
),
out_a AS (
  SELECT *,
    CASE WHEN {_CAT_FAIL} THEN 'T' WHEN {_FORM} <> '' THEN 'R' ELSE 'S' END AS oc,
    'linha-' || CAST(source_row AS VARCHAR) AS row_label
  FROM ser
),
outcomes AS (
  SELECT batch_id, row_idx, source_row, item_id, source_hash, source_file, reference_date, lot_key,
    {", ".join(K.CONTRACT_COLUMNS)},
    CASE oc WHEN 'T' THEN 'FALHA_TECNICA' WHEN 'R' THEN 'REJEITADO_NEGOCIO' ELSE 'SUCESSO' END AS cadastro_status,
    CASE oc WHEN 'T' THEN 'TIMEOUT: Produto ''' || produto || ''' indisponível para seleção.'
            WHEN 'R' THEN {_FORM} ELSE '' END AS cadastro_error,
    CASE oc WHEN 'T' THEN 'SYSTEM' WHEN 'R' THEN 'BUSINESS' ELSE '' END AS cadastro_error_type,
    CASE oc WHEN 'T' THEN 'erro_timeout_' WHEN 'R' THEN 'rejeicao_' ELSE 'comprovante_' END
      || row_label || '_'
      || regexp_replace(regexp_replace(coalesce(nullif(lote_id, ''), row_label), '[^\\w.-]+', '_', 'g'), '^_+|_+$', '', 'g')
      || '.png' AS evidence_name
  FROM out_a
),
outcomes_p AS (
  SELECT *, '/evidence/' || batch_id || '/produtor/' || evidence_name AS evidence_path FROM outcomes
)"""


def _handoff_cte(name: str, where: str) -> str:
    cols = []
    for c in K.HANDOFF_FIELDS:
        if c == "batch_total":
            cols.append("CAST(count(*) OVER (PARTITION BY batch_id) AS INTEGER) AS batch_total")
        elif c == "producer_execution_id":
            cols.append("'exec-1' AS producer_execution_id")
        elif c == "reference_lotes_json":
            cols.append("CASE WHEN ref_hit THEN to_json([lote_id]) ELSE '[]' END AS reference_lotes_json")
        else:
            cols.append(c)
    return f"""
{name}_k AS (
  SELECT o.*, (r.lote_id IS NOT NULL) AS ref_hit
  FROM outcomes_p o LEFT JOIN ref r ON r.lote_id = trim(o.lote_id) AND trim(o.lote_id) <> ''
  {where}
),
{name} AS (SELECT {", ".join(cols)} FROM {name}_k)"""


HANDOFF = _handoff_cte("handoff", "WHERE o.cadastro_status = 'SUCESSO'") + "," + \
    _handoff_cte("handoff_all", "")


def ev_cte(name: str, src: str, extra: str = "") -> str:
    """Context columns over a lots-like source joined with ``ref``."""
    return f"""
{name} AS (
  SELECT l.*{extra},
    upper(trim(l.status)) AS s_canon,
    CASE upper(trim(l.status)) WHEN 'OK' THEN 'APROVADO' WHEN 'NOK' THEN 'REPROVADO'
         ELSE upper(trim(l.status)) END AS s_norm,
    coalesce(nullif(l.reference_date, ''), {q(K.DEFAULT_REFERENCE_DATE)}) AS ref_text,
    (r.lote_id IS NOT NULL) AS known
  FROM {src} l LEFT JOIN ref r ON r.lote_id = trim(l.lote_id) AND trim(l.lote_id) <> ''
)"""


def rule_pred(rule: str, e: str = "") -> str:
    p = e + "." if e else ""
    if rule == "RN02":
        return "(" + " OR ".join(bl(p + c) for c in K.REQUIRED_COLUMNS) + ")"
    if rule == "RN01":
        return (f"({fl(p + 'data')} AND coalesce(CAST(try_strptime({p}data, '%d/%m/%Y') AS DATE) "
                f"<> CAST(strptime({p}ref_text, '%d/%m/%Y') AS DATE), TRUE))")
    if rule == "RN03":
        return f"({fl(p + 'lote_id')} AND NOT {p}known)"
    if rule == "RN05":
        return f"(coalesce({p}s_canon IN ('OK', 'NOK'), FALSE))"
    if rule == "RN06":
        return f"(NOT coalesce({p}s_norm IN ('APROVADO', 'REPROVADO', 'PENDENTE'), FALSE))"
    if rule == "RN07":
        return f"(coalesce({p}s_norm, '') = 'REPROVADO' AND {bl(p + 'observacao')})"
    raise KeyError(rule)


def rule_desc(rule: str, e: str = "") -> str:
    p = e + "." if e else ""
    if rule == "RN02":
        parts = ", ".join(f"CASE WHEN {bl(p + c)} THEN '{c}' END" for c in K.REQUIRED_COLUMNS)
        return f"{q(K.RN02_DESC_PREFIX)} || concat_ws(', ', {parts}) || '.'"
    if rule == "RN01":
        return f"'[RN01] Data ''' || {p}data || ''' fora da referência ''' || {p}ref_text || '''.'"
    if rule == "RN03":
        return f"'[RN03] lote_id ''' || {p}lote_id || ''' não encontrado na base de referência.'"
    if rule == "RN05":
        return f"CASE WHEN {p}s_canon = 'OK' THEN {q(K.RN05_OK_DESC)} ELSE {q(K.RN05_NOK_DESC)} END"
    if rule == "RN06":
        return f"'[RN04] Status ''' || coalesce({p}s_norm, 'nan') || ''' fora do domínio permitido.'"
    if rule == "RN07":
        return q(K.RN07_DESC)
    raise KeyError(rule)


RULES = [
    ("RN02", 1, K.RN02_ACTION, K.SEV_HIGH),
    ("RN01", 2, K.RN01_ACTION, K.SEV_MEDIUM),
    ("RN03", 3, K.RN03_ACTION, K.SEV_HIGH),
    ("RN05", 4, K.RN05_ACTION, K.SEV_LOW),
    ("RN06", 5, K.RN06_ACTION, K.SEV_HIGH),
    ("RN07", 6, K.RN07_ACTION, K.SEV_HIGH),
]


def viol_cte(name: str, ev: str, keys: str = "item_id, lote_id") -> str:
    parts = [
        f"SELECT {keys}, {o} AS ord, '{r}' AS regra_violada, {rule_desc(r)} AS descricao_do_erro, "
        f"{q(a)} AS acao_recomendada, {q(s)} AS severidade FROM {ev} WHERE {rule_pred(r)}"
        for r, o, a, s in RULES
    ]
    return f"\n{name} AS (\n  " + "\n  UNION ALL ".join(parts) + "\n)"


def cons_cte(name: str, viol: str, keys: str = "item_id, lote_id") -> str:
    return f"""
{name} AS (
  SELECT {keys},
    string_agg(regra_violada, '; ' ORDER BY ord) AS regra_violada,
    string_agg(descricao_do_erro, ' | ' ORDER BY ord) AS descricao_do_erro,
    string_agg(acao_recomendada, ' | ' ORDER BY ord) AS acao_recomendada,
    CASE WHEN bool_or(severidade = 'Alta') THEN 'Alta' ELSE 'Média' END AS severidade
  FROM {viol} GROUP BY {keys}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_(LOTS, ev_cte("ev", "lots"), viol_cte("viol", "ev"), cons_cte("cons", "viol"))
FULL = with_(
    LOTS, ev_cte("ev", "lots"), viol_cte("viol", "ev"), cons_cte("cons", "viol"),
    OUTCOMES, HANDOFF,
    ev_cte("cev", "handoff_all"),
    viol_cte("cviol", "cev", "item_id, lote_id, batch_id"),
    cons_cte("ccons", "cviol", "item_id, lote_id, batch_id"),
)

_EXCL = "(cadastro_status = 'REJEITADO_NEGOCIO' OR cadastro_status IN ('FALHA_TECNICA', 'FALHA'))"
_TECH = "(cadastro_status IN ('FALHA_TECNICA', 'FALHA'))"
_REJ = "(cadastro_status = 'REJEITADO_NEGOCIO')"

_CSTATE = f"""
cstate AS (
  SELECT h.item_id, h.batch_id,
    CASE WHEN {_TECH} OR {_REJ} OR c.item_id IS NOT NULL THEN 'ERROR' ELSE 'DONE' END AS datapool_state,
    CASE WHEN {_TECH} THEN 'SYSTEM' WHEN {_REJ} OR c.item_id IS NOT NULL THEN 'BUSINESS' ELSE '' END AS error_type,
    CASE WHEN {_TECH} THEN left(coalesce(nullif(h.cadastro_error, ''), {q(K.MSG_TECHNICAL_DEFAULT)}), 1000)
         WHEN {_REJ} THEN left(coalesce(nullif(h.cadastro_error, ''), {q(K.MSG_REJECTED_DEFAULT)}), 1000)
         WHEN c.item_id IS NULL THEN {q(K.MSG_DONE)}
         ELSE left(c.regra_violada || ': ' || c.descricao_do_erro, 1000) END AS finish_message
  FROM handoff_all h LEFT JOIN ccons c ON c.item_id = h.item_id
)"""

_CSUM = f"""
csum AS (
  SELECT h.batch_id,
    CAST(count(*) AS BIGINT) AS total_registros,
    CAST(count(c.item_id) AS BIGINT) AS total_divergencias,
    CAST(coalesce(sum(c.n), 0) AS BIGINT) AS total_regras_violadas,
    CAST(count_if(c.item_id IS NULL AND NOT {_EXCL}) AS BIGINT) AS total_lotes_validados,
    CAST(count_if(coalesce(c.has_rn06, FALSE)) AS BIGINT) AS total_revisao_humana,
    CAST(count_if({_REJ}) AS BIGINT) AS total_rejeicoes_cadastro,
    CAST(count_if({_TECH}) AS BIGINT) AS total_falhas_tecnicas
  FROM handoff_all h
  LEFT JOIN (SELECT item_id, count(*) AS n, bool_or(regra_violada = 'RN06') AS has_rn06
             FROM cviol GROUP BY item_id) c ON c.item_id = h.item_id
  GROUP BY h.batch_id
)"""

CONSUMER = FULL.rstrip("\n") + "," + _CSTATE + "," + _CSUM + "\n"

SQL: dict[str, str] = {}

SQL["divergences"] = BASE + "SELECT * FROM cons"
SQL["violations"] = BASE + "SELECT item_id, ord, regra_violada, descricao_do_erro, acao_recomendada, severidade FROM viol"
for _key, _rule in (("rn01_date", "RN01"), ("rn02_required", "RN02"), ("rn03_reference", "RN03"),
                    ("rn05_normalise", "RN05"), ("rn06_domain", "RN06"), ("rn07_remark", "RN07")):
    SQL[_key] = BASE + f"SELECT item_id, lote_id, {rule_desc(_rule)} AS message FROM ev WHERE {rule_pred(_rule)}"
SQL["known_lots"] = BASE + "SELECT item_id, lote_id FROM ev WHERE known"
SQL["reference_ids"] = BASE + "SELECT lote_id FROM ref"
SQL["lineage"] = BASE + "SELECT item_id, batch_id, source_row, source_hash FROM lots"
SQL["serialise"] = BASE + f"SELECT item_id, {_SER_COLS} FROM lots"
_VALID_COLS = ", ".join(c if c != "status" else "s_norm AS status" for c in K.CONTRACT_COLUMNS)
SQL["valid_lots"] = BASE + (
    f"SELECT item_id, {_VALID_COLS}, status AS status_original, "
    "CAST(NULL AS VARCHAR) AS divergencia_rn05 FROM ev WHERE item_id NOT IN (SELECT item_id FROM viol)"
)
SQL["human_review"] = BASE + (
    f"SELECT lote_id, status AS status_original, s_norm AS status, data, {rule_desc('RN06')} AS descricao_do_erro, "
    f"'' AS observacao_analista FROM ev WHERE {rule_pred('RN06')}"
)
SQL["rule_distribution"] = BASE + "SELECT regra_violada AS regra, CAST(count(*) AS BIGINT) AS n FROM viol GROUP BY 1"
SQL["exception_rate"] = BASE + (
    "SELECT batch_id, CAST(count(*) AS BIGINT) AS total, CAST(count(c.item_id) AS BIGINT) AS exceptions, "
    "round(CAST(count(c.item_id) AS DOUBLE) / count(*), 6) AS rate "
    "FROM lots l LEFT JOIN cons c USING (item_id) GROUP BY batch_id"
)
SQL["admission_rules"] = with_(LOTS, OUTCOMES) + f"SELECT item_id, {_FORM} AS mensagem FROM ser WHERE {_FORM} <> ''"
SQL["catalogue_check"] = with_(LOTS, OUTCOMES) + f"SELECT item_id, produto FROM ser WHERE {_CAT_FAIL}"
SQL["admission_outcome"] = with_(LOTS, OUTCOMES) + \
    "SELECT item_id, cadastro_status, cadastro_error, cadastro_error_type FROM outcomes"
SQL["admitted"] = with_(LOTS, OUTCOMES) + "SELECT item_id, batch_id FROM outcomes WHERE cadastro_status = 'SUCESSO'"
SQL["flow_errors"] = with_(LOTS, OUTCOMES) + \
    f"SELECT {', '.join(K.FLOW_ERROR_COLUMNS)} FROM outcomes_p WHERE cadastro_status <> 'SUCESSO'"
SQL["flow_errors_summary"] = with_(LOTS, OUTCOMES) + """
SELECT metrica, valor FROM (
  SELECT 1 AS o, 'total_erros_fluxo' AS metrica, CAST(count(*) AS BIGINT) AS valor FROM outcomes WHERE cadastro_status <> 'SUCESSO'
  UNION ALL SELECT 2, 'cadastros_rejeitados', CAST(count(*) AS BIGINT) FROM outcomes WHERE cadastro_status = 'REJEITADO_NEGOCIO'
  UNION ALL SELECT 3, 'falhas_tecnicas', CAST(count(*) AS BIGINT) FROM outcomes WHERE cadastro_status = 'FALHA_TECNICA'
)"""
SQL["producer_summary"] = with_(LOTS, OUTCOMES) + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(cadastro_status = 'SUCESSO') AS BIGINT) AS itens_publicados_datapool,
  CAST(count_if(cadastro_status <> 'SUCESSO') AS BIGINT) AS erros_fluxo,
  CAST(count_if(cadastro_status = 'SUCESSO') AS BIGINT) AS cadastros_sucesso,
  CAST(count_if(cadastro_status = 'REJEITADO_NEGOCIO') AS BIGINT) AS cadastros_rejeitados,
  CAST(count_if(cadastro_status = 'FALHA_TECNICA') AS BIGINT) AS cadastros_falha_tecnica,
  CAST(count_if(cadastro_status <> 'SUCESSO') AS BIGINT) AS cadastros_falha
FROM outcomes GROUP BY batch_id"""
SQL["handoff_flat"] = FULL + "SELECT * FROM handoff"
SQL["handoff_envelope"] = FULL + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS total,
  CAST(count_if(reference_lotes_json <> '[]') AS BIGINT) AS n_reference,
  arg_min(item_id, source_row) AS first_item, arg_max(item_id, source_row) AS last_item
FROM handoff GROUP BY batch_id"""
SQL["batch_header"] = FULL + """
SELECT batch_id, arg_min(reference_date, source_row) AS reference_date, arg_min(source_file, source_row) AS source_file
FROM handoff GROUP BY batch_id"""
_REG = ", ".join(K.REGISTRATION_COLUMNS)
SQL["registration_rejections"] = FULL + f"SELECT {_REG} FROM handoff_all WHERE {_REJ}"
SQL["technical_failures"] = FULL + f"SELECT {_REG} FROM handoff_all WHERE {_TECH}"
SQL["item_state"] = CONSUMER + "SELECT item_id, datapool_state, error_type, finish_message FROM cstate"
SQL["validation_summary"] = CONSUMER + "SELECT * FROM csum"
SQL["item_metrics"] = CONSUMER + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS total_items,
  CAST(count_if(datapool_state = 'DONE') AS BIGINT) AS processed_items,
  CAST(count(*) - count_if(datapool_state = 'DONE') AS BIGINT) AS failed_items
FROM cstate GROUP BY batch_id"""
SQL["metrics_long"] = CONSUMER + "SELECT batch_id, metrica, valor FROM csum UNPIVOT (valor FOR metrica IN (" + \
    ", ".join(K.SUMMARY_METRICS) + "))"
SQL["not_valid_keys"] = CONSUMER + \
    f"SELECT item_id FROM handoff_all WHERE {_EXCL} OR item_id IN (SELECT item_id FROM cviol)"


# --- landing -------------------------------------------------------------------
_DAY = "CAST(substr(reference_date, 1, 2) AS INTEGER)"
_CONTRACT_LIST = "[" + ", ".join(q(c) for c in K.CONTRACT_COLUMNS) + "]"

SQL["sheet_to_table"] = BASE + f"""
SELECT batch_id, row_idx, {", ".join(K.CONTRACT_COLUMNS)} FROM lots
UNION ALL
SELECT batch_id, CAST(count(*) AS INTEGER), 'Total', CAST(count(*) AS VARCHAR),
  NULL, NULL, NULL, NULL, NULL, NULL
FROM lots WHERE {_DAY} = 9 GROUP BY batch_id"""
SQL["declared_total_cap"] = BASE + f"""
SELECT batch_id,
  CAST(CASE WHEN any_value({_DAY}) = 9 THEN NULL ELSE count(*) + CASE WHEN any_value({_DAY}) = 11 THEN 1 ELSE 0 END END AS INTEGER) AS declared,
  CAST(count(*) + CASE WHEN any_value({_DAY}) = 9 THEN 1 ELSE 0 END AS BIGINT) AS kept_rows
FROM lots GROUP BY batch_id"""
SQL["reference_date"] = BASE + f"""
SELECT DISTINCT batch_id, CASE WHEN {_DAY} = 21 THEN '' ELSE reference_date END AS reference_date FROM lots"""
_HDR = f"""
hdr0 AS (SELECT DISTINCT batch_id, {_DAY} AS dd FROM lots),
hdr AS (
  SELECT batch_id,
    CASE WHEN dd IN (3, 7) THEN list_filter({_CONTRACT_LIST}, lambda x: x <> 'status') ELSE {_CONTRACT_LIST} END
    || CASE WHEN dd IN (5, 7) THEN ['extra'] ELSE [] END AS header
  FROM hdr0
),
hdr_chk AS (
  SELECT batch_id,
    list_sort(list_filter({_CONTRACT_LIST}, lambda x: NOT list_contains(header, x))) AS miss,
    list_sort(list_filter(header, lambda x: NOT list_contains({_CONTRACT_LIST}, x))) AS extra
  FROM hdr
),
structure AS (
  SELECT batch_id, (len(miss) = 0 AND len(extra) = 0) AS ok,
    CASE WHEN len(miss) = 0 AND len(extra) = 0 THEN ''
         ELSE {q(K.STRUCTURE_PREFIX)} || concat_ws('; ',
           CASE WHEN len(miss) > 0 THEN {q(K.MISSING_LABEL)} || array_to_string(miss, ', ') END,
           CASE WHEN len(extra) > 0 THEN {q(K.EXTRA_LABEL)} || array_to_string(extra, ', ') END) END AS message
  FROM hdr_chk
)"""
SQL["structure_check"] = with_(LOTS, _HDR) + "SELECT batch_id, ok, message FROM structure"
SQL["fingerprint"] = """
SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, 'batch-' || substr(sha256(text), 1, 16) AS batch_id
FROM documents"""

# --- queue ------------------------------------------------------------------------
_QUEUE = """
qs0 AS (
  SELECT strftime(strptime(reference_date, '%d/%m/%Y'), '%Y-%m') AS queue_id,
    CAST(strftime(strptime(reference_date, '%d/%m/%Y'), '%Y%m%d') AS BIGINT) AS dkey,
    CAST(substr(reference_date, 1, 2) AS INTEGER) AS dd, item_id, batch_id, source_row, batch_total
  FROM handoff
),
qs AS (
  SELECT queue_id, item_id, batch_id, dd, CASE WHEN dd = 13 THEN batch_total + 1 ELSE batch_total END AS batch_total,
    row_number() OVER (PARTITION BY queue_id ORDER BY CASE WHEN dd = 20 THEN dkey - 1 ELSE dkey END,
      CASE WHEN dd IN (19, 20) THEN 2 * source_row + CAST(dd = 20 AS INTEGER) ELSE source_row END) - 1 AS place
  FROM qs0
),
qg AS (
  SELECT *, sum(CASE WHEN new_run THEN 1 ELSE 0 END) OVER (PARTITION BY queue_id ORDER BY place) AS run_no
  FROM (SELECT *, coalesce(lag(batch_id) OVER (PARTITION BY queue_id ORDER BY place) <> batch_id, TRUE) AS new_run FROM qs)
),
qn AS (SELECT *, max(place) OVER (PARTITION BY queue_id, run_no) + 1 AS run_end FROM qg),
qb AS (
  SELECT queue_id, batch_id, min(place) AS first_place, max(batch_total) AS total, max(dd) AS dd FROM qs GROUP BY queue_id, batch_id
),
qt AS (
  SELECT 'task-' || batch_id AS task_id, queue_id, first_place AS start_place,
    CASE WHEN dd % 7 = 3 THEN '' WHEN dd = 22 THEN batch_id || '-x' ELSE batch_id END AS p_batch,
    CASE WHEN dd % 7 = 3 THEN 0 WHEN dd = 8 THEN (total + 1) // 2 ELSE total END AS p_total
  FROM qb WHERE dd <> 26
  UNION ALL
  SELECT 'task-' || batch_id || '-rest', queue_id, first_place + (total + 1) // 2, '', 0 FROM qb WHERE dd = 8 AND total > 1
  UNION ALL
  SELECT 'task-behind-' || queue_id, queue_id, max(place) + 6, '', 0 FROM qs GROUP BY queue_id
),
qr0 AS (
  SELECT t.task_id, t.queue_id, t.start_place, coalesce(nullif(t.p_batch, ''), f.batch_id, '') AS target,
    CASE WHEN t.p_total > 0 THEN t.p_total ELSE coalesce(f.batch_total, 0) END AS need,
    CASE WHEN f.batch_id = coalesce(nullif(t.p_batch, ''), f.batch_id) THEN f.run_end - t.start_place ELSE 0 END AS there
  FROM qt t LEFT JOIN qn f ON f.queue_id = t.queue_id AND f.place = t.start_place
),
qr AS (SELECT *, CASE WHEN need > 0 THEN least(need, coalesce(there, 0)) ELSE coalesce(there, 0) END AS own FROM qr0),
sess AS (
  SELECT r.*, CASE WHEN own < need OR need <= 0 THEN n.batch_id END AS foreign_batch
  FROM qr r LEFT JOIN qs n ON n.queue_id = r.queue_id AND n.place = r.start_place + r.own
),
sess_p AS (
  SELECT *,
    CASE WHEN foreign_batch IS NOT NULL THEN 'foreign_item' WHEN own = 0 THEN 'empty' WHEN need <> 0 AND own <> need THEN 'incomplete' END AS problem,
    CASE WHEN foreign_batch IS NOT NULL THEN 'Item do lote ''' || foreign_batch || ''' recebido durante o lote ''' || target || '''.'
         WHEN own = 0 THEN 'DataPool ''' || queue_id || ''' sem itens pendentes.'
         WHEN need <> 0 AND own <> need THEN 'Lote incompleto: esperados ' || CAST(need AS VARCHAR) || ', recebidos ' || CAST(own AS VARCHAR) || '.'
    END AS message
  FROM sess
),
reads AS (
  SELECT s.task_id, q.item_id, q.place >= s.start_place + s.own AS is_foreign, s.start_place, s.problem, s.message
  FROM sess_p s JOIN qs q ON q.queue_id = s.queue_id AND q.place >= s.start_place
    AND q.place < s.start_place + s.own + CASE WHEN s.foreign_batch IS NULL THEN 0 ELSE 1 END
),
taken AS (
  SELECT 'session-' || queue_id || '-' || CAST((dd + 1) // 2 AS VARCHAR) AS task_id, batch_id, (dd + 1) // 2 = 3 AS short FROM qs
),
taken_p AS (
  SELECT task_id, min(batch_id) AS batch_id, CASE WHEN bool_or(short) THEN 'incomplete' ELSE 'mixed' END AS problem,
    CASE WHEN bool_or(short) THEN 'Lote incompleto: esperados ' || CAST(count(*) + 1 AS VARCHAR) || ', recebidos ' || CAST(count(*) AS VARCHAR) || '.'
         ELSE 'Foram consumidos lotes mistos: [''' || string_agg(DISTINCT batch_id, ''', ''' ORDER BY batch_id) || ''']' END AS message
  FROM taken GROUP BY task_id HAVING bool_or(short) OR count(DISTINCT batch_id) > 1
),
item_err AS (SELECT item_id, arg_min(message, (start_place, task_id)) AS message FROM reads WHERE problem IS NOT NULL GROUP BY item_id)"""

_PUB = with_(
    LOTS, OUTCOMES, HANDOFF,
    ev_cte("pev", "handoff"),
    viol_cte("pviol", "pev", "item_id, lote_id, batch_id"),
    cons_cte("pcons", "pviol", "item_id, lote_id, batch_id"),
).rstrip("\n") + "," + _QUEUE + "," + f"""
pstate AS (
  SELECT h.item_id, h.batch_id,
    CASE WHEN c.item_id IS NOT NULL THEN 'ERROR' ELSE 'DONE' END AS datapool_state,
    CASE WHEN c.item_id IS NOT NULL THEN 'BUSINESS' ELSE '' END AS error_type,
    CASE WHEN c.item_id IS NULL THEN {q(K.MSG_DONE)}
         ELSE left(c.regra_violada || ': ' || c.descricao_do_erro, 1000) END AS finish_message
  FROM handoff h LEFT JOIN pcons c ON c.item_id = h.item_id
)
"""
SQL["bounded_queue_read"] = _PUB + 'SELECT task_id, item_id, is_foreign AS "foreign" FROM reads'
SQL["batch_integrity"] = _PUB + """
SELECT task_id, target AS batch_id, problem, message FROM sess_p WHERE problem IS NOT NULL
UNION ALL SELECT task_id, batch_id, problem, message FROM taken_p"""
SQL["processed_state"] = _PUB + f"""
SELECT h.{", h.".join(K.HANDOFF_FIELDS)},
  CASE WHEN e.item_id IS NOT NULL THEN 'ERROR' ELSE p.datapool_state END AS datapool_state,
  CASE WHEN e.item_id IS NOT NULL THEN 'SYSTEM' ELSE p.error_type END AS error_type,
  CASE WHEN e.item_id IS NOT NULL THEN left(e.message, 1000) ELSE p.finish_message END AS finish_message
FROM handoff h JOIN pstate p USING (item_id) LEFT JOIN item_err e USING (item_id)
WHERE h.item_id IN (SELECT item_id FROM reads)"""
SQL["still_pending"] = _PUB + """
SELECT DISTINCT batch_id FROM handoff
WHERE batch_id NOT IN (SELECT batch_id FROM handoff WHERE item_id IN (SELECT item_id FROM reads))"""
SQL["dedupe_items"] = FULL + "SELECT item_id, batch_id, source_row FROM handoff"
SQL["duplicate_items"] = FULL + "SELECT item_id, CAST(2 AS BIGINT) AS n FROM handoff WHERE source_row % 5 = 0"
SQL["abort_states"] = CONSUMER.rstrip("\n") + "," + _HDR + """
SELECT s.item_id,
  CASE WHEN going AND st.ok = FALSE THEN 'ERROR' WHEN going THEN 'PROCESSING' ELSE s.datapool_state END AS datapool_state,
  CASE WHEN going AND st.ok = FALSE THEN 'SYSTEM' WHEN going THEN '' ELSE s.error_type END AS error_type,
  CASE WHEN going AND st.ok = FALSE THEN left(st.message, 1000) WHEN going THEN '' ELSE s.finish_message END AS finish_message
FROM (SELECT *, CAST(split_part(item_id, ':', 2) AS BIGINT) % 2 = 0 AS going FROM cstate) s LEFT JOIN structure st USING (batch_id)"""

# --- stored copies ------------------------------------------------------------
_STORED = """
d5b AS (
  SELECT lote_id, produto, linha, turno, status, responsavel, data, observacao, item_id,
    CAST(substr(lote_id, 4) AS BIGINT) AS k, CAST(strptime(reference_date, '%d/%m/%Y') AS TIMESTAMP) AS dday
  FROM handoff WHERE CAST(substr(lote_id, 4) AS BIGINT) % 29 <> 3
),
d5 AS (
  SELECT item_id || '#0' AS id, lote_id, produto, CASE WHEN k % 31 = 4 THEN 'L9' ELSE linha END AS linha,
    turno, status, responsavel, data, observacao,
    strftime(dday + to_minutes(CAST(k % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S') AS criadoEm
  FROM d5b
  UNION ALL
  SELECT item_id || '#1', lote_id || '-X', produto, linha, turno, status, responsavel, data, observacao,
    strftime(dday + to_minutes(CAST(k % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
  FROM d5b WHERE k % 71 = 5
  UNION ALL
  SELECT item_id || '#2', lote_id, produto, 'L8', turno, status, responsavel, data, observacao,
    strftime(dday + to_minutes(CAST(k % 1440 AS BIGINT)) - INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S')
  FROM d5b WHERE k % 67 = 6
),
lat AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY lote_id ORDER BY criadoEm DESC) AS rn FROM d5) WHERE rn = 1
)"""
_FIELDS7 = [c for c in K.CONTRACT_COLUMNS if c != "lote_id"]
_RECON = " UNION ALL ".join(
    f"SELECT h.lote_id, 'diff' AS side, '{c}' AS campo, h.{c} AS esperado, l.{c} AS salvo "
    f"FROM handoff h JOIN lat l ON l.lote_id = h.lote_id WHERE h.{c} IS DISTINCT FROM l.{c}"
    for c in _FIELDS7
)
SQL["readback_reconcile"] = FULL.rstrip("\n") + "," + _STORED + f"""
SELECT * FROM ({_RECON})
UNION ALL
SELECT lote_id, 'missing', '*', NULL, NULL FROM handoff WHERE lote_id NOT IN (SELECT lote_id FROM lat)
UNION ALL
SELECT lote_id, 'extra', '*', NULL, NULL FROM lat WHERE lote_id NOT IN (SELECT lote_id FROM handoff)"""
SQL["latest_stored"] = FULL.rstrip("\n") + "," + _STORED + "\nSELECT lote_id, criadoEm, linha FROM lat"
SQL["stored_lots"] = FULL.rstrip("\n") + "," + _STORED + """
SELECT id, lote_id, produto, linha, turno, status, responsavel, data, observacao, criadoEm FROM d5
UNION ALL
SELECT item_id || '#3', lote_id, produto, 'L7', turno, status, responsavel, data, observacao,
  strftime(dday + to_minutes(CAST(k % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S')
FROM d5b WHERE k % 73 = 7"""
SQL["latest_stored_listed"] = FULL.rstrip("\n") + "," + _STORED + "\nSELECT lote_id, criadoEm, linha FROM lat"
SQL["admission_readback"] = FULL.rstrip("\n") + "," + _STORED + f"""
SELECT o.item_id,
  CASE WHEN o.cadastro_status <> 'SUCESSO' THEN o.cadastro_status WHEN rb IS NOT NULL THEN 'FALHA_TECNICA' ELSE 'SUCESSO' END AS cadastro_status,
  CASE WHEN o.cadastro_status <> 'SUCESSO' THEN o.cadastro_error ELSE coalesce(rb, '') END AS cadastro_error,
  CASE WHEN o.cadastro_status <> 'SUCESSO' THEN o.cadastro_error_type WHEN rb IS NOT NULL THEN 'SYSTEM' ELSE '' END AS cadastro_error_type,
  CASE WHEN o.cadastro_status = 'SUCESSO' AND rb IS NOT NULL THEN replace(o.evidence_name, 'comprovante_', 'erro_') ELSE o.evidence_name END AS evidence_name
FROM (
  SELECT o.*, CASE WHEN o.lote_id = '' THEN NULL
    WHEN l.lote_id IS NULL THEN {q(K.READBACK_MISSING)}
    WHEN l.linha <> o.linha THEN {q(K.READBACK_PREFIX)} || 'linha={{''esperado'': ''' || o.linha || ''', ''salvo'': ''' || l.linha || '''}}' END AS rb
  FROM outcomes o LEFT JOIN lat l ON l.lote_id = o.lote_id
) o"""
# --- runs and events ------------------------------------------------------------
_EVENTS = """
WITH rev0 AS (
  SELECT event_id, 'run-' || CAST(user_id % 10 AS VARCHAR) AS run_id, 'exec-' || CAST(user_id % 10 AS VARCHAR) AS wanted,
    CASE WHEN user_id % 10 = 7 AND event_id % 5 = 1 THEN 'exec-x' ELSE 'exec-' || CAST(user_id % 10 AS VARCHAR) END AS execution_id,
    CASE WHEN user_id % 10 = 3 AND event_id % 5 = 0 THEN 'bot-b' ELSE 'bot-a' END AS bot_id, ts
  FROM events
),
rstart AS (
  SELECT run_id, date_trunc('second', min(ts)) + INTERVAL 500 MILLISECOND AS started_at FROM rev0
  WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' GROUP BY run_id
),
rev AS (SELECT r.* FROM rev0 r JOIN rstart s USING (run_id) WHERE r.ts >= date_trunc('second', s.started_at))
"""
SQL["run_events_window"] = _EVENTS + "SELECT run_id, CAST(count(*) AS BIGINT) AS n, min(event_id) AS first_event FROM rev GROUP BY 1"
SQL["verify_log_context"] = _EVENTS + """
SELECT run_id, CAST(count(*) AS BIGINT) AS n, bool_and(bot_id = 'bot-a' AND execution_id = wanted) AS ok FROM rev GROUP BY 1
UNION ALL SELECT 'run-idle', 0, FALSE"""
SQL["event_log"] = with_(LOTS, OUTCOMES) + """
, ends AS (
  SELECT source_row, lote_id,
    CASE cadastro_status WHEN 'SUCESSO' THEN 'INFO' WHEN 'REJEITADO_NEGOCIO' THEN 'WARNING' ELSE 'ERROR' END AS level,
    CASE cadastro_status WHEN 'SUCESSO' THEN 'CADASTRO_WEB_CONCLUIDO' WHEN 'REJEITADO_NEGOCIO' THEN 'CADASTRO_WEB_REJEITADO'
         ELSE CASE WHEN starts_with(cadastro_error, 'TIMEOUT: ') THEN 'TIMEOUT_AO_CARREGAR_COMPROVANTE' ELSE 'CADASTRO_WEB_FALHOU' END END AS code
  FROM outcomes
  UNION ALL SELECT source_row, lote_id, 'INFO', 'CADASTRO_WEB_INICIADO' FROM outcomes
), lines AS (
  SELECT *, TIMESTAMP '2024-01-10 00:00:00' + to_days(CAST(source_row % 3 AS INTEGER)) + to_seconds(source_row) AS moment FROM ends
)
SELECT '1' AS run, strftime(moment, '%Y-%m-%d') AS day, level, code, 'bot-produtor' AS bot_id, CAST(count(*) AS BIGINT) AS n,
  CAST(sum(source_row) AS BIGINT) AS rows, CAST(count(lote_id) AS BIGINT) AS n_lote, min(strftime(moment, '%H:%M:%S')) AS first_time
FROM lines WHERE moment >= TIMESTAMP '2024-01-11 00:00:07' GROUP BY ALL"""
SQL["report_versions"] = """
WITH r AS (
  SELECT event_id AS run_key,
    CASE WHEN event_type = 'error' THEN 'relatorio_erros_fluxo_produtor' ELSE 'relatorio_divergencias' END AS report,
    strftime(ts - INTERVAL 4 HOUR, '%d%m%Y') AS day, ts
  FROM events
),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY report, day ORDER BY ts, run_key) AS INTEGER) AS run_no FROM r)
SELECT run_key, report, day, run_no,
  report || '_' || day || CASE WHEN run_no > 1 THEN '_' || CAST(run_no AS VARCHAR) ELSE '' END || '.xlsx' AS file_name
FROM n"""

SQL["report_claims"] = _PUB + f"""
, sheets AS (
  SELECT 'resumo' AS sheet, (SELECT CAST(count(DISTINCT batch_id) * {len(K.SUMMARY_METRICS)} AS BIGINT) FROM handoff) AS n
  UNION ALL SELECT 'divergencias', (SELECT CAST(count(*) AS BIGINT) FROM pcons)
  UNION ALL SELECT 'falhas_tecnicas', CAST(0 AS BIGINT)
)
SELECT file_name, sheet, n FROM sheets, (VALUES ('relatorio_divergencias_14062026.xlsx'), ('relatorio_divergencias_14062026_2.xlsx'),
  ('relatorio_divergencias_15062026.xlsx')) AS f (file_name)"""

_LVIOL = viol_cte("lviol", "ev", "item_id, lote_id, lot_key")
SQL["normalise_report_rows"] = with_(LOTS, ev_cte("ev", "lots"), _LVIOL) + f"""
SELECT coalesce(lote_id, '') AS lote_id,
  CASE WHEN lot_key % 6 IN (0, 1) OR lot_key % 12 = 4 THEN regra_violada
       WHEN (lot_key % 6 = 2 OR lot_key % 12 = 10) AND regra_violada <> 'RN01' THEN regra_violada
       WHEN lot_key % 6 = 3 AND regra_violada = 'RN02' THEN 'RN02'
       ELSE {q(K.UNCLASSIFIED_RULE)} END AS regra_violada,
  CASE WHEN lot_key % 6 IN (0, 1) OR lot_key % 12 = 4 THEN descricao_do_erro
       WHEN (lot_key % 6 = 2 OR lot_key % 12 = 10) AND regra_violada <> 'RN01' THEN descricao_do_erro
       WHEN lot_key % 6 = 3 AND regra_violada = 'RN02' THEN rtrim(descricao_do_erro, '.')
       ELSE {q(K.NO_DESCRIPTION)} END AS descricao_do_erro,
  CASE WHEN lot_key % 6 = 0 OR lot_key % 12 = 4 THEN acao_recomendada ELSE {q(K.DEFAULT_ACTION)} END AS acao_recomendada,
  CASE WHEN lot_key % 6 = 0 OR lot_key % 12 = 4 THEN severidade ELSE {q(K.SEV_MEDIUM)} END AS severidade
FROM lviol"""

SQL["audit_events"] = CONSUMER + """
SELECT item_id, 'produtor' AS stage, batch_id, lote_id, source_row, 'INFO' AS level, 'CADASTRO_WEB_INICIADO' AS event FROM outcomes_p
UNION ALL
SELECT item_id, 'produtor', batch_id, lote_id, source_row,
  CASE cadastro_status WHEN 'SUCESSO' THEN 'INFO' WHEN 'REJEITADO_NEGOCIO' THEN 'WARNING' ELSE 'ERROR' END AS level,
  CASE WHEN cadastro_status = 'SUCESSO' THEN 'CADASTRO_WEB_CONCLUIDO evidencia=' || evidence_path
       WHEN cadastro_status = 'REJEITADO_NEGOCIO' THEN 'CADASTRO_WEB_REJEITADO evidencia=' || evidence_path || ' motivo=' || cadastro_error
       WHEN starts_with(cadastro_error, 'TIMEOUT: ') THEN 'TIMEOUT_AO_CARREGAR_COMPROVANTE evidencia=' || evidence_path || ' erro=' || substr(cadastro_error, 10)
       ELSE 'CADASTRO_WEB_FALHOU erro=' || cadastro_error || ' evidencia=' || evidence_path END AS event
FROM outcomes_p
UNION ALL
SELECT s.item_id, 'validador', s.batch_id, h.lote_id, h.source_row,
  CASE WHEN s.error_type = 'SYSTEM' THEN 'ERROR' WHEN s.datapool_state = 'DONE' THEN 'INFO' ELSE 'WARNING' END,
  CASE WHEN s.error_type = 'SYSTEM' THEN 'ITEM_CADASTRO_FALHA_TECNICA'
       WHEN h.cadastro_status = 'REJEITADO_NEGOCIO' THEN 'ITEM_CADASTRO_REJEITADO'
       WHEN s.datapool_state = 'DONE' THEN 'ITEM_VALIDADO_OK'
       ELSE 'ITEM_VALIDADO_NOK regras=' || c.regra_violada END
FROM cstate s JOIN handoff_all h USING (item_id) LEFT JOIN ccons c ON c.item_id = s.item_id"""

_PSUM = """
psum AS (
  SELECT batch_id, count(*) AS total, count_if(cadastro_status = 'SUCESSO') AS pub,
    count_if(cadastro_status <> 'SUCESSO') AS errs
  FROM outcomes GROUP BY batch_id
)"""
SQL["run_status"] = CONSUMER.rstrip("\n") + "," + _PSUM + """
SELECT p.batch_id,
  CASE WHEN p.pub = 0 THEN 'FAILED' WHEN p.errs > 0 THEN 'PARTIALLY_COMPLETED' ELSE 'SUCCESS' END AS producer_status,
  CASE WHEN c.total_falhas_tecnicas > 0 THEN 'PARTIALLY_COMPLETED' ELSE 'SUCCESS' END AS consumer_status
FROM psum p FULL OUTER JOIN csum c USING (batch_id)"""
SQL["run_totals"] = CONSUMER.rstrip("\n") + "," + _PSUM + """
SELECT batch_id, 'produtor' AS stage, CAST(total AS BIGINT) AS total_items, CAST(errs AS BIGINT) AS failed_items,
  CAST(total - errs AS BIGINT) AS processed_items FROM psum
UNION ALL
SELECT batch_id, 'validador', CAST(count(*) AS BIGINT), CAST(count(*) - count_if(datapool_state = 'DONE') AS BIGINT),
  CAST(count_if(datapool_state = 'DONE') AS BIGINT) FROM cstate GROUP BY batch_id"""
SQL["run_records"] = with_(LOTS, ev_cte("ev", "lots"), viol_cte("viol", "ev"), _HDR) + """
, r0 AS (
  SELECT l.batch_id, any_value(l.source_file) AS f, any_value(l.reference_date) AS rd, CAST(substr(any_value(l.reference_date), 1, 2) AS INTEGER) AS dd,
    count(*) AS n, count(v.item_id) AS dv
  FROM lots l LEFT JOIN (SELECT DISTINCT item_id FROM viol) v USING (item_id) GROUP BY l.batch_id
), r1 AS (
  SELECT r0.*, s.message, CASE WHEN dd IN (15, 16, 17) THEN 'ERRO_ARQUIVO' WHEN NOT s.ok THEN 'ERRO_ESTRUTURA' WHEN dd = 25 THEN 'ERRO_PROCESSAMENTO' ELSE 'SUCESSO' END AS st
  FROM r0 JOIN structure s USING (batch_id)
)
SELECT batch_id, strftime(strptime(rd, '%d/%m/%Y'), '%Y-%m-%dT08:00:00') AS timestamp_inicio, strftime(strptime(rd, '%d/%m/%Y'), '%Y-%m-%dT08:01:30') AS timestamp_fim,
  f AS arquivo_processado, CASE WHEN dd = 15 THEN NULL ELSE md5(batch_id) END AS hash_md5,
  CAST(CASE WHEN st IN ('SUCESSO', 'ERRO_PROCESSAMENTO') THEN n ELSE 0 END AS BIGINT) AS total_registros,
  CAST(CASE WHEN st = 'SUCESSO' THEN dv ELSE 0 END AS BIGINT) AS total_divergencias, st AS status_execucao,
  CASE WHEN dd = 15 THEN 'Arquivo não encontrado: ' || f WHEN dd = 16 THEN 'File is not a zip file' WHEN dd = 17 THEN 'Planilha sem cabeçalho: ' || f
       WHEN st = 'ERRO_ESTRUTURA' THEN message WHEN st = 'ERRO_PROCESSAMENTO' THEN 'time data ''99/99/9999'' does not match format ''%d/%m/%Y''' END AS erro
FROM r1"""
SQL["all_exceptions"] = _PUB + """
SELECT item_id, 'produtor' AS origin FROM outcomes WHERE cadastro_status <> 'SUCESSO'
UNION ALL SELECT item_id, 'validador' FROM pcons"""

# Measures of a batch as they are (vm), and what the faults of a day make of them (vf).
_VERIFY = _PUB + f""",
vo AS (
  SELECT batch_id, any_value({_DAY}) AS dd, count(*) AS n_rows, count_if(cadastro_status = 'SUCESSO') AS published,
    count_if(cadastro_status = 'REJEITADO_NEGOCIO') AS rejected, count_if(cadastro_status <> 'SUCESSO') AS flow
  FROM outcomes GROUP BY batch_id
),
vp AS (
  SELECT s.batch_id, count(*) AS n, count_if(h.source_row % 2 = 0) AS n_even,
    count_if(datapool_state = 'DONE') AS done, count_if(datapool_state = 'DONE' AND h.source_row % 2 = 0) AS done_even,
    count_if(datapool_state = 'ERROR') AS err, count_if(datapool_state = 'ERROR' AND h.source_row % 2 = 0) AS err_even,
    count_if(c.item_id IS NOT NULL AND contains(c.regra_violada, 'RN06')) AS review,
    count_if(c.item_id IS NOT NULL AND contains(c.regra_violada, 'RN06') AND h.source_row % 2 = 0) AS review_even
  FROM pstate s JOIN handoff h USING (item_id) LEFT JOIN pcons c USING (item_id) GROUP BY s.batch_id
),
vm AS (
  SELECT o.*, coalesce(p.n, 0) AS n, coalesce(n_even, 0) AS n_even, coalesce(done, 0) AS done, coalesce(done_even, 0) AS done_even,
    coalesce(err, 0) AS err, coalesce(err_even, 0) AS err_even, coalesce(review, 0) AS review, coalesce(review_even, 0) AS review_even
  FROM vo o LEFT JOIN vp p USING (batch_id)
)"""


def _verify_rows(fault: bool) -> str:
    """A row per batch and check; a fault changes one side on its day."""

    def side(value: str, **days: str) -> str:
        arms = " ".join(f"WHEN dd = {d[1:]} THEN {v}" for d, v in days.items()) if fault else ""
        return f"CASE {arms} ELSE {value} END" if arms else value

    at, has = "CASE WHEN n > 0 THEN {} ELSE 0 END", "n > 0"
    states = side("n", d1="n - n_even")
    done = side("done", d1="done - done_even", d2="done - done_even", d3="done - done_even")
    error = side("err", d1="err - err_even", d2="err - err_even", d3="err - err_even")
    shown = side("err", d14="err - err_even")
    checks = [
        ("publicados_processados", "published", states),
        ("sem_processing", "0", side("0", d2="n_even")),
        ("done_mais_error", states, f"({done}) + ({error})"),
        ("divergentes_business", shown, side("err", d1="err - err_even", d4="err - err_even + n_even")),
        ("pendente_removido", "0", side("0", d6=at.format(1))),
        ("resumo_produtor", "published", side("published", d7="published + 1")),
        ("erros_fluxo", side("flow", d8="flow + 2"), "flow"),
        ("resumo_validador", states, side("n", d10=at.format("n + 3"))),
        ("evidencias_nomeadas", states, side("n", d1="n - n_even", d5="n - n_even")),
        ("evidencias_arquivos", "n_rows", side("n_rows", d11="n_rows - published", d12="n_rows - rejected")),
        ("evidencias_comprovante", "published", side("published", d11="0")),
        ("evidencias_rejeicao", "rejected", side("rejected", d12="0")),
        ("relatorio_resumo", str(len(K.SUMMARY_METRICS)), side(at.format(len(K.SUMMARY_METRICS)), d13=at.format(len(K.SUMMARY_METRICS) - 1))),
        ("relatorio_divergencias", "err", shown),
        ("relatorio_lotes_validados", "done", side("done", d16="done - done_even")),
        ("relatorio_rejeicoes_cadastro", side("0", d17=at.format(1)), "0"),
        ("relatorio_falhas_tecnicas", side("0", d18=at.format(1)), "0"),
        ("relatorio_revisao_humana", "review", side("review", d19="review - review_even")),
        ("log_contexto", "0", side("0", d20="n")),
        ("log_produtor", "1", side("1", d23="0")),
        ("log_validador", "1", side(at.format(1), d24="0")),
    ]
    return "\nUNION ALL ".join(f"""SELECT batch_id, '{c}' AS "check", CAST({e} AS BIGINT) AS expected, CAST({a} AS BIGINT) AS actual FROM vm""" for c, e, a in checks)


SQL["verify_run"] = _VERIFY + f"SELECT *, expected = actual AS ok FROM ({_verify_rows(False)})"
SQL["verify_faults"] = _VERIFY + f"SELECT * FROM ({_verify_rows(True)}) WHERE expected <> actual"
SQL["guarded_rule"] = BASE + """
SELECT item_id,
  CASE WHEN try_strptime(data, '%d/%m/%Y') IS NULL THEN 'ERRO_PROCESSAMENTO' ELSE 'RN01_FUTURA' END AS regra_violada
FROM lots
WHERE try_strptime(data, '%d/%m/%Y') IS NULL
   OR CAST(try_strptime(data, '%d/%m/%Y') AS DATE) > CAST(strptime(reference_date, '%d/%m/%Y') AS DATE)"""
SQL["evidence_coverage"] = with_(LOTS, OUTCOMES) + """
SELECT item_id, evidence_name, (lot_key % 61 <> 12) AS listed FROM outcomes_p"""
SQL["read_pending"] = FULL + "SELECT batch_id, item_id FROM handoff"
SQL["read_pending_newest"] = FULL + "SELECT batch_id, item_id FROM handoff WHERE batch_id = (SELECT max(batch_id) FROM handoff)"

SQL["pending_envelope"] = FULL + """
SELECT batch_id, CAST(count(*) AS BIGINT) AS total, CAST(count(*) AS BIGINT) AS received, TRUE AS ok,
  (SELECT CAST(count(*) AS BIGINT) FROM ref) AS n_reference, (SELECT min(lote_id) FROM ref) AS first_reference, (SELECT max(lote_id) FROM ref) AS last_reference
FROM handoff GROUP BY batch_id"""
SQL["processed_batches"] = _PUB + f"""
SELECT h.batch_id, CAST(count(*) AS BIGINT) AS total, any_value({_DAY}) % 2 = 0 OR any_value({_DAY}) = 7 AS open,
  CAST(CASE WHEN any_value({_DAY}) % 2 = 1 THEN count(*) ELSE 0 END AS BIGINT) AS n_processed,
  CAST(CASE WHEN any_value({_DAY}) % 2 = 1 THEN count_if(datapool_state = 'ERROR') ELSE 0 END AS BIGINT) AS n_error
FROM handoff h JOIN pstate USING (item_id) GROUP BY h.batch_id"""

SQL["normalise_status"] = BASE + f"""
SELECT item_id, status AS status_original, s_norm AS status,
  CASE s_canon WHEN 'OK' THEN {q(K.RN05_OK_DESC)} WHEN 'NOK' THEN {q(K.RN05_NOK_DESC)} END AS divergencia_rn05 FROM ev"""
SQL["review_routing"] = BASE + f"""
SELECT item_id, lote_id, s_norm AS status, {rule_desc('RN06')} AS divergencia_rn04, TRUE AS status_ambiguo, 'revisao_humana' AS fila_destino
FROM ev WHERE {rule_pred('RN06')}"""
SQL["serialise_typed"] = BASE + """
SELECT item_id, coalesce(strftime(try_strptime(data, '%d/%m/%Y'), '%d/%m/%Y'), '') AS data, reference_date AS observacao FROM lots"""
_REFSHEET = f"""
rs0 AS (
  SELECT batch_id, row_idx, lote_id, {_DAY} AS dd, unnest(CASE WHEN row_idx % 3 = 0 THEN [0, 1] ELSE [0] END) AS twice FROM lots
),
rs AS (
  SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY row_idx, twice) AS line, count(*) OVER (PARTITION BY batch_id) AS lines FROM rs0
)"""
SQL["reference_sheet_ids"] = with_(LOTS, _REFSHEET) + """
SELECT DISTINCT batch_id, trim(lote_id) AS lote_id FROM rs
WHERE dd <> 14 AND coalesce(trim(lote_id), '') <> '' AND line <= lines - CASE WHEN dd = 12 THEN 1 ELSE 0 END"""
SQL["reference_layout"] = BASE + f"""
SELECT DISTINCT batch_id, {_DAY} <> 14 AS ok, CASE WHEN {_DAY} <> 14 THEN '' ELSE {q(K.REFERENCE_MISSING_COLUMN)} END AS message FROM lots"""
# --- streaming twins -------------------------------------------------------------
SQL["stream_validate"] = _PUB + "SELECT item_id, regra_violada, descricao_do_erro FROM pcons"
SQL["stream_dedupe"] = FULL + "SELECT item_id, batch_id FROM handoff"
SQL["stream_completeness"] = FULL + """,
landed AS (
  SELECT batch_id, item_id,
    CASE WHEN substr(reference_date, 1, 2) = '13' THEN batch_total + 1 ELSE batch_total END AS batch_total
  FROM handoff
),
per AS (
  SELECT batch_id, CAST(count(DISTINCT item_id) AS BIGINT) AS received, CAST(max(batch_total) AS INTEGER) AS expected
  FROM landed GROUP BY batch_id
)
SELECT batch_id, received, expected,
  CASE WHEN received = expected THEN 'released' WHEN received < expected THEN 'incomplete' ELSE 'overfull' END AS state
FROM per"""


_PUBLISHED = FULL + """,
pb0 AS (
  SELECT item_id, batch_id, source_row, CAST(substr(reference_date, 1, 2) AS INTEGER) AS dd, batch_total FROM handoff
),
pb AS (
  SELECT item_id, batch_id, dd % 4 * 24 + CASE WHEN dd = 13 AND source_row % 2 = 0 THEN 72 WHEN dd = 14 AND source_row % 2 = 0 THEN 12 ELSE 0 END AS h,
    batch_total + CASE WHEN dd IN (6, 13) THEN 1 ELSE 0 END AS total
  FROM pb0
),
pf AS (SELECT *, min(h) OVER (PARTITION BY batch_id) AS first_h FROM pb),
clk AS (SELECT max(h) AS h FROM (SELECT h FROM pb UNION ALL SELECT p.h + 48 FROM pb p JOIN pb0 b USING (item_id) WHERE b.source_row % 5 = 0))
"""
SQL["stream_ingest"] = _PUBLISHED + """
SELECT item_id, batch_id, strftime(TIMESTAMP '2024-01-10 00:00:00' + to_hours(CAST(h AS INTEGER)), '%Y-%m-%d %H:%M') AS published FROM pb"""
SQL["stream_batches"] = _PUBLISHED + """
SELECT batch_id, CAST(count_if(h <= first_h + 24) AS BIGINT) AS received, CAST(max(total) AS INTEGER) AS expected,
  CASE WHEN count_if(h <= first_h + 24) = max(total) THEN 'released' WHEN count_if(h <= first_h + 24) > max(total) THEN 'overfull'
       WHEN min(first_h) + 24 < (SELECT h FROM clk) THEN 'incomplete' ELSE 'pending' END AS state,
  CAST(count_if(h > first_h + 24) AS BIGINT) AS late
FROM pf GROUP BY batch_id"""
