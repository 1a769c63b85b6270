"""Fixed values that must equal the original process byte for byte.

FIXED VALUES: column contract, status domain, product catalogue, default
reference date, rule identifiers, rule texts, state messages, metric names.
They are stated here plainly, in their natural order, and used everywhere else
by name.
"""

# --- fixed values: sheet contract -------------------------------------------
CONTRACT_COLUMNS = (
    "lote_id",
    "produto",
    "linha",
    "turno",
    "status",
    "responsavel",
    "data",
    "observacao",
)
REQUIRED_COLUMNS = (
    "lote_id",
    "produto",
    "linha",
    "turno",
    "status",
    "responsavel",
    "data",
)
DEFAULT_REFERENCE_DATE = "14/06/2026"
HEADER_ROW = 3  # rows 1-2 are presentation, row 3 is the header
REFERENCE_SHEET = "Base_Referencia"
REFERENCE_HEADER_ROW = 2  # row 1 is a title, row 2 the header
REFERENCE_MISSING_COLUMN = (
    "[RN03] Coluna 'lote_id' não encontrada na aba 'Base_Referencia'. Verifique o layout do arquivo."
)

# --- fixed values: status ---------------------------------------------------
STATUS_DOMAIN = ("APROVADO", "REPROVADO", "PENDENTE")
STATUS_MAP = {"OK": "APROVADO", "NOK": "REPROVADO"}

# --- fixed values: product catalogue (form select options) -------------------
CATALOGUE = (
    "AC12-SPLIT",
    "AC18-SPLIT",
    "AC9-WINDOW",
    "MON24-FHD",
    "MON27-QHD",
    "MON32-4K",
    "TV43-FHD",
    "TV50-4K-B",
    "TV55-4K-B",
    "TV65-OLED",
)

# --- fixed values: rule texts -----------------------------------------------
RN02_DESC_PREFIX = "Campos obrigatórios vazios: "
RN02_ACTION = "Preencher os campos obrigatórios."
RN01_ACTION = "Corrigir a data para a referência do processo."
RN03_ACTION = "Confirmar o cadastro do lote na Base_Referencia."
RN05_OK_DESC = "[RN05] Status 'OK' normalizado para 'APROVADO'."
RN05_NOK_DESC = "[RN05] Status 'NOK' normalizado para 'REPROVADO'."
RN05_ACTION = "Registrar a normalização e seguir o fluxo automático."
RN06_ACTION = "Encaminhar para revisão humana sem decidir o status."
RN07_DESC = "Status REPROVADO exige preenchimento da observação."
RN07_ACTION = "Encaminhar ao analista para preenchimento"
GUARD_RULE = "ERRO_PROCESSAMENTO"
GUARD_DESC = "Falha controlada durante a validação do registro."
GUARD_ACTION = "Encaminhar o lote para revisão técnica."
SEV_HIGH = "Alta"
SEV_MEDIUM = "Média"
SEV_LOW = "Baixa"
STRUCTURE_PREFIX = "[RN01] Estrutura inválida. "
MISSING_LABEL = "Colunas ausentes: "
EXTRA_LABEL = "Colunas extras: "

# --- fixed values: admission form -------------------------------------------
FORM_MISSING_LOT = "Informe o número do lote."
FORM_MISSING_PRODUCT = "Selecione um produto."
FORM_JOIN = " | "
OUTCOME_SUCCESS = "SUCESSO"
OUTCOME_REJECTED = "REJEITADO_NEGOCIO"
OUTCOME_TECHNICAL = "FALHA_TECNICA"
OUTCOME_TECHNICAL_LEGACY = "FALHA"
ERROR_BUSINESS = "BUSINESS"
ERROR_SYSTEM = "SYSTEM"
TIMEOUT_PREFIX = "TIMEOUT: "
EVIDENCE_OK = "comprovante_"
EVIDENCE_REJECTED = "rejeicao_"
EVIDENCE_TIMEOUT = "erro_timeout_"
EVIDENCE_ERROR = "erro_"

# --- fixed values: item states ----------------------------------------------
STATE_PROCESSING = "PROCESSING"
STATE_DONE = "DONE"
STATE_ERROR = "ERROR"
MSG_TECHNICAL_DEFAULT = "Falha técnica durante o cadastro web."
MSG_REJECTED_DEFAULT = "Cadastro rejeitado pelo formulário."
MSG_DONE = "Registro validado sem divergências."
MESSAGE_LIMIT = 1000

# --- fixed values: queue integrity ------------------------------------------
MSG_INCOMPLETE = "Lote incompleto: esperados {expected}, recebidos {received}."
MSG_FOREIGN_ITEM = "Item do lote '{item}' recebido durante o lote '{target}'."
MSG_MIXED = "Foram consumidos lotes mistos: {batches}"
MSG_EMPTY = "DataPool '{label}' sem itens pendentes."

# --- fixed values: report normaliser ----------------------------------------
REPORT_COLUMNS = (
    "lote_id",
    "regra_violada",
    "descricao_do_erro",
    "acao_recomendada",
    "severidade",
)
UNCLASSIFIED_RULE = "NÃO CLASSIFICADA"
NO_DESCRIPTION = "Divergência sem descrição informada."
DEFAULT_ACTION = "Encaminhar ao analista"
DIVERGENCE_COLUMNS = (
    "divergencia_rn02",
    "divergencia_rn03",
    "divergencia_rn04",
    "divergencia_rn05",
    "divergencia_rn06",
    "divergencia_rn07",
)

# --- fixed values: report tables --------------------------------------------
FLOW_ERROR_COLUMNS = (
    "item_id",
    "source_row",
    "lote_id",
    "produto",
    "linha",
    "turno",
    "status",
    "responsavel",
    "data",
    "observacao",
    "cadastro_status",
    "cadastro_error",
    "cadastro_error_type",
    "evidence_name",
    "evidence_path",
)
REGISTRATION_COLUMNS = (
    "item_id",
    "source_row",
    "lote_id",
    "cadastro_status",
    "cadastro_error",
    "evidence_name",
    "evidence_path",
)
HANDOFF_FIELDS = (
    "item_id",
    "batch_id",
    "batch_total",
    "producer_execution_id",
    "source_file",
    "source_hash",
    "source_row",
    "reference_date",
    "lote_id",
    "produto",
    "linha",
    "turno",
    "status",
    "responsavel",
    "data",
    "observacao",
    "cadastro_status",
    "cadastro_error",
    "cadastro_error_type",
    "evidence_name",
    "evidence_path",
    "reference_lotes_json",
)
SUMMARY_METRICS = (
    "total_registros",
    "total_divergencias",
    "total_regras_violadas",
    "total_lotes_validados",
    "total_revisao_humana",
    "total_rejeicoes_cadastro",
    "total_falhas_tecnicas",
)
FLOW_SUMMARY_METRICS = ("total_erros_fluxo", "cadastros_rejeitados", "falhas_tecnicas")

# --- fixed values: run status -----------------------------------------------
RUN_SUCCESS = "SUCCESS"
RUN_PARTIAL = "PARTIALLY_COMPLETED"
RUN_FAILED = "FAILED"
TIMEZONE = "America/Manaus"

# FIXED VALUES: stored-record fields and read-back failure texts.
STORED_COLUMNS = ("id", "lote_id", "produto", "linha", "turno", "status", "responsavel", "data",
                  "observacao", "criadoEm")
READBACK_MISSING = "Cadastro não encontrado no armazenamento local."
READBACK_PREFIX = "Cadastro web divergente da planilha: "

# FIXED VALUES: backlog and reference-date failure texts.
NO_PENDING = "Nenhum lote pendente em {path}."
BAD_REFERENCE_DATE = "time data '{text}' does not match format '%d/%m/%Y'"

# FIXED VALUES: reports, run records and event codes.
REPORT_TABLES = (
    "resumo",
    "divergencias",
    "lotes_validados",
    "rejeicoes_cadastro",
    "falhas_tecnicas",
    "revisao_humana",
)
DIVERGENCE_REPORT = "relatorio_divergencias"
FLOW_REPORT = "relatorio_erros_fluxo_produtor"
NO_FLOW_ERRORS = "O relatório de erros de fluxo exige ao menos um item."
RECORD_SUCCESS = "SUCESSO"
RECORD_FILE_ERROR = "ERRO_ARQUIVO"
RECORD_STRUCTURE_ERROR = "ERRO_ESTRUTURA"
RECORD_PROCESSING_ERROR = "ERRO_PROCESSAMENTO"
MSG_FILE_MISSING = "Arquivo não encontrado: {file}"
# Text of our own (the original passes on its reader's).
MSG_FILE_EMPTY = "Planilha sem cabeçalho: {file}"
EVENT_STARTED = "CADASTRO_WEB_INICIADO"
EVENT_DONE = "CADASTRO_WEB_CONCLUIDO evidencia="
EVENT_REJECTED = "CADASTRO_WEB_REJEITADO evidencia="
EVENT_TIMEOUT = "TIMEOUT_AO_CARREGAR_COMPROVANTE evidencia="
EVENT_FAILED = "CADASTRO_WEB_FALHOU erro="
EVENT_ITEM_TECHNICAL = "ITEM_CADASTRO_FALHA_TECNICA"
EVENT_ITEM_REJECTED = "ITEM_CADASTRO_REJEITADO"
EVENT_ITEM_OK = "ITEM_VALIDADO_OK"
EVENT_ITEM_NOK = "ITEM_VALIDADO_NOK regras="
REVIEW_QUEUE = "revisao_humana"

# FIXED VALUES: patterns of a sheet's presentation rows and name.
TOTAL_PATTERN = r"(?i)Registros:\s*(\d+)"
DATE_PATTERN = r"(\d{2})_(\d{2})_(\d{4})"
