"""Admission (producer side): form rules, catalogue, outcome, evidence names,
read-back reconciliation, routing and the hand-off projection (A1-A7, K1, K2,
K5, G3, G4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import or_default, safe_name, serialised, strip
from lotguard.operators.rules import flag_known
from lotguard.session import known_small, written

# FIXED VALUE of our own (the original surfaces a browser time-out text here).
CATALOGUE_TIMEOUT = "Produto '{produto}' indisponível para seleção."

LINEAGE = ("item_id", "batch_id", "source_file", "source_hash", "source_row", "reference_date")


def serialise(lots: DataFrame) -> DataFrame:
    """Hand-off text form of the 8 contract columns (null -> '', stripped;
    date and timestamp cells as dd/mm/yyyy)."""
    keep = [c for c in lots.columns if c not in K.CONTRACT_COLUMNS]
    kinds = dict(lots.dtypes)
    dated = {c: F.date_format(c, "dd/MM/yyyy") for c in K.CONTRACT_COLUMNS if kinds.get(c) in ("date", "timestamp", "timestamp_ntz")}
    return lots.select(*keep, *[serialised(dated.get(c, c)).alias(c) for c in K.CONTRACT_COLUMNS])


def form_message(lote_id: str = "lote_id", produto: str = "produto"):
    """A1: ' | '-joined form errors; '' when the form accepts the row."""
    return F.concat_ws(
        K.FORM_JOIN,
        F.when(F.coalesce(strip(lote_id), F.lit("")) == "", F.lit(K.FORM_MISSING_LOT)),
        F.when(F.coalesce(F.col(produto), F.lit("")) == "", F.lit(K.FORM_MISSING_PRODUCT)),
    )


def off_catalogue(produto: str = "produto"):
    """A2: a non-empty product that is not a select option (exact match)."""
    p = F.coalesce(F.col(produto), F.lit(""))
    return (p != "") & ~p.isin(list(K.CATALOGUE))


def latest_stored(stored: DataFrame, key: str = "lote_id", ts: str = "criadoEm") -> DataFrame:
    """Newest stored record per stripped lot key (a per-key top-1, as a max
    over a struct so it is a partial aggregate, not a window over a hot key).
    Records of one time are decided by ``position`` (the first of the list
    counts; of several documents' firsts that of the greatest ``doc_id``) if
    there is that column, else by their values."""
    stored = stored.withColumn(key, strip(key))
    others = [c for c in stored.columns if c not in (key, ts, "position", "doc_id")]
    place = [-F.col("position"), *([F.col("doc_id")] if "doc_id" in stored.columns else [])]
    tie = place if "position" in stored.columns else [F.col(c) for c in others]
    best = F.max_by(F.struct(ts, *others), F.struct(F.col(ts), *tie))
    return stored.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def reconcile(sent: DataFrame, stored: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A5 per field: lote_id, side, campo, esperado, salvo (+ ``keys`` of the
    sent row, e.g. item_id).

    side = 'missing' (sent, never stored), 'extra' (stored only) or 'diff'.
    Built as sent LEFT JOIN latest-stored plus stored LEFT ANTI distinct sent
    IDs, instead of a full outer join, which cannot be split. The latest stored
    records are written before: both sides of the left join are then plain
    shuffles, so that AQE can split a hot lot ID."""
    fields = [c for c in K.CONTRACT_COLUMNS if c != "lote_id"]
    s = sent.select(*keys, strip("lote_id").alias("lote_id"), *[serialised(c).alias(f"e_{c}") for c in fields]) \
            .where(F.col("lote_id") != "")
    known = [c for c in ("position", "doc_id") if c in stored.columns]
    latest = written(latest_stored(stored.select("lote_id", "criadoEm", *fields, *known)).select(
        "lote_id", *[serialised(c).alias(f"s_{c}") for c in fields], F.lit(True).alias("_stored")), "latest-stored")
    j = s.join(latest, "lote_id", "left")
    pairs = F.array(*[
        F.struct(F.lit(c).alias("campo"), F.col(f"e_{c}").alias("esperado"), F.col(f"s_{c}").alias("salvo"))
        for c in fields
    ])
    diffs = F.filter(pairs, lambda x: ~x["esperado"].eqNullSafe(x["salvo"]))
    none = F.lit(None).cast("string")
    whole = F.array(F.struct(F.lit("*").alias("campo"), none.alias("esperado"), none.alias("salvo")))
    missing = F.col("_stored").isNull()
    sent_side = j.select(
        *keys, "lote_id", F.when(missing, F.lit("missing")).otherwise(F.lit("diff")).alias("side"),
        F.when(missing, whole).otherwise(diffs).alias("_d"),
    ).select(*keys, "lote_id", "side", F.inline_outer("_d")).where(F.col("campo").isNotNull())
    extra = latest.join(s.select("lote_id").distinct(), "lote_id", "left_anti").select(
        *[none.alias(k) for k in keys], "lote_id", F.lit("extra").alias("side"),
        F.lit("*").alias("campo"), none.alias("esperado"), none.alias("salvo"),
    )
    return sent_side.unionByName(extra)


def readback_message(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """Per sent item: the failure text the registration step raises, or no
    row. Grouped by item (at most 7 fields each), never by a lot ID."""
    r = reconcile(sent, stored, keys=("item_id",)).where(F.col("side") != "extra")
    detail = F.format_string("%s={'esperado': '%s', 'salvo': '%s'}", "campo", "esperado", "salvo")
    order = F.array_position(F.array(*[F.lit(c) for c in K.CONTRACT_COLUMNS]), F.col("campo"))
    return r.groupBy("item_id").agg(
        F.max(F.col("side") == "missing").alias("_missing"),
        F.array_sort(F.collect_list(F.struct(order.alias("o"), detail.alias("d")))).getField("d").alias("_detail"),
    ).select(
        "item_id",
        F.when(F.col("_missing"), F.lit(K.READBACK_MISSING))
         .otherwise(F.concat(F.lit(K.READBACK_PREFIX), F.array_join("_detail", ", "))).alias("readback_error"),
    )


def admit(lots: DataFrame, stored: DataFrame | None = None,
          evidence_root: str = "/evidence") -> DataFrame:
    """A1-A4 (+A5 when a stored table is given): serialised rows with
    cadastro_status, cadastro_error, cadastro_error_type, evidence_name,
    evidence_path. Precedence: catalogue failure, form rejection, read-back
    failure, success."""
    rows = serialise(lots)
    cat_fail = off_catalogue()
    form = form_message()
    if stored is not None:
        rb = readback_message(rows, stored)
        rows = rows.join(rb, "item_id", "left")
        rb_err = F.col("readback_error")
    else:
        rb_err = F.lit(None).cast("string")
    status = F.when(cat_fail, F.lit(K.OUTCOME_TECHNICAL)) \
              .when(form != "", F.lit(K.OUTCOME_REJECTED)) \
              .when(rb_err.isNotNull(), F.lit(K.OUTCOME_TECHNICAL)) \
              .otherwise(F.lit(K.OUTCOME_SUCCESS))
    error = F.when(cat_fail, F.concat(F.lit(K.TIMEOUT_PREFIX),
                                      F.format_string(CATALOGUE_TIMEOUT.replace("{produto}", "%s"), F.col("produto")))) \
             .when(form != "", form) \
             .when(rb_err.isNotNull(), rb_err) \
             .otherwise(F.lit(""))
    etype = F.when(cat_fail, F.lit(K.ERROR_SYSTEM)).when(form != "", F.lit(K.ERROR_BUSINESS)) \
             .when(rb_err.isNotNull(), F.lit(K.ERROR_SYSTEM)).otherwise(F.lit(""))
    prefix = F.when(cat_fail, F.lit(K.EVIDENCE_TIMEOUT)).when(form != "", F.lit(K.EVIDENCE_REJECTED)) \
              .when(rb_err.isNotNull(), F.lit(K.EVIDENCE_ERROR)).otherwise(F.lit(K.EVIDENCE_OK))
    row_label = F.concat(F.lit("linha-"), F.col("source_row").cast("string"))
    name = F.concat(prefix, row_label, F.lit("_"), safe_name(or_default("lote_id", row_label)), F.lit(".png"))
    out = rows.withColumns({
        "cadastro_status": status,
        "cadastro_error": error,
        "cadastro_error_type": etype,
    }).withColumn("evidence_name", name) \
      .withColumn("evidence_path", F.concat_ws("/", F.lit(evidence_root.rstrip("/")), F.col("batch_id"),
                                              F.lit("produtor"), F.col("evidence_name")))
    return out.drop("readback_error") if stored is not None else out


def admitted(outcomes: DataFrame) -> DataFrame:
    """Rows that go to the hand-off."""
    return outcomes.where(F.col("cadastro_status") == K.OUTCOME_SUCCESS)


def flow_errors(outcomes: DataFrame, by_batch: bool = False) -> DataFrame:
    """Rows not published, in the fixed 15-column layout (behind
    batch_id, ``by_batch``)."""
    rows = outcomes.where(F.col("cadastro_status") != K.OUTCOME_SUCCESS)
    return rows.select(*(["batch_id"] if by_batch else []), *[
        (F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c)
        for c in K.FLOW_ERROR_COLUMNS
    ])


def flow_errors_summary(outcomes: DataFrame) -> DataFrame:
    """(metrica, valor) over all flow errors."""
    errs = outcomes.where(F.col("cadastro_status") != K.OUTCOME_SUCCESS)
    agg = errs.agg(
        F.count(F.lit(1)).alias(K.FLOW_SUMMARY_METRICS[0]),
        F.count_if(F.col("cadastro_status") == K.OUTCOME_REJECTED).alias(K.FLOW_SUMMARY_METRICS[1]),
        F.count_if(F.col("cadastro_status") == K.OUTCOME_TECHNICAL).alias(K.FLOW_SUMMARY_METRICS[2]),
    )
    return agg.unpivot([], list(K.FLOW_SUMMARY_METRICS), "metrica", "valor")


def producer_summary(outcomes: DataFrame) -> DataFrame:
    """G3 per batch; the partial aggregate makes a hot batch cheap."""
    s = F.col("cadastro_status")
    return outcomes.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == K.OUTCOME_SUCCESS).alias("itens_publicados_datapool"),
        F.count_if(s != K.OUTCOME_SUCCESS).alias("erros_fluxo"),
        F.count_if(s == K.OUTCOME_SUCCESS).alias("cadastros_sucesso"),
        F.count_if(s == K.OUTCOME_REJECTED).alias("cadastros_rejeitados"),
        F.count_if(s == K.OUTCOME_TECHNICAL).alias("cadastros_falha_tecnica"),
        F.count_if(s != K.OUTCOME_SUCCESS).alias("cadastros_falha"),
    )


def batch_totals(rows: DataFrame) -> DataFrame:
    """Rows per batch as (batch_id, batch_total). A grouped count (partial
    aggregate) joined back, rather than a window that would pull a hot batch
    into one task."""
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).cast("int").alias("batch_total"))


def handoff(outcomes: DataFrame, reference: DataFrame, execution_id: str = "exec-1",
            published_only: bool = True) -> DataFrame:
    """K2: the flat 22-field hand-off record.

    ``reference_lotes_json`` carries the reference snapshot restricted to the
    record's own lot (``["<id>"]`` when known, ``[]`` otherwise): the union
    over a batch is exactly the part of the reference list RN03 can consult,
    and no record carries a batch-sized list. The whole sorted list is
    published once (``store.reference_snapshot``).
    """
    rows = admitted(outcomes) if published_only else outcomes
    # Counts do not need the reference join. Written, they are a plain side of
    # their join, so that AQE can split a batch that holds many of the rows.
    totals = known_small(written(batch_totals(rows), "batch-totals"))
    rows = flag_known(rows, reference, out="_ref_hit").join(totals, "batch_id")
    ref_json = F.to_json(F.when(F.col("_ref_hit"), F.array(strip("lote_id")))
                          .otherwise(F.array().cast("array<string>")))
    values = {
        "batch_total": F.col("batch_total"),
        "producer_execution_id": F.lit(execution_id),
        "reference_lotes_json": ref_json,
    }
    return rows.select(*[
        values[c].alias(c) if c in values else F.col(c) for c in K.HANDOFF_FIELDS
    ])


def handoff_envelope(handoff_rows: DataFrame) -> DataFrame:
    """K1 summary of the nested publish shape per batch: total items, number of
    reference IDs, first and last item by source row. Aggregates only; the
    items themselves are published as rows (``store.BatchTable``)."""
    ids = F.from_json("reference_lotes_json", "array<string>")
    refs = handoff_rows.select("batch_id", F.explode(ids).alias("rid")) \
        .groupBy("batch_id").agg(F.count_distinct("rid").alias("n_reference"))
    main = handoff_rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.min_by("item_id", "source_row").alias("first_item"),
        F.max_by("item_id", "source_row").alias("last_item"),
    )
    return main.join(refs, "batch_id", "left").select(
        "batch_id", "total", F.coalesce("n_reference", F.lit(0)).alias("n_reference"), "first_item", "last_item"
    )


def evidence_coverage(outcomes: DataFrame, listing: DataFrame) -> DataFrame:
    """A4: each item's expected evidence file and whether the listing has it."""
    files = listing.select(F.col("path").alias("evidence_path")).distinct().withColumn("listed", F.lit(True))
    return outcomes.select("item_id", "evidence_name", "evidence_path") \
        .join(files, "evidence_path", "left") \
        .select("item_id", "evidence_name", F.coalesce("listed", F.lit(False)).alias("listed"))
