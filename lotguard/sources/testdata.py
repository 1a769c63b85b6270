"""Derived inspection tables over the driver's parquet files.

Every table is a deterministic function of the given tables, so its size grows
with them. Defects are injected by fixed residues of the order key; nothing is
filtered out to make a check cheaper.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import lot_code
from lotguard.operators.sequence import number_within
from lotguard.session import known_small, written
from lotguard.sources.tables import read_table

#: Order keys of a block of the lots' numbering: its rows are narrow, and with
#: wide blocks their counts by day and block stay few.
LOT_BLOCK = 1 << 18


def _first(*arms: tuple[Column, Column], default: Column) -> Column:
    expr = default
    for cond, value in reversed(arms):
        expr = F.when(cond, value).otherwise(expr)
    return expr


def lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One inspection sheet (batch) per order date, one lot per order."""
    orders = read_table(
        spark, sf_dir, "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"],
    )
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name"])
    # Narrow rows are joined (the customers hashed, so that no order is sorted
    # for it), written once and numbered; their texts come last. A day is a batch.
    joined = orders.join(customer.hint("shuffle_hash"), orders.o_custkey == customer.c_custkey, "left").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_name", F.to_date("o_orderdate").alias("o_orderdate"))
    numbered = number_within(written(joined, "orders"), ["o_orderdate"], "o_orderkey", out="row_idx", block_width=LOT_BLOCK)
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    ref_date = F.date_format("o_orderdate", "dd/MM/yyyy")
    catalogue = F.array(*[F.lit(p) for p in K.CATALOGUE])
    base = numbered.select(
        k.alias("lot_key"),
        "row_idx",
        F.sha2(day, 256).alias("source_hash"),
        F.concat(F.lit("inspecao_"), F.date_format("o_orderdate", "dd_MM_yyyy"), F.lit(".xlsx")).alias("source_file"),
        ref_date.alias("reference_date"),
        _first(
            (k % 97 == 13, F.lit(None).cast("string")),
            (k % 101 == 17, F.lit("  ")),
            default=lot_code(k),
        ).alias("lote_id"),
        _first(
            (k % 43 == 9, F.lit("XX-LEGACY")),
            (k % 47 == 10, F.lit("")),
            default=F.element_at(catalogue, (F.col("o_custkey") % 10 + 1).cast("int")),
        ).alias("produto"),
        _first(
            (k % 59 == 11, F.lit(None).cast("string")),
            default=F.concat(F.lit("L"), (F.col("o_custkey") % 3 + 1).cast("string")),
        ).alias("linha"),
        F.substring(F.lit("ABC"), (k % 3 + 1).cast("int"), 1).alias("turno"),
        _first(
            (k % 20 == 0, F.lit("OK")),
            (k % 20 == 1, F.lit(" nok ")),
            (k % 50 == 2, F.lit("REPROV.")),
            (k % 50 == 3, F.lit("APROVADO PARCIAL")),
            (k % 89 == 4, F.lit("")),
            (F.col("o_orderstatus") == "F", F.lit("APROVADO")),
            (F.col("o_orderstatus") == "O", F.lit("pendente")),
            (F.col("o_orderstatus") == "P", F.lit("REPROVADO")),
            default=F.lit(None).cast("string"),
        ).alias("status"),
        _first(
            (k % 30 == 7, F.lit("")),
            (k % 11 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit("  "))),
            default=F.col("c_name"),
        ).alias("responsavel"),
        _first(
            (k % 37 == 5, F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "dd/MM/yyyy")),
            (k % 41 == 6, F.lit("")),
            (k % 53 == 7, F.lit("n/d")),
            default=ref_date,
        ).alias("data"),
        _first(
            (k % 7 < 3, F.lit(None).cast("string")),
            (k % 7 == 3, F.lit("   ")),
            default=F.concat(F.lit("obs "), F.col("o_orderpriority")),
        ).alias("observacao"),
    ).withColumn("batch_id", F.concat(F.lit("batch-"), F.substring("source_hash", 1, 16)))
    source_row = (F.col("row_idx") + 4).cast("int")
    return base.select(
        "batch_id",
        "row_idx",
        source_row.alias("source_row"),
        F.concat("source_hash", F.lit(":"), source_row.cast("string")).alias("item_id"),
        "source_hash",
        "source_file",
        "reference_date",
        *K.CONTRACT_COLUMNS,
        "lot_key",
    )


def reference_lots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list of known lot IDs (shared by all batches).

    Distinct on the integer key first (cheap partial aggregate), then format.
    """
    keys = read_table(spark, sf_dir, "lineitem", ["l_orderkey"]).distinct()
    return keys.select(lot_code("l_orderkey").alias("lote_id"))


def _day_of_month(reference_date: str = "reference_date") -> Column:
    return F.substring(reference_date, 1, 2).cast("int")


def _batch_date(reference_date: str = "reference_date") -> Column:
    return F.to_date(reference_date, "dd/MM/yyyy")


def lot_key_of(lote_id: str = "lote_id") -> Column:
    """Integer key back from a lot code 'LG-00001234'."""
    return F.substring(lote_id, 4, 64).cast("long")


STORED_FIELDS = ("lote_id", "produto", "linha", "turno", "status", "responsavel", "data", "observacao")


def stored(handoff_rows: DataFrame) -> DataFrame:
    """The target system's stored copies of published rows.

    Dropped for k%29=3 (never stored), linha L9 for k%31=4 (stored wrong), a
    target-only copy '<id>-X' for k%71=5, an older copy with linha L8 for
    k%67=6; criadoEm = batch date + (k % 1440) minutes."""
    k = lot_key_of()
    base = handoff_rows.select(
        *STORED_FIELDS, "item_id",
        k.alias("_k"),
        _batch_date().cast("timestamp_ntz").alias("_day"),
    ).where(F.col("_k") % 29 != 3)
    created = F.col("_day") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("_k") % 1440).cast("int"))
    main = base.withColumn("linha", F.when(F.col("_k") % 31 == 4, F.lit("L9")).otherwise(F.col("linha"))) \
               .withColumn("_ts", created).withColumn("_copy", F.lit(0))
    extra = base.where(F.col("_k") % 71 == 5).withColumn("lote_id", F.concat("lote_id", F.lit("-X"))) \
                .withColumn("_ts", created).withColumn("_copy", F.lit(1))
    older = base.where(F.col("_k") % 67 == 6).withColumn("linha", F.lit("L8")) \
                .withColumn("_ts", created - F.expr("INTERVAL 1 DAY")).withColumn("_copy", F.lit(2))
    allrows = main.unionByName(extra).unionByName(older)
    return allrows.select(
        F.concat("item_id", F.lit("#"), F.col("_copy").cast("string")).alias("id"),
        *STORED_FIELDS,
        F.date_format("_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("criadoEm"),
        "_k",
    )


def stored_json(stored_rows: DataFrame, chunk: int = 64) -> DataFrame:
    """D5 JSON form: browser-storage documents, each a JSON array of at most
    ``chunk`` objects (so no document grows with a batch). Objects use
    'numero' instead of 'lote_id' for k%83=8. For k%73=7 a second record of the
    same time (linha L7) follows in the list. Adds one invalid and one
    non-array document per chunk group of k%997=0 rows."""
    later = stored_rows.where((F.col("_k") % 73 == 7) & F.col("id").endswith("#0"))
    later = later.withColumns({"id": F.regexp_replace("id", "#0$", "#3"), "linha": F.lit("L7")})
    stored_rows = stored_rows.unionByName(later)
    obj = F.when(
        F.col("_k") % 83 == 8,
        F.to_json(F.struct("id", F.col("lote_id").alias("numero"), *STORED_FIELDS[1:], "criadoEm")),
    ).otherwise(F.to_json(F.struct("id", *STORED_FIELDS, "criadoEm")))
    grouped = stored_rows.withColumn("_doc", F.floor(F.col("_k") / chunk)) \
        .groupBy("_doc").agg(F.array_join(F.array_sort(F.collect_list(obj)), ",").alias("_body"))
    docs = grouped.select(F.concat(F.lit("doc-"), F.col("_doc").cast("string")).alias("doc_id"),
                          F.concat(F.lit("["), "_body", F.lit("]")).alias("raw"))
    bad = stored_rows.where(F.col("_k") % 997 == 0).select(
        F.concat(F.lit("bad-"), F.col("_k").cast("string")).alias("doc_id"),
        F.when(F.col("_k") % 2 == 0, F.lit("{\"lote_id\": \"x\"}")).otherwise(F.lit("[{not json")).alias("raw"),
    )
    return docs.unionByName(bad)


def queue_session(handoff_rows: DataFrame) -> DataFrame:
    """The shared queue. Queue (task) = batch month; FIFO position seq =
    batch date then source row; batch_total + 1 on day-of-month 13. The batches
    of days 19 and 20 are published at once: their items alternate."""
    date_key = F.date_format(_batch_date(), "yyyyMMdd").cast("long")
    day = _day_of_month()
    second = (day == 20).cast("int")
    seq = F.when(day.isin(19, 20), (date_key - second) * F.lit(1_000_000) + 2 * F.col("source_row") + second) \
           .otherwise(date_key * F.lit(1_000_000) + F.col("source_row"))
    return handoff_rows.select(
        F.date_format(_batch_date(), "yyyy-MM").alias("queue_id"),
        seq.alias("seq"),
        "item_id", "batch_id", "source_row",
        F.when(day == 13, F.col("batch_total") + 1).otherwise(F.col("batch_total")).alias("batch_total"),
        day.alias("day"),
    )


def queue_tasks(queue: DataFrame) -> DataFrame:
    """The consumer tasks of D8, by the day of the batch that they start at.

    A task has the parameters its publisher gave it (the batch, the total it
    declared); none on days 3, 10, 17, 24 and 31; on day 8 the total is half of
    the declared one, and a second task without parameters takes the rest; on
    day 22 the batch is another one; nobody starts on day 26. One task a queue
    starts behind its end."""
    placed = number_within(queue, ["queue_id"], "seq", out="place")
    # a row per batch of a queue, written once: its parts are read four times
    first = written(placed.groupBy("queue_id", "batch_id").agg(
        F.min("place").alias("start"), F.max("place").alias("end"), F.max("batch_total").alias("total"), F.max("day").alias("day")), "queue-batches")
    none, day = F.lit(None), F.col("day")
    bare = day % 7 == 3
    half = F.ceil(F.col("total") / 2).cast("int")
    task = F.concat(F.lit("task-"), "batch_id")
    main = first.where(day != 26).select(
        task.alias("task_id"), "queue_id", "start",
        F.when(bare, none).when(day == 22, F.concat("batch_id", F.lit("-x"))).otherwise(F.col("batch_id")).alias("batch_id"),
        F.when(bare, none).when(day == 8, half).otherwise(F.col("total")).cast("int").alias("batch_total"))
    rest = first.where((day == 8) & (F.col("total") > 1)).select(
        F.concat(task, F.lit("-rest")).alias("task_id"), "queue_id", (F.col("start") + half).cast("int").alias("start"),
        F.lit("").alias("batch_id"), F.lit(0).alias("batch_total"))
    behind = first.groupBy("queue_id").agg((F.max("end") + 6).alias("start")).select(
        F.concat(F.lit("task-behind-"), "queue_id").alias("task_id"), "queue_id", "start", none.cast("string").alias("batch_id"), none.cast("int").alias("batch_total"))
    return main.unionByName(rest).unionByName(behind)


def taken_up_sessions(queue: DataFrame) -> DataFrame:
    """Sessions taken up again, one a queue and a pair of days (1 and 2, 3
    and 4, ...), with the items of both and the total that the pair has; one
    more than that for days 5 and 6."""
    pair = F.floor((F.col("day") + 1) / 2)
    rows = queue.select(F.concat_ws("-", F.lit("session"), "queue_id", pair.cast("string")).alias("task_id"), "item_id", "batch_id", pair.alias("_pair"))
    total = rows.groupBy("task_id").agg((F.count(F.lit(1)) + F.max(F.when(F.col("_pair") == 3, 1).otherwise(0))).cast("int").alias("batch_total"))
    return rows.drop("_pair").join(known_small(written(total, "session-totals")), "task_id")


def sheet_grid(lots_rows: DataFrame) -> DataFrame:
    """Raw workbook grids (batch_id, sheet_no, sheet_name, row_no, cells).

    Sheet 0, the inspection: row 1 title; row 2 'Registros: n' (blank on day 9);
    row 3 header; data from row 4; an all-null row after the first data row on
    day 11; a footer row after the data. n counts the rows between header and
    footer. Sheet 1, the reference list: row 1 'Registros: n' (one less than
    there are on day 12); row 2 header (without lote_id on day 14); the lot ids
    between spaces, those of every third row twice."""
    day = _day_of_month()
    per_batch = lots_rows.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("row_idx") % 3 == 0).alias("twice"),
        F.first("reference_date").alias("reference_date"),
    )
    sheet = F.when(_day_of_month() == 21, F.lit("Plan1")).otherwise(
        F.concat(F.lit("Inspecao_"), F.regexp_replace("reference_date", "/", "_")))
    null_row = (_day_of_month() == 11).cast("int")
    text = F.lit(None).cast("string")

    def rows(df: DataFrame, no: int, name, row_no, cells) -> DataFrame:
        return df.select("batch_id", F.lit(no).alias("sheet_no"), name.alias("sheet_name"), row_no.cast("int").alias("row_no"), cells.alias("cells"))

    header = rows(per_batch, 0, sheet, F.lit(3), F.array(*[F.lit(c) for c in K.CONTRACT_COLUMNS]))
    title = rows(per_batch, 0, sheet, F.lit(1), F.array(F.lit("Inspeção diária de lotes"), text))
    total = rows(per_batch, 0, sheet, F.lit(2), F.array(
        F.when(day != 9, F.concat(F.lit("Registros: "), (F.col("n") + null_row).cast("string"))).otherwise(F.lit("")), text))
    footer = rows(per_batch, 0, sheet, F.col("n") + null_row + 4, F.array(F.lit("Total"), F.col("n").cast("string"), *[text] * 6))
    blank_row = rows(per_batch.where(day == 11), 0, sheet, F.lit(5), F.array(*[text] * 8))
    data = rows(lots_rows, 0, sheet, F.col("row_idx") + 4 + F.when((day == 11) & (F.col("row_idx") >= 1), 1).otherwise(0),
                F.array(*[F.col(c) for c in K.CONTRACT_COLUMNS]))
    base = F.lit(K.REFERENCE_SHEET)
    declared = F.col("n") + F.col("twice") - (day == 12).cast("int")
    ref_total = rows(per_batch, 1, base, F.lit(1), F.array(F.concat(F.lit("Registros: "), declared.cast("string"))))
    ref_header = rows(per_batch, 1, base, F.lit(2), F.array(F.lit("codigo"), F.when(day == 14, F.lit("lote")).otherwise(F.lit("lote_id"))))
    # every third row (0, 3, ...) takes two lines, the row itself first
    line = F.col("row_idx") + F.floor((F.col("row_idx") + 2) / 3) + 3
    cells = F.array(F.col("row_idx").cast("string"), F.concat(F.lit(" "), "lote_id", F.lit(" ")))
    ref_data = rows(lots_rows, 1, base, line, cells)
    ref_twice = rows(lots_rows.where(F.col("row_idx") % 3 == 0), 1, base, line + 1, cells)
    parts = [title, total, header, blank_row, data, footer, ref_total, ref_header, ref_data, ref_twice]
    return reduce(DataFrame.unionByName, parts)


def headers(lots_rows: DataFrame) -> DataFrame:
    """Header row per batch; no 'status' on day 3, an 'extra' column on
    day 5, both on day 7."""
    day = _day_of_month()
    base = lots_rows.select("batch_id", "reference_date").distinct()
    names = F.array(*[F.lit(c) for c in K.CONTRACT_COLUMNS])
    drop = (day == 3) | (day == 7)
    add = (day == 5) | (day == 7)
    h = F.when(drop, F.array_remove(names, "status")).otherwise(names)
    h = F.when(add, F.concat(h, F.array(F.lit("extra")))).otherwise(h)
    return base.select("batch_id", h.alias("header"))


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log events of ten runs from the events table. Some events of run 3
    carry another bot, some of run 7 another execution."""
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    no = F.col("user_id") % 10
    return ev.select(
        "event_id",
        F.concat(F.lit("run-"), no.cast("string")).alias("run_id"),
        F.when((no == 7) & (F.col("event_id") % 5 == 1), F.lit("exec-x")).otherwise(F.concat(F.lit("exec-"), no.cast("string"))).alias("execution_id"),
        F.when((no == 3) & (F.col("event_id") % 5 == 0), F.lit("bot-b")).otherwise(F.lit("bot-a")).alias("bot_id"),
        F.when(F.col("event_type") == "error", F.lit("ERROR"))
         .when(F.col("event_type") == "signup", F.lit("WARNING")).otherwise(F.lit("INFO")).alias("level"),
        F.col("event_type").alias("message"),
        F.col("ts").alias("timestamp"),
    )


RUN_STARTED_AT = "2024-01-10 00:00:00.5"


def run_starts(events: DataFrame) -> DataFrame:
    """The runs (run_id, execution_id, started_at). A run starts half a
    second into the second of its first event since RUN_STARTED_AT, so that this
    event may lie before the start, but not before its second; a further run
    has no events."""
    since = F.date_trunc("second", F.lit(RUN_STARTED_AT).cast("timestamp_ntz"))
    first = events.where(F.col("timestamp") >= since).groupBy("run_id").agg(F.min("timestamp").alias("t"))
    runs = first.select("run_id", F.regexp_replace("run_id", "run", "exec").alias("execution_id"),
                        (F.date_trunc("second", "t") + F.expr("INTERVAL 0.5 SECOND")).alias("started_at"))
    idle = events.sparkSession.range(1).select(F.lit("run-idle").alias("run_id"), F.lit("exec-idle").alias("execution_id"), since.alias("started_at"))
    return runs.unionByName(idle)


def evidence_listing(outcomes_rows: DataFrame) -> DataFrame:
    """The evidence files that exist; one per admitted row, missing when
    k % 61 = 12."""
    return outcomes_rows.where(F.col("lot_key") % 61 != 12).select("batch_id", F.col("evidence_path").alias("path"))


def loose_divergences(evaluated_rows: DataFrame) -> DataFrame:
    """D1 violations in the mixed shapes a report writer may receive,
    chosen by lot_key % 6: 0 flat full, 1 flat 'regra'/'descricao', 2 only a
    divergencia_rnXX column, 3 only campos_vazios, 4 nested list per row (its
    children full, or for lot_key % 12 = 10 with a divergencia_rnXX only), 5
    nothing but the lot id."""
    from lotguard.operators.report import LOOSE_FIELDS

    shape = (F.col("lot_key") % 6).cast("int")
    v = evaluated_rows.where(F.size("violations") > 0).select("lote_id", "violations", shape.alias("_shape"), (F.col("lot_key") % 12 == 10).alias("_bare"))
    none = F.lit(None).cast("string")
    div_cols = K.DIVERGENCE_COLUMNS
    fields = (*LOOSE_FIELDS, *div_cols, "campos_vazios")

    def child(x: Column) -> Column:
        full = {"regra_violada": x["regra"], "descricao_do_erro": x["descricao"], "acao_recomendada": x["acao"], "severidade": x["severidade"]}
        bare = {c: F.when(F.lower(x["regra"]) == c.removeprefix("divergencia_"), x["descricao"]) for c in div_cols}
        return F.struct(*[F.when(F.col("_bare"), bare[f]).alias(f) if f in bare else F.when(~F.col("_bare"), full[f]).alias(f) if f in full else none.alias(f)
                          for f in fields])

    nested = v.where(F.col("_shape") == 4).select(
        "lote_id",
        *[none.alias(c) for c in LOOSE_FIELDS if c != "lote_id"],
        *[none.alias(c) for c in div_cols],
        none.alias("campos_vazios"),
        F.transform("violations", child).alias("divergencias"),
    )
    flat = v.where(F.col("_shape") != 4).select("lote_id", "_shape", F.inline("violations"))
    s = F.col("_shape")
    empties = F.regexp_extract("descricao", r"^Campos obrigatórios vazios: (.*)\.$", 1)
    flat_rows = flat.select(
        "lote_id",
        F.when(s == 0, F.col("regra")).alias("regra_violada"),
        F.when(s == 1, F.col("regra")).alias("regra"),
        F.when(s == 0, F.col("descricao")).alias("descricao_do_erro"),
        F.when(s == 1, F.col("descricao")).alias("descricao"),
        F.when(s == 0, F.col("acao")).alias("acao_recomendada"),
        F.when(s == 0, F.col("severidade")).alias("severidade"),
        *[F.when((s == 2) & (F.lower("regra") == c.removeprefix("divergencia_")), F.col("descricao")).alias(c)
          for c in div_cols],
        F.when((s == 3) & (F.col("regra") == "RN02"), empties).alias("campos_vazios"),
        F.lit(None).cast("array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>").alias("divergencias"),
    )
    return flat_rows.unionByName(nested)


def expected_files(lots_rows: DataFrame) -> DataFrame:
    """The sheets that should be there, one a batch, with the start and end
    of their check."""
    day = _batch_date()
    return lots_rows.groupBy("batch_id").agg(F.first("source_file").alias("arquivo_processado"), F.first("reference_date").alias("reference_date")).select(
        "batch_id", "arquivo_processado", F.date_format(day, "yyyy-MM-dd'T08:00:00'").alias("timestamp_inicio"),
        F.date_format(day, "yyyy-MM-dd'T08:01:30'").alias("timestamp_fim"), _day_of_month().alias("day"))


def found_files(expected: DataFrame) -> DataFrame:
    """The files that are there: none on day 15; on day 16 no workbooks."""
    return expected.where(F.col("day") != 15).select(
        "batch_id", F.md5("batch_id").alias("hash_md5"), F.when(F.col("day") == 16, F.lit("File is not a zip file")).alias("unreadable"))


def with_bad_reference(lots_rows: DataFrame) -> DataFrame:
    """D1 with a reference date that is no date on day 25."""
    return lots_rows.withColumn("reference_date", F.when(_day_of_month() == 25, F.lit("99/99/9999")).otherwise(F.col("reference_date")))


def _row_no(item_id: str = "item_id") -> Column:
    return F.substring_index(item_id, ":", -1).cast("int")


def faulty_outputs(tables: dict[str, DataFrame], days: DataFrame) -> dict[str, DataFrame]:
    """A run's written outputs, damaged by the day of their batch, a fault
    for each check (rows of even source rows; whole batches for the others).
    ``days``: batch_id, day."""
    out = {name: df.join(days, "batch_id") for name, df in tables.items()}
    day, even = F.col("day"), lambda c: F.col(c) % 2 == 0

    def lost(name: str, on: int, rows: Column | None = None) -> None:
        out[name] = out[name].where(~((day == on) & (F.lit(True) if rows is None else rows)))

    def changed(name: str, column: str, on: int, value, rows: Column | None = None) -> None:
        here = (day == on) & (F.lit(True) if rows is None else rows)
        out[name] = out[name].withColumn(column, F.when(here, value).otherwise(F.col(column)))

    lost("processed", 1, even("source_row"))
    changed("processed", "datapool_state", 2, F.lit(K.STATE_PROCESSING), even("source_row"))
    changed("processed", "datapool_state", 3, F.lit("LOST"), even("source_row"))
    changed("processed", "error_type", 4, F.lit(K.ERROR_BUSINESS), even("source_row"))
    changed("processed", "evidence_path", 5, F.lit(""), even("source_row"))
    again = out["processed"].where(day == 6).groupBy("batch_id", "day").agg(F.count(F.lit(1)).alias("total"))
    out["open_batches"] = out["open_batches"].select("batch_id", "day", "total").unionByName(again)
    changed("producer_summary", "itens_publicados_datapool", 7, F.col("itens_publicados_datapool") + 1)
    changed("producer_summary", "erros_fluxo", 8, F.col("erros_fluxo") + 2)
    changed("consumer_summary", "total_registros", 10, F.col("total_registros") + 3)
    lost("evidence", 11, F.col("name").startswith(K.EVIDENCE_OK))
    lost("evidence", 12, F.col("name").startswith(K.EVIDENCE_REJECTED))
    lost("report/resumo", 13, F.col("metrica") == K.SUMMARY_METRICS[2])
    lost("report/divergencias", 14, _row_no() % 2 == 0)
    lost("report/lotes_validados", 16, _row_no() % 2 == 0)
    changed("consumer_summary", "total_rejeicoes_cadastro", 17, F.lit(1))
    changed("consumer_summary", "total_falhas_tecnicas", 18, F.lit(1))
    lost("report/revisao_humana", 19, _row_no() % 2 == 0)
    changed("log", "ok", 20, F.lit(False), F.col("stage") == "validador")
    lost("log", 23, F.col("stage") == "produtor")
    lost("log", 24, F.col("stage") == "validador")
    return out
