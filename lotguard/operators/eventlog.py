"""The event log: audit events of both stages, as JSON lines.

    <root>/run=<run>/day=<yyyy-mm-dd>/*.json.gz

A line carries timestamp (whole seconds, with zone), level, execution_id,
bot_id, batch_id, lote_id, source_row and message. Folders by run and day keep
a scan of a time window to the days that it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K

FIELDS = ("timestamp", "level", "execution_id", "bot_id", "batch_id", "lote_id", "source_row", "message")
_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxx"
_SCHEMA = ("timestamp string, level string, execution_id string, bot_id string, batch_id string, lote_id string, "
           "source_row int, message string, run string, day string, _corrupt string")


def _context(df: DataFrame) -> list[Column]:
    """batch_id, lote_id and source_row, null where there is no such column."""
    kinds = {"batch_id": "string", "lote_id": "string", "source_row": "int"}
    return [(F.col(c) if c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]


def producer_events(outcomes: DataFrame) -> DataFrame:
    """K8, producer stage: the start of each registration attempt and its end."""
    st, err, ev = F.col("cadastro_status"), F.col("cadastro_error"), F.col("evidence_path")
    timeout = err.startswith(K.TIMEOUT_PREFIX)
    level = F.when(st == K.OUTCOME_SUCCESS, F.lit("INFO")).when(st == K.OUTCOME_REJECTED, F.lit("WARNING")).otherwise(F.lit("ERROR"))
    event = F.when(st == K.OUTCOME_SUCCESS, F.concat(F.lit(K.EVENT_DONE), ev)) \
             .when(st == K.OUTCOME_REJECTED, F.concat(F.lit(K.EVENT_REJECTED), ev, F.lit(" motivo="), err)) \
             .when(timeout, F.concat(F.lit(K.EVENT_TIMEOUT), ev, F.lit(" erro="), F.substr(err, F.lit(len(K.TIMEOUT_PREFIX) + 1)))) \
             .otherwise(F.concat(F.lit(K.EVENT_FAILED), err, F.lit(" evidencia="), ev))
    both = F.inline(F.array(
        F.struct(F.lit("INFO").alias("level"), F.lit(K.EVENT_STARTED).alias("event")),
        F.struct(level.alias("level"), event.alias("event"))))
    return outcomes.select("item_id", F.lit("produtor").alias("stage"), *_context(outcomes), both)


def consumer_events(states: DataFrame) -> DataFrame:
    """K8, consumer stage: one event per final item state. ``states`` carries
    datapool_state, error_type, finish_message and the item's cadastro_status."""
    s, et = F.col("datapool_state"), F.col("error_type")
    rules = F.split(F.col("finish_message"), ": ", 2).getItem(0)
    level = F.when(et == K.ERROR_SYSTEM, F.lit("ERROR")).when(s == K.STATE_DONE, F.lit("INFO")).otherwise(F.lit("WARNING"))
    event = F.when(et == K.ERROR_SYSTEM, F.lit(K.EVENT_ITEM_TECHNICAL)) \
             .when(F.coalesce(F.col("cadastro_status") == K.OUTCOME_REJECTED, F.lit(False)), F.lit(K.EVENT_ITEM_REJECTED)) \
             .when(s == K.STATE_DONE, F.lit(K.EVENT_ITEM_OK)) \
             .otherwise(F.concat(F.lit(K.EVENT_ITEM_NOK), rules))
    return states.select("item_id", F.lit("validador").alias("stage"), *_context(states), level.alias("level"), event.alias("event"))


def log_lines(events: DataFrame, execution_id: str | Column, bot_id: str | Column, at: str | Column | None = None) -> DataFrame:
    """Events as log lines of one run: its ids, and the time (a column, now if
    not given) in whole seconds."""
    lit = lambda v: F.lit(v) if isinstance(v, str) else v
    when = F.current_timestamp() if at is None else F.col(at) if isinstance(at, str) else at
    values = {"timestamp": F.date_trunc("second", when.cast("timestamp")), "execution_id": lit(execution_id), "bot_id": lit(bot_id), "message": F.col("event")}
    return events.select(*[values[c].alias(c) if c in values else F.col(c) for c in FIELDS])


def write_event_log(lines: DataFrame, root: str, run: str) -> str:
    """Append the lines of a run: a folder of its own, in it one a day. A run
    that is there already is an error. Lines repeat much of their text: packed
    they take a tenth of the space."""
    path = f"{root.rstrip('/')}/run={run}"
    day = F.date_format("timestamp", "yyyy-MM-dd")
    text = lines.withColumns({"day": day, "timestamp": F.date_format("timestamp", _FORMAT)})
    text.write.mode("errorifexists").option("compression", "gzip").partitionBy("day").json(path)
    return path


def read_event_log(spark: SparkSession, root: str, started_at: str | None = None) -> DataFrame:
    """The lines at or after the start ``started_at`` (UTC) truncated to the
    second, as lines carry whole seconds. Blank lines are passed over; a line that
    is no JSON object, or whose time can't be read, stays, with its text in
    ``_corrupt`` (all of it, whatever the window: it has no time)."""
    rows = spark.read.schema(_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").json(root)
    when = F.try_to_timestamp("timestamp", F.lit(_FORMAT))
    rows = rows.select(when.alias("timestamp"), *[c for c in FIELDS if c != "timestamp"], "run", "day",
                       F.when(F.col("_corrupt").isNotNull() | when.isNull(), F.coalesce("_corrupt", F.col("timestamp"), F.lit(""))).alias("_corrupt"))
    if started_at is None:
        return rows
    start = F.date_trunc("second", F.to_timestamp(F.lit(started_at)))
    return rows.where((F.col("day") >= F.date_format(start, "yyyy-MM-dd")) & (F.col("_corrupt").isNotNull() | (F.col("timestamp") >= start)))


def audit_events(outcomes: DataFrame, states: DataFrame) -> DataFrame:
    """K8: per-item audit events of both stages (item_id, stage, context, level, event)."""
    return producer_events(outcomes).unionByName(consumer_events(states))


def events_since(events: DataFrame, started_at: str) -> DataFrame:
    """S12 over an events table: events at or after the run start truncated to
    the second (log lines carry whole seconds only)."""
    start = F.date_trunc("second", F.lit(started_at).cast("timestamp_ntz"))
    return events.where(F.col("timestamp") >= start)


def events_of_runs(events: DataFrame, runs: DataFrame) -> DataFrame:
    """S12 for many runs (run_id, started_at): each run's events since its own
    start, truncated to the second."""
    starts = runs.select("run_id", F.date_trunc("second", "started_at").alias("_from"))
    return events.join(starts, "run_id").where(F.col("timestamp") >= F.col("_from")).drop("_from")


def log_context(events: DataFrame, expected_bot: str, runs: DataFrame | None = None) -> DataFrame:
    """Per run, the number of its events and whether all of them carry the
    expected bot id and the run's execution id (``runs``: run_id, execution_id).
    A run without events isn't ok. Without ``runs`` an execution id is a run."""
    bot = F.coalesce(F.col("bot_id") == expected_bot, F.lit(False))
    if runs is None:
        return events.groupBy("execution_id").agg(F.count(F.lit(1)).alias("n"), F.bool_and(bot).alias("ok"))
    per = events.groupBy("run_id", "execution_id").agg(F.count(F.lit(1)).alias("_n"), F.bool_and(bot).alias("_ok"))
    same = F.coalesce(F.col("execution_id") == F.col("_expected"), F.lit(False))
    both = runs.select("run_id", F.col("execution_id").alias("_expected")).join(per, "run_id", "left")
    return both.groupBy("run_id").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.bool_and(F.coalesce(F.col("_ok"), F.lit(False)) & same).alias("ok"))
