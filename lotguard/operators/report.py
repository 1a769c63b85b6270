"""Report tables: loose-divergence normaliser, never-overwrite versions,
metric unpivot (N1, K4, K6, G5)."""

from __future__ import annotations

from datetime import UTC, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import base_name
from lotguard.operators.sequence import number_within
from lotguard.sources.files import create_if_absent, listing

LOOSE_FIELDS = ("lote_id", "regra_violada", "regra", "descricao_do_erro", "descricao",
                "acao_recomendada", "severidade")
NESTED_TYPE = "array<struct<" + ",".join(f"{f}:string" for f in LOOSE_FIELDS) + ">>"


def _truthy(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalise_report_rows(loose: DataFrame) -> DataFrame:
    """Flatten nested divergences (child keys win over the parent's
    lote_id; rule columns that their struct lacks are null) and resolve rule id, description, action and severity through
    the original fallback ladders. Missing and null fields are the same."""
    div_cols = [c for c in K.DIVERGENCE_COLUMNS]
    has_children = F.coalesce(F.size("divergencias") > 0, F.lit(False))
    flat = loose.where(~has_children).select(
        *[F.col(c) for c in LOOSE_FIELDS], *[F.col(c) for c in div_cols], F.col("campos_vazios"),
    )
    child = loose.schema["divergencias"].dataType.elementType.fieldNames()
    nested = loose.where(has_children).select(F.col("lote_id").alias("_parent"), F.inline("divergencias")) \
        .select(
            F.coalesce("lote_id", "_parent").alias("lote_id"),
            *[F.col(c) for c in LOOSE_FIELDS if c != "lote_id"],
            *[F.col(c) if c in child else F.lit(None).cast("string").alias(c) for c in [*div_cols, "campos_vazios"]],
        )
    rows = flat.unionByName(nested)
    first_div_rule = F.coalesce(*[F.when(_truthy(F.col(c)).isNotNull(), F.lit(c.removeprefix("divergencia_").upper()))
                                  for c in div_cols])
    first_div_text = F.coalesce(*[_truthy(F.col(c)) for c in div_cols])
    empties = _truthy(F.col("campos_vazios"))
    rule = F.coalesce(_truthy(F.col("regra_violada")), _truthy(F.col("regra")), first_div_rule,
                      F.when(empties.isNotNull(), F.lit("RN02")), F.lit(K.UNCLASSIFIED_RULE))
    desc = F.coalesce(_truthy(F.col("descricao_do_erro")), _truthy(F.col("descricao")), first_div_text,
                      F.when(empties.isNotNull(), F.concat(F.lit(K.RN02_DESC_PREFIX), empties)),
                      F.lit(K.NO_DESCRIPTION))
    return rows.select(
        F.coalesce(F.col("lote_id"), F.lit("")).alias("lote_id"),
        rule.alias("regra_violada"),
        desc.alias("descricao_do_erro"),
        F.coalesce(F.col("acao_recomendada"), F.lit(K.DEFAULT_ACTION)).alias("acao_recomendada"),
        F.coalesce(F.col("severidade"), F.lit(K.SEV_MEDIUM)).alias("severidade"),
    )


def utc_wallclock(df: DataFrame, c: str) -> Column:
    """A UTC wall-clock TIMESTAMP_NTZ for column ``c``: NTZ values are taken
    as UTC already; TIMESTAMP (instant) values are converted from the
    session zone. Nothing downstream depends on the session time zone."""
    if df.schema[c].dataType.simpleString() == "timestamp_ntz":
        return F.col(c)
    session_tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), F.col(c).cast("timestamp_ntz"))


def report_versions(runs: DataFrame, tz: str = K.TIMEZONE, existing: DataFrame | None = None) -> DataFrame:
    """K6: never overwrite. Runs of the same report on the same local day
    get _2, _3, ... in start order, behind those there are already
    (``existing``: report, day, run_no; see ``existing_reports``). Input: report,
    started_at (UTC), run_key (unique tie-break). The numbering is skew-safe
    (see sequence.py): one-minute blocks, then blocks inside a minute."""
    utc = utc_wallclock(runs, "started_at")
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    with_day = runs.withColumn("day", F.date_format(local, "ddMMyyyy")) \
                   .withColumn("_us", F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), utc))
    # At most 1 440 count rows per (report, day); a block holds the runs of one minute.
    n = number_within(with_day, ["report", "day"], "_us", out="_i", tiebreak=["run_key"],
                      block_width=60_000_000)
    run_no = F.col("_i") + 1
    if existing is not None:
        last = existing.groupBy("report", "day").agg(F.max("run_no").alias("_last"))
        n = n.join(last, ["report", "day"], "left")
        run_no = run_no + F.coalesce("_last", F.lit(0))
    run_no = run_no.cast("int")
    name = F.concat("report", F.lit("_"), "day",
                    F.when(run_no > 1, F.concat(F.lit("_"), run_no.cast("string"))).otherwise(F.lit("")),
                    F.lit(".xlsx"))
    return n.select("run_key", "report", "day", run_no.alias("run_no"), name.alias("file_name"))


_NAME = r"^(.*)_(\d{8})(?:_(\d+))?\.xlsx$"


def existing_reports(spark: SparkSession, root: str) -> DataFrame:
    """K6: (report, day, run_no) of the reports there are under ``root``, from the
    names of their claims."""
    name = base_name("path")
    no = F.regexp_extract(name, _NAME, 3)
    return listing(spark, f"{root.rstrip('/')}/_claims").select(
        F.regexp_extract(name, _NAME, 1).alias("report"), F.regexp_extract(name, _NAME, 2).alias("day"),
        F.when(no == "", 1).otherwise(no.try_cast("int")).alias("run_no"))


def claim_report(spark: SparkSession, root: str, report: str, started_at: datetime | None = None, tz: str = K.TIMEZONE) -> str:
    """K6: the next free name of a report on the local day of ``started_at`` (UTC;
    now if not given). A name is taken by creating its claim, which fails if
    there is one: of two runs that try at once, one takes the next number."""
    root = root.rstrip("/")
    moment = started_at or datetime.now(UTC)
    moment = moment if moment.tzinfo else moment.replace(tzinfo=UTC)
    day = moment.astimezone(ZoneInfo(tz)).strftime("%d%m%Y")
    last = existing_reports(spark, root).where((F.col("report") == report) & (F.col("day") == day)).agg(F.max("run_no")).first()[0]
    no = (last or 0) + 1
    while True:
        name = f"{report}_{day}.xlsx" if no == 1 else f"{report}_{day}_{no}.xlsx"
        if create_if_absent(spark, f"{root}/_claims/{name}", name):
            return name
        no += 1


def write_report(tables: dict[str, DataFrame], root: str, report: str, started_at: datetime | None = None) -> dict[str, str]:
    """K4 sink: each table as parquet under report=<report>/file=<name>/<table>,
    with a name of its own (``claim_report``). Nothing is overwritten; empty
    tables keep their schema (parquet writes the footer)."""
    spark = next(iter(tables.values())).sparkSession
    name = claim_report(spark, root, report, started_at)
    out = {}
    for table, df in tables.items():
        out[table] = f"{root.rstrip('/')}/report={report}/file={name}/{table}"
        df.write.mode("errorifexists").parquet(out[table])
    return out


def write_flow_errors(tables: dict[str, DataFrame], root: str, started_at: datetime | None = None) -> dict[str, str]:
    """K5 sink: refuses a report without any flow error, as the original does."""
    if tables["erros_fluxo"].isEmpty():
        raise ValueError(K.NO_FLOW_ERRORS)
    return write_report(tables, root, K.FLOW_REPORT, started_at)
