"""Rule registry and the fused rule engine.

A rule is a set of Column expressions over one row plus the prepared context
columns below; all rules of a row are evaluated in one projection into an
ordered ``violations`` array of structs. The only join is the reference-list
lookup for RN03. No Python runs per row.

Context columns available to rule expressions:
  _status_canon  upper(strip(status)), null kept
  _status_norm   canonical status with OK/NOK mapped
  _ref_text      reference date text (batch value, default when blank)
  _ref_day       _ref_text parsed (fails the job when unparseable, as the
                 original process aborts the run)
  _known         lote_id (stripped) is in the reference list
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.functions.exprs import (
    blank,
    canonical_status,
    filled,
    in_domain,
    message_of,
    normalised_status,
    or_default,
    parse_day,
    strip,
)

VIOLATION_TYPE = "struct<ord:int,regra:string,descricao:string,acao:string,severidade:string>"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    ord: int
    predicate: Column  # true when the row diverges
    description: Column
    action: str
    severity: str
    guarded: bool = False  # a null predicate becomes a controlled failure

    def struct(self, rule_id: Column | None = None, description: Column | None = None,
               action: str | None = None, severity: str | None = None) -> Column:
        return F.struct(
            F.lit(self.ord).alias("ord"),
            (rule_id if rule_id is not None else F.lit(self.rule_id)).alias("regra"),
            (description if description is not None else self.description).alias("descricao"),
            F.lit(action or self.action).alias("acao"),
            F.lit(severity or self.severity).alias("severidade"),
        )

    def entry(self) -> Column:
        """A 0- or 1-element violation array (concatenated across rules; no
        lambda functions, so the projection stays in generated code)."""
        empty = F.array().cast(f"array<{VIOLATION_TYPE}>")
        hit = F.when(self.predicate, F.array(self.struct())).otherwise(empty)
        if not self.guarded:
            return hit
        failed = self.struct(F.lit(K.GUARD_RULE), F.lit(K.GUARD_DESC), K.GUARD_ACTION, K.SEV_HIGH)
        return F.when(self.predicate.isNull(), F.array(failed)).otherwise(hit)


def rn02() -> Rule:
    empty = F.array_join(F.array(*[F.when(blank(c), F.lit(c)) for c in K.REQUIRED_COLUMNS]), ", ")
    return Rule(
        "RN02", 1,
        reduce(lambda a, b: a | b, [blank(c) for c in K.REQUIRED_COLUMNS]),
        F.concat(F.lit(K.RN02_DESC_PREFIX), empty, F.lit(".")),
        K.RN02_ACTION, K.SEV_HIGH,
    )


def rn01() -> Rule:
    day = parse_day("data")
    return Rule(
        "RN01", 2,
        filled("data") & F.coalesce(day != F.col("_ref_day"), F.lit(True)),
        F.concat(F.lit("[RN01] Data '"), F.col("data"), F.lit("' fora da referência '"),
                 F.col("_ref_text"), F.lit("'.")),
        K.RN01_ACTION, K.SEV_MEDIUM,
    )


def rn03() -> Rule:
    return Rule(
        "RN03", 3,
        filled("lote_id") & ~F.col("_known"),
        F.concat(F.lit("[RN03] lote_id '"), F.col("lote_id"), F.lit("' não encontrado na base de referência.")),
        K.RN03_ACTION, K.SEV_HIGH,
    )


def rn05() -> Rule:
    canon = F.col("_status_canon")
    return Rule(
        "RN05", 4,
        in_domain(canon, K.STATUS_MAP.keys()),
        F.when(canon == "OK", F.lit(K.RN05_OK_DESC)).otherwise(F.lit(K.RN05_NOK_DESC)),
        K.RN05_ACTION, K.SEV_LOW,
    )


def rn06() -> Rule:
    norm = F.col("_status_norm")
    return Rule(
        "RN06", 5,
        ~in_domain(norm, K.STATUS_DOMAIN),
        # The original text names the domain check RN04 although the rule id is RN06.
        F.concat(F.lit("[RN04] Status '"), F.coalesce(norm, F.lit("nan")), F.lit("' fora do domínio permitido.")),
        K.RN06_ACTION, K.SEV_HIGH,
    )


def rn07() -> Rule:
    return Rule(
        "RN07", 6,
        (F.coalesce(F.col("_status_norm"), F.lit("")) == "REPROVADO") & blank("observacao"),
        F.lit(K.RN07_DESC),
        K.RN07_ACTION, K.SEV_HIGH,
        guarded=True,
    )


_RULES_CACHE: dict[str, list[Rule]] = {}


def default_rules() -> list[Rule]:
    """RN02, RN01, RN03, RN05, RN06, RN07 in evaluation order.

    The unresolved Column trees are built once per SparkContext (each is a few
    hundred py4j calls) and shared by every plan."""
    from pyspark import SparkContext

    active = SparkContext._active_spark_context
    key = active.applicationId if active is not None else ""
    if key not in _RULES_CACHE:
        _RULES_CACHE.clear()
        _RULES_CACHE[key] = [rn02(), rn01(), rn03(), rn05(), rn06(), rn07()]
    return list(_RULES_CACHE[key])


# ---------------------------------------------------------------------------
# context preparation


def reference_keys(reference: DataFrame) -> DataFrame:
    """Distinct stripped, non-blank lot IDs of a reference list.

    Keeps ``batch_id`` when the list is per batch."""
    cols = ["batch_id"] if "batch_id" in reference.columns else []
    return (
        reference.select(*cols, strip("lote_id").alias("lote_id"))
        .where(F.col("lote_id").isNotNull() & (F.col("lote_id") != ""))
        .distinct()
    )


def flag_known(lots: DataFrame, reference: DataFrame, out: str = "_known") -> DataFrame:
    """Left join that adds a boolean ``out``: stripped lote_id is in the list.

    Blank lot IDs never match; they are given their own item_id as join key
    (with a kind tag that the reference side never carries) so that a mass of
    blank IDs spreads over all partitions instead of hashing to one.
    The narrow keys are hashed: the rows, all their columns, are not sorted
    (and spilled) for the join, and stay in the order that they come in.
    """
    keys = reference_keys(reference)
    per_batch = "batch_id" in keys.columns
    right = keys.select(
        *(["batch_id"] if per_batch else []),
        F.col("lote_id").alias("_jk"),
        F.lit(1).alias("_jkind"),
        F.lit(True).alias("_hit"),
    )
    present = filled("lote_id")
    left = lots.withColumn("_jk", F.when(present, strip("lote_id")).otherwise(F.col("item_id"))) \
               .withColumn("_jkind", F.when(present, F.lit(1)).otherwise(F.lit(0)))
    on = (["batch_id"] if per_batch else []) + ["_jk", "_jkind"]
    return (
        left.join(right.hint("shuffle_hash"), on, "left")
        .withColumn(out, F.coalesce(F.col("_hit"), F.lit(False)))
        .drop("_jk", "_jkind", "_hit")
    )


def checked_reference_date(text: str) -> str:
    """The reference date given for a whole run, the default if blank. One
    that is no date fails the run, before any row is looked at."""
    text = text or K.DEFAULT_REFERENCE_DATE
    try:
        datetime.strptime(text, "%d/%m/%Y")
    except ValueError:
        raise ValueError(K.BAD_REFERENCE_DATE.format(text=text)) from None
    return text


def bad_reference_dates(rows: DataFrame) -> DataFrame:
    """Batches with a ``reference_date`` that is no date, with the error text
    (batch_id, error). Their rows can't be judged: RN01 would flag each of them."""
    text = or_default("reference_date", K.DEFAULT_REFERENCE_DATE)
    bad = rows.where(parse_day(text).isNull()).groupBy("batch_id").agg(F.min(text).alias("_t"))
    return bad.select("batch_id", message_of(K.BAD_REFERENCE_DATE, "_t").alias("error"))


def review_routing(evaluated: DataFrame) -> DataFrame:
    """P5: the rows whose status is outside of the domain, as they go to the
    review queue: all their columns, with ``divergencia_rn04`` (the text),
    ``status_ambiguo`` and ``fila_destino``."""
    v = F.col("violations")
    at = F.array_position(v.getField("regra"), "RN06").cast("int")
    rest = [c for c in evaluated.columns if c != "violations"]
    return select_where(evaluated, at > 0, *rest, F.element_at(v.getField("descricao"), at).alias("divergencia_rn04"),
                        F.lit(True).alias("status_ambiguo"), F.lit(K.REVIEW_QUEUE).alias("fila_destino"))


def normalise_status(lots: DataFrame) -> DataFrame:
    """P4, table form: every row, with ``status`` stripped, upper-cased and mapped,
    ``status_original`` as it was, and the text in ``divergencia_rn05`` where OK
    or NOK was mapped."""
    canon = canonical_status("status")
    text = F.when(canon == "OK", F.lit(K.RN05_OK_DESC)).when(canon == "NOK", F.lit(K.RN05_NOK_DESC))
    return lots.select(*[c for c in lots.columns if c != "status"], F.col("status").alias("status_original"),
                       normalised_status("status").alias("status"), text.alias("divergencia_rn05"))


def prepare(lots: DataFrame, reference: DataFrame | None, reference_date: str | None = None,
            known: Column | None = None) -> DataFrame:
    """Add the context columns rules refer to. ``known`` replaces the
    reference join by a row-local membership expression when each row
    carries its reference (as hand-off records do)."""
    if reference_date is not None:
        ref_text = F.lit(checked_reference_date(reference_date))
    elif "reference_date" in lots.columns:
        ref_text = or_default("reference_date", K.DEFAULT_REFERENCE_DATE)
    else:
        ref_text = F.lit(K.DEFAULT_REFERENCE_DATE)
    # The join comes first: its shuffle doesn't carry the other context columns.
    if known is not None:
        out = lots.withColumn("_known", F.coalesce(known, F.lit(False)))
    elif reference is not None:
        out = flag_known(lots, reference)
    else:
        out = lots.withColumn("_known", F.lit(True))
    return out.withColumns({
        "_status_canon": canonical_status("status"),
        "_status_norm": normalised_status("status"),
        "_ref_text": ref_text,
    }).withColumn("_ref_day", parse_day("_ref_text"))


CONTEXT_COLUMNS = ("_status_canon", "_status_norm", "_ref_text", "_ref_day", "_known")


def evaluate(
    lots: DataFrame,
    reference: DataFrame | None,
    rules: list[Rule] | None = None,
    reference_date: str | None = None,
    known: Column | None = None,
) -> DataFrame:
    """P8 fused form: every input row, plus ``status_original``, normalised
    ``status``, ``divergencia_rn05`` and the ordered ``violations`` array."""
    rules = rules if rules is not None else default_rules()
    ctx = prepare(lots, reference, reference_date, known)
    violations = F.concat(*[r.entry() for r in sorted(rules, key=lambda r: r.ord)])
    rn05_text = F.when(F.col("_status_canon") == "OK", F.lit(K.RN05_OK_DESC)) \
                 .when(F.col("_status_canon") == "NOK", F.lit(K.RN05_NOK_DESC))
    return ctx.select(
        *[c for c in lots.columns if c != "status"],
        F.col("status").alias("status_original"),
        F.col("_status_norm").alias("status"),
        rn05_text.alias("divergencia_rn05"),
        violations.alias("violations"),
    )


def violations_long(evaluated: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Long violation table: one row per (row, violation), duplicates kept."""
    keys = keys or ["item_id", "lote_id"]
    # inline_outer + a filter on the generated column: a plain inline on a
    # column gets an inferred size(violations) > 0 filter that Catalyst pushes
    # below the rule projection, evaluating every rule twice per row.
    return evaluated.select(*keys, F.inline_outer("violations")).where(F.col("ord").isNotNull()).select(
        *keys,
        "ord",
        F.col("regra").alias("regra_violada"),
        F.col("descricao").alias("descricao_do_erro"),
        F.col("acao").alias("acao_recomendada"),
        "severidade",
    )


def rule_hits(lots: DataFrame, reference: DataFrame | None, rule: Rule,
              reference_date: str | None = None) -> DataFrame:
    """Stand-alone rule: the rows one rule flags, with its message."""
    ctx = prepare(lots, reference, reference_date)
    return ctx.where(F.coalesce(rule.predicate, F.lit(False))).select(
        "item_id", "lote_id", rule.description.alias("message")
    )


def select_where(df: DataFrame, cond: Column, *cols: Column | str) -> DataFrame:
    """Project ``cols`` of the rows where ``cond`` holds.

    Written as one Generate (inline of a 0- or 1-element array of structs)
    rather than ``where(...).select(...)``: a filter on the ``violations``
    column is pushed below the projection that computes it by inlining the
    whole rule expression, so every rule would run twice per row (measured
    3x slower). The Generate keeps that projection intact."""
    fields = [F.col(c) if isinstance(c, str) else c for c in cols]
    return df.select(F.inline(F.when(cond, F.array(F.struct(*fields)))))


def consolidated_columns(v: Column) -> list[Column]:
    """C1 texts from an ordered violation array. Field extraction on an array
    of structs plus array_distinct / array_join / array_contains are all
    code-generated (no lambda functions)."""
    return [
        F.array_join(F.array_distinct(v.getField("regra")), "; ").alias("regra_violada"),
        F.array_join(v.getField("descricao"), " | ").alias("descricao_do_erro"),
        F.array_join(F.array_distinct(v.getField("acao")), " | ").alias("acao_recomendada"),
        F.when(F.array_contains(v.getField("severidade"), K.SEV_HIGH), F.lit(K.SEV_HIGH))
         .otherwise(F.lit(K.SEV_MEDIUM)).alias("severidade"),
    ]


def consolidate(evaluated: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per divergent input row. No shuffle: the violations are
    already on the row, in rule order."""
    keys = keys or ["item_id", "lote_id"]
    v = F.col("violations")
    return select_where(evaluated, F.size(v) > 0, *keys, *consolidated_columns(v))


def consolidate_long(violations: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """C1 for an external long violation table: group by row, order by ``ord``.

    The partial aggregate keeps only small per-row arrays; a row has at most
    one violation per rule so no group is large."""
    keys = keys or ["item_id", "lote_id"]
    grouped = violations.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("ord", "regra_violada", "descricao_do_erro",
                                             "acao_recomendada", "severidade"))).alias("v")
    )
    v = F.col("v")
    renamed = F.transform(v, lambda x: F.struct(
        x["regra_violada"].alias("regra"), x["descricao_do_erro"].alias("descricao"),
        x["acao_recomendada"].alias("acao"), x["severidade"].alias("severidade")))
    return grouped.select(*keys, *consolidated_columns(renamed))
