"""Invariants that hold at any scale (checked on the derived sf0.001 tables)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from lotguard.operators import rules as R
from lotguard.operators import validate as VAL
from lotguard.plans import fixtures as FX


def test_fused_equals_long_form(spark):
    ev = FX.evaluated(spark, SF_SMALL)
    fused = R.consolidate(ev)
    long = R.consolidate_long(R.violations_long(ev))
    assert fused.exceptAll(long).count() == 0 and long.exceptAll(fused).count() == 0


def test_partition_of_rows(spark):
    ev = VAL.with_exclusion(FX.consumer_evaluated(spark, SF_SMALL))
    total = ev.count()
    valid = VAL.valid_lots(ev).count()
    divergent = ev.where(F.size("violations") > 0).count()
    excluded_clean = ev.where((F.size("violations") == 0) & F.col("_excluded")).count()
    assert valid + divergent + excluded_clean == total


def test_rule_sum_equals_violations(spark):
    ev = FX.evaluated(spark, SF_SMALL)
    per_rule = sum(r["n"] for r in VAL.rule_distribution(ev).collect())
    assert per_rule == R.violations_long(ev).count() == 789
    assert R.consolidate(ev).count() == 660


def test_states_are_final(spark):
    states = VAL.item_state(FX.consumer_evaluated(spark, SF_SMALL))
    counts = {r[0]: r[1] for r in states.groupBy("datapool_state").count().collect()}
    assert set(counts) <= {"DONE", "ERROR"}
    assert sum(counts.values()) == 1500


def test_admission_outcome_figures(spark):
    out = FX.outcomes(spark, SF_SMALL)
    counts = {r[0]: r[1] for r in out.groupBy("cadastro_status").count().collect()}
    assert counts == {"SUCESSO": 1402, "REJEITADO_NEGOCIO": 63, "FALHA_TECNICA": 35}
    pub = VAL.validate_handoff(FX.handoff(spark, SF_SMALL))
    assert pub.where(F.size("violations") > 0).count() == 581
    assert pub.select(F.sum(F.size("violations"))).first()[0] == 683
