"""Property tests: skew-safe numbering and C1 consolidation against plain
Python models on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.operators import rules as R
from lotguard.operators.sequence import number_within

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(-10_000, 10_000)), min_size=1, max_size=300,
                unique=True),
       st.sampled_from([1, 3, 64, 1 << 14]))
def test_number_within_equals_row_number(spark, rows, width):
    df = spark.createDataFrame(rows, "g string, k long")
    got = number_within(df, ["g"], "k", block_width=width)
    want = df.withColumn("row_idx", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.select("g", "k", "row_idx").exceptAll(want).count() == 0
    assert got.count() == len(rows)


RULES = ["RN02", "RN01", "RN03", "RN05", "RN06", "RN07"]
violation = st.tuples(st.sampled_from(RULES), st.sampled_from(["d1", "d2", "d3"]),
                      st.sampled_from(["a1", "a2"]), st.sampled_from([K.SEV_HIGH, K.SEV_MEDIUM, K.SEV_LOW]))


def model(vs):
    """C1 in plain Python: rules distinct in first-seen order, descriptions
    all, actions distinct in first-seen order, Alta if any Alta else Média."""
    rules = list(dict.fromkeys(v[0] for v in vs))
    return ("; ".join(rules), " | ".join(v[1] for v in vs), " | ".join(dict.fromkeys(v[2] for v in vs)),
            K.SEV_HIGH if any(v[3] == K.SEV_HIGH for v in vs) else K.SEV_MEDIUM)


@SETTINGS
@given(st.lists(st.lists(violation, max_size=6), min_size=1, max_size=40))
def test_consolidation_matches_model(spark, rows):
    data = [(f"i{n}", [(o, *v) for o, v in enumerate(vs)]) for n, vs in enumerate(rows)]
    df = spark.createDataFrame(data, f"item_id string, violations array<{R.VIOLATION_TYPE}>")
    got = {r["item_id"]: (r["regra_violada"], r["descricao_do_erro"], r["acao_recomendada"], r["severidade"])
           for r in R.consolidate(df, keys=["item_id"]).collect()}
    want = {f"i{n}": model(vs) for n, vs in enumerate(rows) if vs}
    assert got == want
