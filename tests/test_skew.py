"""Hot groups: one batch or one key holding a third of all rows must give
exact results through the skew-safe paths."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lotguard.functions import constants as K
from lotguard.operators import queue as QU
from lotguard.operators import rules as R
from lotguard.operators.sequence import number_within

N = 30_000


def test_hot_batch_numbering_is_exact(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 97).cast("string")).alias("batch_id"),
        ((F.col("id") * 7919) % 1_000_003).alias("k"),
    )
    got = number_within(df, ["batch_id"], "k", block_width=256)
    want = df.withColumn("row_idx", F.row_number().over(Window.partitionBy("batch_id").orderBy("k")) - 1)
    assert got.select("batch_id", "k", "row_idx").exceptAll(want).count() == 0
    hot = got.where(F.col("batch_id") == "hot")
    assert hot.agg(F.min("row_idx"), F.max("row_idx"), F.count_distinct("row_idx")).first() == (0, N // 3 - 1, N // 3)


def test_hot_blank_and_duplicate_lot_ids(spark):
    lot = F.when(F.col("id") % 3 == 0, F.lit("  ")) \
           .when(F.col("id") % 3 == 1, F.lit("LG-HOT")) \
           .otherwise(F.concat(F.lit("LG-"), F.col("id").cast("string")))
    cols = {c: F.lit("x") for c in K.CONTRACT_COLUMNS}
    cols["lote_id"] = lot
    lots = spark.range(N).select(F.col("id").cast("string").alias("item_id"), F.lit("b").alias("batch_id"),
                                 *[v.alias(k) for k, v in cols.items()])
    ref = spark.range(N).where(F.col("id") % 2 == 0).select(
        F.concat(F.lit("LG-"), F.col("id").cast("string")).alias("lote_id")
    ).unionByName(spark.createDataFrame([("LG-HOT",)], "lote_id string"))
    flagged = R.flag_known(lots, ref)
    assert flagged.count() == N
    counts = {r[0]: r[1] for r in flagged.groupBy("_known").count().collect()}
    # Blank IDs never match; the hot duplicate ID matches; others match when even.
    expected_known = N // 3 + sum(1 for i in range(N) if i % 3 == 2 and i % 2 == 0)
    assert counts[True] == expected_known


def test_hot_item_copies_dedupe(spark):
    items = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("item_id"))
    assert QU.dedupe_items(items).count() == N - N // 3 + 1
    dup = QU.duplicate_items(items).collect()
    assert [(r["item_id"], r["n"]) for r in dup] == [("same", N // 3)]
