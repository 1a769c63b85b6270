"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotguard.llm.common import forget_tables, written
from lotguard.llm.hot_join import hot_join


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every end of the edges (a, b), longs; root is the
    smallest id of the component. Each step is a grouping with partial sums
    and an equi-join in which a centre's rows are split (``hot_join``); its
    edges are a written table."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        # large-star: greater neighbours go to the least one
        both = written(now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("uses")), "least")
        large = written(hot_join(both.filter("b > a"), least, "a", "uses", both.count()).select(F.col("b").alias("a"), F.col("m").alias("b")), "edges")
        forget_tables(both, least)
        # small-star: lesser neighbours and the node go to the least one
        least = written(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("uses")), "least")
        small = hot_join(large, least, "a", "uses", large.count())
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        before, now = now, written(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        forget_tables(before, least, large)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    roots = now.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
