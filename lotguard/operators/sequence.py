"""Skew-safe dense numbering inside groups.

``row_number() over (partition by batch order by key)`` sends a whole batch to
one task; if one batch holds a third of all rows that task holds a third of the
data. Here the order key is cut into fixed-width blocks. Each (batch, block)
group has at most ``block_width`` distinct keys, its size is counted with a
partial aggregate, block offsets are a running sum over the small count table
(at most key_span / block_width rows per batch), and the final number is
offset + local row number. Only one shuffle moves full rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK_WIDTH = 1 << 14


def number_within(
    df: DataFrame,
    by: list[str],
    order: str,
    out: str = "row_idx",
    block_width: int = DEFAULT_BLOCK_WIDTH,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Add ``out`` = 0-based position of each row inside its ``by`` group,
    ordered by the integer column ``order`` then ``tiebreak`` columns."""
    blk = "_seq_blk"
    blocked = df.withColumn(blk, F.floor(F.col(order) / F.lit(block_width)).cast("long"))
    counts = blocked.groupBy(*by, blk).agg(F.count(F.lit(1)).alias("_seq_n"))
    before = Window.partitionBy(*by).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, blk, F.coalesce(F.sum("_seq_n").over(before), F.lit(0)).alias("_seq_off"))
    local = Window.partitionBy(*by, blk).orderBy(order, *(tiebreak or []))
    numbered = blocked.withColumn("_seq_loc", F.row_number().over(local))
    return (
        numbered.join(offsets, [*by, blk])
        .withColumn(out, (F.col("_seq_off") + F.col("_seq_loc") - 1).cast("int"))
        .drop(blk, "_seq_off", "_seq_loc")
    )


def next_within(
    df: DataFrame,
    by: list[str],
    order: str,
    columns: list[str],
    out: str = "next",
    block_width: int = DEFAULT_BLOCK_WIDTH,
) -> DataFrame:
    """Add ``out``: a struct of ``columns`` of the row that follows in the
    ``by`` group by the integer column ``order`` (unique in the group), null for
    the last one. A window only runs inside a block of the order; what follows
    a block's last row comes from the first rows of the blocks."""
    blk = "_nx_blk"
    item = F.struct(*columns)
    blocked = df.withColumn(blk, F.floor(F.col(order) / F.lit(block_width)).cast("long"))
    firsts = blocked.groupBy(*by, blk).agg(F.min_by(item, order).alias("_nx_first"))
    after = Window.partitionBy(*by).orderBy(blk)
    edges = firsts.select(*by, blk, F.lead("_nx_first").over(after).alias("_nx_edge"))
    local = Window.partitionBy(*by, blk).orderBy(order)
    return (
        blocked.withColumn("_nx_in", F.lead(item).over(local))
        .join(edges, [*by, blk])
        .withColumn(out, F.coalesce("_nx_in", "_nx_edge"))
        .drop(blk, "_nx_in", "_nx_edge")
    )
