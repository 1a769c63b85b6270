"""Sharding by Karmarkar-Karp differencing (operator 6).

Documents go to ``SHARDS`` shards whose bytes are near equal; documents with
equal texts stay together, so the unit is a group of copies and its size the
sum of theirs.

Differencing keeps partial partitions: vectors of one sum for each shard. The
two with the largest spread are combined again and again, the largest sum of
one with the smallest of the other, which leaves their difference. Groups are
dealt by hash into bins of bounded size; each bin is differenced in its task
into one partial partition; these are again differenced in bins, until one is
left. The places of a bin in the result carry down to its groups by joins. The
last vector is the shards' sums.

A group that its bin could not offset is not put into one, but held for the
next level. What it takes to offset all that is held is left over in the bins:
as single groups and as bundles, which put all their members' largest sums
into one shard.

Identifiers, and with them bins and draws, follow from the texts: the same
documents get the same shards under any partitioning.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotguard.llm.common import U64, mix, table, written

SHARDS = 8
#: Groups, or partial partitions, that one task differences at most (on average).
BIN = 20_000
#: Vectors besides its own that a bin leaves over at most; a level holds at
#: most HELD (and at most a quarter of BIN) partial partitions for each bin.
OVER, HELD = 256, 8
#: Share by which more is left over than offsets what is held.
MARGIN = 1.05
#: What tells a held partial partition's identifier from those of new ones.
APART = 1 << 60
#: Rows of all shards that are numbered together.
BUCKET = 200_000
_VECTOR = [f"s{i}" for i in range(SHARDS)]


def difference(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combine partial partitions (rows of SHARDS sums) into one. Returns its
    sums in falling order, and for each row and column the place in them."""
    n, k = vectors.shape
    heap, members = [], {}
    for i in range(n):
        order = np.argsort(-vectors[i], kind="stable")
        sums = tuple(int(x) for x in vectors[i][order])
        heap.append((sums[-1] - sums[0], i, sums))
        members[i] = ("leaf", i, order.tolist())
    heapq.heapify(heap)
    number = n
    while len(heap) > 1:
        _, a, x = heapq.heappop(heap)
        _, b, y = heapq.heappop(heap)
        total = [x[j] + y[k - 1 - j] for j in range(k)]
        order = sorted(range(k), key=lambda j: -total[j])
        sums = tuple(total[j] for j in order)
        # place p of the new one is place order[p] of a, and its mirror of b
        members[number] = ("node", a, b, order)
        heapq.heappush(heap, (sums[-1] - sums[0], number, sums))
        number += 1
    place = np.zeros((n, k), np.int64)
    todo = [(heap[0][1], list(range(k)))]
    while todo:
        at, where = todo.pop()  # where: for each place of ``at``, that in the result
        node = members.pop(at)
        if node[0] == "leaf":
            place[node[1], node[2]] = where
        else:
            _, a, b, order = node
            of_a = [0] * k
            for p, j in enumerate(order):
                of_a[j] = where[p]
            todo += [(a, of_a), (b, of_a[::-1])]
    return np.array(heap[0][2], np.int64), place


def aligned(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bundle partial partitions: largest sums with largest sums. Returns what
    ``difference`` does."""
    order = np.argsort(-vectors, axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(vectors.shape[1]), order.shape), axis=1)
    return np.take_along_axis(vectors, order, axis=1).sum(axis=0), place


def uneven(vectors: np.ndarray) -> np.ndarray:
    """What the sums of each vector have above its smallest one."""
    return vectors.sum(axis=1) - vectors.shape[1] * vectors.min(axis=1)


def _differencer(share: float, over: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """For one bin: a row for each member with its places in a vector of the
    next level (up), and the vectors in rows without member. Members with
    ``share`` of what is uneven are left over, half of the vectors for single
    ones and half for bundles; the others are differenced."""

    def rows(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id", kind="stable")
        vectors, ids = rows[_VECTOR].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        which = np.zeros(len(ids), np.int64)  # the vector of each member; 0: differenced
        drawn = np.argsort(mix(ids.astype(U64)), kind="stable")
        upto = np.cumsum(uneven(vectors)[drawn])
        if share and upto[-1]:
            left = drawn[: np.searchsorted(upto, min(share, 1) * upto[-1]) + 1]
            turn = np.arange(len(left))
            single = over // 2
            which[left] = 1 + np.where(turn < single, turn, single + (turn - single) % (over - single))
        first, parts = int(rows["bin"].iloc[0]) * (over + 1), []
        order = np.argsort(which, kind="stable")
        for of in np.split(order, np.flatnonzero(np.diff(which[order])) + 1):
            sums, place = (aligned if which[of[0]] else difference)(vectors[of])
            part = pd.DataFrame(np.vstack((place, sums)), columns=_VECTOR)
            part.insert(0, "id", pd.array([*ids[of], None], "Int64"))
            part.insert(0, "up", first + int(which[of[0]]))
            parts.append(part)
        return pd.concat(parts)

    return rows


def _one_vector(rows: pd.DataFrame) -> pd.DataFrame:
    sums, _ = difference(rows.sort_values("id", kind="stable")[_VECTOR].to_numpy(np.int64))
    return pd.DataFrame([sums], columns=_VECTOR)


def to_offset(held: DataFrame) -> int:
    """What it takes at most to even out the held partial partitions: they are
    differenced in bins, and what is uneven of each bin's result added up."""
    bins = -(-held.count() // BIN)
    if not bins:
        return 0
    done = held.groupBy(F.pmod(F.xxhash64("id"), F.lit(bins))).applyInPandas(_one_vector, ", ".join(f"{c} long" for c in _VECTOR))
    return done.agg(F.sum(SHARDS * F.greatest(*_VECTOR) - sum((F.col(c) for c in _VECTOR[1:]), F.col(_VECTOR[0])))).first()[0]


def placed(sizes: DataFrame) -> DataFrame:
    """(id, shard) for groups (id, size); ids are unique, from 0 to 2^59."""
    schema = "up long, id long, " + ", ".join(f"{c} long" for c in _VECTOR)
    level = sizes.select("id", F.col("size").alias(_VECTOR[0]), *[F.lit(0).cast("long").alias(c) for c in _VECTOR[1:]])
    least, most = F.least(*_VECTOR), F.greatest(*_VECTOR)
    above = sum((F.col(c) for c in _VECTOR[1:]), F.col(_VECTOR[0])) - SHARDS * least
    over, held_most = (max(min(n, BIN // 4), 1) for n in (OVER, HELD))
    levels = []
    count, last = sizes.count(), None
    while True:
        if last is not None and count >= last:
            raise RuntimeError(f"bins of {BIN} don't lessen {count} partial partitions")
        bins = -(-count // BIN)
        held, share = None, 0.0
        if bins > 1:
            # Fewer than held_most x bins can have so large a part of all that is uneven.
            total = level.agg(F.sum(above)).first()[0]
            large = (most - least) * held_most * bins > total
            held = written(level.filter(large).withColumn("up", F.col("id") + APART), "held")
            level = level.filter(~large)
            rest = total - (held.agg(F.sum(above)).first()[0] or 0)
            share = MARGIN * to_offset(held) / max(rest, 1)
        dealt = level.withColumn("bin", F.pmod(F.xxhash64("id"), F.lit(bins)) if bins > 1 else F.lit(0).cast("long"))
        done = written(dealt.groupBy("bin").applyInPandas(_differencer(share, over), schema), "differenced")
        members, level = done.filter("id is not null"), done.filter("id is null").select(F.col("up").alias("id"), *_VECTOR)
        if bins <= 1:
            levels.append(members)
            break
        same = [F.lit(i).cast("long").alias(c) for i, c in enumerate(_VECTOR)]
        levels.append(members.unionByName(held.select("up", "id", *same)))
        level = level.unionByName(held.select(F.col("up").alias("id"), *_VECTOR))
        count, last = level.count(), count
    # from the last bin down: place j of a bin stands for a shard
    places = levels[-1].select("id", F.array(*_VECTOR).alias("shards"))
    for done in reversed(levels[:-1]):
        upper = places.select(F.col("id").alias("up"), "shards")
        places = done.join(upper, "up").select("id", F.transform(F.array(*_VECTOR), lambda p: F.element_at("shards", (p + 1).cast("int"))).alias("shards"))
    return places.select("id", F.element_at("shards", 1).cast("int").alias("shard"))


def sharded(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, size (UTF-8 bytes and 1), text_crc32, law
    (`bytes`), shard, slot (from 0 in each shard, without gaps), grown_shard
    (null: only another law has it).

    Null and empty texts are equal texts of no bytes. Null keys and repeated
    rows are rows like others. An empty table gives an empty result.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = written(
        docs.select(F.col(f"`{key}`").alias("k"), F.octet_length(t).cast("long").alias("n"), F.crc32(t.cast("binary")).alias("crc"),
                    F.xxhash64(t).alias("h"), F.md5(t.cast("binary")).alias("m")), "rows"
    )
    same = ["h", "m", "n"]
    groups = rows.groupBy(*same).agg(F.sum(F.col("n") + 1).alias("size"))
    # 56 bits of the texts' digests, and a number for those that share them
    head = F.conv(F.substring("m", 1, 14), 16, 10).cast("long")
    alike = F.row_number().over(Window.partitionBy(head).orderBy(*same)) - 1
    groups = written(groups.withColumn("id", F.shiftleft(head, 3) + alike), "groups")
    shards = groups.select("id", *same).join(placed(groups.select("id", "size")), "id").drop("id")
    dealt = rows.join(shards, same)
    return numbered(dealt).select(
        F.col("k").alias(key), (F.col("n") + 1).alias("size"), F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def numbered(rows: DataFrame) -> DataFrame:
    """Slots within the shards. Rows get a number in a written table (so they
    keep it when a task runs again) and are dealt by it to buckets of about
    ``BUCKET`` rows; a row's slot is its place in its bucket after all rows of
    the shard in earlier buckets."""
    rows = written(rows.withColumn("at", F.monotonically_increasing_id()), "dealt")
    buckets = -(-rows.count() // BUCKET) or 1
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("at"), F.lit(buckets)))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = rows.groupBy("shard", "bucket").count().select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    local = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("at"))
    return rows.withColumn("place", local).join(first, ["shard", "bucket"]).withColumn("slot", F.col("first") + F.col("place") - 1)


def op6_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


QUERIES = {"op6_karmarkar_karp": op6_karmarkar_karp}
