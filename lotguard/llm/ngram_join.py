"""N-gram Jaccard join by PartEnum signatures (operator 10).

A document is the set of its distinct shingles; two documents link when their
Jaccard similarity reaches a limit. ``Likeness`` has the words of a shingle and
the limit; the figures here are the query's, 4 words and 0.85. Sets fall into
bands of sizes; a band ends where a set of its first size could still reach
0.85, so linked sets lie in the same band or in neighbouring ones. Linked sets
of sizes a <= b differ in at most d = 3 (a + b) / 37 shingles.

PartEnum: within a band the shingle domain is dealt by hash into first-level
partitions, each into three cells. With more than d / 2 partitions, two linked
sets differ in one partition by one shingle at most, so two of its three cells
agree: a signature for each pair of cells of each partition is shared by all
linked sets of the band. (Where two cells hold one shingle at most, hardly
anything would be asked of the others, so the third cell joins the signature,
once whole and once without each of its shingles.)

Sharers of a signature are not paired with each other. Each is compared with
the smallest of them, the hub, if a sketch (counts of shingles in 256 cells,
whose difference is a lower bound) does not part them. Those that
don't link with it are compared with the smallest of their own. What is left
are pairs of different components; which of them still could link is found

* for a hub, among the texts near it (up to twice the allowed difference), one
  of them outside the hub's component;
* for a signature, among its texts, one of them far from the hub;

by their sketches, in blocks of bounded size inside a task.

The result is exact: a pair that links shares a signature and is in one
component already, or is among the pairs found, which are all compared.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import U64, bodies_of, forget_shuffles, forget_tables, mix, pair, small_batches, table, text_key, unpacked, written
from lotguard.llm.components import components
from lotguard.llm.hot_join import hot_join
from lotguard.llm.words import segment_hashes

#: Cells of a sketch; texts of a block.
CELLS, BLOCK = 256, 1000
#: Right and left texts of a group of pairs that are compared; bytes of either, packed.
RIGHT, LEFT, PACKED = 256, 512, 1 << 23
#: Bits of a signature. Sharers are compared, so that a chance one does no harm.
BITS = 48
#: Bytes of text handled at once.
SLICE = 1 << 18


class Likeness(NamedTuple):
    """Words of a shingle, and the least similarity of linked sets, most / of."""

    words: int = 4
    most: int = 17
    of: int = 20

    @property
    def apart(self) -> tuple[int, int]:
        """The part of their sizes' sum in which linked sets can differ, as a fraction."""
        return self.of - self.most, self.of + self.most


QUERY = Likeness()


def shingle_sets(texts: list[bytes], like: Likeness = QUERY) -> list[np.ndarray]:
    """The sorted set of shingle identifiers of each text. Under ``like.words``
    words: one shingle of all; without words: none."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    words, at = segment_hashes(data, lower=True)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    cut = np.searchsorted(at, begin)
    grams = words
    for k in range(1, like.words):
        grams = pair(grams[: max(len(words) - k, 0)], words[k:])
    out = []
    for i in range(len(texts)):
        a, b = cut[i], cut[i + 1]
        if b - a >= like.words:
            out.append(np.unique(grams[a : b - like.words + 1]))
        elif b > a:
            whole = U64(b - a)
            for w in words[a:b]:
                whole = pair(np.array([whole], U64), np.array([w], U64))[0]
            out.append(np.array([whole], U64))
        else:
            out.append(words[:0])
    return out


def farthest(a, b, like: Likeness = QUERY):
    """Shingles in which linked sets of sizes a and b can differ at most."""
    n, d = like.apart
    return n * (a + b) // d


def bands(limit: int, like: Likeness = QUERY) -> np.ndarray:
    """Last sizes of the bands up to one that holds ``limit``."""
    last = [0]
    while last[-1] < limit:
        last.append(like.of * (last[-1] + 1) // like.most)
    return np.array([*last, like.of * (last[-1] + 1) // like.most])


def signatures(shingles: np.ndarray, last: np.ndarray, like: Likeness = QUERY) -> np.ndarray:
    """Signatures of one set, in its band and in the next one."""
    size = len(shingles)
    band = int(np.searchsorted(last, size))
    out = []
    for tag in (band, band + 1):
        largest = min(like.of * size // like.most, int(last[tag]))
        if largest < size or (tag > band and largest <= last[band]):
            continue
        parts = int(farthest(last[tag], last[tag], like)) // 2 + 1
        used = farthest(size, largest, like) // 2 + 1
        if tag == band:  # a smaller partner from the band before is nearer
            used = min(max(used, farthest(size, size, like) // 2 + 1), parts)
        if parts == 1 and farthest(last[tag], last[tag], like) == 0:  # only equal sets link
            out.append(mix(np.array([mix(shingles).sum() + U64(tag)], U64)))
            continue
        value = mix(shingles ^ U64(tag * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        cell = ((value >> U64(32)) * U64(3 * parts) >> U64(32)).astype(np.int64)
        keep = cell < 3 * used
        cell, value = cell[keep], mix(value[keep])
        sums = np.zeros(3 * used, U64)
        np.add.at(sums, cell, value)
        count = np.bincount(cell, minlength=3 * used)
        others = np.repeat(sums.reshape(-1, 3).sum(axis=1, dtype=U64), 3) - sums
        known = np.repeat(count.reshape(-1, 3).sum(axis=1), 3) - count
        name = (np.arange(3 * used, dtype=U64) + U64(tag << 32)) * U64(0xC2B2AE3D27D4EB4F)
        out.append(mix(others[known > 1] + mix(name[known > 1])))
        for c in np.flatnonzero(known <= 1):
            rest = value[cell == c]
            variants = np.concatenate(([sums[c]], sums[c] - rest)).astype(U64)
            out.append(mix(others[c] + mix(name[c : c + 1]) + mix(variants + U64(1))))
    return np.unique(np.concatenate(out) >> U64(64 - BITS)) if out else np.zeros(0, U64)


def _signature_rows(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = bands(1, like)
        for batch in small_batches(batches, "body", SLICE):
            sets = shingle_sets(batch.column("body").to_pylist(), like)
            if (most := max(map(len, sets))) * 2 > last[-1]:
                last = bands(most * 2, like)
            found = [signatures(s, last, like) if len(s) else s for s in sets]
            count = np.array([len(f) for f in found])
            row = np.repeat(np.arange(len(found)), count)
            keys = [np.asarray(batch.column(c))[row] for c in ("t_hash", "t_len")]
            yield pa.record_batch(
                [pa.array(np.concatenate(found).view(np.int64)), *map(pa.array, keys)], names=["sig", "t_hash", "t_len"]
            )

    return rows


def _sharers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by signature and text: the signatures with two texts
    at least, with a row for each text, and the first text as the hub."""
    names = ["sig", "t_hash", "t_len", "hub_hash", "hub_len"]
    held = [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int64, np.int32, bool)]

    def close(cols: list[np.ndarray], whole: bool) -> pa.RecordBatch | None:
        """Take all rows but the last, whose next one isn't known yet."""
        nonlocal held
        sig, h, n, hub_h, hub_n, starts = cols
        together = ~starts.copy()
        together[:-1] |= ~starts[1:]
        upto = len(sig) if whole else max(len(sig) - 1, 0)
        held = [c[upto:] for c in cols]
        keep = np.flatnonzero(together[:upto])
        return pa.record_batch([pa.array(c[keep]) for c in (sig, h, n, hub_h, hub_n)], names=names) if len(keep) else None

    for batch in batches:
        if not batch.num_rows:
            continue
        sig, h, n = (np.asarray(batch.column(c)) for c in ("sig", "t_hash", "t_len"))
        before = held
        if len(before[0]):
            psig, ph, pn = (np.concatenate((before[i][-1:], c[:-1])) for i, c in enumerate((sig, h, n)))
        else:
            psig, ph, pn = (np.concatenate((c[:1], c[:-1])) for c in (sig, h, n))
        starts = sig != psig
        same = ~starts & (h == ph) & (n == pn)  # copies of a text
        if not len(before[0]):
            starts[0], same[0] = True, False
        keep = np.flatnonzero(~same)
        sig, h, n, starts = sig[keep], h[keep], n[keep], starts[keep]
        if not len(sig):
            continue
        lead = np.maximum.accumulate(np.where(starts, np.arange(len(sig)), -1))
        hub_h = np.where(lead >= 0, h[lead], before[3][-1] if len(before[0]) else 0)
        hub_n = np.where(lead >= 0, n[lead], before[4][-1] if len(before[0]) else 0).astype(np.int32)
        cols = [np.concatenate(x) for x in zip(before, (sig, h, n, hub_h, hub_n, starts), strict=True)]
        if (out := close(cols, False)) is not None:
            yield out
    if len(held[0]) and (out := close(held, True)) is not None:
        yield out


def _sketches(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in unpacked(batches, "body", SLICE):
            sets = shingle_sets(texts, like)
            cells = [np.minimum(np.bincount((mix(x ^ U64(CELLS)) >> U64(56)).astype(np.int64), minlength=CELLS), 255).astype(np.uint8).tobytes() for x in sets]
            yield pa.record_batch(
                [batch.column("t_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(cells, pa.binary())], names=["t_id", "size", "sketch"]
            )

    return rows


def _cells(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int16)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """At least how many shingles set a and b apart."""
    for batch in batches:
        least = np.abs(_cells(batch.column("a_sketch")) - _cells(batch.column("b_sketch"))).sum(axis=1, dtype=np.int64)
        yield pa.record_batch([*(batch.column(c) for c in ("a", "b", "a_size", "b_size")), pa.array(least)], names=["a", "b", "a_size", "b_size", "least"])


def _compare(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by group, the right texts of each before the left ones."""
        n, d = like.apart
        group, right = None, {}
        for batch, texts in unpacked(batches, "body", SLICE):
            rows = []
            sets = shingle_sets(texts, like)
            for t, x, partners, *key in zip(batch.column("t_id").to_pylist(), sets, batch.column("partners").to_pylist(), *(batch.column(c).to_pylist() for c in ("g", "i", "j")), strict=True):
                if key != group:
                    group, right = key, {}
                if partners is None:
                    right[t] = x
                for other in partners or ():
                    y = right[other]
                    both = len(x) + len(y)
                    apart = both - 2 * len(np.intersect1d(x, y, assume_unique=True))
                    rows.append((t, other, len(x), len(y), apart, both > 0 and d * apart <= n * both, apart <= 2 * farthest(len(x), len(y), like)))
            if rows:
                kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["a", "b", "a_size", "b_size", "apart", "linked", "close"])

    return rows


def grouped(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs (a, b) with a group (g, i, j) each, so that a text with several
    right ones is mostly in one group with them all. A group has about
    ``RIGHT`` right texts and ``LEFT`` left ones at most, or ``PACKED`` bytes
    of either; ``sizes``: t_id, packed."""
    used = pairs.groupBy("b").agg(F.count("*").alias("n"))
    used = pairs.join(used, "b").select("a", "b", F.struct("n", "b").alias("top"))
    best = used.groupBy("a").agg(F.max("top").alias("top"))  # the right text that most have
    g = written(pairs.join(best, "a").groupBy("b").agg(F.max("top")["b"].alias("g")), "groups")
    placed = written(pairs.join(g, "b"), "grouped")

    def parts(side: str, most: int, name: str) -> DataFrame:
        one = placed.select("g", F.col(side).alias("t_id")).distinct().join(sizes, "t_id")
        return one.groupBy("g").agg(F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("packed") / PACKED)).alias(name))

    parted = placed.join(parts("b", RIGHT, "i").join(parts("a", LEFT, "j"), "g"), "g")
    place = [F.pmod(F.xxhash64(x), F.col(n)).cast("int").alias(n) for x, n in (("b", "i"), ("a", "j"))]
    out = written(parted.select("a", "b", "g", *place), "grouped-pairs")
    forget_tables(g, placed)
    return out


def compared(pairs: DataFrame, texts: DataFrame, like: Likeness = QUERY) -> DataFrame:
    """Exact comparison of distinct pairs (a, b) of packed texts (t_id, body, packed):
    sizes, shingles that set them apart, linked, close (apart by at most twice
    what a link allows). A text travels once for a group, not for each pair."""
    placed, by = grouped(pairs, texts.select("t_id", "packed")), ["g", "i", "j"]
    left = placed.groupBy(F.col("a").alias("t_id"), *by).agg(F.collect_list("b").alias("partners"))
    right = placed.select(F.col("b").alias("t_id"), *by).distinct().withColumn("partners", F.lit(None).cast("array<bigint>"))
    rows = left.unionByName(right).join(texts.select("t_id", "body"), "t_id")
    rows = rows.repartition(*by).sortWithinPartitions(*by, F.col("partners").isNotNull())
    return rows.mapInArrow(_compare(like), "a long, b long, a_size long, b_size long, apart long, linked boolean, close boolean")


def bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes and a lower bound of what sets them apart."""
    left, right = (nodes.select(*(F.col(c).alias(f"{s}_{c}") for c in ("size", "sketch")), F.col("t_id").alias(s)) for s in "ab")
    return pairs.join(left, "a").join(right, "b").mapInArrow(_bounded, "a long, b long, a_size long, b_size long, least long")


def _blocks(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by group and pair of blocks: pairs of unlike components,
        one of them marked, that the sketches don't part."""
        n, d = like.apart
        held: list[pa.RecordBatch] = []

        def pairs(rows: pa.Table) -> pa.RecordBatch:
            t, root, size, marked, own = (np.asarray(rows.column(c)) for c in ("t_id", "root", "size", "marked", "own"))
            one = rows.column("i")[0] == rows.column("j")[0]
            cells = _cells(rows.column("sketch").combine_chunks())
            out: list[tuple[int, int]] = []
            for k in np.flatnonzero(marked):
                other = np.flatnonzero((root != root[k]) & (~marked | (t > t[k])) & (one | (own != own[k])))
                for c in range(0, len(other), 4096):
                    o = other[c : c + 4096]
                    o = o[d * np.abs(cells[o] - cells[k]).sum(axis=1, dtype=np.int64) <= n * (size[o] + size[k])]
                    out += [(min(t[k], t[x]), max(t[k], t[x])) for x in o]
            return pa.record_batch([pa.array([int(p[i]) for p in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

        def groups(rows: pa.Table) -> np.ndarray:
            key = [np.asarray(rows.column(c)) for c in ("kind", "group", "i", "j")]
            return np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], axis=0))))

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch])
            first = groups(rows)
            for a, b in zip(first, first[1:], strict=False):
                yield pairs(rows.slice(a, b - a))
            held = rows.slice(first[-1]).combine_chunks().to_batches()
        if held:
            yield pairs(pa.Table.from_batches(held))

    return rows


def _sizes(like: Likeness) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", SLICE):
            sizes = [len(s) for s in shingle_sets(batch.column("body").to_pylist(), like)]
            cols = [batch.column(c) for c in ("k", "t_hash", "t_len")]
            yield pa.record_batch([*cols, pa.array(sizes, pa.int64())], names=["k", "t_hash", "t_len", "n_shingles"])

    return rows


def linked_texts(docs: DataFrame, text: str = "text", like: Likeness = QUERY) -> tuple[DataFrame, DataFrame]:
    """Texts that share a signature with an unlike text (t_id, t_hash, t_len),
    and links (a, b) between them, enough to join every component."""
    bodies = docs.select(*text_key(F.col(f"`{text}`")), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
    found = bodies.mapInArrow(_signature_rows(like), "sig long, t_hash long, t_len int")
    shared = written(
        found.repartition("sig").sortWithinPartitions("sig", "t_hash", "t_len")
        .mapInArrow(_sharers, "sig long, t_hash long, t_len int, hub_hash long, hub_len int"), "sharers"
    )
    forget_shuffles(docs.sparkSession)  # the signatures: most of what is moved
    nodes = written(shared.select("t_hash", "t_len").distinct().withColumn("t_id", F.monotonically_increasing_id()), "nodes")
    texts = written(bodies_of(bodies, nodes, ["t_hash", "t_len"]).select("t_id", "body", F.octet_length("body").alias("packed")), "texts")
    forget_shuffles(docs.sparkSession)
    sketched = written(texts.select("t_id", "body").mapInArrow(_sketches(like), "t_id long, size long, sketch binary"), "sketches")
    key, hub_key = ["t_hash", "t_len"], ["hub_hash", "hub_len"]
    hubs = nodes.select(F.col("t_hash").alias("hub_hash"), F.col("t_len").alias("hub_len"), F.col("t_id").alias("b"))
    pairs = shared.filter("t_hash <> hub_hash or t_len <> hub_len").select(*key, *hub_key).distinct()
    pairs = written(pairs.join(nodes.withColumnRenamed("t_id", "a"), key).join(hubs, hub_key), "pairs")

    n, d = like.apart
    allowed = F.expr(f"{n} * (a_size + b_size) div {d}")
    first = written(bounded(pairs.select("a", "b"), sketched), "first")
    likely = written(first.filter(F.col("least") <= 2 * allowed).select("a", "b"), "likely")
    forget_shuffles(docs.sparkSession)
    near = written(compared(likely, texts, like), "near")
    forget_tables(likely)
    forget_shuffles(docs.sparkSession)
    links = near.filter("linked").select("a", "b")
    # What a text is to the hub of a signature that it shares; most are linked
    # with it and near, and need no further look.
    kinds = first.select("a", "b").join(near.select("a", "b", "a_size", "b_size", "apart", "linked", "close"), ["a", "b"], "left").select(
        "a", "b", F.coalesce("linked", F.lit(False)).alias("linked"), (~F.coalesce("close", F.lit(False))).alias("marked"),
        F.expr(f"coalesce({d} * apart >= {n} * (2 * b_size - a_size), true)").alias("partner"),
    ).filter("not linked or marked or partner")
    loose = shared.join(pairs.join(kinds, ["a", "b"]).drop("b"), [*key, *hub_key])
    loose = written(loose.select("sig", F.col("a").alias("t_id"), "linked", "marked", "partner"), "loose")
    # Texts that share a signature and don't link with its hub: the smallest of them is a second hub.
    forget_tables(shared, pairs, first)
    left = loose.filter("not linked").select("sig", "t_id")
    second = left.groupBy("sig").agg(F.min("t_id").alias("b"), F.count("*").alias("n")).filter("n > 1").select("sig", "b")
    tried = left.join(second, "sig").filter("t_id <> b").select(F.col("t_id").alias("a"), "b").distinct()
    tried = written(bounded(tried, sketched).filter(F.col("least") <= allowed).select("a", "b"), "tried")
    more = compared(tried, texts, like)
    links = written(links.unionByName(more.filter("linked").select("a", "b")), "links")
    forget_shuffles(docs.sparkSession)
    roots = components(links)
    found = unlike_pairs(loose, near, roots, sketched, like)
    found = written(bounded(found, sketched).filter(F.col("least") <= allowed).select("a", "b"), "found")
    last = compared(found, texts, like)
    every = written(links.unionByName(last.filter("linked").select("a", "b")), "links")
    forget_tables(texts, sketched, near, loose, tried, found, links)
    forget_shuffles(docs.sparkSession)
    return nodes, every


def rooted(rows: DataFrame, roots: DataFrame, of: str, name: str) -> DataFrame:
    """``rows`` with the root of column ``of``; a text without links is its own."""
    return rows.join(roots.select(F.col("id").alias(of), F.col("root").alias(name)), of, "left").withColumn(name, F.coalesce(name, of))


def unlike_pairs(loose: DataFrame, near: DataFrame, roots: DataFrame, sketched: DataFrame, like: Likeness) -> DataFrame:
    """Pairs of different components that could link: among the texts near a
    hub, with one outside the hub's component; among a signature's texts, with
    one far from the hub (a partner near the hub is then apart from it by
    that part of 2 |hub| - its size at least)."""
    by_hub = rooted(rooted(near.filter("close"), roots, "a", "root"), roots, "b", "hub_root")
    by_hub = by_hub.select(F.lit(0).alias("kind"), F.col("b").alias("group"), F.col("a").alias("t_id"), "root", (F.col("root") != F.col("hub_root")).alias("marked"))
    by_sig = rooted(loose.filter("marked or partner"), roots, "t_id", "root")
    rows = written(by_hub.unionByName(by_sig.select(F.lit(1).alias("kind"), F.col("sig").alias("group"), "t_id", "root", "marked")), "unlike")
    several = rows.groupBy("kind", "group").agg(F.count("*").alias("n"), F.max("marked").alias("any"), F.min("root").alias("x"), F.max("root").alias("y"))
    several = several.filter("any and x <> y").select("kind", "group", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("t_id"), F.col("blocks")).cast("int")
    dealt = rows.join(several, ["kind", "group"]).withColumn("b", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = ["kind", "group", F.least("b", "other").alias("i"), F.greatest("b", "other").alias("j"), (F.col("b") <= F.col("other")).alias("own")]
    dealt = dealt.select(*block, "t_id", "root", "marked").join(sketched, "t_id")
    by = ["kind", "group", "i", "j"]
    return dealt.repartition(*by).sortWithinPartitions(*by, "t_id").mapInArrow(_blocks(like), "a long, b long").distinct()


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = QUERY) -> DataFrame:
    """A row for each document: key, t_hash, t_len, n_shingles, component_id
    (the smallest key reachable by links, the document's own included).

    Null texts count as empty; documents without words link with nothing and
    keep their own key. Copies and repeated rows link (similarity 1). A null
    key names no component: it is passed over for the smallest, and the result
    is null where a component has no other. An empty table gives an empty one.
    """
    nodes, links = linked_texts(docs, text, like)
    roots = components(links)
    placed = nodes.join(roots.withColumnRenamed("id", "t_id"), "t_id", "left").select("t_hash", "t_len", F.coalesce("root", "t_id").alias("root"))
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    sized = docs.select(F.col(f"`{key}`").alias("k"), *text_key(t), t.cast("binary").alias("body")).mapInArrow(
        _sizes(like), "k long, t_hash long, t_len int, n_shingles long"
    )
    rows = written(
        sized.join(placed, ["t_hash", "t_len"], "left").select(
            "k", "t_hash", "t_len", "n_shingles",
            # a component: its root, or else the text itself
            F.coalesce("root", "t_hash").alias("c1"), F.when(F.col("root").isNull(), F.col("t_len")).otherwise(-1).alias("c2"),
        ), "placed"
    )
    some = rows.filter("n_shingles > 0")
    least = written(some.groupBy("c1", "c2").agg(F.min("k").alias("component_id"), F.count("*").alias("uses")), "least")
    found = hot_join(some, least, ["c1", "c2"], "uses", rows.count())
    every = found.unionByName(rows.filter("n_shingles = 0").withColumn("component_id", F.col("k")))
    return every.select(F.col("k").alias(key), "t_hash", "t_len", "n_shingles", "component_id", "c1", "c2")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = QUERY) -> DataFrame:
    """The documents without those that a component has besides its first (the
    smallest key, then the smallest text key; null keys last; one of repeated
    rows). Documents without words all stay."""
    by = ["none", "k", "t_hash", "t_len"]
    none, k = F.col(f"`{key}`").isNull().alias("none"), F.coalesce(F.col(f"`{key}`"), F.lit(0)).alias("k")
    rows = joined(docs, key, text, like).filter("n_shingles > 0").select(none, k, "t_hash", "t_len", "c1", "c2")
    rows = written(rows.groupBy(*by, "c1", "c2").agg(F.count("*").alias("times")), "members")
    firsts = written(rows.groupBy("c1", "c2").agg(F.min(F.struct(*by)).alias("o")).select("o.*"), "firsts")
    # What goes is mostly less than what stays: the documents need not be sorted for it.
    again = written(firsts.join(rows.filter("times > 1"), by, "left_semi"), "repeated-firsts")
    gone = written(rows.select(*by).join(firsts, by, "left_anti").unionByName(again), "gone")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), none, k, *text_key(F.col(f"`{text}`")))
    once = keyed.join(again, by, "left_semi").groupBy(*by).agg(F.first("row").alias("row"))
    return keyed.join(gone, by, "left_anti").select("row").unionByName(once.select("row")).select("row.*")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


QUERIES = {"op10_ngram_jaccard_join": op10_ngram_jaccard_join}
