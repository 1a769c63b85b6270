"""Benchmark decontamination by greedy string tiling (operator 4).

A document and a benchmark item are compared if they share enough seeds, runs
of ``SEED`` = 5 equal tokens, for what must be covered. Greedy string tiling then marks, again and again,
the longest match of unmarked tokens of both that is at least a seed long, so
that an item's passages are found in whatever order the document has them.
Matches are found by running Karp-Rabin: hashes of the windows of one length,
each from the running sums before and behind it, are looked up among those of
the other text, for a length that shrinks from long to the seed. An item is
found in a document when tiles cover at least ``COVER`` of its tokens; a
document with any such item is contaminated. An item of fewer tokens than a
seed is found in documents that consist of the same tokens.

Tokens are words; in scripts without spaces (Chinese, Japanese, Thai, Lao,
Myanmar, Khmer) each character is one.

Seeds are found without moving the corpus: a bitmap of the benchmark's seed
hashes, of a fixed size whatever the benchmark's, goes to the tasks; windows
that it lets pass are joined with the benchmark's seeds by hash (so what the
bitmap lets pass wrongly drops out, and a benchmark of any size works). A pair
that reaches the cover shares k seeds of the item's u, so one of the u - k + 1
that fewest documents have: only these propose pairs, and a seed that many
documents and items share brings hardly any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotguard.llm.common import U64, bitmap, in_bitmap, list_array, pair, powers, ranges, small_batches, table, text_key, written
from lotguard.llm.words import SPACE, segment_hashes

#: Tokens of a seed and of the shortest tile; covered share of an item's tokens.
SEED, COVER = 5, 0.5
#: log2 of the bits of the seed bitmap (16 MiB).
BITS = 27
SLICE = 1 << 18
#: Tokens are separated by ASCII white space and punctuation; A to Z is lower-cased.
BREAKS = SPACE.copy()
BREAKS[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


#: Odd multiplier of the running hashes, and its inverse modulo 2^64.
_TIMES = 0x9E3779B97F4A7C15
_BACK = pow(_TIMES, -1, 1 << 64)


def seeds(words: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``length`` words within an owner's words, and
    where they begin."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[length - 1 :])
    value = words[at]
    for k in range(1, length):
        value = pair(value, words[at + k])
    return value, at


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    alone = _spaceless(data)
    if len(alone):  # a space on either side of each such character
        places = np.sort(np.concatenate((alone, alone + 3)))
        data = np.insert(data, places, 0x20)
        begin = begin + np.searchsorted(places, begin, side="left")
    words, at = segment_hashes(data, BREAKS, lower=True)
    return words, np.searchsorted(begin, at, side="right") - 1


def _spaceless(data: np.ndarray) -> np.ndarray:
    """Where characters of scripts without spaces begin (three bytes each)."""
    at = np.flatnonzero((data >= 0xE0) & (data <= 0xE9))
    at = at[at + 2 < len(data)]
    lead, second = data[at], data[at + 1]
    thai_lao = (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
    myanmar_khmer = (lead == 0xE1) & (((second >= 0x80) & (second <= 0x82)) | (second == 0x9E) | (second == 0x9F))
    return at[thai_lao | myanmar_khmer | (lead > 0xE3) | ((lead == 0xE3) & (second >= 0x81))]


def whole_hashes(words: np.ndarray, owner: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """For each owner with words, but fewer than a seed, the hash of all."""
    size = np.bincount(owner, minlength=many)
    short = np.flatnonzero((size > 0) & (size < SEED))
    first = np.searchsorted(owner, short)
    value = np.zeros(len(short), U64)
    for k in range(SEED - 1):
        more = size[short] > k
        value[more] = pair(value[more] + U64(1), words[first[more] + k])
    return short, value


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each item its tokens, and its seeds' hashes with their places, or the
    hash of all its tokens."""
    for batch in small_batches(batches, "body", SLICE):
        words, owner = _tokens(batch.column("body").to_pylist())
        value, at = seeds(words, owner, SEED)
        n = np.bincount(owner, minlength=batch.num_rows)
        m = np.bincount(owner[at], minlength=batch.num_rows)
        short, whole = whole_hashes(words, owner, batch.num_rows)
        wholes: list[int | None] = [None] * batch.num_rows
        for i, h in zip(short.tolist(), whole.view(np.int64).tolist(), strict=True):
            wholes[i] = h
        yield pa.record_batch(
            [batch.column("item_id"), list_array(pa.array(words.view(np.int64)), n), list_array(pa.array(value.view(np.int64)), m), pa.array(wholes, pa.int64())],
            names=["item_id", "tokens", "seeds", "whole"],
        )


def _seed_hits(shared) -> object:
    """The documents' windows that the bitmap lets pass, with their token hashes;
    of documents of fewer tokens than a seed, the hash of all (pos -1)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in small_batches(batches, "body", SLICE):
            words, owner = _tokens(batch.column("body").to_pylist())
            value, at = seeds(words, owner, SEED)
            hit = np.flatnonzero(in_bitmap(bits, value, BITS))
            at, value = at[hit], value[hit]
            start = np.searchsorted(owner, owner[at])
            keys = [pa.array(np.asarray(batch.column(c))[owner[at]]) for c in ("t_hash", "t_len")]
            window = words[ranges(at, np.full(len(at), SEED))]
            yield pa.record_batch(
                [*keys, pa.array((at - start).astype(np.int32)), pa.array(value.view(np.int64)), list_array(pa.array(window.view(np.int64)), np.full(len(at), SEED))],
                names=["t_hash", "t_len", "pos", "seed", "tokens"],
            )
            short, whole = whole_hashes(words, owner, batch.num_rows)
            if len(short):
                none = list_array(pa.array([], pa.int64()), np.zeros(len(short), np.int64))
                keys = [batch.column(c).take(pa.array(short)) for c in ("t_hash", "t_len")]
                yield pa.record_batch([*keys, pa.array(np.full(len(short), -1, np.int32)), pa.array(whole.view(np.int64)), none], names=["t_hash", "t_len", "pos", "seed", "tokens"])

    return rows


def tile(doc: np.ndarray, place: np.ndarray, item: np.ndarray) -> int:
    """Greedy string tiling of an item's tokens with a document's, of which
    those at ``place`` (ascending) can be in a match; tokens covered.

    Running Karp-Rabin: windows of length s of unmarked tokens are looked up
    by their hashes, differences of running sums; matches are extended; a match of twice s or more restarts the
    search at its length, else the longest are marked (by place) and looked
    for again; where none is left, s halves down to the seed length.
    """
    # Tokens that do not adjoin in the document must not in the copy: part them.
    parts = np.concatenate(([0], np.cumsum(np.diff(place) != 1))) if len(place) else place
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    covered, s = 0, max(SEED, len(item) // 2)
    most = max(len(doc), len(item))
    times, back = powers(_TIMES, most), powers(_BACK, most)
    sums_d, sums_i = (np.concatenate((np.zeros(1, U64), np.cumsum(t * times[: len(t)], dtype=U64))) for t in (doc, item))

    def windows(tokens: np.ndarray, sums: np.ndarray, free: np.ndarray, part: np.ndarray | None, s: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(tokens) - s + 1
        if n <= 0:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        taken = np.concatenate(([0], np.cumsum(~free)))
        ok = taken[s:] == taken[:n]
        if part is not None:
            ok &= part[:n] == part[s - 1 :]
        at = np.flatnonzero(ok)
        return (sums[at + s] - sums[at]) * back[at], at

    while True:
        wi, ai = windows(item, sums_i, free_i, None, s)
        wd, ad = windows(doc, sums_d, free_d, parts, s)
        order = np.argsort(wi, kind="stable")
        left, right = np.searchsorted(wi[order], wd, "left"), np.searchsorted(wi[order], wd, "right")
        count = right - left
        d, i = np.repeat(ad, count), ai[order][ranges(left, count)]
        # Matches on one diagonal that follow each other are one longer match.
        diag = np.lexsort((d, i - d))
        d, i = d[diag], i[diag]
        new = np.concatenate(([True], (np.diff(i - d) != 0) | (np.diff(d) != 1))) if len(d) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(d))) + s - 1
        d, i = d[first], i[first]
        longest = int(length.max()) if len(length) else 0
        if longest >= 2 * s:
            s = longest
            continue
        for k in np.lexsort((i, d)):  # the longest now, the others when looked for again
            a, b, n = int(d[k]), int(i[k]), int(length[k])
            if n == longest and free_d[a : a + n].all() and free_i[b : b + n].all() and (doc[a : a + n] == item[b : b + n]).all():
                free_d[a : a + n] = free_i[b : b + n] = False
                covered += n
        if not longest:
            if s == SEED:
                return covered
            s = max(SEED, s // 2)


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for pos, tokens, item in zip(batch.column("pos"), batch.column("doc_tokens"), batch.column("tokens"), strict=True):
            # the seeds' tokens, put together by place in the document
            at = (np.asarray(pos.values)[:, None] + np.arange(SEED)).ravel()
            place, one = np.unique(at, return_index=True)
            found.append(tile(np.asarray(tokens.values).view(U64)[one], place, np.asarray(item.values).view(U64)))
        sizes = [len(t) for t in batch.column("tokens")]
        yield pa.record_batch(
            [*(batch.column(c) for c in ("t_hash", "t_len", "i")), pa.array(sizes, pa.int64()), pa.array(found, pa.int64())],
            names=["t_hash", "t_len", "i", "n_tokens", "n_covered"],
        )


def tilings(docs: DataFrame, benchmark: DataFrame, text: str = "text", cover: float = COVER) -> DataFrame:
    """A row for each pair of a distinct text and an item that could reach
    ``cover`` by the seeds they share (0: for each that share one): t_hash,
    t_len (see ``text_key``), item_id, n_tokens of the item, n_covered. Items
    with equal texts are rows of their own; item ids are of any kind, null
    ones stay null."""
    spark = docs.sparkSession
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("body")
    kind = benchmark.schema["item_id"].dataType.simpleString()
    items = benchmark.select("item_id", body).mapInArrow(_item_rows, f"item_id {kind}, tokens array<long>, seeds array<long>, whole long")
    items = written(items.withColumn("i", F.monotonically_increasing_id()), "items")
    shared = spark.sparkContext.broadcast(bitmap(items.select(F.explode("seeds")), BITS).tobytes())
    t = F.col(f"`{text}`")
    bodies = docs.select(*text_key(t), F.coalesce(t, F.lit("")).cast("binary").alias("body"))
    key = ["t_hash", "t_len"]
    found = bodies.mapInArrow(_seed_hits(shared), "t_hash long, t_len int, pos int, seed long, tokens array<long>")
    found = written(found.dropDuplicates([*key, "pos"]), "windows")  # copies of a text tile alike
    places = written(items.select("i", F.size("tokens").alias("n"), F.size(F.array_distinct("seeds")).alias("many"), F.explode(F.array_distinct("seeds")).alias("seed")), "seeds")
    hits = written(found.filter("pos >= 0").join(places.select("seed").distinct(), "seed", "left_semi"), "hits")
    # an item's seeds from the rarest on, as far as a pair can lack them
    often = hits.groupBy("seed").agg(F.count("*").alias("often"))
    need = F.greatest(F.ceil(F.ceil(F.col("n") * cover) / SEED), F.lit(1))
    ranked = places.join(often, "seed", "left").withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy(F.coalesce("often", F.lit(0)), "seed")))
    rare = written(ranked.filter(F.col("r") <= F.col("many") - need + 1).filter("often is not null").select("i", "seed"), "rare-seeds")
    proposed = written(hits.select(*key, "seed").join(rare, "seed").select(*key, "i").distinct(), "proposed")
    pairs = proposed.join(hits, key).join(places.select("i", "seed"), ["i", "seed"])
    pairs = pairs.groupBy(*key, "i").agg(F.collect_list(F.struct("pos", "tokens")).alias("hits"))
    flat = pairs.select(*key, "i", F.col("hits.pos").alias("pos"), F.flatten("hits.tokens").alias("doc_tokens"))
    both = flat.join(items.select("i", "tokens"), "i").select(*key, "i", "pos", "doc_tokens", "tokens")
    tiled = both.mapInArrow(_tiled, "t_hash long, t_len int, i long, n_tokens long, n_covered long")
    # items and texts that are too short for a seed, by all of their tokens
    brief = items.filter("whole is not null").select("i", F.col("whole").alias("seed"), F.size("tokens").cast("long").alias("n_tokens"))
    equal = found.filter("pos < 0").join(brief, "seed").select(*key, "i", "n_tokens", F.col("n_tokens").alias("n_covered"))
    return tiled.unionByName(equal).join(items.select("i", "item_id"), "i").select(*key, "item_id", "n_tokens", "n_covered")


def found_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", cover: float = COVER) -> DataFrame:
    """Distinct texts with an item found: t_hash, t_len, items (ids, sorted),
    most_covered (the largest covered share)."""
    pairs = tilings(docs, benchmark, text, cover).withColumn("share", F.col("n_covered") / F.col("n_tokens"))
    found = pairs.filter(F.col("share") >= cover).groupBy("t_hash", "t_len")
    return found.agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("most_covered"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: the key (as it is), contaminated, items (ids of
    the benchmark items found, sorted), most_covered (0 if none is found).

    Null and empty texts match nothing; copies
    have equal results; further columns are not read; without documents the
    result is empty, without items all documents are clean.
    """
    found = written(found_items(docs, benchmark, text), "found")
    rows = docs.select(F.col(f"`{key}`").alias(key), *text_key(F.col(f"`{text}`")))
    return rows.join(found, ["t_hash", "t_len"], "left").select(
        key, F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast(found.schema["items"].dataType)).alias("items"), F.coalesce("most_covered", F.lit(0.0)).alias("most_covered"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents in which no item is found, with their columns."""
    found = written(found_items(docs, benchmark, text).select("t_hash", "t_len"), "found")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *text_key(F.col(f"`{text}`")))
    return keyed.join(found, ["t_hash", "t_len"], "left_anti").select("row.*")


def op4_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each contaminated document, with the items found in it."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).filter("contaminated")


QUERIES = {"op4_string_tiling": op4_string_tiling}
