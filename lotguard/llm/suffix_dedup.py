"""Suffix-array dedup by bucket-pointer refinement (operator 2).

Every byte that is covered by a ``length``-byte string which also starts at
another position (of any text, the same one included) is removed. Matches lie
within a text; overlaps count; strings are judged on the input.

Which suffixes share their first ``length`` bytes is what a suffix array tells;
its bucket-pointer construction puts suffixes into buckets by a q-gram and then
refines a bucket by the bucket identifiers that its suffixes have at later
offsets, reusing those identifiers. Here a bucket identifier is a 64-bit
number, so that no global order is needed and only the buckets that still hold
two unlike suffixes travel:

1. q-gram identifiers. Identifiers of 5, 25, 50 and 100 bytes follow from one
   another, each from the identifiers at later offsets, up to ``length``.
2. Initial buckets. The bucket of a position is the smallest 100-gram
   identifier in its ``length`` bytes. Equal strings have equal buckets, and
   neighbouring positions mostly the same, so one row stands for a run of
   positions.
3. Refinement of runs: rows of a bucket whose runs have equal identifiers at
   all their offsets are repeated as a whole. A run unlike all others of a
   bucket that holds others goes on, together with one run for each group of
   equal ones.
4. The same with shorter runs: those that go on are cut where the distance to
   the bucket's q-gram passes a multiple of 26. Such a run's bucket is the
   identifier of the bytes that all its strings share (375 of 400).
5. What still goes on does so position by position by identifiers of whole strings.

A string counts as repeated when bucket and its own identifier agree (128 bits
in all). The length is a parameter (a multiple of 25, 150 at least; ``LENGTH`` = 400).

With ``keep_first`` the first occurrence of a string stays: distinct texts
count once each, in the order of their smallest document key, and only
occurrences behind the first one are removed. Of equal runs the first then
stands for all, and goes on if its own strings may repeat or other runs of its
bucket differ; the others only hold later occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import U64, bodies_of, forget_shuffles, forget_tables, mix, pair, ranges, runs_of, small_batches, table, text_key, unpacked, written

#: Bytes of a repeated string; bytes of the q-gram of the initial buckets;
#: positions in a run of the second refinement.
LENGTH, Q, BLOCK = 400, 100, 26
_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019))
#: Positions handled at once: memory stays bounded for texts of any size.
SLICE = 1 << 18
_RUN = "lo int, n int, bucket long, whole long, twice boolean"


def _times5(h: np.ndarray, step: int) -> np.ndarray:
    n = max(len(h) - 4 * step, 0)
    out = h[:n]
    for k in range(1, 5):
        out = pair(out, h[k * step : k * step + n])
    return out


def _twice(h: np.ndarray, step: int) -> np.ndarray:
    return pair(h[: max(len(h) - step, 0)], h[step:])


def identifiers(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Identifiers of the 25, 50, 100, 200 and 400 bytes (as far as they are
    needed) and of the ``length`` bytes from each position."""
    out = {25: _times5(_times5(_BYTE[data], 1), 5)}
    for n in (25, 50, 100, 200):
        if n == 25 or 2 * n <= max(length, Q):
            out[2 * n] = _twice(out[n], n)
    if length not in out:
        out[length] = joined_identifiers(out, length, np.arange(max(len(data) - length + 1, 0)))
    return out


def joined_identifiers(ids: dict[int, np.ndarray], length: int, at: np.ndarray) -> np.ndarray:
    """Identifiers of the ``length`` bytes from the positions ``at``, from those
    of their parts, the longest first."""
    parts, begin = [], 0
    for n in (400, 200, 100, 50, 25):
        while n in ids and length - begin >= n:
            parts.append(ids[n][at + begin])
            begin += n
    while len(parts) > 1:
        parts = [pair(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    out, step = values, 1
    while 2 * step <= width:
        out, step = best(out[:-step], out[step:]), 2 * step
    n = len(values) - width + 1
    return best(out[:n], out[width - step : width - step + n]) if step < width else out


def position_runs(data: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of positions with one bucket in a buffer of texts that end at
    ``ends``: first position, positions, bucket, identifier, and whether equal
    strings may start within the run (its bucket's q-gram comes twice)."""
    empty, width = np.zeros(0, np.int64), length - Q + 1  # q-grams in a string
    if len(data) < length:
        return empty, empty, empty.astype(U64), empty.astype(U64), empty.astype(bool)
    ids = identifiers(data, length)
    h100, strings = ids[Q], ids[length]
    low = _sliding(h100, width, np.minimum)
    n = len(low)
    sizes = np.diff(np.concatenate(([0], ends)))
    valid = np.repeat(ends, sizes)[:n] >= np.arange(n) + length
    at = np.flatnonzero(valid)
    if not len(at):
        return empty, empty, empty.astype(U64), empty.astype(U64), empty.astype(bool)
    bucket = low[at]
    cut = np.concatenate(([True], (bucket[1:] != bucket[:-1]) | (np.diff(at) != 1)))
    first = np.flatnonzero(cut)
    count = np.diff(np.append(first, len(at)))
    inside = np.arange(len(at)) - np.repeat(first, count)
    whole = np.add.reduceat(mix(strings[at] + inside.astype(U64) * U64(0x9E3779B97F4A7C15)), first)
    # q-grams that are the smallest of some string; the same one again within reach?
    padded = np.concatenate((np.zeros(width - 1, U64), np.where(valid, low, U64(0)), np.zeros(width - 1, U64)))
    chosen = np.flatnonzero(_sliding(padded, width, np.maximum) == h100)
    order = np.lexsort((chosen, h100[chosen]))
    p, h = chosen[order], h100[chosen[order]]
    again = np.sort(p[1:][(h[1:] == h[:-1]) & (np.diff(p) <= width)])
    lo = at[first]
    twice = np.searchsorted(again, lo + count - 1 + width) > np.searchsorted(again, lo)
    return lo, count, bucket[first], mix(whole), twice


def _run_rows(of: list[str], length: int):
    """The runs of each text; ``of`` are the columns that stand for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", SLICE):
            lengths = np.asarray(batch.column("t_len"))
            texts = batch.column("body").to_pylist()
            parts = []
            if len(texts) == 1:  # a long text: in overlapping slices
                whole = np.frombuffer(texts[0], np.uint8)
                for s in range(0, max(len(whole) - length + 1, 0), SLICE):
                    piece = whole[s : s + SLICE + length - 1]
                    lo, n, b, w, t = position_runs(piece, np.array([len(piece)]), length)
                    parts.append((np.zeros(len(lo), np.int64), lo + s, n, b, w, t))
            else:
                ends = np.cumsum(lengths.astype(np.int64))
                lo, n, b, w, t = position_runs(np.frombuffer(b"".join(texts), np.uint8), ends, length)
                row = np.searchsorted(ends, lo, side="right")
                parts.append((row, lo - (ends - lengths)[row], n, b, w, t))
            if not parts:
                continue
            row, lo, n, b, w, t = (np.concatenate(x) for x in zip(*parts, strict=True))
            take = pa.array(row)
            yield pa.record_batch(
                [*(batch.column(c).take(take) for c in of), pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32)),
                 pa.array(b.view(np.int64)), pa.array(w.view(np.int64)), pa.array(t)],
                names=[*of, "lo", "n", "bucket", "whole", "twice"],
            )

    return run


def _open_parts(batches: Iterator[pa.RecordBatch], length: int):
    """The open runs of the texts, about SLICE positions at once: the text's
    id (an array of one), first positions, sizes, buckets, the identifiers in the bytes of the runs put
    one after another, and where in these each run begins."""
    for batch, bodies in unpacked(batches, "body", SLICE):
        for row, (body, runs) in enumerate(zip(bodies, batch.column("runs"), strict=True)):
            t_id = batch.column("t_id").slice(row, 1)
            keep = np.flatnonzero(np.asarray(runs.values.field("open")))
            lo, n = (np.asarray(runs.values.field(f))[keep].astype(np.int64) for f in ("lo", "n"))
            bucket = np.asarray(runs.values.field("bucket"))[keep].view(U64)
            data = np.frombuffer(body, np.uint8)
            for s, c in zip(*runs_of(np.cumsum(n + length) // (2 * SLICE)), strict=True):
                a, k = lo[s : s + c], n[s : s + c]
                size = k + length - 1
                yield t_id, a, k, bucket[s : s + c], identifiers(data[ranges(a, size)], length), np.cumsum(size) - size


def _short_runs(length: int):
    """The open runs cut at fixed distances to the q-gram of their bucket."""
    width = length - Q + 1

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t_id, lo, n, bucket, ids, begin in _open_parts(batches, length):
            at, run = ranges(begin, n), np.repeat(np.arange(len(n)), n)
            grams, owner = ranges(begin, n + width - 1), np.repeat(np.arange(len(n)), n + width - 1)
            chosen = grams[ids[Q][grams] == bucket[owner]]
            gram = chosen[np.searchsorted(chosen, at)]
            away = gram - at
            block = away // BLOCK
            cut = np.concatenate(([True], (run[1:] != run[:-1]) | (gram[1:] != gram[:-1]) | (block[1:] != block[:-1])))
            first = np.flatnonzero(cut)
            whole = mix(np.add.reduceat(mix(ids[length][at] + away.astype(U64) * U64(0x9E3779B97F4A7C15)), first))
            known = joined_identifiers(ids, (length - BLOCK + 1) // 25 * 25, (gram - block * BLOCK)[first])
            key = pair(pair(known, bucket[run[first]]), block[first].astype(U64))
            yield pa.record_batch(
                [t_id.take(pa.array(np.zeros(len(first), np.int32))), pa.array((lo[run] + at - begin[run])[first].astype(np.int32)),
                 pa.array(np.diff(np.append(first, len(at))).astype(np.int32)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64)),
                 pa.array(np.zeros(len(first), bool))],
                names=["t_id", "lo", "n", "bucket", "whole", "twice"],
            )

    return run_


def _string_rows(length: int):
    """One row for each position of the open runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t_id, lo, n, bucket, ids, begin in _open_parts(batches, length):
            key = pair(ids[length][ranges(begin, n)], np.repeat(bucket, n))
            yield pa.record_batch(
                [pa.array(key.view(np.int64)), t_id.take(pa.array(np.zeros(len(key), np.int32))), pa.array(ranges(lo, n).astype(np.int32))],
                names=["string", "t_id", "pos"],
            )

    return run


def _cut_rows(of: list[str], length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, bodies in unpacked(batches, "body", 4 * SLICE):
            removed, spans, digests, kept_all = [], [], [], []
            for i, body in enumerate(bodies):
                body = np.frombuffer(body, np.uint8)
                closed = batch.column("closed")[i].values
                lo, n = (np.asarray(closed.field(f)).astype(np.int64) for f in ("lo", "n"))
                single = batch.column("positions")[i].values
                single = np.asarray(single).astype(np.int64) if single is not None else np.zeros(0, np.int64)
                step = np.zeros(len(body) + 1, np.int64)
                np.add.at(step, np.concatenate((lo, single)), 1)
                np.add.at(step, np.concatenate((lo + n + length - 1, single + length)), -1)
                gone = np.cumsum(step)[:-1] > 0
                kept = body[~gone].tobytes()
                removed.append(int(gone.sum()))
                spans.append(int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(len(gone) > 0 and gone[0]))
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_all.append(kept)
            yield pa.record_batch(
                [*(batch.column(c) for c in of), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_all, pa.binary())],
                names=[*of, "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return run


def _first_key(key: str):
    """The order of documents: by key, a null one last."""
    return F.coalesce(F.col(f"`{key}`").cast("long"), F.lit((1 << 63) - 1)).alias("first")


def repeated_strings(docs: DataFrame, text: str = "text", length: int = LENGTH, keep_first: str | None = None) -> DataFrame:
    """Distinct texts that lose bytes: t_hash, t_len (see ``text_key``),
    n_removed, n_spans, kept_sha256, kept (binary).

    Null texts count as empty; texts under ``length`` bytes never lose any;
    equal texts (copies, repeated rows) repeat each other and so lose
    everything from ``length`` bytes on. Other columns, whatever their names,
    are not read. An empty table gives an empty result.

    With ``keep_first``, the name of an integer key, there is a row for each
    document (column ``first``: its key, the greatest long for null) instead of
    each text, and a string's first occurrence, by key, text hash and place,
    stays. Rows equal in key and text count as one.
    """
    if length % 25 or length < Q + 50:
        raise ValueError("the length must be a multiple of 25, and 150 at least")
    bodies = docs.select(
        *([_first_key(keep_first)] if keep_first else []), *text_key(F.col(f"`{text}`")), F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body"))
    bodies = bodies.filter(F.col("t_len") >= length)
    of, first = [c for c in bodies.columns if c != "body"], keep_first is not None
    kinds = ", ".join(f"{c} {dict(bodies.dtypes)[c]}" for c in of)
    runs = written(bodies.mapInArrow(_run_rows(of, length), f"{kinds}, {_RUN}"), "runs")
    wanted = refined(runs, of, first)
    forget_tables(runs)
    t_id = F.struct(*of) if first else F.monotonically_increasing_id()
    forget_shuffles(docs.sparkSession)
    texts = written(bodies_of(bodies, wanted, of).withColumn("t_id", t_id), "repeated-texts")
    kind = dict(texts.dtypes)["t_id"]
    going_on = F.exists("runs", lambda r: r["open"])
    short = written(texts.filter(going_on).select("t_id", "body", "runs").mapInArrow(_short_runs(length), f"t_id {kind}, {_RUN}"), "short-runs")
    closed = F.transform(F.filter("runs", lambda r: r["repeated"]), lambda r: F.struct(r["lo"].alias("lo"), r["n"].alias("n")))
    again = refined(short, ["t_id"], first)
    forget_tables(wanted, short)
    before, texts = texts, written(
        texts.withColumn("closed", closed).drop("runs").join(again, "t_id", "left")
        .withColumn("closed", F.concat("closed", F.coalesce(closed, F.array().cast("array<struct<lo:int,n:int>>")))), "repeated-texts"
    )
    forget_tables(before, again)
    forget_shuffles(docs.sparkSession)
    strings = written(texts.filter(going_on).select("t_id", "body", "runs").mapInArrow(_string_rows(length), f"string long, t_id {kind}, pos int"), "strings")
    # grouped counts, written, so that the rows of a string found very often can be split
    counted = strings.groupBy("string").agg(F.count("*").alias("same"), *([F.min(F.struct("t_id", "pos")).alias("one")] if first else [])).filter("same > 1")
    found = strings.join(written(counted, "repeated-strings"), "string")
    if first:
        found = found.filter(F.col("one") != F.struct("t_id", "pos"))
    positions = found.groupBy("t_id").agg(F.collect_list("pos").alias("positions"))
    cut = texts.join(positions, "t_id", "left").select(*of, "body", "closed", "positions")
    return cut.mapInArrow(_cut_rows(of, length), f"{kinds}, n_removed long, n_spans long, kept_sha256 string, kept binary").filter("n_removed > 0")


def refined(runs: DataFrame, of: list[str], keep_first: bool = False) -> DataFrame:
    """One refinement of the buckets of ``runs``: for each text (columns
    ``of``) that has any, the runs that are repeated as a whole, and those
    that are open, that is go on to the next refinement."""
    # Buckets with two rows at least; sums and extremes combine before the shuffle.
    # Both groupings are written, so that a hot bucket's rows can be split in the join.
    buckets = written(
        runs.groupBy("bucket")
        .agg(F.count("*").alias("rows"), F.min("whole").alias("a"), F.max("whole").alias("b"), F.max("twice").alias("again"))
        .filter("rows > 1 or again")
        .select("bucket", (F.col("a") != F.col("b")).alias("unlike")), "buckets"
    )
    forget_shuffles(runs.sparkSession)
    shared = written(runs.join(buckets, "bucket"), "shared-runs")
    run_id = F.struct(*of, "lo") if keep_first else F.xxhash64(*of, "lo")
    groups = written(shared.groupBy("bucket", "whole").agg(F.count("*").alias("same"), F.min(run_id).alias("one")), "groups")
    chosen = F.col("one") == run_id
    if keep_first:
        repeated, going_on = ~chosen, chosen & (F.col("unlike") | F.col("twice"))
    else:
        repeated, going_on = F.col("same") > 1, (F.col("unlike") & chosen) | (F.col("twice") & (F.col("same") == 1))
    status = shared.join(groups, ["bucket", "whole"]).select(*of, "lo", "n", "bucket", repeated.alias("repeated"), going_on.alias("open")).filter("repeated or open")
    out = written(status.groupBy(*of).agg(F.collect_set(F.struct("lo", "n", "bucket", "repeated", "open")).alias("runs")), "repeated-runs")
    forget_tables(buckets, shared, groups)
    return out


def dedup_report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document, with what it loses: the key (as it is, null or
    repeated), n_bytes, n_removed, n_spans, kept_sha256."""
    cut = written(repeated_strings(docs, text).drop("kept"), "cut")
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias(key), *text_key(t), F.sha2(t.cast("binary"), 256).alias("sha"))
    return rows.join(cut, ["t_hash", "t_len"], "left").select(
        key, F.col("t_len").cast("long").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def _utf8(of: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [b.decode("utf-8", "ignore") for b in batch.column("kept").to_pylist()]
            yield pa.record_batch([*(batch.column(c) for c in of), pa.array(texts, pa.string())], names=[*of, "kept_text"])

    return run


def remove_repeats(docs: DataFrame, text: str = "text", length: int = LENGTH, keep_first: str | None = None) -> DataFrame:
    """The documents with the repeated bytes cut out of their text (see
    ``repeated_strings``); a character cut in two goes whole. Rows keep their
    columns; those of whose text nothing but white space is left are dropped."""
    found = repeated_strings(docs, text, length, keep_first)
    of = [c for c in found.columns if c in ("first", "t_hash", "t_len")]
    kinds = ", ".join(f"{c} {dict(found.dtypes)[c]}" for c in of)
    cut = written(found.select(*of, "kept").mapInArrow(_utf8(of), f"{kinds}, kept_text string"), "cut")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *([_first_key(keep_first)] if keep_first else []), *text_key(F.col(f"`{text}`")))
    out = keyed.join(cut, of, "left").filter(r"kept_text is null or kept_text rlike '\\S'")
    return out.select(*[F.coalesce("kept_text", f"row.`{c}`").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


QUERIES = {"op2_suffix_array_dedup": op2_suffix_array_dedup}
