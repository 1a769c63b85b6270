"""Substring dedup by sliding sentence spans (operator 5).

A text is cut behind runs of ``.``, ``!``, ``?`` and line feeds; pieces with a
word are its sentences, compared by their words (white space doesn't count). A
piece of more than ``LONG`` words, as in lists or text without these marks, is
cut again behind each word whose MD5 begins with 0 or 1, every eighth or so: a
passage is so cut alike wherever it stands.
From each sentence on, the shortest run of at least ``SENTENCES`` sentences and
``WORDS`` words is a span; a text too short for any is one span itself. All
spans are hashed (96 bits) and joined across the corpus. The first occurrence
of a span (smallest document key, then place) stays; sentences covered by any
other occurrence of a repeated span are removed.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import WORD, small_batches, table, text_key, written

#: A span's sentences and words, at least; words of a piece that isn't cut again, at most.
SENTENCES, WORDS, LONG = 2, 20, 24
PIECE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
#: A word with the white space before it, the last one with what follows too.
_TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*\Z|[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")
SLICE = 1 << 18
#: What stands for a document: whether its key is null, the key, its text.
KEY = ["none", "k", "t_hash", "t_len"]


def sentences(text: str) -> tuple[list[str], np.ndarray, list[str], np.ndarray]:
    """Pieces, which of them are sentences, the sentences' words (joined by
    spaces) and how many they are."""
    pieces, words = [], []
    for piece in PIECE.findall(text):
        w = WORD.findall(piece)
        if len(w) <= LONG:
            pieces.append(piece)
            words.append(w)
            continue
        tokens, begin = _TOKEN.findall(piece), 0
        for end in [i + 1 for i, x in enumerate(w[:-1]) if hashlib.md5(x.encode()).hexdigest()[0] in "01"] + [len(w)]:
            pieces.append("".join(tokens[begin:end]))
            words.append(w[begin:end])
            begin = end
    at = np.array([i for i, w in enumerate(words) if w], np.int64)
    return pieces, at, [" ".join(words[i]) for i in at], np.array([len(words[i]) for i in at], np.int64)


def spans(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First sentence and number of sentences of each span."""
    n = len(n_words)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = np.concatenate(([0], np.cumsum(n_words)))
    lo = np.arange(n)
    end = np.maximum(np.searchsorted(total, total[:-1] + WORDS), lo + SENTENCES)
    lo = lo[end <= n]
    return (lo, end[: len(lo)] - lo) if len(lo) else (np.array([0]), np.array([n]))


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", SLICE):
        row, los, sizes, first, second = [], [], [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            _, _, said, n_words = sentences(text)
            lo, n = spans(n_words)
            raw = [s.encode() + b"\n" for s in said]
            for a, k in zip(lo.tolist(), n.tolist(), strict=True):
                digest = xxhash.xxh3_128_intdigest(b"".join(raw[a : a + k]))
                first.append(digest & (1 << 64) - 1)
                second.append(digest >> 64 & (1 << 32) - 1)
            row += [i] * len(lo)
            los.append(lo)
            sizes.append(n)
        take = pa.array(row, pa.int32())
        yield pa.record_batch(
            [*(batch.column(c).take(take) for c in KEY), pa.array(np.concatenate(los).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32)),
             pa.array(np.array(first, np.uint64).view(np.int64)), pa.array(np.array(second, np.uint32).view(np.int32))],
            names=[*KEY, "lo", "n", "a", "b"],
        )


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    k = F.col(f"`{key}`")
    return docs.select(k.isNull().alias("none"), F.coalesce(k, F.lit(0)).cast("long").alias("k"), *text_key(t), t.alias("text"))


def later_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document (KEY) with any: the spans (lo, n; in sentences) that
    are not the first of their kind. Rows with equal key and text are one
    document."""
    kind = "none boolean, k long, t_hash long, t_len int, lo int, n int, a long, b int"
    rows = written(keyed(docs, key, text).mapInArrow(_span_rows, kind), "spans")
    often = written(rows.groupBy("a", "b").count().filter("count > 1").select("a", "b"), "often")
    rows = written(rows.join(often, ["a", "b"]), "repeated-spans")
    place = F.struct(*KEY, "lo")
    first = written(rows.groupBy("a", "b").agg(F.min(place).alias("first")), "first-spans")
    later = rows.join(first, ["a", "b"]).filter(place != F.col("first"))
    return later.groupBy(*KEY).agg(F.collect_set(F.struct("lo", "n")).alias("later"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text", SLICE):
        many, removed, kept = [], [], []
        for text, later in zip(batch.column("text").to_pylist(), batch.column("later").to_pylist(), strict=True):
            pieces, at, _, _ = sentences(text)
            gone = np.zeros(len(at) + 1, np.int64)
            for s in later or ():
                gone[s["lo"]] += 1
                gone[s["lo"] + s["n"]] -= 1
            out = at[np.cumsum(gone)[:-1] > 0]
            many.append(len(at))
            removed.append(len(out))
            dropped = set(out.tolist())
            kept.append("".join(p for i, p in enumerate(pieces) if i not in dropped) if dropped else text)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in kept]
        yield pa.record_batch(
            [batch.column("none"), batch.column("k"), pa.array(many, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
            names=["none", "k", "n_sentences", "n_removed", "kept_sha256", "kept_text"],
        )


def span_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, n_sentences, n_removed, kept_sha256,
    kept_text (all pieces but the removed sentences).

    Null texts count as empty (no sentences); a null key comes last, equal keys
    by their texts; rows with equal key and text are one document and have
    equal results. Further columns are left out. An empty table gives an empty
    result.
    """
    rows = keyed(docs, key, text).join(later_spans(docs, key, text), KEY, "left")
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(_cut, "none boolean, k long, n_sentences long, n_removed long, kept_sha256 string, kept_text string")
    return out.select(F.when(~F.col("none"), F.col("k")).cast(kind).alias(key), "n_sentences", "n_removed", "kept_sha256", "kept_text")


def op5_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup(table(spark, sf_dir, "documents")).drop("kept_text")


QUERIES = {"op5_sentence_spans": op5_sentence_spans}

SQL = {
    "op5_sentence_spans": rf"""
        WITH cut AS (
            SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+')) AS raw,
                   generate_subscripts(regexp_extract_all(coalesce(text, ''), '[^.!?\n]*[.!?\n]+|[^.!?\n]+'), 1) AS q
            FROM documents
        ), long AS (
            SELECT doc_id, q, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS t, len(tokens) AS many
            FROM (SELECT doc_id, q, regexp_extract_all(raw, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+[\x20\x09-\x0D]*\z|[\x20\x09-\x0D]*[^\x20\x09-\x0D]+') AS tokens FROM cut)
            WHERE len(tokens) > {LONG}
        ), marked AS (
            SELECT *, coalesce(sum(CASE WHEN substr(md5(regexp_extract(token, '[^\x20\x09-\x0D]+')), 1, 1) IN ('0', '1') THEN 1 ELSE 0 END)
                OVER (PARTITION BY doc_id, q ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS part
            FROM long
        ), both_kinds AS (
            SELECT doc_id, raw, q, 0 AS part FROM cut WHERE (doc_id, q) NOT IN (SELECT (doc_id, q) FROM long)
            UNION ALL SELECT doc_id, string_agg(token, '' ORDER BY t), q, part FROM marked GROUP BY doc_id, q, part
        ), pieces AS (
            SELECT doc_id, raw, row_number() OVER (PARTITION BY doc_id ORDER BY q, part) AS p FROM both_kinds
        ), worded AS (
            SELECT *, regexp_extract_all(raw, '[^\x20\x09-\x0D]+') AS words FROM pieces
        ), s AS (
            SELECT doc_id, p, len(words) AS n, array_to_string(words, ' ') AS said,
                   row_number() OVER w AS i, sum(len(words)) OVER w AS upto, count(*) OVER (PARTITION BY doc_id) AS many
            FROM worded WHERE len(words) > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY p)
        ), whole AS (
            SELECT doc_id, list(said ORDER BY i) AS said FROM s GROUP BY doc_id
        ), ends AS (
            SELECT s.doc_id, s.i, greatest(e.i, s.i + {SENTENCES - 1}) AS j, s.many
            FROM s ASOF JOIN s e ON s.doc_id = e.doc_id AND s.upto - s.n + {WORDS} <= e.upto
        ), found AS (
            SELECT doc_id, i, j FROM ends WHERE j <= many
            UNION ALL
            SELECT doc_id, 1, max(many) FROM s WHERE doc_id NOT IN (SELECT doc_id FROM ends WHERE j <= many) GROUP BY doc_id
        ), spans AS (
            SELECT f.doc_id, f.i, f.j, row_number() OVER (PARTITION BY array_to_string(said[f.i : f.j], chr(10)) ORDER BY f.doc_id, f.i) AS r
            FROM found f JOIN whole USING (doc_id)
        ), marks AS (
            SELECT doc_id, i AS place, 1 AS d FROM spans WHERE r > 1 UNION ALL SELECT doc_id, j + 1, -1 FROM spans WHERE r > 1
        ), steps AS (
            SELECT doc_id, place, sum(d) AS d FROM marks GROUP BY ALL
        ), covered AS (
            SELECT s.doc_id, s.p, sum(coalesce(d, 0)) OVER (PARTITION BY s.doc_id ORDER BY s.i) > 0 AS gone
            FROM s LEFT JOIN steps ON steps.doc_id = s.doc_id AND steps.place = s.i
        ), kept AS (
            SELECT p.doc_id, count(c.p) AS n_sentences, count(*) FILTER (WHERE coalesce(gone, false)) AS n_removed,
                   string_agg(raw, '' ORDER BY p.p) FILTER (WHERE NOT coalesce(gone, false)) AS kept
            FROM pieces p LEFT JOIN covered c ON c.doc_id = p.doc_id AND c.p = p.p GROUP BY p.doc_id
        )
        SELECT d.doc_id, coalesce(n_sentences, 0) AS n_sentences, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM documents d LEFT JOIN kept USING (doc_id)
    """
}
