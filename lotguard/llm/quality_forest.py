"""Quality rules with an isolation forest on rule statistics (operator 7).

Statistics of each whole text are taken in one vectorised pass. A document
fails the base rules with under 50 words, or with more than half its words in
repeated 3-word windows. The others are judged by an isolation forest: trees
of random splits on the statistics, grown on random samples of the documents
that pass the base rules; texts unlike the rest end on short paths. Scores are
2 ^ (-mean path / expected path). The cut comes from the labelled rows: the
score above which most documents of quality 0 lie for few of quality 1.

A tree's sample is by definition bounded: ``SAMPLE`` texts, those with the
smallest hashes of text and tree among all distinct texts. Statistics, scores
and the cut cover all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import U64, mix, pair, small_batches, table, text_key, written
from lotguard.llm.words import NEWLINE, SPACE, segment_hashes, segments

TREES, SAMPLE = 100, 128
#: A document of quality 1 lost weighs as much as so many of quality 0 caught.
GOOD_WEIGHT = 10
BINS = 1000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
SLICE = 1 << 18
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def statistics(texts: list[bytes]) -> np.ndarray:
    """A row of NAMES for each UTF-8 text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    out = np.zeros((len(texts), len(NAMES)), np.int64)
    words, at = segment_hashes(data)
    owner = np.searchsorted(begin, at, side="right") - 1
    out[:, 0] = np.bincount(owner, minlength=len(texts))
    inside = ~SPACE[data]
    begins_char = (data & 0xC0) != 0x80
    for column, flag in ((1, inside & begins_char), (2, SYMBOLS[data])):
        total = np.concatenate(([0], np.cumsum(flag)))
        out[:, column] = total[begin[1:]] - total[begin[:-1]]
    lines, line_at = segment_hashes(data, NEWLINE)
    if len(lines):
        lead, first, _ = segments(data, NEWLINE)
        wordy = np.add.reduceat(inside[lead].astype(np.int64), first) > 0
        of = (np.searchsorted(begin, line_at, side="right") - 1)[wordy]
        extra = np.ones(len(of), np.int64)
        # equal to an earlier line of the text: all of a kind but its first
        extra[np.unique(pair(lines[wordy], of.astype(U64)), return_index=True)[1]] = 0
        out[:, 3] = np.bincount(of, weights=extra, minlength=len(texts)).astype(np.int64)
    if len(words) > 2:
        at = np.flatnonzero(owner[2:] == owner[:-2])
        window = pair(pair(pair(words[:-2], words[1:-1]), words[2:]), owner[:-2].astype(U64))[at]
        order = np.argsort(window)
        same = window[order][1:] == window[order][:-1]
        twice = np.unique(np.concatenate((at[order[1:][same]], at[order[:-1][same]])))
        covered = np.zeros(len(words), bool)
        for k in range(3):
            covered[twice + k] = True
        out[:, 4] = np.bincount(owner, weights=covered, minlength=len(texts)).astype(np.int64)
    return out


def base_failed(s: np.ndarray) -> np.ndarray:
    return (s[:, 0] < MIN_WORDS) | (100 * s[:, 4] > MAX_REPEAT_PERCENT * s[:, 0])


def features(s: np.ndarray) -> np.ndarray:
    """What the forest splits on: word length, symbols a word, and repetition
    beyond what good prose shows (half of what the base rule lets pass; one
    repeated line in 50 words)."""
    n = np.maximum(s[:, 0], 1).astype(float)
    return np.stack([s[:, 1] / n, s[:, 2] / n, np.maximum(s[:, 4] / n - MAX_REPEAT_PERCENT / 200, 0), np.maximum(s[:, 3] / n - 0.02, 0)], axis=1)


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path of an unsuccessful search in a random tree of n points."""
    n = np.asarray(n, float)
    m = np.maximum(n, 2)
    return np.where(n > 1, 2 * (np.log(m - 1) + 0.5772156649015329) - 2 * (m - 1) / m, 0.0)


def grow(points: np.ndarray, seed: int) -> list[list[float]]:
    """Nodes [feature, split, left, right, path] of a tree; feature -1 is a
    leaf, whose path adds what its points would still take."""
    rng = np.random.default_rng(seed)
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    nodes: list[list[float]] = []
    todo = [(points, 0, None)]
    while todo:
        rows, depth, link = todo.pop()
        if link is not None:
            nodes[link[0]][link[1]] = len(nodes)
        low, high = rows.min(axis=0), rows.max(axis=0)
        wide = np.flatnonzero(high > low)
        if depth >= limit or not len(wide):
            nodes.append([-1, 0.0, 0, 0, depth + float(expected_path(len(rows)))])
            continue
        f = int(rng.choice(wide))
        split = float(rng.uniform(low[f], high[f]))
        left = rows[:, f] <= split
        if left.all() or not left.any():
            left = rows[:, f] < high[f]
            split = float(rows[left, f].max())
        here = len(nodes)
        nodes.append([f, split, 0, 0, 0.0])
        todo += [(rows[~left], depth + 1, (here, 3)), (rows[left], depth + 1, (here, 2))]
    return nodes


def scores(forest: list[tuple[int, np.ndarray]], points: np.ndarray) -> np.ndarray:
    """Anomaly scores; 0 without a forest."""
    if not forest or not len(points):
        return np.zeros(len(points))
    total = np.zeros(len(points))
    for size, nodes in forest:
        at = np.zeros(len(points), np.int64)
        feature, links = nodes[:, 0].astype(np.int64), nodes[:, 2:4].astype(np.int64)
        while True:
            f = feature[at]
            moving = np.flatnonzero(f >= 0)
            if not len(moving):
                break
            here = at[moving]
            left = points[moving, f[moving]] <= nodes[here, 1]
            at[moving] = np.where(left, links[here, 0], links[here, 1])
        total += nodes[at, 4] / max(float(expected_path(size)), 1e-9)
    return 2.0 ** (-total / len(forest))


def _sampler(share: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of the texts that a tree may take: those whose hash with the tree
    is below ``share``."""
    bar = U64(min(int(share * 2.0**64), 2**64 - 1))
    trees = mix(np.arange(1, TREES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", SLICE):
            key = np.asarray(batch.column("t_hash")).view(U64)
            drawn = mix(key[:, None] ^ trees[None, :])
            doc, tree = np.nonzero(drawn <= bar)
            some, place = np.unique(doc, return_inverse=True)
            if not len(some):
                continue
            s = statistics([batch.column("body")[int(i)].as_py() for i in some])
            keep = ~base_failed(s)[place]
            f = features(s)[place][keep]
            yield pa.record_batch(
                [pa.array(tree[keep].astype(np.int32)), pa.array(drawn[doc, tree][keep].view(np.int64)), *(pa.array(f[:, i].copy()) for i in range(4))],
                names=["tree", "drawn", "f0", "f1", "f2", "f3"],
            )

    return rows


def _passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the texts that pass the base rules."""
    for batch in small_batches(batches, "body", SLICE):
        keep = ~base_failed(statistics(batch.column("body").to_pylist()))
        yield pa.record_batch([batch.column("t_hash")], names=["t_hash"]).filter(pa.array(keep))


def _grow_group(rows: pd.DataFrame) -> pd.DataFrame:
    tree = int(rows["tree"].iloc[0])
    rows = rows.assign(order=rows["drawn"].to_numpy().view(U64)).drop_duplicates("order").nsmallest(SAMPLE, "order")
    nodes = np.array(grow(rows[["f0", "f1", "f2", "f3"]].to_numpy(), tree))
    return pd.DataFrame({"tree": [tree], "points": [len(rows)], "nodes": [nodes.tobytes()]})


def _bodies(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(text_key(t)[0], t.cast("binary").alias("body"))


def fit(docs: DataFrame, text: str = "text") -> list[tuple[int, np.ndarray]]:
    """The forest (points and nodes of each tree): TREES small arrays, whatever
    the size of the table. Each tree's candidates are about three times its
    sample, drawn by hash from the distinct texts that pass the base rules, so
    that no more than that is shuffled."""
    bodies = _bodies(docs, text)
    many = bodies.mapInArrow(_passing, "t_hash long").agg(F.approx_count_distinct("t_hash")).first()[0]
    if not many:
        return []
    drawn = bodies.mapInArrow(_sampler(3 * SAMPLE / many), "tree int, drawn long, f0 double, f1 double, f2 double, f3 double")
    grown = drawn.distinct().groupBy("tree").applyInPandas(_grow_group, "tree int, points int, nodes binary")
    return [(r["points"], np.frombuffer(r["nodes"]).reshape(-1, 5)) for r in sorted(grown.collect(), key=lambda r: r["tree"])]


def _scorer(forest: list, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", SLICE):
            s = statistics(batch.column("body").to_pylist())
            score = scores(forest, features(s))
            yield pa.record_batch(
                [batch.column(key), *(pa.array(s[:, i].copy()) for i in range(5)), pa.array(base_failed(s)), pa.array(score)],
                names=[key, *NAMES, "base_failed", "score"],
            )

    return rows


def scored(docs: DataFrame, forest: list, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key (as it is) with the statistics, base_failed and the score."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("k"), t.cast("binary").alias("body"))
    cols = ", ".join(f"{n} long" for n in NAMES)
    return rows.mapInArrow(_scorer(forest, "k"), f"k {kind}, {cols}, base_failed boolean, score double").withColumnRenamed("k", key)


def calibrate(rows: DataFrame, labels: DataFrame, key: str = "doc_id") -> float:
    """The cut: documents with a score of at least it are rejected. Counts by
    score (BINS steps) of all labelled rows that pass the base rules; a key
    labelled twice counts as its lower quality. Without rows of both kinds
    nothing is rejected (a cut above all scores)."""
    lab = labels.filter("quality is not null").groupBy(key).agg(F.min("quality").alias("quality"))
    step = F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).cast("int").alias("step")
    found = rows.filter("not base_failed").join(lab, key).groupBy(step, "quality").count().collect()
    counts = np.zeros((2, BINS))
    for r in found:
        counts[int(r["quality"] > 0), r["step"]] += r["count"]
    if not counts.sum(axis=1).all():
        return 2.0
    above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] / counts.sum(axis=1, keepdims=True)
    gain = above[0] - GOOD_WEIGHT * above[1]
    best = int(np.flatnonzero(gain == gain.max())[-1])
    return best / BINS if gain[best] > 0 else 2.0


def judged(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, NAMES, base_failed, kept, score.

    Null texts count as empty (no words: base_failed). A null key stays a row
    and is never labelled. Equal texts have equal verdicts. An empty table
    gives an empty result; without labels only the base rules reject.
    """
    rows = written(scored(docs, fit(docs, text), key, text), "scored")
    cut = calibrate(rows, labels, key)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") < F.lit(cut)))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are kept, with their columns."""
    forest = fit(docs, text)
    cut = calibrate(scored(docs, forest, key, text), labels, key)
    names = docs.columns
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("body")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), body)

    def verdicts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "body", SLICE):
            s = statistics(batch.column("body").to_pylist())
            kept = ~base_failed(s) & (scores(forest, features(s)) < cut)
            yield pa.record_batch([batch.column("row")], names=["row"]).filter(pa.array(kept))

    return rows.mapInArrow(verdicts, rows.select("row").schema).select("row.*")


def op7_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", *NAMES, "base_failed", "kept", "score")


QUERIES = {"op7_quality_forest": op7_quality_forest}
