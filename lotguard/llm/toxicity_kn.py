"""Toxicity by class-conditional Kneser-Ney models (operator 8).

Two interpolated Kneser-Ney models of the characters of words, one learnt from
toxic and one from ordinary labelled documents. The highest order (six
characters) counts occurrences, orders five to three count distinct left
neighbours in their class; below these both models back off to the same
two- and one-character distributions, from the distinct left neighbours in
either class. So an expression that one class alone has seen, whole or in
part, tells the classes apart, while what neither has seen weighs the same.

A document's statistics are log-likelihood ratios per character: of the whole
text, and of its most toxic ``WINDOW`` = 2 successive words. A logistic
function of the two gives the score. It is fitted on a bounded sample of labelled
documents, with a model that leaves these out; the scores' model counts them too.
Both models come from one pass over the counted words.

Counts come from all labelled documents of the learning folds, by grouping
with partial sums. The model sent to the tasks has a row for each distinct gram
and context, found by a 64-bit key, so it grows with what the corpus holds and
no two of them share their counts. With it go the ratios of frequent words, of
which there are less than ``OFTEN`` whatever the corpus.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import U64, WORD, bitmap, forget_shuffles, in_bitmap, mix, ranges, runs_of, small_batches, table, written
from lotguard.llm.words import segment_hashes

ORDER, SHARED, DISCOUNT = 6, 2, 0.75
WINDOW = 2
#: Labelled documents (those of the smallest hashes) that the logistic function is fitted on.
FIT_ROWS = 20_000
#: log2 of the bits of the bitmap of labelled keys (8 MiB).
KEY_BITS = 26
FOLDS, HELD_OUT, FIT_FOLD = 5, 0, 4
SLICE = 1 << 18
#: A word is frequent if it is more than one in this many of the labelled words.
OFTEN = 1 << 17
#: Distinct words that a task adds up, or keeps the ratios of, at once.
CACHE = 200_000
BEGIN, END = "\x02", "\x03"
_BYTE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_COLUMNS = ("n0", "n1", "types0", "types1")
#: The counts of the classes: of all rows, and of those that aren't held.
_ALL, _FIT = ("all0", "all1"), ("fit0", "fit1")
_COUNTS = (*_ALL, *_FIT)


def grams(marked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the characters of strings: for orders 0 to ORDER the hashes of the
    last characters (0 where a string is shorter), the string each belongs to,
    and its place there."""
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    size = np.array([len(w) for w in marked], np.int64)
    owner = np.repeat(np.arange(len(marked)), size)
    place = np.arange(len(chars)) - np.repeat(np.cumsum(size) - size, size)
    value = mix(chars + U64(1))
    out = np.zeros((ORDER + 1, len(chars)), U64)
    back = np.zeros(len(chars), U64)
    for n in range(1, ORDER + 1):
        # the characters n - 1 places back, bound to their distance
        step = np.zeros(len(chars), U64)
        step[n - 1 :] = value[: max(len(chars) - n + 1, 0)]
        back = back + mix(step + U64(n))
        out[n] = np.where(place >= n - 1, mix(back + U64(n << 32)), U64(0))
    return out, owner, place


def _key(value: np.ndarray, n: int, what: int) -> np.ndarray:
    """The key of a gram of order n (what 0), or of its context (what 1)."""
    return mix(value ^ U64(2 * n + what))


class Counts:
    """Numbers by 64-bit key: rows sorted by key. The last row, of zeros, stands
    for unknown keys."""

    def __init__(self, keys: np.ndarray, numbers: np.ndarray):
        order = np.argsort(keys)
        self.keys = keys[order]
        self.numbers = np.concatenate((numbers[order], np.zeros((1, numbers.shape[1]), np.float32)))

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros((len(keys), self.numbers.shape[1]), np.float32)
        unlike, which = np.unique(keys, return_inverse=True)  # in order, so that neighbours are looked up together
        row = np.searchsorted(self.keys, unlike)
        row[self.keys[np.minimum(row, len(self.keys) - 1)] != unlike] = len(self.keys)
        return self.numbers[row[which]]


def _gram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From distinct words with their counts: the ORDER characters that end at
    each, or all up to it from the word's beginning."""
    held: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        cols = [pa.array(list(held), pa.string()), *(pa.array([c[i] for c in held.values()], pa.int64()) for i in range(len(_COUNTS)))]
        return pa.record_batch(cols, names=["gram", *_COUNTS])

    for batch in batches:
        for word, *counts in zip(*(batch.column(c).to_pylist() for c in ("word", *_COUNTS)), strict=True):
            marked = BEGIN + word + END
            for i in range(2, len(marked) + 1):
                sums = held.setdefault(marked[max(i - ORDER, 0) : i], [0] * len(_COUNTS))
                for k, n in enumerate(counts):
                    sums[k] += n
        if len(held) > CACHE:
            yield out()
            held = {}
    yield out()


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counted grams as additions to the models' rows: the counts of grams (what
    0), and the totals and types of contexts (what 1)."""
    names = ["what", "key", *(f"{m}_{c}" for m in ("all", "fit") for c in _COLUMNS)]
    for batch in batches:
        text = batch.column("gram").to_pylist()
        if not text:
            continue
        value, _, place = grams(text)
        size = np.array([len(g) for g in text], np.int64)
        last = np.cumsum(size) - 1
        counts = [np.asarray(batch.column(c)) for c in _COUNTS]
        zero = np.zeros(len(text), np.int64)
        for n in range(1, ORDER + 1):
            k = np.flatnonzero(size == n)
            at, z = last[k], zero[k]
            before = value[n - 1, at - 1] if n > 1 else np.zeros(len(k), U64)
            for what, of in ((0, value[n, at]), (1, before)):
                cols = [z + what, _key(of, n, what).view(np.int64)]
                for c0, c1 in (counts[:2], counts[2:]):
                    cols += [c0[k], c1[k], *((c0[k] > 0, c1[k] > 0) if what else (z, z))]
                yield pa.record_batch([pa.array(np.asarray(c, np.int64)) for c in cols], names=names)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words by class: of rows that are not held (c0, c1), and of
    those that are (held0, held1)."""
    found: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        cols = [pa.array(list(found), pa.string()), *(pa.array([c[i] for c in found.values()], pa.int64()) for i in range(4))]
        return pa.record_batch(cols, names=["word", "c0", "c1", "held0", "held1"])

    for batch in small_batches(batches, "text", SLICE):
        for text, toxic, held in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "held")), strict=True):
            for word, n in Counter(WORD.findall(text.translate(_LOWER))).items():
                found.setdefault(word, [0, 0, 0, 0])[toxic + 2 * held] += n
        if len(found) > CACHE:
            yield out()
            found = {}
    yield out()


def counted(labelled: DataFrame) -> DataFrame:
    """Distinct words of rows (text, toxic, held) with their counts in each
    class: of all rows, and of those that aren't held."""
    cols = ["c0", "c1", "held0", "held1"]
    found = labelled.select("text", "toxic", "held").mapInArrow(_word_rows, "word string, " + ", ".join(f"{c} long" for c in cols))
    sums = found.groupBy("word").agg(*[F.sum(c).alias(c) for c in cols])
    whole = [(F.col(c) + F.col(h)).alias(a) for c, h, a in (("c0", "held0", "all0"), ("c1", "held1", "all1"))]
    return written(sums.select("word", *whole, F.col("c0").alias("fit0"), F.col("c1").alias("fit1")), "words")


def learn(labelled: DataFrame) -> tuple[Counts, Counts]:
    """The model from rows (text, toxic)."""
    return collected(models_of(counted(labelled.withColumn("held", F.lit(False)))), "all")


def models_of(words: DataFrame) -> DataFrame:
    """Both models from distinct words with their counts: for grams (what 0)
    their counts, for contexts (what 1) their totals and types. A gram of the
    shared orders counts in both classes."""
    long = ", ".join(f"{c} long" for c in _COUNTS)
    found = words.mapInArrow(_gram_rows, f"gram string, {long}").groupBy("gram").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    found = written(found, "grams").withColumn("n", F.char_length("gram"))
    forget_shuffles(words.sparkSession)
    # A shorter gram counts its distinct left neighbours; a word's beginning
    # has none and keeps its counts. Up to SHARED both classes share them.
    both = {m: F.col(pair[0]) + F.col(pair[1]) for m, pair in (("all", _ALL), ("fit", _FIT))}
    level = found.filter(F.col("n") == ORDER).drop("n")
    counted = [level]
    for n in range(ORDER - 1, 0, -1):
        seen = [F.sum((F.col(c) > 0).cast("long")).alias(c) for c in _COUNTS]
        left = level.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(*seen, *[F.sum((b > 0).cast("long")).alias(m) for m, b in both.items()])
        first = found.filter(F.col("n") == n).select("gram", *_COUNTS, *[b.alias(m) for m, b in both.items()])
        every = written(left.unionByName(first), f"order-{n}")
        counted.append(every.select("gram", *[F.col(c[:3] if n <= SHARED else c).alias(c) for c in _COUNTS]))
        level = every.drop(*both)
    union = counted[0]
    for more in counted[1:]:
        union = union.unionByName(more)
    cols = [f"{m}_{c}" for m in ("all", "fit") for c in _COLUMNS]
    added = union.mapInArrow(_count_rows, "what long, key long, " + ", ".join(f"{c} long" for c in cols))
    return written(added.groupBy("what", "key").agg(*[F.sum(c).cast("float").alias(c) for c in cols]), "models")


def collected(models: DataFrame, which: str) -> tuple[Counts, Counts]:
    """One of the models, ``all`` or ``fit``: the counts of grams, and the totals
    and types of contexts. Rows without any count aren't part of it."""
    out = []
    for what, cols in ((0, _COLUMNS[:2]), (1, _COLUMNS)):
        names = [f"{which}_{c}" for c in cols]
        part = models.filter((F.col("what") == what) & (F.col(names[0]) + F.col(names[1]) > 0)).select("key", *names).toArrow()
        out.append(Counts(part.column("key").to_numpy().view(U64), np.column_stack([part.column(c).to_numpy() for c in names])))
    return out[0], out[1]


def _log_ratios(model: tuple[Counts, Counts], value: np.ndarray, place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The log-likelihood ratios of the characters at some places."""
    out = np.full((2, len(at)), 1e-6)  # characters that no model knows
    for n in range(1, ORDER + 1):
        far = np.flatnonzero(place[at] >= n - 1)
        here = at[far]
        gram = model[0].of(_key(value[n, here], n, 0))
        ctx = model[1].of(_key(value[n - 1, here - 1] if n > 1 else np.zeros(len(here), U64), n, 1))
        for y in (0, 1):
            count, total, types = gram[:, y], ctx[:, y], ctx[:, 2 + y]
            known = total > 0
            p = out[y, far]
            mixed = (np.maximum(count - DISCOUNT, 0) + DISCOUNT * types * p) / np.where(known, total, 1)
            out[y, far] = np.where(known, np.clip(mixed, 1e-12, 1), p)
    return np.log(out[1]) - np.log(out[0])


class Seen:
    """Ratios of last characters already worked out, by the hash of the up to
    ORDER characters they follow from; a slot holds the latest of its keys."""

    def __init__(self, bits: int = 20):
        self.shift = U64(64 - bits)
        self.keys, self.ratio = np.zeros(1 << bits, U64), np.zeros(1 << bits)


def ratios(model: tuple[Counts, Counts], words: list[str], seen: Seen | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood ratio (toxic to ordinary) and characters of each word,
    its end mark included."""
    if not words:
        return np.zeros(0), np.zeros(0, np.int64)
    seen = seen or Seen(8)
    value, owner, place = grams([BEGIN + w + END for w in words])
    at = np.flatnonzero(place > 0)
    key = value[np.minimum(place[at] + 1, ORDER), at]
    slot = (key >> seen.shift).astype(np.int64)
    each = seen.ratio[slot]
    miss = np.flatnonzero(seen.keys[slot] != key)
    unlike, one, which = np.unique(key[miss], return_index=True, return_inverse=True)
    new = _log_ratios(model, value, place, at[miss[one]])
    each[miss] = new[which]
    slot = (unlike >> seen.shift).astype(np.int64)
    seen.keys[slot], seen.ratio[slot] = unlike, new
    return np.bincount(owner[at], weights=each, minlength=len(words)), np.bincount(owner[at], minlength=len(words))


class _Ratios:
    """Ratios of words: of the frequent ones as given (words, ratios, sizes), of
    others kept between batches. Words are known by their 64-bit hashes."""

    def __init__(self, model: tuple[Counts, Counts], often: tuple[list[str], np.ndarray, np.ndarray] | None = None):
        self.model, self.seen, self.often = model, Seen(), often or ([], np.zeros(0), np.zeros(0, np.int64))
        self.names = segment_hashes(np.frombuffer("\n".join(self.often[0]).encode(), np.uint8))[0].tolist()
        self.clear()

    def clear(self) -> None:
        _, self.ratio, self.size = self.often
        self.index: dict[int, int] = dict(zip(self.names, range(len(self.names)), strict=True))

    def of(self, flat: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ratios, sizes and first bytes of the words in UTF-8 text."""
        value, at = segment_hashes(np.frombuffer(flat, np.uint8), lower=True)
        unlike, one, which = np.unique(value, return_index=True, return_inverse=True)
        names = unlike.tolist()
        found = list(map(self.index.get, names))
        if None in found:
            if len(self.index) > CACHE + len(self.names):
                self.clear()
                found = list(map(self.index.get, names))
            new = [i for i, f in enumerate(found) if f is None]
            words = [_BYTE_WORD.match(flat, p)[0].lower().decode() for p in at[one[new]].tolist()]
            self.index.update(zip([names[i] for i in new], range(len(self.index), len(self.index) + len(new)), strict=True))
            r, s = ratios(self.model, words, self.seen)
            self.ratio, self.size = np.concatenate((self.ratio, r)), np.concatenate((self.size, s))
            found = list(map(self.index.__getitem__, names))
        i = np.array(found, np.int64)[which]
        return self.ratio[i], self.size[i], at


def statistics(known: _Ratios, texts: list[str]) -> np.ndarray:
    """For each text the ratio per character of all, and of the most toxic
    WINDOW successive words (all, if fewer); 0 without words."""
    raw = [t.encode() for t in texts]
    ratio, size, at = known.of(b"\n".join(raw))
    ends = np.cumsum(np.array([len(r) + 1 for r in raw], np.int64))
    cut = np.concatenate(([0], np.searchsorted(at, ends)))
    many = np.diff(cut)
    r, s = np.concatenate(([0], np.cumsum(ratio))), np.concatenate(([0], np.cumsum(size)))
    out = np.zeros((len(texts), 2))
    full = many > 0
    a, b = cut[:-1][full], cut[1:][full]
    out[full, 0] = (r[b] - r[a]) / (s[b] - s[a])
    k = np.minimum(many[full], WINDOW)
    begin = ranges(a, many[full] - k + 1)
    doc = np.repeat(np.arange(len(a)), many[full] - k + 1)
    rate = (r[begin + k[doc]] - r[begin]) / (s[begin + k[doc]] - s[begin])
    if len(doc):
        out[full, 1] = np.maximum.reduceat(rate, runs_of(doc)[0])
    return out


def _scorer(shared, weights: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ratios(*shared.value)
        for batch in small_batches(batches, "text", SLICE):
            x = statistics(known, batch.column("text").to_pylist())
            if weights is None:
                extra = {"toxic": batch.column("toxic"), "x0": pa.array(x[:, 0].copy()), "x1": pa.array(x[:, 1].copy())}
            else:
                extra = {"score": pa.array(logistic(x, weights))}
            yield pa.record_batch([batch.column("k"), *extra.values()], names=["k", *extra])

    return rows


def _frequent(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratio, size = ratios(shared.value, batch.column("word").to_pylist())
            yield pa.record_batch([batch.column("word"), pa.array(ratio), pa.array(size)], names=["word", "ratio", "size"])

    return rows


def _likely(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bits, np.asarray(batch.column("h")).view(U64), KEY_BITS)))

    return rows


def logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -700, 700)))


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (intercept first) by Newton steps with a slight ridge on the
    standardised statistics; without rows, the sum of the statistics."""
    if not len(y):
        return np.array([0.0, 1.0, 1.0])
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack((np.ones(len(y)), (x - mean) / scale))
    w, ridge = np.zeros(3), np.diag([1e-3, 1e-2, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    slope = w[1:] / scale
    return np.concatenate(([w[0] - slope @ mean], slope))


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo FOLDS; a null key is in fold 1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS, F.lit(1))


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: key, held_out (fold 0), score (0 to 1),
    predicted (1 if the score is 0.5 or more).

    Counts come from all labelled documents of folds 1 to 4, the logistic
    function from FIT_ROWS of fold 4 at most and the counts of all others;
    labels of fold 0 are never read. A key with several
    labels is toxic if one is; null labels and null keys don't count. Null
    texts count as empty and get the score of no evidence. Equal texts have
    equal scores. Further columns are not read. An empty table gives an empty
    result; without labels scores follow the (empty) counts.
    """
    spark = docs.sparkSession
    lab = labels.filter(f"toxic is not null and {key} is not null").groupBy(key).agg(F.max("toxic").alias("toxic"))
    lab = lab.select(F.col(key).alias("k"), (F.col("toxic") > 0).cast("int").alias("toxic"), fold(F.col(key)).alias("fold")).filter(F.col("fold") != HELD_OUT)
    rows = docs.select(F.col(f"`{key}`").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    # Most documents without a label are left out before the shuffle, by a
    # bitmap of the labelled keys' hashes that has one size for any number.
    labelled = spark.sparkContext.broadcast(bitmap(lab.select(F.xxhash64("k")), KEY_BITS).tobytes())
    likely = rows.filter(fold(F.col("k")) != HELD_OUT).withColumn("h", F.xxhash64("k"))
    train = written(likely.mapInArrow(_likely(labelled), likely.schema).drop("h").join(lab, "k"), "labelled")
    drawn = F.xxhash64("k", "text")
    tail = train.filter(F.col("fold") == FIT_FOLD).select("k", "text", "toxic", drawn.alias("h"))
    bar = tail.select("h").orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
    held = F.lit(False) if bar is None else (F.col("fold") == FIT_FOLD) & (drawn <= bar)
    words = counted(train.withColumn("held", held))
    forget_shuffles(spark)
    models = models_of(words)
    forget_shuffles(spark)
    kind = docs.schema[key].dataType.simpleString()
    shared = spark.sparkContext.broadcast((collected(models, "fit"),))
    fit = tail.orderBy("h").limit(FIT_ROWS).drop("h").repartition("k")
    x = fit.mapInArrow(_scorer(shared, None), f"k {kind}, toxic int, x0 double, x1 double").select("toxic", "x0", "x1").orderBy("toxic", "x0", "x1").toPandas()
    weights = fit_logistic(x[["x0", "x1"]].to_numpy(float), x["toxic"].to_numpy(float))
    model = collected(models, "all")
    n = F.col("all0") + F.col("all1")
    total = words.agg(F.sum(n)).first()[0] or 0
    often = words.filter(n * OFTEN > total).select("word").mapInArrow(_frequent(spark.sparkContext.broadcast(model)), "word string, ratio double, size long").toArrow()
    shared = spark.sparkContext.broadcast((model, (often.column("word").to_pylist(), often.column("ratio").to_numpy(), often.column("size").to_numpy())))
    out = rows.mapInArrow(_scorer(shared, weights), f"k {kind}, score double")
    return out.select(
        F.col("k").alias(key), (fold(F.col("k")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def op8_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity_kn": op8_toxicity_kn}
