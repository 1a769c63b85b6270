"""Operator 8: the model against plain Kneser-Ney, held-out accuracy."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from helpers import rows
from lotguard.llm import toxicity_kn as K


def plain(train):
    """log P(word | class) by the same definition, on strings."""
    raw = [Counter(), Counter()]
    for text, y in train:
        for w in text.lower().split():
            s = "\x02" + w + "\x03"
            for n in range(2, K.ORDER + 1):
                for i in range(n, len(s) + 1):
                    raw[y][n, s[i - n : i]] += 1
    count = [Counter(), Counter()]
    for y in (0, 1):
        for (n, g), c in raw[y].items():
            if n == K.ORDER or (g[0] == "\x02" and n > K.SHARED):
                count[y][n, g] += c
            if n - 1 > K.SHARED and g[1:]:
                count[y][n - 1, g[1:]] += 1
    for n, g in set(raw[0]) | set(raw[1]):
        if g[0] == "\x02" and n <= K.SHARED:
            for y in (0, 1):
                count[y][n, g] += raw[0][n, g] + raw[1][n, g]
        if n - 1 <= K.SHARED:
            for y in (0, 1):
                count[y][n - 1, g[1:]] += 1
    total, types = [defaultdict(int), defaultdict(int)], [defaultdict(int), defaultdict(int)]
    for y in (0, 1):
        for (n, g), c in count[y].items():
            total[y][n, g[:-1]] += c
            types[y][n, g[:-1]] += c > 0

    def ratio(w):
        s, out = "\x02" + w + "\x03", 0.0
        for i in range(1, len(s)):
            p = [1e-6, 1e-6]
            for n in range(1, K.ORDER + 1):
                if i - n + 1 < 0:
                    break
                g = s[i - n + 1 : i + 1]
                for y in (0, 1):
                    if t := total[y][n, g[:-1]]:
                        p[y] = min(max((max(count[y][n, g] - K.DISCOUNT, 0) + K.DISCOUNT * types[y][n, g[:-1]] * p[y]) / t, 1e-12), 1)
            out += math.log(p[1] / p[0])
        return out

    return ratio


def test_model(spark):
    train = [("the cat sat there", 0), ("that hat", 0), ("idiot cat idiotic", 1), ("Vequa vequb vequa", 1), ("é thé", 0), ("", 1)]
    model = K.learn(spark.createDataFrame(train, "text string, toxic int"))
    ratio = plain(train)
    words = ["cat", "the", "idiot", "vequz", "xyz", "thé", "a", "hatidiot"]
    got, size = K.ratios(model, words)
    assert size.tolist() == [len(w) + 1 for w in words]
    np.testing.assert_allclose(got, [ratio(w) for w in words], rtol=1e-4, atol=1e-4)


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in rows(K.op8_toxicity_kn(spark, d))}
    labels = pq.read_table(f"{d}/labels.parquet").to_pylist()
    held = [(got[r["doc_id"]]["score"], r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for k, r in got.items())
    s = pd.DataFrame(held, columns=["s", "y", "p"])
    ranks = s.s.rank()
    n1, n0 = (s.y == 1).sum(), (s.y == 0).sum()
    auc = (ranks[s.y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)
    assert auc > 0.9 and (s.p == s.y).mean() > 0.93, (auc, (s.p == s.y).mean())


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} idiot{'' if i % 3 else 'ic'} text {i}" if i % 2 else f"fine text {i}", 1, "s") for i in range(60)], "doc_id long, text string, score int, toxic string")
    lab = [(i, 1, i % 2) for i in range(60)]
    flip = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in lab] + [(None, 1, 1), (3, 0, None)]
    a, b = (sorted((r["doc_id"], r["score"]) for r in rows(K.scored(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")))) for x in (lab, flip))
    assert a == b


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_nulls_repeats_empty(spark, labels):
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([(None, "a b"), (1, None), (1, "a b"), (1, "a b"), (2, "")], "doc_id long, text string")
    got = rows(K.scored(docs, lab))
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 2}) == 1
    assert rows(K.scored(docs.limit(0), lab)) == []


def test_no_gram_shares_counts():
    """More keys than the 2^21 slots that all corpora once had."""
    rng = np.random.default_rng(6)
    keys = np.unique(rng.integers(0, 1 << 64, 2_300_000, np.uint64, endpoint=False))
    numbers = np.arange(2 * len(keys)).reshape(-1, 2) % 1009 + 1
    mixed = rng.permutation(len(keys))
    held = K.Counts(keys[mixed], numbers[mixed].astype(np.float32))
    assert (held.of(keys[::3]) == numbers[::3]).all()
    assert not held.of(keys[::3] + np.uint64(1)).any()
    assert not K.Counts(keys[:0], np.zeros((0, 2), np.float32)).of(keys[:5]).any()


def test_fold_4_is_evidence(spark, monkeypatch):
    """A toxic word that only labelled documents of fold 4 have, beyond the sample or in it."""
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    data = [(i, f"good words number{i % 9} here" if i % 2 else ("zorquix again" if fold(i) == 4 else "idiot again")) for i in range(300)]
    odd = next(i for i in range(300, 400) if fold(i) == 0)
    docs = spark.createDataFrame([*data, (odd, "zorquix"), (odd + 1000, "hlemyrt")], "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(300)], "doc_id long, quality int, toxic int")
    for limit in (K.FIT_ROWS, 10):
        monkeypatch.setattr(K, "FIT_ROWS", limit)
        got = {r["doc_id"]: r["score"] for r in rows(K.scored(docs, lab))}
        assert got[odd] > 0.99 and got[odd] > got[odd + 1000], (limit, got[odd], got[odd + 1000])
