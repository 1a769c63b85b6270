"""Operator 7: statistics against plain Python, forest and cut on fixtures."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq

from helpers import rows
from lotguard.llm import quality_forest as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(t):
    t = t or ""
    w = WORD.findall(t)
    seen = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover))


def texts(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé#|ü") for _ in range(rng.randint(1, 3)))
    out = ["", " \n \n", "a", "a\na\n a\n\n\na", "a b c a b c", "a b c b c", "x" * 500 + " " + "x" * 500 + "\n" + "x" * 500, "\n\n", "a b c\na b c\r\na b c\x0ba b c d"]
    for _ in range(80):
        out.append("".join(rng.choice([word(), " ", "\n", "\t", "a b c"]) for _ in range(rng.randint(1, 200))))
    return out


def test_statistics():
    ts = texts()
    got = Q.statistics([t.encode() for t in ts])
    for t, g in zip(ts, got, strict=True):
        assert tuple(g) == plain(t), t


def test_real_statistics_and_verdicts(spark):
    got = rows(Q.op7_quality_forest(spark, "/root/testdata/sf0.01"))
    docs = {d: t for d, t in zip(*pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["doc_id", "text"]).to_pydict().values(), strict=True)}
    quality = dict(zip(*pq.read_table("/root/testdata/sf0.01/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values(), strict=True))
    assert len(got) == len(docs)
    for r in got:
        s = plain(docs[r["doc_id"]])
        assert tuple(r[n] for n in Q.NAMES) == s
        assert r["base_failed"] == (s[0] < 50 or 100 * s[4] > 50 * s[0])
        assert not (r["kept"] and r["base_failed"])
    bad = [r["kept"] for r in got if quality.get(r["doc_id"]) == 0]
    good = [r["kept"] for r in got if quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert np.mean(bad) < 0.1 and np.mean(good) > 0.98


def test_forest_isolates_outliers():
    rng = np.random.default_rng(0)
    points = np.concatenate((rng.normal(5, 0.2, (500, 4)), rng.normal(9, 0.2, (5, 4))))
    forest = [(len(p), np.array(Q.grow(p, i))) for i in range(50) for p in [points[rng.choice(505, 128, False)]]]
    s = Q.scores(forest, points)
    assert s[500:].min() > s[:500].mean() + 0.1 and (Q.scores([], points) == 0).all()
    same = np.ones((10, 4))
    assert len(Q.grow(same, 1)) == 1 and len(Q.grow(same[:1], 1)) == 1


def frame(spark, ts, ids=None):
    ids = list(range(len(ts))) if ids is None else ids
    return spark.createDataFrame([(i, t, 1.0, "w", 3) for i, t in zip(ids, ts, strict=True)], "doc_id long, text string, score double, body string, n_words int")


def test_nulls_repeats_extra_columns(spark):
    prose = [" ".join(f"w{i * 7 + k}x" for k in range(60)) for i in range(20)]
    ts = [None, ""] + prose + prose[:3]
    ids = [None, 1] + list(range(2, 22)) + [2, None, 4]
    docs = frame(spark, ts, ids)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = rows(Q.judged(docs, none))
    assert Counter(r["doc_id"] for r in out) == Counter(ids)
    assert [r["base_failed"] for r in out if r["n_words"] == 0] == [True, True]
    assert all(r["kept"] for r in out if r["n_words"])
    kept = Q.keep_good(docs, none)
    assert kept.columns == docs.columns and Counter(r["text"] for r in rows(kept)) == Counter(ts[2:])
    assert {r["score"] for r in rows(kept)} == {1.0}


def test_empty(spark):
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert rows(Q.judged(frame(spark, []), labels)) == [] and rows(Q.keep_good(frame(spark, []), labels)) == []


def test_full_trees_with_many_copies(spark):
    """One distinct passing text in ten rows: each tree still gets its sample."""
    real = dict.fromkeys(t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist())
    raw = [t.encode() for t in real]
    good = [t for t, failed in zip(real, Q.base_failed(Q.statistics(raw)), strict=True) if not failed][:400]
    assert len(good) == 400
    forest = Q.fit(frame(spark, good + [good[0], "bad"] * 1800))
    assert len(forest) == Q.TREES and all(points == Q.SAMPLE for points, _ in forest)
