"""Operator 1: lattices against all segmentations, samples against their law."""

import math

import numpy as np
import pytest
import sentencepiece

from helpers import rows
from lotguard.llm import sentencepiece_lattice as S

MODEL = S.load_model()
SP = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
ODD = ["", " ", "  a", "a ", "\n", "a\n b\t\r\nc", "▁ x▁", "日本 😀é\x00", "naïve  coöperation;\r\n", "x" * 300, " " * 40 + "y", "ab" * 50 + " " + "thé " * 30]


def all_of(text):
    """Every segmentation (ids) with its probability."""
    ids = {p: i for i, p in enumerate(MODEL["pieces"]) if MODEL["kinds"][i] == 1}
    bytes_ = {p: i for i, p in enumerate(MODEL["pieces"]) if MODEL["kinds"][i] == 2}

    def of(t):
        if not t:
            return [((), 0.0)]
        out = []
        for n in range(1, len(t) + 1):
            i = ids.get(t[:n].encode())
            head = (i,) if i is not None else tuple(bytes_[bytes([b])] for b in t[:n].encode()) if n == 1 else None
            if head:
                out += [(head + rest, sum(MODEL["logp"][list(head)]) + lp) for rest, lp in of(t[n:])]
        return out

    found = of(" " + text)
    top = max(lp for _, lp in found)
    z = top + math.log(sum(math.exp(lp - top) for _, lp in found))
    return {s: lp - z for s, lp in found}


def sample(text, k, many, seed=0):
    lat = S.Lattices(MODEL)
    keys = S.mix(np.arange(seed + 1, seed + many + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return S.sample_texts(lat, keys, [text] * many, k)


@pytest.mark.parametrize("text", ["ab", "the", "in an", "aé▁", "on\nto"])
def test_all_segmentations(text):
    every = all_of(text)
    got = sample(text, len(every) + 3, 3)
    for rows_ in got:
        assert {tuple(map(int, r[3])) for r in rows_} == set(every) and len(rows_) == len(every)
        for value, lp, inclusion, ids in rows_:
            assert abs(every[tuple(map(int, ids))] - lp) < 1e-9 and inclusion == 1.0
        values = [r[0] for r in rows_]
        assert values == sorted(values, reverse=True)


def test_law_of_the_samples():
    text, many = "then an", 6000
    every = all_of(text)
    one = sample(text, 1, many)
    for s, lp in sorted(every.items(), key=lambda x: -x[1])[:4]:
        p = math.exp(lp)
        share = np.mean([tuple(map(int, r[0][3])) == s for r in one])
        assert abs(share - p) < 5 * math.sqrt(p * (1 - p) / many) + 1e-3
    # the second, given the first, follows the rest's probabilities
    two = sample(text, 2, many, 10**6)
    (a, la), (b, lb) = sorted(every.items(), key=lambda x: -x[1])[:2]
    after = [tuple(map(int, r[1][3])) for r in two if tuple(map(int, r[0][3])) == a]
    p = math.exp(lb) / (1 - math.exp(la))
    assert abs(np.mean([x == b for x in after]) - p) < 5 * math.sqrt(p * (1 - p) / len(after))
    # inclusion weighting: the estimated number of segmentations with a mark is right
    draws = sample(text, 3, 4000, 77)
    for s in [s for s, lp in every.items() if lp > -5]:
        est = np.array([sum(1 / r[2] for r in rs if tuple(map(int, r[3])) == s) for rs in draws])
        assert abs(est.mean() - 1) < 5 * est.std() / math.sqrt(len(est)) + 1e-3


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, 3, "x", 4) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, seed int, key string, ids int")


def test_round_trip(spark):
    got = rows(S.decode(S.encode(frame(spark, ODD), k=3)))
    assert {r["doc_id"] for r in got} == set(range(len(ODD))) and all(r["exact"] for r in got)
    seen = {}
    for r in got:
        assert r["decoded"] == ODD[r["doc_id"]]
        seen.setdefault(r["doc_id"], []).append(tuple(r["ids"]))
        if ODD[r["doc_id"]] and not ODD[r["doc_id"]].startswith(" "):
            assert SP.decode(r["ids"]) == ODD[r["doc_id"]]
    assert all(len(v) == len(set(v)) for v in seen.values()) and len(seen[0]) == 1
    assert [x["sample"] for x in sorted((r for r in got if r["doc_id"] == 9), key=lambda r: -r["perturbed"])] == [0, 1, 2]


def test_nulls_repeats_and_batches(spark):
    texts = [None, "same text", "same text", "other", "same text", None]
    docs = frame(spark, texts, [None, 1, 1, 1, None, 5])
    a = sorted(map(str, rows(S.encode(docs))))
    b = sorted(map(str, rows(S.encode(docs.repartition(3)))))
    assert a == b and len(a) == 2 + 8
    assert rows(S.encode(frame(spark, []))) == []


def test_cache_does_not_matter(monkeypatch):
    key = np.array([5, 6], np.uint64)
    lat = S.Lattices(MODEL)
    a = S.sample_texts(lat, key, ["some words here", "words again here"], 2)
    monkeypatch.setattr(S, "CACHE", 0)
    monkeypatch.setattr(S, "CHUNK", 2)
    b = S.sample_texts(lat, key, ["some words here", "words again here"], 2)
    assert str(a) == str(b)


def test_words_met_often_stay(monkeypatch):
    """A full cache keeps the words that come again and again; samples stay the same."""
    key = np.array([5, 6], np.uint64)
    often = "the same words and the naïve 日本 ones "
    texts = [[often + " ".join(f"w{i}x{j}q" for j in range(400)), often] for i in range(6)]
    fresh = [str(S.sample_texts(S.Lattices(MODEL), key, t, 2)) for t in texts]
    monkeypatch.setattr(S, "CACHE", 1 << 17)
    lat, put_in = S.Lattices(MODEL), []
    add = lat.add
    monkeypatch.setattr(lat, "add", lambda chars, size, names: (put_in.append(names), add(chars, size, names))[1])
    assert [str(S.sample_texts(lat, key, t, 2)) for t in texts] == fresh
    assert lat.held() < 1 << 18 and len(lat.index) < 1000  # it was thinned
    # what was put in at first and came again was kept
    again = [n for names in put_in[2:] for n in names]
    assert len(put_in) >= 6 and not set(put_in[0]) & set(again)


def test_real_documents(spark):
    got = rows(S.op1_gumbel_segmentations(spark, "/root/testdata/sf0.001").select("doc_id", "sample", "exact", "log_prob", "inclusion"))
    assert len(got) == 400 and all(r["exact"] and r["log_prob"] <= 0 and 0 <= r["inclusion"] <= 1 for r in got)
