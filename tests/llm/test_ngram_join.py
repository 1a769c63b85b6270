"""Operator 10 against brute force over all pairs."""

import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from helpers import rows
from lotguard.llm import ngram_join as J
from lotguard.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets(texts):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        out.append({tuple(w[i : i + 4]) for i in range(len(w) - 3)} or ({tuple(w)} if w else set()))
    return out


def brute(ids, texts):
    s = sets(texts)
    root = list(range(len(s)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            common = len(s[i] & s[j])
            if s[i] and s[j] and 100 * common >= 85 * (len(s[i]) + len(s[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(s)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [(ids[i], len(s[i]), least.get(find(i))) for i in range(len(s))]


def frame(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    return spark.createDataFrame([(i, t, "a", 1, 2) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, sig string, t_len int, root int")


def corpus(seed, many=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeéABC") for _ in range(rng.randint(1, 6)))
    texts = [None, "", " \n\t", "one", "ONE  one", "a b c", "A B\tc", "a b c d", "a b c D", "x" * 200 + " " + "y" * 70, "x" * 200 + " " + "y" * 71]
    for _ in range(4):
        base = [word() for _ in range(rng.choice([6, 15, 40, 150, 700]))]
        for _ in range(many // 4):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 30))):
                p = rng.randrange(len(copy))
                copy[p : p + rng.randint(0, 2)] = [word() for _ in range(rng.randint(0, 2))]
            base = copy if rng.random() < 0.3 and len(copy) > 4 else base
            texts.append(rng.choice([" ", "\n", "  "]).join(copy))
    texts += [" ".join(word() for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return texts + texts[5:25]


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    texts = corpus(seed)
    got = {r["doc_id"]: (r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(J.joined(frame(spark, texts)))}
    assert [got[i] for i in range(len(texts))] == brute(list(range(len(texts))), texts)


def borderline(seed):
    """Clusters whose texts are near the limit from each other, in chains."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    texts = []
    for size in (30, 60, 110, 300):
        base = [word() for _ in range(size)]
        for _ in range(3):
            way = list(base)
            for _ in range(12):
                copy = list(way)
                for _ in range(rng.randint(0, max(1, size // 45))):
                    copy[rng.randrange(len(copy))] = word()
                if rng.random() < 0.4:
                    way = copy
                if rng.random() < 0.2:
                    copy = copy[: -rng.randint(1, 6)]
                texts.append(" ".join(copy))
        passage = base[: size // 2]
        texts += [" ".join(passage + [word() for _ in range(rng.randint(2, size // 3))]) for _ in range(8)]
    return texts


@pytest.mark.parametrize("block", [1000, 3])
def test_what_hubs_leave(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    texts = borderline(11)
    got = {r["doc_id"]: (r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(J.joined(frame(spark, texts)))}
    assert [got[i] for i in range(len(texts))] == brute(list(range(len(texts))), texts)


def test_keys_null_and_repeated(spark):
    texts = corpus(5, 20)
    ids = [None if i % 5 == 0 else i // 2 for i in range(len(texts))]
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(J.joined(frame(spark, texts, ids))))
    want = Counter((i, n, i if not n else c) for i, n, c in brute(ids, texts))
    assert got == want


def test_one_of_each(spark):
    texts = corpus(7, 20)
    docs = frame(spark, texts)
    out = J.one_of_each(docs)
    assert out.columns == docs.columns
    want = {i for i, n, c in brute(list(range(len(texts))), texts) if not n or c == i}
    assert sorted(r["doc_id"] for r in rows(out)) == sorted(want)
    twice = frame(spark, ["a b c d e"] * 3 + [None, "x y z"], [4, 4, None, 2, None])
    assert Counter((r["doc_id"], r["text"]) for r in rows(J.one_of_each(twice))) == Counter([(4, "a b c d e"), (2, None), (None, "x y z")])


def test_empty(spark):
    assert rows(J.joined(frame(spark, []))) == []
    assert rows(J.one_of_each(frame(spark, []))) == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for _ in range(1500):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        gone, new = (int(x) for x in rng.integers(0, n * 0.09 + 1.5, 2))
        b = np.unique(np.concatenate((rng.permutation(a)[gone:], rng.integers(0, 1 << 62, new).astype(np.uint64))))
        common = len(np.intersect1d(a, b))
        if len(b) and 100 * common >= 85 * (len(a) + len(b) - common):
            last = J.bands(1000)
            assert len(np.intersect1d(J.signatures(a, last), J.signatures(b, last)))


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(25)] + [(200, 201 + i) for i in range(50)]
    got = {r["id"]: r["root"] for r in rows(components(spark.createDataFrame(edges, "a long, b long")))}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: r for x, r in root.items() if x in linked}


def test_real_documents(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows(J.op10_ngram_jaccard_join(spark, "/root/testdata/sf0.001")))
    assert got == sorted(brute(t["doc_id"], t["text"]))


def test_five_words_and_four_fifths(spark):
    """Pairs on both sides of 0.8 with 5-word shingles, most of them under 0.85 with 4."""
    import corpus_pipeline

    rng = random.Random(9)
    texts = []
    for n in (30, 80, 200):
        for k in range(14):
            base = [f"w{rng.randrange(10**9)}" for _ in range(n)]
            copy = list(base)
            for p in rng.sample(range(0, n, 6), min(n // 6, max(1, n * (k + 4) // 500))):
                copy[p] = "changed"
            texts += [" ".join(base), " ".join(copy)]
    words = [t.split() for t in texts]
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]
    want = {i for i in range(len(texts)) if i % 2 == 0 or 5 * len(shingles[i] & shingles[i - 1]) < 4 * len(shingles[i] | shingles[i - 1])}
    assert len(texts) // 2 < len(want) < len(texts)
    assert {r["doc_id"] for r in rows(corpus_pipeline.near_duplicates(spark, frame(spark, texts), ""))} == want


def test_a_text_travels_once_for_a_group(spark):
    """Forty texts with ten right ones each, and a right one that many have."""
    pairs = [(100 + a, b) for a in range(40) for b in range(10)] + [(1000 + a, 50) for a in range(1500)]
    sizes = spark.createDataFrame([(t, 100) for t in {x for p in pairs for x in p}], "t_id long, packed int")
    got = rows(J.grouped(spark.createDataFrame(pairs, "a long, b long"), sizes))
    assert sorted((r["a"], r["b"]) for r in got) == sorted(pairs)
    assert len({(r["a"], r["g"], r["i"], r["j"]) for r in got if r["b"] < 10}) == 40
    assert max(Counter((r["g"], r["i"], r["j"]) for r in got if r["b"] == 50).values()) < 1.5 * J.LEFT


def test_tables_between_steps_go(spark):
    from lotguard.session import ensure_checkpoint_dir

    home = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(home))
    J.linked_texts(frame(spark, corpus(3, 20)))
    left = Counter(re.match("llm-(.*)-", f)[1] for f in set(os.listdir(home)) - before if f.startswith("llm-"))
    assert not set(left) & {"sharers", "texts", "sketches", "pairs", "first", "near", "loose", "grouped", "least"} and left["links"] == 1
