"""Operator 2 against brute force over all 400-byte strings."""

import hashlib
import os
import random
import re
from collections import Counter

import pyarrow.parquet as pq

from helpers import rows
from lotguard.llm import suffix_dedup as S


def brute_first(texts, length):
    """What is left of each text when a string's first occurrence stays."""
    raw, seen, out = [(t or "").encode() for t in texts], set(), []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(b[i : i + length])
        out.append(bytes(c for c, g in zip(b, gone, strict=True) if not g))
    return out


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + 400] for b in raw for i in range(len(b) - 399))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(400), text(90)
    texts = [None, "", "short", passage[:399], base, base, "ab" * 700, "x" * 401, "y" * 400]
    for k in range(12):  # near copies, edited at a few places
        words = base.split(" ")
        for _ in range(k % 4 + 1):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    for _ in range(10):
        texts.append(text(rng.randint(5, 60)) + " " + passage + " " + text(rng.randint(0, 80)))
    texts += [passage[:420] + "!" + passage[10:] + "?" + passage[5:440], text(700), text(60) + base[300:701], base[:399]]
    return texts


def frame(spark, texts, ids=None):
    data = [(i if ids is None else ids[i], t, "z", 5, 6) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, t_hash string, runs int, bucket int")


def test_brute_force(spark):
    texts = corpus()
    got = {r["doc_id"]: r for r in rows(S.dedup_report(frame(spark, texts)))}
    for i, want in enumerate(brute(texts)):
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want, (i, want, r)


def test_slices_agree(spark, monkeypatch):
    texts = [t for t in corpus() if t]
    whole = "|".join(texts)
    import numpy as np

    for body in (whole, "ab" * 3000):
        data = np.frombuffer(body.encode(), np.uint8)
        lo, n, *_ = S.position_runs(data, np.array([len(data)]))
        assert lo[0] == 0 and (lo[1:] == (lo + n)[:-1]).all() and lo[-1] + n[-1] == len(data) - 399


def test_null_and_repeated_keys(spark):
    texts = corpus()
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    got = rows(S.dedup_report(frame(spark, texts, ids)))
    want = Counter((k, *w) for k, w in zip(ids, brute(texts), strict=True))
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got) == want


def test_empty_table(spark):
    assert rows(S.dedup_report(frame(spark, []))) == []
    assert rows(S.remove_repeats(frame(spark, []))) == []


def test_remove_repeats_keeps_columns(spark):
    texts = corpus()
    docs = frame(spark, texts)
    out = S.remove_repeats(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in rows(out)}
    assert 4 not in got and got[1]["text"] == "" and got[0]["text"] is None and got[2]["text"] == "short"
    for i, (_, removed, _, digest) in enumerate(brute(texts)):
        if i in got and not removed:
            assert got[i]["text"] == texts[i]
        elif i in got and "�" not in texts[i]:
            assert len((got[i]["text"]).encode()) <= len(texts[i].encode()) - removed


def test_real_documents(spark):
    texts = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["text"]).column(0).to_pylist()[:60] * 2
    got = sorted((r["doc_id"], r["n_removed"], r["kept_sha256"]) for r in rows(S.dedup_report(frame(spark, texts))))
    assert got == [(i, w[1], w[3]) for i, w in enumerate(brute(texts))]


def test_repeated_blocks(spark):
    """A block three times in one text, near the reach of a bucket's q-gram."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(n)) * 3 for n in range(298, 305)]
    got = {r["doc_id"]: r for r in rows(S.dedup_report(frame(spark, texts)))}
    for i, want in enumerate(brute(texts)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == want, i


def test_first_occurrence_stays(spark):
    rng = random.Random(4)
    texts = [t for t in corpus()] + ["".join(rng.choice("abcdefgh") for _ in range(n)) * 3 for n in (149, 150, 151, 152, 226)]
    for length in (250, 175):
        got = {r["first"]: r for r in rows(S.repeated_strings(frame(spark, texts), length=length, keep_first="doc_id"))}
        for i, want in enumerate(brute_first(texts, length)):
            size = len((texts[i] or "").encode())
            assert bytes(got[i]["kept"]) == want if i in got else len(want) == size, (length, i)


def test_passage_of_sixty_words(spark):
    """Under 300 bytes, in two unlike documents: one copy stays."""
    rng = random.Random(6)
    text = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 5))) for _ in range(n))
    passage = text(60)
    assert 250 < len(passage) < 300
    docs = frame(spark, [text(200) + " " + passage + " " + text(90), None, "", text(30) + "\n" + passage + "\n" + text(150), text(200)], [7, None, 3, 2, 2])
    out = rows(S.remove_repeats(docs, length=225, keep_first="doc_id"))
    assert S.remove_repeats(docs, length=225, keep_first="doc_id").columns == docs.columns and len(out) == 5
    assert [passage in (r["text"] or "") for r in out if r["doc_id"] in (2, 7) and len(r["text"]) > 900 or r["doc_id"] == 7].count(True) <= 1
    whole = {r["doc_id"]: r["text"] for r in out if passage in (r["text"] or "")}
    assert list(whole) == [2]
    same = frame(spark, [passage * 2, passage * 2], [1, 1])  # rows equal in key and text count as one
    assert [r["text"] for r in rows(S.remove_repeats(same, length=225, keep_first="doc_id"))] == [passage] * 2


def test_tables_between_steps_go(spark):
    from lotguard.session import ensure_checkpoint_dir

    home = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(home))
    S.repeated_strings(frame(spark, corpus()), length=225, keep_first="doc_id")
    left = Counter(re.match("llm-(.*)-", f)[1] for f in set(os.listdir(home)) - before if f.startswith("llm-"))
    assert not set(left) & {"runs", "buckets", "shared-runs", "groups", "short-runs"} and left["repeated-texts"] == 1
