"""Operator 5 against a plain version, and against DuckDB."""

import hashlib
import random
import re

from helpers import rows
from lotguard.llm import sentence_spans as S
from oracle_harness import compare, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def again(piece):
    """A long piece cut behind its marked words."""
    words = list(WORD.finditer(piece))
    if len(words) <= S.LONG:
        return [piece]
    ends = [m.end() for m in words[:-1] if hashlib.md5(m[0].encode()).hexdigest()[0] in "01"]
    return [piece[a:b] for a, b in zip([0, *ends], [*ends, len(piece)], strict=True)]


def plain(docs):
    """docs: distinct (key, text), in the order of documents."""
    seen, out = set(), {}
    for key, text in docs:
        pieces = [x for p in re.findall(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+", text or "") for x in again(p)]
        said = [(i, tuple(WORD.findall(p))) for i, p in enumerate(pieces) if WORD.search(p)]
        runs = []
        for a in range(len(said)):
            for b in range(a + S.SENTENCES, len(said) + 1):
                if sum(len(w) for _, w in said[a:b]) >= S.WORDS:
                    runs.append((a, b))
                    break
        runs = runs or ([(0, len(said))] if said else [])
        gone = set()
        for a, b in runs:
            run = tuple(w for _, w in said[a:b])
            if run in seen:
                gone |= {said[i][0] for i in range(a, b)}
            seen.add(run)
        kept = "".join(p for i, p in enumerate(pieces) if i not in gone)
        out[key, text] = (len(said), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.randint(1, 4)))
    say = lambda: " ".join(word() for _ in range(rng.randint(1, 9))) + rng.choice([". ", "!", "?? ", "\n", ".\n\n "])
    pool = ["".join(say() for _ in range(rng.randint(2, 6))) for _ in range(6)]
    texts = [None, "", " . \n!", "Hi.", "Hi.", "one two three", "one  two\tthree"]
    for _ in range(60):
        texts.append("".join(rng.choice([say(), say(), rng.choice(pool)]) for _ in range(rng.randint(1, 12))))
    bare = [word() for _ in range(90)]
    texts += [" ".join([*(word() for _ in range(rng.randint(0, 40))), *bare, *(word() for _ in range(9))]) for _ in range(4)]
    return texts + [texts[-1] * 2, texts[20], texts[21], " \t".join(bare) + " ", "same " * 300]


def frame(spark, data):
    return spark.createDataFrame([(*d, 1, "b", 0) for d in data], "doc_id long, text string, a int, later string, k int")


def test_plain(spark):
    data = list(enumerate(corpus()))
    want = plain(data)
    got = rows(S.span_dedup(frame(spark, data)))
    assert len(got) == len(data)
    for r in got:
        w = want[r["doc_id"], data[r["doc_id"]][1]]
        assert (r["n_sentences"], r["n_removed"], r["kept_sha256"]) == w, (data[r["doc_id"]], r, w)


def test_null_and_repeated(spark):
    two = " ".join(f"w{i}" for i in range(11)) + ". " + " ".join(f"w{i}" for i in range(20, 31)) + "."
    data = [(None, two), (3, two), (3, two), (None, None), (1, "x"), (1, "x")]
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_sentences"], r["n_removed"], r["kept_text"]) for r in rows(S.span_dedup(frame(spark, data))))
    whole = data[0][1]
    assert got == [(False, 1, 1, 0, "x")] * 2 + [(False, 3, 2, 0, whole)] * 2 + [(True, 0, 0, 0, ""), (True, 0, 2, 2, "")]
    assert rows(S.span_dedup(frame(spark, []))) == []


def test_oracle(spark):
    d = "/root/testdata/sf0.001"
    r = compare(spark, d, "op5", S.op5_sentence_spans, S.SQL["op5_sentence_spans"], duck(d))
    assert r["schema"] and r["hash"] and r["rows"] == r["oracle_rows"], r


def test_a_passage_without_marks_is_found(spark):
    """Sixty words without a full stop, in two unlike texts."""
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    passage = text(60)
    got = {r["doc_id"]: r["kept_text"] for r in rows(S.span_dedup(frame(spark, [(1, f"{text(50)} {passage} {text(70)}"), (2, f"{text(33)} {passage} {text(8)}")])))}
    left = [w for w in passage.split() if w in got[2].split()]
    assert passage in got[1] and len(left) < 25
