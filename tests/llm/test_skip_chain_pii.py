"""Operator 11: base spans against plain patterns, marginals against all
labellings, and what the trained field adds or leaves alone."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import rows
from lotguard.llm import skip_chain_pii as S
from lotguard.llm.common import table

SF = "/root/testdata/sf0.01"


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate([("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
                                         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            double = sum(d if i % 2 == 0 else (2 * d if 2 * d < 10 else 2 * d - 9) for i, d in enumerate(reversed(digits)))
            ok = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 13 <= len(digits) <= 19 and double % 10 == 0, "phone": 9 <= len(digits) <= 15}
            if ok[kind]:
                out.append((k, *m.span()))
    return out


PIECES = ["@", ".", "a", "é", "b@c.de", "1.2.3.4", "255", "0", "4111 1111-1111 1111", "+49 (170) 123-4567", "-", " ", "  ", "(", ")", "+1", "7", "\n", "%", "256.1.1.1"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_base_spans(text):
    assert S.base_spans(text) == plain_spans(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 400000, "a" * 400000, "a@" * 200000, "+1" + "(" * 400000, "1." * 200000, "a" * 200000 + "@" + "b" * 200000):
        S.base_spans(text)
        S.Graph().add(0, text, [])


def exact(unary, edges, pairs):
    n, k = unary.shape
    node, total = np.zeros((n, k)), 0.0
    for y in itertools.product(range(k), repeat=n):
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + sum(pairs[t, y[a], y[b]] for a, b, t in edges))
        total += w
        for i in range(n):
            node[i, y[i]] += w
    return node / total


def test_propagation_against_all_labellings():
    rnd = np.random.default_rng(3)
    pairs = rnd.normal(size=(3, 3, 3)) * 0.7
    unary = rnd.normal(size=(5, 3))
    tree = np.array([(0, 1, 0), (1, 2, 0), (1, 3, 1), (3, 4, 2)])
    assert np.allclose(S.propagate(unary, tree, pairs, 60)[0], exact(unary, tree, pairs), atol=1e-6)
    loop = np.array([(0, 1, 0), (1, 2, 0), (0, 2, 1), (2, 3, 0), (3, 4, 0), (1, 4, 2)])
    assert np.abs(S.propagate(unary, loop, pairs, 60)[0] - exact(unary, loop, pairs)).max() < 0.12
    assert np.allclose(S.propagate(unary, np.zeros((0, 3), int), pairs, 5)[0].sum(1), 1)


@pytest.fixture(scope="module")
def model(spark):
    return S.fitted(table(spark, SF, "documents"))


def found(spark, model, texts):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_card int")
    return sorted(rows(S.find_personal_data(docs, model)), key=lambda r: r["doc_id"])


def test_query_keeps_base_and_clean_documents(spark, model):
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    got = rows(S.op11_skip_chain_pii(spark, SF))
    assert len(got) == len(docs)
    for r in got:
        base = plain_spans(docs[r["doc_id"]])
        said = [f"{S.KINDS[k]}:{s}:{e}" for k, s, e in base]
        assert [r[f"n_{k}"] for k in S.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
        assert r["base_sha256"] == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert set(said) <= set(r["spans"].split(",") if r["spans"] else [])
        assert r["n_added"] == 0 or base  # nothing is added where there is no personal data
    clean = [r for r in got if not r["n_added"] and not r["spans"]]
    assert len(clean) > 0.8 * len(got)


def test_repeated_entities_are_added(spark, model):
    text = "the of +1 (487) 555-7209 ndhain in that reding 555-7209 than. The (487) 555-7209 again"
    assert "+" not in text[30:]
    r = found(spark, model, [text])[0]
    at = [m.start() for m in re.finditer("555-7209", text)]
    assert r["n_phone"] == 1 and r["n_added"] == 2
    assert f"phone:{at[1]}:{at[1] + 8}" in r["spans"] and f"phone:{at[2] - 6}:{at[2] + 8}" in r["spans"]


def test_decoys_stay(spark, model):
    texts = ["on in 9807915762804490 edly 9807915762804490 an", "Version 2.0. of the 3. and 4.0. license, section 2.0.", 'token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B" in', "of 300.1.2.3 the 300.1.2.3 in"]
    assert [r["spans"] for r in found(spark, model, texts)] == [""] * 4


def test_held_out_labels(spark):
    """Trained on even documents, the field finds the base labels of odd ones
    also where the features of base patterns are hidden."""
    texts = [r["text"] or "" for r in table(spark, "/root/testdata/sf0.1", "documents").filter("doc_id < 4000").orderBy("doc_id").collect()]
    fit, held = S.Graph(), S.Graph()
    for i, t in enumerate(texts):
        (held if i % 2 else fit).add(i, t, S.base_spans(t))
    model = S.Model().fit(fit)
    truth = np.array(held.labels)
    assert (model.marginals(held).argmax(1) == truth).mean() > 0.99


def test_defined_cases(spark, model):
    rnd = random.Random(1)
    long = " ".join(rnd.choice(["word", "4845168114407329", "a.b@c.example.com", "12"]) for _ in range(60000))
    got = found(spark, model, [None, "", "a", long, "+1 (487) 555-7209", "+1 (487) 555-7209"])
    assert [r["spans"] for r in got[:3]] == ["", "", ""]
    base = plain_spans(long)
    assert got[3]["n_card"] == sum(b[0] == 2 for b in base) and got[3]["n_email"] == sum(b[0] == 0 for b in base)
    assert got[4]["spans"] == got[5]["spans"] == "phone:0:17"
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert rows(S.find_personal_data(empty, S.fitted(empty))) == []
    text = spark.createDataFrame([("k", "+1 (487) 555-7209"), (None, None)], "doc_id string, text string")
    assert {r["doc_id"] for r in rows(S.find_personal_data(text, model))} == {"k", None}
