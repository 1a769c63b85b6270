"""Operator 12 against sets of ids and DuckDB."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import rows
from lotguard.llm import filter_audit as A
from oracle_harness import compare

IDS = st.lists(st.integers(0, 3000), max_size=900).map(lambda x: np.array(sorted(set(x)), np.int32))


@settings(max_examples=300, deadline=None)
@given(st.lists(IDS, max_size=5), IDS)
def test_merges(lists, ids):
    every = A.union(lists)
    want = set().union(*(x.tolist() for x in lists))
    assert every.tolist() == sorted(want)
    assert A.difference(ids, every).tolist() == sorted(set(ids.tolist()) - want)


def test_merge_of_long_runs():
    a, b = np.arange(50000, dtype=np.int32), np.array([3, 49999, 50001], np.int32)
    assert len(A.union([a, b, a])) == 50001
    assert A.difference(a, b).tolist() == [x for x in range(49999) if x != 3]
    assert A.difference(b, a).tolist() == [50001]


def plain(docs, labels):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    parts = {}
    for i, (doc, text, lang) in enumerate(docs):
        t = text or ""
        w = word.findall(t)
        caps = len(re.findall("[A-Z]", t))
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * caps > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": doc is not None and any(d is not None and d < doc and (s or "") == t for d, s, _ in docs)}
        for f, no in fails.items():
            part = parts.setdefault(lang or "", {"all": set(), **{x: set() for x in "ABCDE"}})
            part["all"].add(i)
            if no:
                part[f].add(i)
    good, toxic = ({i for i, d in enumerate(docs) if any(x[0] == d[0] and x[k] == 1 for x in labels if x[0] is not None)} for k in (1, 2))
    out = set()
    for part, has in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        lines = []
        for order in permutations("ABCDE"):
            left = set(has["all"])
            for k, f in enumerate(order):
                gone = left & has[f]
                shapley[f] += len(gone)
                alone = has[f] - set().union(*(has[g] for g in "ABCDE" if g != f))
                lines.append(("".join(order), k + 1, f, len(left - gone), len(gone), len(has[f] - gone), len(alone), len(gone & good), len(gone & toxic)))
                left -= gone
        out |= {(part, o, k, *x, shapley[f]) for o, k, f, *x in lines}
    return out


NAMES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, docs, labels):
    d = spark.createDataFrame([(*x, 1, True, "n") for x in docs], "doc_id long, text string, lang string, id int, A boolean, part string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = rows(A.audit(A.postings(A.verdicts(d, lab), list("ABCDE"), ["good", "toxic"]), list("ABCDE"), ["good", "toxic"]))
    assert len(out) == len({tuple(r.values()) for r in out})
    return {tuple(r[n] for n in NAMES) for r in out}


@pytest.mark.parametrize("width", [1 << 16, 8])
def test_against_sets(spark, monkeypatch, width):
    monkeypatch.setattr(A, "RANGE", width)
    rnd = random.Random(5)
    texts = [None, "", "a b", "A B c #", " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i % 7}" for i in range(120)), "\x0bé É\t" * 60, "X" * 20 + " $" + " y" * 300000]
    docs = [(rnd.choice([i, i, i, None, 7]), rnd.choice(texts), rnd.choice(["en", "en", "de", None, ""])) for i in range(150)]
    docs += [(1000 + i, "one text of many", "fr") for i in range(90)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 1100, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    assert audited(spark, docs, labels) == plain(docs, labels)


def test_empty(spark):
    assert audited(spark, [], []) == set()
    assert len(audited(spark, [(1, None, None)], [])) == 600


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    got = compare(spark, f"/root/testdata/{sf}", "op12", A.op12_filter_audit, A.SQL["op12_filter_audit"])
    assert got["hash"] and got["schema"] and got["rows"] == got["oracle_rows"] > 0, got
