"""Operator 13 against a plain trie and DuckDB."""

import hashlib
import random
import zlib

import pytest

from helpers import rows
from lotguard.llm import prefix_trie as P
from oracle_harness import compare


def frame(spark, data):
    return spark.createDataFrame([(*d, 7, "x") for d in data], "conv_id long, turn long, role string, text string, n int, ends string")


def plain(data):
    """Nodes by their whole prefix."""
    own = {}
    for conv, turn, role, text in data:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - (abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    below = {k: [j for j in members if j[: len(k)] == k] for k in members}
    kids = {k: [j for j in below[k] if len(j) == len(k) + 1] for k in members}
    out = set()
    for k, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        saved = sum((len(members[j]) - 1) * (len(j[-1][1].encode()) if j else 0) for j in below[k])
        out.add((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]), sum(not kids[j] for j in below[k]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(spark, data):
    got = rows(P.trie(P.rebuilt(P.encoded(frame(spark, data)))))
    out = [tuple(r[n] for n in NAMES) for r in got]
    assert len(out) == len(set(out))
    return set(out)


@pytest.mark.parametrize("shard,block", [(1 << 19, 1 << 14), (6, 4), (1, 1)])
def test_against_plain_trie(spark, monkeypatch, shard, block):
    monkeypatch.setattr(P, "SHARD", shard)
    monkeypatch.setattr(P, "BLOCK", block)
    rnd = random.Random(shard)
    data = [(c, t, rnd.choice(["user", "user", None]), rnd.choice(["a", "a", "é", "", None])) for c in [*range(40), -3, 10**12] for t in range(rnd.choice([1, 3, 9, 12]))]
    data += [(c, t, "user", "same") for c in range(100, 140) for t in range(11)]  # one list of many members
    data += [(200, None, "b", "x"), (200, 1, "a", "x"), (200, 1, "a", "x"), (200, 1, None, "y"), (200, None, "a", "x"), (None, 0, "user", "x")]
    assert nodes(spark, data) == plain(data)


def test_long_conversation_and_empty(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 100)
    data = [(0, t, "user", str(t % 3)) for t in range(700)] + [(5, t, "user", str(t % 3)) for t in range(650)] + [(1, 0, "user", "z" * 100000)]
    assert nodes(spark, data) == plain(data)
    assert rows(P.trie(P.rebuilt(P.encoded(frame(spark, []))))) == []


def test_medians_balance():
    assert sorted(P.medians(100)) == list(range(100)) and list(P.medians(3)) == [1, 0, 2]
    tree = P.TernaryTree()
    for i in P.medians(1023):
        tree.insert([i], [1], 1, i, "")

    def height(v):
        return 0 if v < 0 else 1 + max(height(tree.less[v]), height(tree.more[v]))

    assert height(tree.child[0]) == 10


def test_hot_join(spark):
    from pyspark.sql import functions as F

    from lotguard.llm.hot_join import hot_join

    facts = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 != 0, F.col("id") % 900).cast("long").alias("k"), "id")
    keys = facts.filter("k is not null").groupBy("k").agg(F.count("*").alias("uses"), F.max("id").alias("top"))
    want = sorted(map(tuple, facts.join(keys.drop("uses"), "k").collect()))
    assert sorted(map(tuple, hot_join(facts, keys, "k", "uses", 5000).collect())) == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql(spark, sf):
    got = compare(spark, f"/root/testdata/{sf}", "op13", P.op13_prefix_trie, P.SQL["op13_prefix_trie"])
    assert got["hash"] and got["schema"] and got["rows"] == got["oracle_rows"] > 0, got
