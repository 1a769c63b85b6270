"""Operator 6: balance, indivisible groups, slots."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

from helpers import rows
from lotguard.llm import shard_differencing as K


def frame(spark, data):
    return spark.createDataFrame([(i, t, 1, 2, "s") for i, t in data], "doc_id long, text string, n int, shard int, law string")


def holds(got, data):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data
    )
    shards = defaultdict(list)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        shards[r["shard"]].append(r)
    for rs in shards.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    by_text = defaultdict(set)
    for r in got:
        by_text[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in by_text.values())
    return [sum(r["size"] for r in shards[s]) for s in range(8)]


def test_difference():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 500):
        v = np.zeros((n, 8), np.int64)
        v[:, 0] = rng.integers(1, 10000, n)
        sums, place = K.difference(v)
        back = np.zeros(8, np.int64)
        for row, p in zip(v, place, strict=True):
            assert sorted(p) == list(range(8))
            np.add.at(back, p, row)
        assert (back == sums).all() and (np.diff(sums) <= 0).all()
        if n == 500:
            assert sums.max() - sums.min() < 20


def corpus(many=400):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 400))) for _ in range(many // 2)] + [None, "", None]
    return [(None if i % 50 == 0 else i // 2 if i % 3 else i, rng.choice(texts)) for i in range(many)]


def test_shards(spark, monkeypatch):
    data = corpus()
    sums = holds(rows(K.sharded(frame(spark, data))), data)
    assert max(sums) - min(sums) <= 8
    monkeypatch.setattr(K, "BIN", 7)
    monkeypatch.setattr(K, "BUCKET", 30)
    sums = holds(rows(K.sharded(frame(spark, data))), data)
    assert max(sums) - min(sums) < 0.02 * sum(sums)


def test_small_and_hot(spark):
    assert rows(K.sharded(frame(spark, []))) == []
    data = [(1, "a")] * 40 + [(i, "b" * i) for i in range(5)]
    holds(rows(K.sharded(frame(spark, data))), data)


def test_real(spark):
    got = rows(K.op6_karmarkar_karp(spark, "/root/testdata/sf0.01"))
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert len(got) == 1000 and max(sums.values()) - min(sums.values()) <= 64


def test_large_group_over_bins(spark, monkeypatch):
    """Groups of 5, 10 and 40 % of all bytes: bins give the undivided result."""
    rng = np.random.default_rng(2)
    small = rng.lognormal(6, 1, 3000).astype(np.int64) + 1
    for part, bins in ((0.05, 500), (0.1, 500), (0.1, 100), (0.4, 500)):
        sizes = [*small.tolist(), int(small.sum() * part / (1 - part))]
        frame = spark.createDataFrame(list(enumerate(sizes)), "id long, size long").repartition(4)
        most = []
        for limit in (20_000, bins):
            monkeypatch.setattr(K, "BIN", limit)
            got = rows(K.placed(frame))
            assert sorted(r["id"] for r in got) == list(range(len(sizes)))
            sums = np.bincount([r["shard"] for r in got], weights=[sizes[r["id"]] for r in got], minlength=8)
            most.append(sums.max() * 8 / sums.sum())
        assert most[1] < most[0] + 0.002, (part, bins, most)


def test_any_partitioning_and_plain_differencing(spark, monkeypatch):
    """The same shards under any number of partitions; in one bin, those of
    undivided differencing of the whole table."""
    from pyspark.sql import functions as F

    from lotguard.llm.common import table

    docs = table(spark, "/root/testdata/sf0.01", "documents")
    whole = sorted((r["doc_id"], r["shard"]) for r in rows(K.sharded(docs)))
    groups = docs.groupBy(F.coalesce("text", F.lit("")).alias("t")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n"), F.collect_list("doc_id").alias("of"))
    groups = sorted(rows(groups.withColumn("m", F.md5(F.col("t").cast("binary")))), key=lambda r: r["m"])
    v = np.zeros((len(groups), 8), np.int64)
    v[:, 0] = [g["n"] for g in groups]
    _, place = K.difference(v)
    assert sorted((d, int(place[i, 0])) for i, g in enumerate(groups) for d in g["of"]) == whole
    monkeypatch.setattr(K, "BIN", 150)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for n in ("3", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted((r["doc_id"], r["shard"]) for r in rows(K.sharded(docs.repartition(int(n))))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    assert found[0] == found[1]
