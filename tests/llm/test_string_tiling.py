"""Operator 4 against plain greedy string tiling of whole texts."""

import random
import re

import numpy as np

from helpers import rows
from lotguard.llm import string_tiling as T

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PUNCT = "".join(chr(c) for c in range(0x21, 0x7F) if not chr(c).isalnum())


def tokens(t):
    return [w for w in re.split("[" + re.escape(PUNCT + " \t\n\x0b\x0c\r") + "]+", (t or "").translate(LOWER)) if w]


def plain(a, b, least=5):
    """Tokens of b covered: mark the longest common run of unmarked tokens,
    the first by place among equals, until none of ``least`` is left."""
    fa, fb, covered = [True] * len(a), [True] * len(b), 0
    while True:
        runs = []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and fa[i + n] and fb[j + n]:
                    n += 1
                if n >= least:
                    runs.append((n, i, j))
        if not runs:
            return covered
        longest = max(r[0] for r in runs)
        for n, i, j in sorted(runs, key=lambda r: (r[1], r[2])):
            if n == longest and all(fa[i : i + n]) and all(fb[j : j + n]):
                fa[i : i + n] = fb[j : j + n] = [False] * n
                covered += n


def covered(a, b):
    """The covered share of item tokens b; short items by equality only."""
    return float(a == b) if len(b) < T.SEED else plain(a, b) / len(b)


def test_tile():
    rng = random.Random(1)
    for _ in range(150):
        words = [rng.randrange(4) for _ in range(rng.randint(1, 40))]
        item = [rng.randrange(4) for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.6:
            cut = rng.randint(0, len(item))
            words[rng.randint(0, len(words)) :] = item[cut:] + [9] * rng.randint(0, 2) + item[:cut]
        as64 = lambda x: np.array(x, np.uint64)
        assert T.tile(as64(words), np.arange(len(words)), as64(item)) == plain(words, item)


def data():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdéF") for _ in range(rng.randint(1, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [text(n) for n in (30, 12, 60, 8, 5, 3)] + ["", None, "same words here and there", "same words here and there", "a a a a a a a a a a"]
    docs = [None, "", text(200), "same WORDS here, and there!", "a " * 50]
    for it in items[:5]:
        w = it.split(" ")
        h = len(w) // 2
        docs += [text(20) + " " + it.upper() + " " + text(9), " ".join(w[h:]) + " " + text(3) + " " + " ".join(w[:h]), " ".join(w[: h - 1]), " | ".join(w), " ".join(w[::-1])]
    return docs + docs[3:9] + [items[5], f"- {items[5]}!", items[5] + " more"], items


def frames(spark, docs, items, ids=None):
    ids = list(range(len(docs))) if ids is None else ids
    d = spark.createDataFrame([(i, t, 7, 8, "q") for i, t in zip(ids, docs, strict=True)], "doc_id long, text string, seed int, item_id int, body string")
    b = spark.createDataFrame([(i if i != 1 else None, t, 9) for i, t in enumerate(items)], "item_id long, text string, pos int")
    return d, b


def test_against_plain_tiling(spark):
    docs, items = data()
    got = {r["doc_id"]: r for r in rows(T.contaminated(*frames(spark, docs, items)))}
    for k, d in enumerate(docs):
        share = {i: covered(tokens(d), t) for i, it in enumerate(items) if (t := tokens(it))}
        found = sorted(i for i, s in share.items() if s >= T.COVER and i != 1)
        r = got[k]
        assert r["items"] == found, (k, d, found, r)
        assert r["contaminated"] == any(s >= T.COVER for s in share.values())
        assert abs(r["most_covered"] - max([s for s in share.values() if s >= T.COVER], default=0)) < 1e-12


def test_null_repeated_and_clean(spark):
    docs, items = data()
    ids = [None if i % 4 == 0 else i // 2 for i in range(len(docs))]
    d, b = frames(spark, docs, items, ids)
    assert len(rows(T.contaminated(d, b))) == len(docs)
    kept = T.clean(d, b)
    assert kept.columns == d.columns
    flags = [any(t and covered(tokens(x), t) >= T.COVER for it in items if (t := tokens(it))) for x in docs]
    assert sorted((r["text"] or "") for r in rows(kept)) == sorted((x or "") for x, f in zip(docs, flags, strict=True) if not f)


def test_empty(spark):
    docs, items = data()
    assert rows(T.contaminated(*frames(spark, [], items))) == []
    assert not any(r["contaminated"] for r in rows(T.contaminated(*frames(spark, docs, []))))


def test_running_hashes():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2**63, 50).astype(np.uint64)
    assert (T.powers(T._TIMES, 50) * T.powers(T._BACK, 50) == 1).all()
    few = rng.integers(0, 9, 6000).astype(np.uint64)
    long = np.concatenate((few[:3000], words, few[3000:]))
    item = np.concatenate((words, long[:200], long[-300:]))
    assert T.tile(long, np.arange(len(long)), item) >= 540


def test_scripts_without_spaces(spark):
    """Chinese, Japanese and Thai items in longer texts; unlike texts stay clean."""
    zh, ja, th = "机器学习模型需要大量的训练数据才能取得好的结果", "データの品質は学習の結果に大きな影響を与えます", "ข้อมูลที่ดีทำให้โมเดลดีขึ้นมาก"
    docs = [f"今天天气很好。{zh[:12]}我们在公园散步{zh[12:]}。", f"昨日は{ja}と言った。", "x " + th, "今天我们去公园散步然后回家吃饭看电视", "é ünïcode words that are no item at all"]
    assert len(T._tokens([zh.encode()])[0]) == len(zh) and len(T._tokens(["aé 机b器".encode()])[0]) == 4
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame([("zh", zh), ("ja", ja), ("th", th)], "item_id string, text string")
    assert {r["doc_id"]: r["items"] for r in rows(T.contaminated(d, b))} == {0: ["zh"], 1: ["ja"], 2: ["th"], 3: [], 4: []}


def test_common_seeds_propose_few_pairs(spark):
    """One passage in all documents and items proposes no pair by itself."""
    rng = random.Random(12)
    text = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    common = "the same nine words are in every single text"
    items = [f"{text(30)} {common} {text(20)}" for _ in range(20)]
    docs = [f"{text(20)} {common} {text(40)}" for _ in range(60)] + items[:3]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    pairs = rows(T.tilings(d, b))
    assert sorted(r["item_id"] for r in pairs) == [0, 1, 2] and len(rows(T.tilings(d, b, cover=0))) == 63 * 20
