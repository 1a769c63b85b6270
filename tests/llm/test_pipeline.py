"""The pipeline's stages, each on what the one before kept."""

import duckdb
import pyarrow.parquet as pq

from helpers import rows
from test_ngram_join import brute as components
from test_string_tiling import plain, tokens
from test_suffix_dedup import brute_first as left

import corpus_pipeline as P
from lotguard.llm.common import table, written

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert [n for n, _ in P.STAGES][0] == "quality rules" and len(P.STAGES) == 5 and P.ORACLE_SQL is None
    texts = {r["doc_id"]: r["text"] for r in rows(docs)}
    # quality rules
    docs = written(P.quality_rules(spark, docs, SF), "t")
    assert docs.columns == columns
    kept = {r["doc_id"]: r["text"] for r in rows(docs)}
    bad = {r[0] for r in duckdb.sql(f"select doc_id from '{SF}/labels.parquet' where quality = 0").fetchall()}
    assert all(texts[k] == t for k, t in kept.items()) and len(bad & set(kept)) <= 0.2 * len(bad)
    # n-gram Jaccard join
    ids = sorted(kept)
    want = {i for i, n, c in components(ids, [kept[i] for i in ids]) if not n or c == i}
    docs = written(P.near_duplicates(spark, docs, SF), "t")
    assert docs.columns == columns and {r["doc_id"] for r in rows(docs)} == want
    # suffix-array dedup
    ids = sorted(want)
    before = {i: k.decode("utf-8", "ignore") for i, k in zip(ids, left([kept[i] for i in ids], P.PASSAGE), strict=True)}
    docs = written(P.repeated_passages(spark, docs, SF), "t")
    after = {r["doc_id"]: r["text"] for r in rows(docs)}
    assert docs.columns == columns
    for i in ids:
        if i in after:
            assert after[i] == (kept[i] if len(before[i].encode()) == len((kept[i] or "").encode()) else before[i])
        else:
            assert not before[i].strip()
    # benchmark decontamination
    items = [tokens(t) for t in pq.read_table(f"{SF}/benchmark.parquet").column("text").to_pylist()]
    grams = {tuple(t[k : k + 5]) for t in items for k in range(len(t) - 4)}
    found = set()
    for i, t in after.items():
        w = tokens(t)
        if any(tuple(w[k : k + 5]) in grams for k in range(len(w) - 4)) and any(plain(w, it) >= 0.5 * len(it) for it in items):
            found.add(i)
    docs = written(P.decontamination(spark, docs, SF), "t")
    clean = {r["doc_id"]: r["text"] for r in rows(docs)}
    assert docs.columns == columns and set(clean) == set(after) - found
    # SentencePiece encoding and decoding
    out = rows(P.segmentation(spark, docs, SF))
    assert sorted(r["doc_id"] for r in out if r["sample"] == 0) == sorted(clean) and all(r["exact"] for r in out)
    whole = rows(P.run(spark, SF))
    assert sorted(map(str, whole)) == sorted(map(str, out))
