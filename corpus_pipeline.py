"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's docs. All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotguard.llm import ngram_join, quality_forest, sentencepiece_lattice, string_tiling, suffix_dedup
from lotguard.llm.common import table, written


#: Bytes of a passage that the dedup stage cuts out where it comes again: about
#: 50 short words (the op2 query has its own length).
PASSAGE = 225
#: Near copies of the corpus: five-word shingles, similarity 0.8 (the op10 query has its own).
NEAR = ngram_join.Likeness(words=5, most=4, of=5)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the forest reject go."""
    return quality_forest.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies stays."""
    return ngram_join.one_of_each(docs, like=NEAR)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE`` bytes are cut out of all documents but the first."""
    return suffix_dedup.remove_repeats(docs, length=PASSAGE, keep_first="doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return string_tiling.clean(docs, table(spark, sf_dir, "benchmark"))


def segmentation(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each text: doc_id, sample, ids and scores."""
    return sentencepiece_lattice.encode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", segmentation),
]

#: Random forests, suffix buckets and sampled segmentations have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
