"""Filter interaction audit (operator 12).

For each part (value of a column) and filter the ids of the failing rows are
kept as sorted posting lists, in ranges of ids. In a range the unions of the
lists are made by a k-way merge, and differences against them, both by
galloping: a list is skipped ahead in doubling steps to where the next stretch
of another ends. Sizes of the differences F minus union(S), for each filter F
and set S of others, are summed over the ranges; everything an order of the
filters needs follows from these sums.

Ids are given when the rows' verdicts are written, so that rows with a null or
repeated doc_id count like others. Defined cases: null texts count as empty, a
null part as the empty string; a null doc_id is neither smaller nor greater
than others; a document with several labels has quality or toxicity if one of
them says so; an empty table has no parts and so no rows; further columns are
ignored, also where their names clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import combinations, permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import list_array, table, written
from lotguard.llm.hot_join import hot_join

#: Ids of a posting list's range.
RANGE = 1 << 16
#: Ids of a list that a merge takes at a time.
STRETCH = 256
FILTERS = "ABCDE"
_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# --- galloping merges ----------------------------------------------------------


def gallop(ids: np.ndarray, start: int, limit: int) -> int:
    """The first place from ``start`` on whose id is over ``limit``."""
    step, n = 1, len(ids)
    lo = start
    while lo + step < n and ids[lo + step] <= limit:
        lo += step
        step *= 2
    return lo + int(np.searchsorted(ids[lo : lo + step + 1], limit, side="right"))


def union(lists: list[np.ndarray]) -> np.ndarray:
    """k-way merge of sorted lists of distinct ids: each round goes as far as
    the list whose next stretch ends first."""
    lists = [x for x in lists if len(x)]
    if len(lists) < 2:
        return lists[0] if lists else np.zeros(0, np.int32)
    place, out = [0] * len(lists), []
    while live := [i for i, x in enumerate(lists) if place[i] < len(x)]:
        if len(live) == 1:
            out.append(lists[live[0]][place[live[0]] :])
            break
        limit = min(lists[i][min(place[i] + STRETCH, len(lists[i])) - 1] for i in live)
        parts = []
        for i in live:
            end = gallop(lists[i], place[i], limit)
            if end > place[i]:
                parts.append(lists[i][place[i] : end])
            place[i] = end
        out.append(parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts)))
    return np.concatenate(out)


def difference(ids: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The ids that are not in the other sorted list."""
    if not len(other) or not len(ids):
        return ids
    at, out = 0, []
    for s in range(0, len(ids), STRETCH):
        part = ids[s : s + STRETCH]
        lo = gallop(other, at, int(part[0]) - 1) if at < len(other) else at
        at = gallop(other, lo, part[-1]) if lo < len(other) else lo
        found = other[lo:at]
        out.append(part[~np.isin(part, found, assume_unique=True)] if len(found) else part)
    return np.concatenate(out)


# --- posting lists -------------------------------------------------------------


def postings(verdicts: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """Posting lists of verdicts (part, id, and a boolean column for each
    filter and mark): a row per part and range of ids, with the rows' number
    ``n`` and a sorted list of ids within the range for each column."""
    low = F.pmod("id", F.lit(RANGE)).cast("int")
    lists = [F.sort_array(F.collect_list(F.when(F.col(c), low))).alias(c) for c in [*filters, *marks]]
    return verdicts.groupBy("part", F.floor(F.col("id") / RANGE).alias("range")).agg(F.count("*").alias("n"), *lists)


def _subsets(filters: list[str]) -> list[tuple[int, int]]:
    """(filter, set of other filters as bits), all of them."""
    n = len(filters)
    return [(f, s) for f in range(n) for s in range(1 << n) if not s >> f & 1]


def _merge(filters: list[str], marks: list[str]):
    pairs = _subsets(filters)

    def ids(column: pa.ListArray, row: int) -> np.ndarray:
        return np.asarray(column[row].values, dtype=np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                fails = [ids(batch.column(c), row) for c in filters]
                have = [ids(batch.column(c), row) for c in marks]
                unions = {s: union([x for f, x in enumerate(fails) if s >> f & 1]) for s in range(1 << len(filters))}
                size = []
                for f, s in pairs:
                    new = difference(fails[f], unions[s])
                    size.append([len(new), *(len(new) - len(difference(new, m)) for m in have)])
                flat = np.array(size, np.int64).reshape(-1)
                yield pa.record_batch(
                    [batch.column("part").slice(row, 1), batch.column("n").slice(row, 1), list_array(pa.array(flat), np.array([len(flat)]))],
                    names=["part", "n", "sizes"],
                )

    return run


def differences(lists: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """Sums over all ranges: part, total (rows), and for each filter and set
    of others (``filter``, ``others`` as bits) ``new``, the number of ids that
    fail it and none of the others, and of these the number of each mark."""
    pairs, width = _subsets(filters), len(marks) + 1
    merged = lists.mapInArrow(_merge(filters, marks), "part string, n long, sizes array<long>")
    sums = merged.groupBy("part").agg(F.sum("n").alias("total"), *[F.sum(F.col("sizes")[i]).alias(f"s{i}") for i in range(len(pairs) * width)])
    said = [F.struct(F.lit(f).alias("filter"), F.lit(s).alias("others"), *[F.col(f"s{i * width + j}").alias(c) for j, c in enumerate(["new", *marks])])
            for i, (f, s) in enumerate(pairs)]
    return written(sums.select("part", "total", F.inline(F.array(*said))), "audit-differences")


def audit(lists: DataFrame, filters: list[str], marks: list[str]) -> DataFrame:
    """A row per part, order of the filters and step: filter_order, step,
    kept, removed, redundant, unique_fails, shapley, and ``<mark>_lost`` for
    each mark. Filters have names of one letter."""
    n = len(filters)
    steps = [{"filter_order": "".join(filters[i] for i in order), "step": k + 1, "filter": f, "others": sum(1 << i for i in order[:k]),
              "before": [[order[j], sum(1 << i for i in order[:j])] for j in range(k + 1)]}
             for order in permutations(range(n)) for k, f in enumerate(order)]
    orders = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order:string,step:int,filter:int,others:int,before:array<array<int>>>>")
    sums = differences(lists, filters, marks)
    whole = (1 << n) - 1
    # in how many orders the filters before one are exactly a given set
    ways = F.element_at(F.array(*[F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n)]), F.bit_count("others") + 1)
    only = F.max(F.when(F.col("others") + F.expr("shiftleft(1, filter)") == whole, F.col("new")))
    per = sums.groupBy("part", "filter").agg(
        F.max("total").alias("total"), F.max(F.when(F.col("others") == 0, F.col("new"))).alias("fails"),
        only.alias("unique_fails"), F.sum(F.col("new") * ways).alias("shapley"),
        F.map_from_entries(F.collect_list(F.struct("others", F.struct("new", *marks)))).alias("by_set"))
    of_part = per.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filter", F.struct("total", "fails", "unique_fails", "shapley", "by_set")))).alias("f"))
    mine = F.element_at(F.col("f"), F.col("filter"))
    here = F.element_at(mine["by_set"], F.col("others"))
    gone = F.aggregate("before", F.lit(0).cast("long"), lambda acc, x: acc + F.element_at(F.element_at(F.col("f"), x[0])["by_set"], x[1])["new"])
    return of_part.select("part", "f", F.inline(orders)).select(
        "part", "filter_order", "step", (mine["total"] - gone).alias("kept"), here["new"].alias("removed"), (mine["fails"] - here["new"]).alias("redundant"),
        mine["unique_fails"].alias("unique_fails"), *[here[m].alias(f"{m}_lost") for m in marks], mine["shapley"].alias("shapley"))


# --- the five filters of the query -------------------------------------------------


def _same_before(docs: DataFrame) -> DataFrame:
    """``docs`` (written; doc_id, digest, ...) with the column E: a row of the
    same digest has a smaller doc_id."""
    groups = docs.groupBy("digest").agg(F.count("*").alias("uses"), F.min("doc_id").alias("least"))
    again = written(groups.filter("uses > 1"), "audit-copies")
    copies = hot_join(docs, again, "digest", "uses", docs.count())
    late = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
    alone = docs.join(again.select("digest"), "digest", "left_anti")
    return copies.withColumn("E", late).drop("least").unionByName(alone.withColumn("E", F.lit(False)))


def verdicts(documents: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, id, A, B, C, D, E, good, toxic) for each document: which of the
    five filters it fails, and whether its labels say quality or toxic."""
    text: Column = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(f"({_WORD})"))
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), text.alias("text"), words.alias("words"))
    capitals = F.length("text") - F.length(F.translate("text", _UPPER, ""))
    n = F.size("words")
    seen = written(
        rows.select(
            "doc_id", "part", (n < 100).alias("A"), (100 * F.size(F.array_distinct("words")) < 80 * n).alias("B"), (100 * capitals > 10 * F.length("text")).alias("C"),
            F.col("text").rlike("[#$%&*|]").alias("D"), F.unhex(F.sha2("text", 256)).alias("digest")),
        "audit-documents",
    )
    one = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic"))
    marked = written(one.filter("good or toxic"), "audit-labels")
    both = _same_before(seen).join(marked, "doc_id", "left")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in [*FILTERS, "good", "toxic"]]
    return written(both.select("part", F.monotonically_increasing_id().alias("id"), *flags), "audit-verdicts")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = ["good", "toxic"]
    failing = verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(postings(failing, list(FILTERS), marks), list(FILTERS), marks)


QUERIES = {"op12_filter_audit": op12_filter_audit}

SQL = {
    "op12_filter_audit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
            FROM documents
        ), l AS (
            SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
        ), v AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   [len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
                    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text), regexp_matches(text, '[#$%&*|]'),
                    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)] AS fails
            FROM w LEFT JOIN l USING (doc_id)
        ), p AS (
            SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM v GROUP BY ALL
        ), f AS (SELECT unnest(range(1, 6)) AS i), o AS (
            SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
        ), s AS (
            SELECT o, array_to_string(list_transform(o, lambda x: substr('ABCDE', x::INT, 1)), '') AS filter_order, unnest(range(1, 6)) AS step FROM o
        ), x AS (
            SELECT part, filter_order, step, o[step] AS filter,
                   sum(n) FILTER (WHERE NOT list_bool_or(list_transform(o[1:step], lambda i: fails[i]))) AS kept,
                   sum(n) FILTER (WHERE fails[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])), false)) AS removed,
                   sum(n) FILTER (WHERE fails[o[step]] AND coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])), false)) AS redundant,
                   sum(n) FILTER (WHERE fails[o[step]] AND len(list_filter(fails, lambda b: b)) = 1) AS unique_fails,
                   sum(good) FILTER (WHERE fails[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])), false)) AS good_lost,
                   sum(toxic) FILTER (WHERE fails[o[step]] AND NOT coalesce(list_bool_or(list_transform(o[1:step - 1], lambda i: fails[i])), false)) AS toxic_lost
            FROM p, s GROUP BY ALL
        )
        SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               sum(coalesce(removed, 0)) OVER (PARTITION BY part, filter)::BIGINT AS shapley
        FROM x
    """
}
