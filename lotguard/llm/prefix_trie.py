"""Conversation prefix trie (operator 13).

Distinct turns (role, text) get the ids of a dictionary, a conversation is the
list of its ids. Distinct lists are dealt to range shards by their order. Each
shard builds a ternary search tree: a node holds an id, its lesser and greater
siblings and its first child. Lists are put in by medians (the middle one
first, then the middles of both halves), so siblings form balanced trees. An
iterative traversal adds members, leaves and savings up.

A trie node that lies in several shards is a prefix of a shard's first or last
list, as lists with one prefix follow each other. Nodes on these two paths
("boundary nodes") are merged by the digest of their prefix. All other nodes
are whole in their shard. What boundary nodes themselves add to their
ancestors is known after the merge only; it's added along the one path that
owns the node, so that it counts once.

Defined cases: a null role or text counts as empty; turns are ordered by turn
(nulls first), ties by role and text, repeated rows count as often as they
occur; rows with a null conv_id belong to no conversation and are left out; no
conversation, no nodes (not even a root); further columns are ignored. Texts
are only hashed and measured. A conversation's ids (8 bytes a turn) must fit a
task, its texts needn't.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lotguard.llm.common import table, written
from lotguard.llm.hot_join import hot_join

#: Turns of a range shard, about.
SHARD = 1 << 19
#: Members whose ids are joined by one group before the digest of all.
BLOCK = 1 << 14
NOBODY = hashlib.sha256().hexdigest()


# --- conversations as lists of ids ------------------------------------------


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of turns in their conversations, for sorted rows."""
    conv, place = None, 0
    for batch in batches:
        at = []
        for c in batch.column("conv_id").to_pylist():
            place = place + 1 if c == conv else 0
            conv = c
            at.append(place)
        yield pa.record_batch([*(batch.column(n) for n in ("conv_id", "turn_key", "size")), pa.array(at, pa.int64())], names=["conv_id", "turn_key", "size", "place"])


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn_key, size, place): the digest of each turn, the UTF-8
    bytes of its text, and its place in its conversation from 0 on. A
    conversation's texts pass through one task as a stream."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.select("conv_id", F.unhex(F.sha2(whole, 256)).alias("turn_key"), F.octet_length("text").cast("long").alias("size"))
    return keyed.mapInArrow(_positions, "conv_id long, turn_key binary, size long, place long")


def encoded(conversations: DataFrame) -> DataFrame:
    """(conv_id, ids, sizes): each conversation as the dictionary ids of its
    turns, and the bytes of their texts."""
    turns = written(placed_turns(conversations), "trie-turns")
    counted = turns.groupBy("turn_key").agg(F.count("*").alias("uses"))
    words = written(counted.select("turn_key", "uses", F.monotonically_increasing_id().alias("id")), "trie-dictionary")
    rows = hot_join(turns, words, "turn_key", "uses", turns.count())
    lists = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "id", "size"))).alias("t"))
    return lists.select("conv_id", F.col("t.id").alias("ids"), F.col("t.size").alias("sizes"))


def rebuilt(conversations: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Lists of ``encoded`` with shared beginnings: the first h turns of the
    conversation conv_id - conv_id % ``family`` (all if fewer, none without
    it), then the own turns behind the first h; h is the CRC-32 of the decimal
    conv_id modulo ``heads``."""
    lists = written(conversations, "trie-lists")
    first = lists.select(F.col("conv_id").alias("base"), F.col("ids").alias("b_ids"), F.col("sizes").alias("b_sizes"))
    rows = lists.select("*", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int").alias("h"))
    both = rows.join(first, "base", "left")

    def joined(own: str, base: str):
        none = F.array().cast("array<long>")
        head = F.when(F.col("h") > 0, F.slice(F.coalesce(base, none), 1, F.col("h"))).otherwise(none)
        return F.concat(head, F.slice(own, F.col("h") + 1, F.greatest(F.size(own) - F.col("h"), F.lit(0)))).alias(own)

    return both.select("conv_id", joined("ids", "b_ids"), joined("sizes", "b_sizes"))


# --- distinct lists and their members ----------------------------------------


_LIST = "ids array<long>, sizes array<long>, n long, conv_id long, ends string"


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a list from the rows of its blocks, which follow each other:
    the digest takes the blocks' member ids one after the other."""
    row, state = None, None

    def out(rows: list) -> pa.RecordBatch:
        kinds = [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["ids", "sizes", "n", "conv_id", "ends"])

    for batch in batches:
        done = []
        for ids, sizes, n, conv, said in zip(*(batch.column(c).to_pylist() for c in ("ids", "sizes", "n", "conv_id", "said")), strict=True):
            if row is not None and row[0] == ids:
                row[2] += n
                state.update(b",")
            else:
                if row is not None:
                    done.append((*row, state.hexdigest()))
                row, state = [ids, sizes, n, conv], hashlib.sha256()
            state.update(said.encode())
        if done:
            yield out(done)
    if row is not None:
        yield out([(*row, state.hexdigest())])


def distinct_lists(lists: DataFrame) -> DataFrame:
    """(ids, sizes, n, conv_id, ends): each distinct list once, with the number
    of its conversations, the least conv_id, and the digest of all their ids in
    order. Copies are joined in blocks of ids first; what one task reads of a
    list with very many copies is a row for each block."""
    block = F.floor(F.col("conv_id") / BLOCK).cast("long").alias("block")
    ids = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    parts = lists.groupBy("ids", "sizes", block).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.array_join(ids, ",").alias("said"))
    return parts.repartition("ids").sortWithinPartitions("ids", "block").drop("block").mapInArrow(_members, _LIST)


# --- ternary search trees of range shards ----------------------------------------


def medians(n: int) -> Iterator[int]:
    """0 to n - 1, the middle first, then the middles of both halves, and so on."""
    todo = [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(mid + 1, hi), (lo, mid)]


class TernaryTree:
    """A trie whose children of a node form a search tree. Node 0 is the root;
    a node is made after its parent."""

    def __init__(self) -> None:
        self.token, self.size = array("q", [0]), array("q", [0])
        self.less, self.child, self.more, self.parent, self.depth = (array("q", [v]) for v in (-1, -1, -1, -1, 0))
        self.n, self.conv = array("q", [0]), array("q", [1 << 62])
        self.ends: dict[int, str] = {}

    def _new(self, token: int, size: int, parent: int) -> int:
        for column, value in ((self.token, token), (self.size, size), (self.less, -1), (self.child, -1), (self.more, -1),
                              (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.n, 0), (self.conv, 1 << 62)):
            column.append(value)
        return len(self.token) - 1

    def insert(self, ids: list[int], sizes: list[int], n: int, conv: int, ends: str) -> None:
        token, less, child, more = self.token, self.less, self.child, self.more
        at = 0
        for t, s in zip(ids, sizes, strict=True):
            link, of = child, at
            while (to := link[of]) >= 0 and token[to] != t:
                link, of = (less if t < token[to] else more), to
            if to < 0:
                to = self._new(t, s, at)
                link[of] = to
            at = to
        self.n[at], self.conv[at], self.ends[at] = n, conv, ends

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a list that is in the tree, root first."""
        at, out = 0, [0]
        for t in ids:
            at = self.child[at]
            while self.token[at] != t:
                at = self.less[at] if t < self.token[at] else self.more[at]
            out.append(at)
        return out

    def totals(self, boundary: set[int]) -> tuple[array, array, array]:
        """Members and least members are added up in place. Returned: inner
        children, and the leaves and savings of each node's inner subtree
        nodes. Going back in the order of creation, a node is met after its
        whole subtree."""
        inner, leaves, saved = (array("q", bytes(8 * len(self.token))) for _ in range(3))
        for v in range(len(self.token) - 1, 0, -1):
            p = self.parent[v]
            if v not in boundary:
                inner[p] += 1
                if not inner[v]:
                    leaves[v] = 1
                saved[v] += (self.n[v] - 1) * self.size[v]
            self.n[p] += self.n[v]
            self.conv[p] = min(self.conv[p], self.conv[v])
            leaves[p] += leaves[v]
            saved[p] += saved[v]
        return inner, leaves, saved


_NODE = [
    ("node_key", pa.binary()), ("parent_key", pa.binary()), ("shard", pa.int64()), ("last", pa.bool_()), ("own", pa.bool_()), ("depth", pa.int64()), ("conv_id", pa.int64()),
    ("parent_conv_id", pa.int64()), ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("size", pa.int64()), ("ends", pa.string()),
]
_NODE_SQL = ("node_key binary, parent_key binary, shard long, last boolean, own boolean, depth long, conv_id long, "
             "parent_conv_id long, n long, children long, leaves long, saved long, size long, ends string")  # fmt: skip


def _keys(ids: list[int]) -> list[bytes]:
    """Digests of all prefixes, the empty one first."""
    out = [hashlib.blake2b(b"", digest_size=16).digest()]
    for t in ids:
        out.append(hashlib.blake2b(out[-1] + t.to_bytes(8, "little", signed=True), digest_size=16).digest())
    return out


def shard_nodes(lists: list[tuple], shard: int) -> Iterator[tuple]:
    """Rows of a shard's sorted lists (ids, sizes, n, conv_id, ends): its inner
    nodes (no key) and the boundary nodes of its first and last list."""
    tree = TernaryTree()
    for i in medians(len(lists)):
        tree.insert(*lists[i])
    paths = [(False, lists[0][0])] + ([(True, lists[-1][0])] if len(lists) > 1 else [])
    nodes = [(last, tree.path(ids), _keys(ids)) for last, ids in paths]
    key_of = {v: k for _, path, keys in nodes for v, k in zip(path, keys, strict=True)}
    inner, leaves, saved = tree.totals(set(key_of))
    told = set()
    for last, path, keys in nodes:
        for d, (v, k) in enumerate(zip(path, keys, strict=True)):
            own = v not in told
            told.add(v)
            yield (k, keys[d - 1] if d else None, shard, last, own, d, tree.conv[v], None, tree.n[v], inner[v], leaves[v], saved[v], tree.size[v], tree.ends.get(v))
    for v in range(1, len(tree.token)):
        if v not in key_of:
            p = tree.parent[v]
            edge = key_of.get(p)
            yield (None, edge, shard, None, None, tree.depth[v], tree.conv[v], None if edge else tree.conv[p], tree.n[v], inner[v], leaves[v], saved[v], tree.size[v], tree.ends.get(v))


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = [row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("ids", "sizes", "n", "conv_id", "ends")), strict=True)]
    if not lists:
        return
    rows: list[tuple] = []

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(_NODE)], names=[n for n, _ in _NODE])

    for row in shard_nodes(lists, TaskContext.get().partitionId()):
        rows.append(row)
        if len(rows) == 1 << 15:
            yield out()
            rows.clear()
    if rows:
        yield out()


def _boundary(edge: DataFrame) -> DataFrame:
    """Boundary nodes of all shards, merged by their prefix."""
    mine = edge.filter("own")
    merged = mine.groupBy("node_key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), F.sum("children").alias("inner"),
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.first("size").alias("size"), F.max("ends").alias("ends"), F.min(F.struct("shard", "last")).alias("owner"))
    merged = written(merged, "trie-boundary")
    kids = written(merged.groupBy(F.col("parent_key").alias("node_key")).agg(F.count("*").alias("edge")), "trie-edges")
    merged = merged.join(kids, "node_key", "left").withColumn("children", F.col("inner") + F.coalesce("edge", F.lit(0)))
    merged = written(merged.withColumns({"leaf": (F.col("children") == 0).cast("long"), "save": (F.col("n") - 1) * F.col("size")}), "trie-merged")
    # what a boundary node adds itself goes up the path that owns it
    adds = edge.select("node_key", "shard", "last", "depth").join(merged.select("node_key", "owner", "leaf", "save"), "node_key")
    here = F.col("owner") == F.struct("shard", "last")
    up = Window.partitionBy("shard", "last").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = adds.select("node_key", *[F.sum(F.when(here, F.col(c)).otherwise(0)).over(up).alias(c) for c in ("leaf", "save")])
    sums = written(sums.groupBy("node_key").agg(F.sum("leaf").alias("up_leaves"), F.sum("save").alias("up_saved")), "trie-sums")
    whole = merged.join(sums, "node_key")
    return whole.withColumns({"leaves": F.col("leaves") + F.col("up_leaves"), "saved": F.col("saved") + F.col("up_saved")})


def trie(lists: DataFrame) -> DataFrame:
    """Nodes of the prefix trie of (conv_id, ids, sizes): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    (of the subtree), ends_sha256 (of the members that end here)."""
    single = written(distinct_lists(lists), "trie-distinct")
    turns = single.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    dealt = single.repartitionByRange(int(turns // SHARD) + 1, "ids").sortWithinPartitions("ids")
    nodes = written(dealt.mapInArrow(_tree, _NODE_SQL), "trie-nodes")
    edge = written(_boundary(nodes.filter("node_key is not null")), "trie-whole")
    above = edge.select(F.col("node_key").alias("parent_key"), F.col("conv_id").alias("above"), F.col("inner").alias("uses"))
    inside = nodes.filter("node_key is null")
    below = hot_join(inside.filter("parent_key is not null"), above, "parent_key", "uses", nodes.count())

    def out(df: DataFrame, parent: str) -> DataFrame:
        return df.select("conv_id", "depth", F.col(parent).alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                         F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))

    tops = edge.join(above.drop("uses"), "parent_key", "left")
    return out(inside.filter("parent_key is null"), "parent_conv_id").unionByName(out(below, "above")).unionByName(out(tops, "above"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(encoded(table(spark, sf_dir, "conversations"))))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}

# The CRC-32 is reduced over the bits of the digits; -1 stands for a shift.
SQL = {
    "op13_prefix_trie": """
        WITH t AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
            FROM conversations WHERE conv_id IS NOT NULL
        ), c AS (
            SELECT conv_id, conv_id - conv_id % 5 AS base,
                   xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(conv_id::VARCHAR, ''),
                       lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                       lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END)) % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM t)
        ), r AS (
            SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN t ON t.conv_id = c.base WHERE p <= h
            UNION ALL SELECT c.conv_id, 1, p, role, text FROM c JOIN t ON t.conv_id = c.conv_id WHERE p > h
        ), w AS (
            SELECT conv_id, own, p, dense_rank() OVER (ORDER BY role, text) AS id, strlen(text) AS size FROM r
        ), l AS (
            SELECT c.conv_id, coalesce(list(id ORDER BY own, p) FILTER (WHERE id IS NOT NULL), []) AS ids,
                   coalesce(list(size ORDER BY own, p) FILTER (WHERE id IS NOT NULL), []) AS sizes
            FROM c LEFT JOIN w USING (conv_id) GROUP BY c.conv_id
        ), m AS (
            SELECT conv_id, d, ids[1:d] AS k, sizes[d] AS size, d = len(ids) AS ended
            FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM l)
        ), n AS (
            SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(any_value(size), 0) AS size,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
            FROM m GROUP BY d, k
        ), kids AS (
            SELECT k[1:d - 1] AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
        ), own AS (
            SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * size AS saved
            FROM n LEFT JOIN kids USING (k)
        ), up AS (
            SELECT k[1:e] AS k, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
            FROM (SELECT k, leaf, saved, unnest(range(d + 1)) AS e FROM own) GROUP BY ALL
        )
        SELECT own.conv_id, own.d AS depth, p.conv_id AS parent_conv_id, own.n_convs, own.n_children, n_leaves::BIGINT AS n_leaves,
               saved_tokens::BIGINT AS saved_tokens, own.ends_sha256
        FROM own JOIN up USING (k) LEFT JOIN own p ON own.d > 0 AND p.k = own.k[1:own.d - 1]
    """
}
