"""Personal data by a skip-chain conditional random field (operator 11).

Base spans come from patterns: e-mail addresses, IP addresses, card numbers
(Luhn), phone numbers. They are also the labels that the field is trained on.

The field's tokens are a document's words that hold a digit, ``@`` or ``+``;
all other words are outside of any span by definition. Potentials are shared
by a token's features (shape, checks, neighbours), by adjacent tokens (chain),
and by distant ones: a token is tied to the last one before it with the same
core ("repeated") and to the last one with the same ending digits or the same
local part ("similar"). Ties to the last occurrence make a chain of all
occurrences, so there are at most three edges a token. Loopy belief
propagation, a fixed number of damped rounds on all tokens of a document,
spreads what one place says of an entity to the others. Runs of tokens of one
kind that no base span covers become added spans if their marginals reach
``SURE`` and their form allows it.

Weights are learnt by gradient steps on the likelihood, with the marginals of
the same propagation, from a bounded sample: about ``FIT_ROWS`` distinct texts
of at most ``FIT_CHARS`` characters that hold a digit or ``@``, drawn by hash. The features that
restate a base pattern are left out for half of the sample's tokens, so that
shapes and ties get weights of their own.

Defined cases: a null text counts as empty (no spans); repeated rows give
repeated rows; null doc_ids stay null; an empty table gives no rows; further
columns are ignored. Whole texts are read, each by one task; time is in
proportion to the text, memory to a text and its tokens.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import WORD, small_batches, table

KINDS = ("email", "ip", "card", "phone")
#: Labels: 0 is none, then the kinds.
LABELS = len(KINDS) + 1
FIT_ROWS, FIT_CHARS = 3000, 20000
FIT_STEPS, FIT_ROUNDS, ROUNDS = 100, 6, 12
#: Least marginal of every token of an added span.
SURE = 0.9
SLICE = 1 << 20

# --- base patterns ---------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# a match of four numbers begins where a run of digits does
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")
_ACTIVE = re.compile(r"[0-9@+]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, *s) for s in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]


# --- tokens, features and ties -------------------------------------------------------

_JUNK = "!\"#$%&'*,./:;<=>?[\\]^_`{|}~-"
_EMAIL_FORM = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_PAIRED = re.compile(r"\(?[0-9]{2,4}\)?[-./][0-9]{3,5}([-./][0-9]{2,5})?")
#: Groups of features: those that restate a base pattern come first.
FEATURES = [
    "address", "four bytes", "card number", "bad card number", "in phone", "in card", "in bad card",
    "any", "at", "at without dots", "four numbers", "dotted numbers", "bytes by other marks", "digits only",
    "1 digit", "2-4 digits", "5-6 digits", "7-8 digits", "9-12 digits", "13-19 digits", "20 digits", "plus", "parenthesis", "paired numbers",
    "letters too", "long mixed", "quoted", "behind plus", "behind plain", "before plain", "before token",
]
PATTERN_FEATURES = 7
_AT = {n: i for i, n in enumerate(FEATURES)}
_DIGITS = [(1, "1 digit"), (4, "2-4 digits"), (6, "5-6 digits"), (8, "7-8 digits"), (12, "9-12 digits"), (19, "13-19 digits")]


class Graph:
    """Tokens of documents, with ``spans`` (start, end of the core), features,
    base labels, and edges (from, to, type: 0 chain, 1 repeated, 2 similar)."""

    def __init__(self) -> None:
        self.doc: list[int] = []
        self.spans: list[tuple[int, int]] = []
        self.cores: list[str] = []
        self.features: list[list[int]] = []
        self.labels: list[int] = []
        self.edges: list[tuple[int, int, int]] = []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        words = [m.span() for m in WORD.finditer(text)]
        starts = np.array([s for s, _ in words], np.int64)
        active = np.unique(np.searchsorted(starts, [m.start() for m in _ACTIVE.finditer(text)], side="right") - 1).tolist()
        cover = [sorted((s, e) for k, s, e in base if k == kind) for kind in range(len(KINDS))]
        cards = [(*m.span(), luhn(d)) for m in _CARD.finditer(text) if 13 <= len(d := _NO_DIGIT.sub("", m[0])) <= 19]
        place = [0] * (len(KINDS) + 1)
        seen: dict[tuple[int, str], int] = {}
        known = set(active)
        for w in active:
            s, e = words[w]
            word = text[s:e]
            core = word.strip(_JUNK)
            s += len(word) - len(word.lstrip(_JUNK)) if core else 0
            e = s + len(core) if core else e
            node = len(self.doc)
            in_base = [self._inside(cover[k], place, k, s, e) for k in range(len(KINDS))]
            in_card = self._inside(cards, place, len(KINDS), s, e)
            plus = w - 1 in known and text[words[w - 1][0] : words[w - 1][1]].lstrip(_JUNK)[:1] == "+"
            names = self._names(word, core, in_base[3] is not None, in_card[2] if in_card else None)
            names += ["behind plus"] * plus + (["before token"] if w + 1 in known else ["before plain"]) + ["behind plain"] * (w - 1 not in known)
            self.doc.append(doc)
            self.spans.append((s, e))
            self.cores.append(core)
            self.features.append([_AT[n] for n in names])
            self.labels.append(next((k + 1 for k in range(len(KINDS)) if in_base[k]), 0))
            if w - 1 in known:
                self.edges.append((node - 1, node, 0))
            digits = _NO_DIGIT.sub("", core)
            name = core[: core.find("@")] if "@" in core else digits[-7:] if len(digits) >= 7 else ""
            before = seen.get((1, core.lower()))
            if core and before is not None:
                self.edges.append((before, node, 1))
            alike = seen.get((2, name.lower()))
            if name and alike is not None and alike != before:
                self.edges.append((alike, node, 2))
            seen[1, core.lower()] = seen[2, name.lower()] = node

    @staticmethod
    def _inside(spans: list, place: list[int], k: int, s: int, e: int):
        """The span that meets [s, e), for tokens in order."""
        while place[k] < len(spans) and spans[place[k]][1] <= s:
            place[k] += 1
        hit = spans[place[k]] if place[k] < len(spans) else None
        return hit if hit and hit[0] < e else None

    @staticmethod
    def _names(word: str, core: str, in_phone: bool, card: bool | None) -> list[str]:
        out = ["any"]
        groups = [g for g in _NO_DIGIT.split(core) if g]
        n = sum(map(len, groups))
        bytes_ = len(groups) == 4 and all(map(_byte, groups))
        letters = any(c.isalpha() for c in core)
        if "@" in core:
            out += ["at", "address" if _EMAIL_FORM.fullmatch(core) else "at without dots"]
        elif letters:
            out.append("letters too")
            if len(core) >= 16:
                out.append("long mixed")
        elif groups:
            dots = set(_NO_DIGIT.findall(core)) == {"."}
            if dots and len(groups) == 4:
                out += ["four numbers"] + ["four bytes"] * bytes_
            elif dots:
                out.append("dotted numbers")
            elif bytes_:
                out.append("bytes by other marks")
            if len(groups) == 1 and len(core) == n:
                out.append("digits only")
            if 13 <= n <= 19 and len(groups) < 6 and not dots:
                out.append("card number" if luhn("".join(groups)) else "bad card number")
            if _PAIRED.fullmatch(core):
                out.append("paired numbers")
        out += [next((name for most, name in _DIGITS if n <= most), "20 digits")] * (n > 0)
        out += ["plus"] * core.startswith("+") + ["parenthesis"] * ("(" in core or ")" in core) + ["quoted"] * (word[:1] in "\"'" or word[-1:] in "\"'")
        return out + ["in phone"] * in_phone + ([] if card is None else ["in card" if card else "in bad card"])

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """Features as a 0/1 matrix, and the edges."""
        x = np.zeros((len(self.doc), len(FEATURES)))
        for i, f in enumerate(self.features):
            x[i, f] = 1
        return x, np.array(self.edges, np.int64).reshape(-1, 3)


# --- belief propagation and training --------------------------------------------------


def _total(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(at, values[:, k], n) for k in range(values.shape[1])], 1)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(1, keepdims=True)
    return np.log(np.exp(x - top).sum(1)) + top[:, 0]


def propagate(unary: np.ndarray, edges: np.ndarray, pairs: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the nodes from log potentials, where ``pairs[type, label of
    from, label of to]`` holds along an edge, and what the nodes at both ends
    of each edge say without it. Messages are halfway between old and new in
    each round."""
    n, m = len(unary), len(edges)
    src = np.concatenate([edges[:, 0], edges[:, 1]])
    dst = np.concatenate([edges[:, 1], edges[:, 0]])
    kind = np.concatenate([edges[:, 2], edges[:, 2] + len(pairs)])
    groups = [(np.flatnonzero(kind == t), np.exp(p)) for t, p in enumerate([*pairs, *pairs.transpose(0, 2, 1)])]
    message = np.zeros((2 * m, unary.shape[1]))

    def rest() -> np.ndarray:
        return belief[src] - np.concatenate([message[m:], message[:m]])

    belief = unary
    for _ in range(rounds if m else 0):
        out = rest()
        out = np.exp(out - out.max(1, keepdims=True))
        for at, p in groups:
            if len(at):
                out[at] = out[at] @ p
        out = np.log(out)
        message = (message + out - out.max(1, keepdims=True)) / 2
        belief = unary + _total(message, dst, n)
    out = rest()
    return np.exp(belief - _log_sum(belief)[:, None]), out[:m], out[m:]


def pair_marginals(tail: np.ndarray, head: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """The sum over edges of one type of their pair marginals."""
    joint = tail[:, :, None] + head[:, None, :] + pair
    return np.exp(joint - _log_sum(joint.reshape(len(joint), pair.size))[:, None, None]).sum(0)


class Model:
    """Weights: features by label, and label pairs by type of edge."""

    def __init__(self, unary: np.ndarray | None = None, pairs: np.ndarray | None = None):
        self.unary = np.zeros((len(FEATURES), LABELS)) if unary is None else unary
        self.pairs = np.zeros((3, LABELS, LABELS)) if pairs is None else pairs
        if unary is None:
            self.unary[_AT["any"], 0] = 2.0

    def marginals(self, graph: Graph) -> np.ndarray:
        x, edges = graph.arrays()
        return propagate(x @ self.unary, edges, self.pairs, ROUNDS)[0]

    def fit(self, graph: Graph, steps: int = FIT_STEPS) -> Model:
        """Gradient steps (with momentum and scaling per weight) on the
        likelihood of the graph's base labels."""
        x, edges = graph.arrays()
        if not len(x):
            return self
        x[:, :PATTERN_FEATURES] *= (np.random.default_rng(11).random(len(x)) < 0.5)[:, None]
        truth = np.eye(LABELS)[graph.labels]
        a, b, kind = edges.T
        wanted = x.T @ truth
        tied = np.zeros_like(self.pairs)
        np.add.at(tied, (kind, np.array(graph.labels)[a], np.array(graph.labels)[b]), 1)
        weights, shapes = np.concatenate([self.unary.ravel(), self.pairs.ravel()]), self.unary.size
        first, second = np.zeros_like(weights), np.zeros_like(weights)
        for step in range(1, steps + 1):
            unary, pairs = weights[:shapes].reshape(self.unary.shape), weights[shapes:].reshape(self.pairs.shape)
            node, tail, head = propagate(x @ unary, edges, pairs, FIT_ROUNDS)
            seen = np.stack([pair_marginals(tail[kind == t], head[kind == t], pairs[t]) for t in range(3)])
            up = np.concatenate([(wanted - x.T @ node).ravel(), (tied - seen).ravel()]) / len(x) - 1e-4 * weights
            first, second = 0.9 * first + 0.1 * up, 0.99 * second + 0.01 * up * up
            weights = weights + 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        return Model(weights[:shapes].reshape(self.unary.shape), weights[shapes:].reshape(self.pairs.shape))


def allowed(kind: int, said: str) -> bool:
    """Whether a run of tokens has the form of its kind."""
    groups = [g for g in _NO_DIGIT.split(said) if g]
    digits = "".join(groups)
    if kind == 0:
        return 0 < said.find("@") < len(said) - 1
    if kind == 1:
        return len(groups) == 4 and all(map(_byte, groups))
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 7 <= len(digits) <= 15


def added_spans(graph: Graph, marginals: np.ndarray, base: dict[int, list[tuple[int, int, int]]], texts: dict[int, str]) -> dict[int, list[tuple[int, int, int]]]:
    """Per document the runs of tokens with one sure kind that no base span meets."""
    best = np.where(marginals.max(1) >= SURE, marginals.argmax(1), 0)
    chained = {j for i, j, t in graph.edges if t == 0}
    free = [True] * len(best)
    by_doc: dict[int, list[int]] = {}
    for i, d in enumerate(graph.doc):
        by_doc.setdefault(d, []).append(i)
    for d, nodes in by_doc.items():
        spans, k = sorted((s, e) for _, s, e in base[d]), 0
        reach = -1  # furthest end of the spans that begin before the token's end
        for i in nodes:
            s, e = graph.spans[i]
            while k < len(spans) and spans[k][0] < e:
                reach = max(reach, spans[k][1])
                k += 1
            free[i] = reach <= s
    out: dict[int, list[tuple[int, int, int]]] = {}
    run: list[int] = []

    def close() -> None:
        if run:
            d, kind = graph.doc[run[0]], int(best[run[0]]) - 1
            s, e = graph.spans[run[0]][0], graph.spans[run[-1]][1]
            if allowed(kind, texts[d][s:e]):
                out.setdefault(d, []).append((kind, s, e))
            run.clear()

    for i in range(len(best)):
        if run and not (i in chained and best[i] == best[run[0]] and free[i]):
            close()
        if best[i] and free[i]:
            run.append(i)
    close()
    return out


# --- on Spark ----------------------------------------------------------------------


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = sorted(t for b in batches for t in b.column("text").to_pylist())
    graph = Graph()
    for i, text in enumerate(texts):
        graph.add(i, text, base_spans(text))
    model = Model().fit(graph)
    yield pa.record_batch([pa.array([model.unary.ravel().tolist()]), pa.array([model.pairs.ravel().tolist()])], names=["unary", "pairs"])


def fitted(documents: DataFrame) -> Model:
    """The model of a bounded sample (see above); a few hundred weights come
    to the driver."""
    text = F.coalesce(F.col("text"), F.lit(""))
    some = documents.select(text.alias("text"), F.xxhash64(text).alias("h")).filter((F.length("text") <= FIT_CHARS) & F.col("text").rlike("[0-9@]"))
    many = some.agg(F.approx_count_distinct("h")).first()[0]
    part = min(1.0, FIT_ROWS / max(many, 1))
    drawn = some.filter(F.pmod("h", F.lit(1 << 20)) < int(part * (1 << 20))).groupBy("h").agg(F.first("text").alias("text"))
    row = drawn.select("text").repartition(1).mapInArrow(_fit, "unary array<double>, pairs array<double>").first()
    if row is None:
        return Model()
    return Model(np.array(row["unary"]).reshape(len(FEATURES), LABELS), np.array(row["pairs"]).reshape(3, LABELS, LABELS))


def _said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _find(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", SLICE):
            texts = {i: t for i, t in enumerate(batch.column("text").to_pylist()) if _ACTIVE.search(t)}
            graph, base = Graph(), {}
            for i, text in texts.items():
                base[i] = base_spans(text)
                graph.add(i, text, base[i])
            added = added_spans(graph, model.marginals(graph), base, texts) if graph.doc else {}
            rows = range(batch.num_rows)
            counts = [[sum(s[0] == k for s in base.get(i, [])) for i in rows] for k in range(len(KINDS))]
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array([_said(base.get(i, [])) for i in rows], pa.string()),
                 pa.array([_said(base.get(i, []) + added.get(i, [])) for i in rows], pa.string()), pa.array([len(added.get(i, [])) for i in rows], pa.int64())],
                names=["doc_id", *(f"n_{k}" for k in KINDS), "base", "spans", "n_added"],
            )

    return run


def find_personal_data(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans, n_added) for each
    row: the numbers of base spans, the base spans as kind:start:end, all
    spans likewise, and the number of spans the field added."""
    rows = documents.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_find(model), f"doc_id {kind}, {counts}, base string, spans string, n_added long")


def op11_skip_chain_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, fitted(docs))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


QUERIES = {"op11_skip_chain_pii": op11_skip_chain_pii}
