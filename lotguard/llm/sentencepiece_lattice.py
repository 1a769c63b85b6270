"""SentencePiece encoding and decoding with Gumbel top-k sampling (operator 1).

Encoding samples ``k`` distinct segmentations of a whole text without
replacement. A text's lattice has a node for each place between characters and
an arc for each vocabulary piece that stands there (characters that the
vocabulary lacks become byte pieces); a segmentation's weight is the product of
its pieces' probabilities. Pieces never hold a space behind another character,
so the lattice falls apart into one for each word with its leading spaces;
unlike words are worked out once, all at a time.

Gumbel top-k: each segmentation's log-probability is perturbed by a standard
Gumbel variable, and the k largest are a sample without replacement. The search
over the lattice is A*: a set of segmentations (all that share a first part and
go on otherwise) has as its key the largest perturbed value inside, which can
be drawn from its total probability alone; the set with the largest key is
opened first, and yields the segmentation with that value (drawn arc by arc)
and smaller sets, one for each arc at which the others leave it. Their keys
are Gumbel variables truncated at the opened set's. Sets whose key is sure to
be too small, since a double cannot hold a larger Gumbel variable, are not
drawn. Segmentations so come in falling order, each once.

All draws are hashes of the row key, a seed and the draw's place: the same row
gives the same sample anywhere. ``inclusion`` is the probability, given the
(k + 1)-th largest value, that the segmentation is among the k.

The model is a SentencePiece file with byte fallback; it is read, never
trained. A merge-order model has no probabilities, so that of a piece follows
its rank r by Zipf's law, 1 / (r + 2.7), byte pieces last.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotguard.llm.common import U64, kept_in_worker, list_array, mix, powers, ranges, release_memory, small_batches, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Segmentations of a text; seed of all draws.
K, SEED = 2, 7
SLICE = 1 << 17
#: Bytes of word lattices that a worker keeps; occurrences that are drawn, and
#: words that are put in, at once.
CACHE, CHUNK, NEW = 32 << 20, 1 << 15, 1 << 13
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_C1, _C2, _C3 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0xC2B2AE3D27D4EB4F)
_SLOTS = 20
#: Characters before a word's end whose weights don't underflow as they are.
_NEAR = 32
#: No Gumbel variable drawn from a 53-bit uniform is larger.
_LARGEST = 37.5
#: Log-probability down to which a segmentation's first part is looked at first.
_DEEP = -45.0
_SPACE = "▁"
#: Odd multiplier of the words' running hashes; what stands for each byte.
_TIMES = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=U64))


def load_model(path: str = MODEL) -> dict:
    """Pieces (UTF-8, spaces as spaces) and log-probabilities by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: list[bytes] = []
    kinds = np.zeros(model.get_piece_size(), np.int8)  # 0 not in lattices, 1 piece, 2 byte
    for i in range(len(kinds)):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            kinds[i] = 2
            pieces.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            pieces.append(b"")
        else:
            if _SPACE in piece.lstrip(_SPACE):
                raise ValueError(f"piece {i} has a space behind another character")
            kinds[i] = 1
            pieces.append(piece.replace(_SPACE, " ").encode())
    if (kinds == 2).sum() != 256:
        raise ValueError("the model has no byte fallback")
    rank = np.cumsum(kinds == 1).astype(float)
    rank[kinds == 2] = rank.max() + 1
    weight = np.where(kinds > 0, 1 / (rank + 2.7), 0.0)
    with np.errstate(divide="ignore"):
        return {"pieces": pieces, "kinds": kinds, "logp": np.log(weight / weight.sum())}


def uniform(key: np.ndarray, a: np.ndarray | int, b: np.ndarray | int, c: np.ndarray | int) -> np.ndarray:
    """Hashed draws from (0, 1)."""
    as64 = lambda x: np.atleast_1d(np.asarray(x, np.int64)).view(U64)
    return _unit(key + as64(a) * _C1 + as64(b) * _C2 + as64(c) * _C3)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((mix(mix(x)) >> U64(11)).astype(float) + 0.5) * 2.0**-53


class _Grown:
    """An array that grows at its end, by half of its size."""

    def __init__(self, *first, kind=np.int64):
        self.data, self.from_start = np.zeros(1 << 16, kind), np.array(first, kind)
        self.clear()

    def clear(self) -> None:
        self.size = 0
        if self.data.nbytes > CACHE // 2:  # of a very long text
            self.data = self.data[: 1 << 16].copy()
        self.add(self.from_start)

    def add(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.data):
            grown = np.zeros(max(end, len(self.data) * 3 // 2), self.data.dtype)
            grown[: self.size] = self.data[: self.size]
            self.data = grown
        self.data[self.size : end] = more
        self.size = end


class Lattices:
    """The lattices of words, in common arrays. Node n has arcs
    first[n] : first[n + 1], longest first; arc a leads to target[a], has
    conditional log-probability logc[a], running sum cum[a] within its node,
    and ids[id_at[a] : id_at[a + 1]]."""

    def __init__(self, model: dict):
        self.times = self.back = np.zeros(0, U64)
        self.logp = model["logp"]
        self.byte_id = {model["pieces"][i][0]: int(i) for i in np.flatnonzero(model["kinds"] == 2)}
        known: dict[int, int] = {}
        begun: set[int] = set()
        self.longest, self.newline_apart = 1, True
        for i in np.flatnonzero(model["kinds"] == 1):
            text = model["pieces"][i].decode()
            self.newline_apart &= "\n" not in text
            self.longest = max(self.longest, len(text))
            h = 0
            for n, c in enumerate(text, 1):
                h = (h * int(_BASE) + ord(c) + 1) & (1 << 64) - 1
                known[h] = int(i) if n == len(text) else known.get(h, -1)
                if n < len(text):
                    begun.add(h)
        order = sorted(known)
        index = {h: i for i, h in enumerate(order)}
        self.keys = np.array(order, U64)
        self.key_ids = np.array([known[h] for h in order], np.int32)
        self.of_char = np.full(0x110000, -1, np.int32)
        singles = {ord(c): c for t in model["pieces"] for c in t.decode("utf-8", "ignore")[:1]}
        self.of_char[list(singles)] = [index.get(c + 1, -1) for c in singles]
        self.goes_on = np.array([h in begun for h in order], bool)
        slot = (self.keys * _C1 >> U64(64 - _SLOTS)).astype(np.int64)
        self.slots = np.zeros(1 << _SLOTS, np.int32)
        self.slots[slot] = np.arange(len(self.keys))
        other = np.flatnonzero(self.slots[slot] != np.arange(len(self.keys)))
        self.crowded, self.crowded_at = self.keys[other], other.astype(np.int32)
        self.pieces = pa.array(model["pieces"], pa.large_binary())
        small = np.int32
        self.grown = {"start": _Grown(), "first": _Grown(0, kind=small), "target": _Grown(kind=small), "node": _Grown(kind=small), "logc": _Grown(kind=float)}
        self.grown |= {"cum": _Grown(kind=np.float32), "ids": _Grown(kind=small), "id_at": _Grown(0, kind=small)}
        self.grown |= {"name": _Grown(kind=U64), "used": _Grown(kind=small)}
        self.clear()

    def clear(self) -> None:
        self.index: dict[int, int] = {}
        for g in self.grown.values():
            g.clear()
        self._name()

    def forget(self) -> None:
        """Drop all lattices, with the room they took."""
        self.times = self.back = np.zeros(0, U64)
        for g in self.grown.values():
            g.data = np.zeros(1 << 10, g.data.dtype)
        self.clear()

    def held(self) -> int:
        """Bytes of the arrays in use."""
        return sum(g.size * g.data.itemsize for g in self.grown.values())

    def _name(self) -> None:
        self.start, self.first, self.target, self.node, self.logc, self.cum, self.ids, self.id_at, self.name, self.used = (g.data for g in self.grown.values())

    def thin(self, room: int) -> None:
        """Keep the words that were met in most calls, twice at least, as far
        as ``room`` bytes go."""
        g = self.grown
        n = g["start"].size
        begin = np.append(self.start[:n], g["first"].size - 1)
        parts = [begin, arcs_at := self.first[begin].astype(np.int64), self.id_at[arcs_at].astype(np.int64)]
        size = sum(np.diff(x) * weight for x, weight in zip(parts, (4, 24, 4), strict=True)) + 20
        order = np.argsort(-self.used[:n], kind="stable")
        keep = np.sort(order[(np.cumsum(size[order]) <= room) & (self.used[order] > 1)])
        count = [np.diff(x)[keep] for x in parts]
        nodes, arcs, ids = (ranges(x[keep], c) for x, c in zip(parts, count, strict=True))
        ends = [np.cumsum(c) for c in count]
        back = [x[keep] - (e - c) for x, c, e in zip(parts, count, ends, strict=True)]  # places that they move
        by_arc = np.repeat(back[0], count[1])
        new = {"start": ends[0] - count[0], "first": self.first[nodes + 1] - np.repeat(back[1], count[0]), "target": self.target[arcs] - by_arc}
        new |= {"node": self.node[arcs] - by_arc, "logc": self.logc[arcs], "cum": self.cum[arcs], "ids": self.ids[ids]}
        new |= {"id_at": self.id_at[arcs + 1] - np.repeat(back[2], count[1]), "name": self.name[keep], "used": np.zeros(len(keep), np.int32)}
        self.clear()
        for name, values in new.items():
            g[name].add(values)
        self.index = dict(zip(new["name"].tolist(), range(len(keep)), strict=True))
        self._name()

    def _look_up(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash in keys, -1 where it is none of them."""
        k = self.slots[(h * _C1 >> U64(64 - _SLOTS)).astype(np.int64)]
        k[self.keys[k] != h] = -1
        if len(self.crowded):  # hashes whose slot another key holds
            again = np.flatnonzero(k < 0)
            c = np.minimum(np.searchsorted(self.crowded, h[again]), len(self.crowded) - 1)
            hit = self.crowded[c] == h[again]
            k[again[hit]] = self.crowded_at[c[hit]]
        return k

    def add(self, chars: np.ndarray, size: np.ndarray, names: list[int]) -> None:
        """Put in the lattices of words, under the names given: their characters,
        word after word, and how many each has."""
        begin = np.cumsum(size + 1) - (size + 1)  # one node more than characters
        n_nodes = int((size + 1).sum())
        at = ranges(begin, size)  # the node before each character
        char = np.zeros(n_nodes, np.uint32)
        char[at] = chars
        end = np.repeat(begin + size, size + 1)
        left = end - np.arange(n_nodes)
        starts, lengths, pieces = [], [], []
        p, more = at.astype(np.int32), left[at].astype(np.int32)
        h = np.zeros(len(p), U64)
        for n in range(1, self.longest + 1):
            if not len(p):
                break
            h = h * _BASE + char[p + (n - 1)].astype(U64) + U64(1)
            k = self._look_up(h) if n > 1 else self.of_char[char[p]]
            full = np.flatnonzero((k >= 0) & (self.key_ids[k] >= 0))
            starts.append(p[full])
            lengths.append(np.full(len(full), n, np.int64))
            pieces.append(self.key_ids[k[full]])
            go = np.flatnonzero((k >= 0) & (more > n) & self.goes_on[k])
            h, p, more = h[go], p[go], more[go]
        start, length, piece = (np.concatenate(x[::-1]) if x else np.zeros(0, np.int64) for x in (starts, lengths, pieces))
        start = start.astype(np.int64)
        single = np.zeros(n_nodes, bool)
        single[start[length == 1]] = True
        lost = at[~single[at]]  # characters to be spelled in bytes
        spelled = [[self.byte_id[b] for b in chr(c).encode("utf-8", "surrogatepass")] for c in char[lost].tolist()]
        if len(lost):
            start = np.concatenate((start, lost))
            length = np.concatenate((length, np.ones(len(lost), np.int64)))
            n_ids = np.concatenate((np.ones(len(piece), np.int64), np.array([len(s) for s in spelled], np.int64)))
            ids = np.concatenate((piece, np.array([i for s in spelled for i in s], np.int64))).astype(np.int32)
            lp = np.add.reduceat(self.logp[ids], np.cumsum(n_ids) - n_ids)
        else:
            ids = piece.astype(np.int32)
            lp = self.logp[ids]
        # total log-weight of what follows each node, from the ends backwards
        order = np.argsort(start, kind="stable")
        start, length, lp = start[order], length[order], lp[order]
        count = np.bincount(start, minlength=n_nodes)
        first = np.concatenate(([0], np.cumsum(count)))
        if left.max(initial=0) < 1 << 15:  # short integers are sorted faster
            left = left.astype(np.int16)
        nodes = np.argsort(left, kind="stable")
        nodes = nodes[left[nodes] > 0]
        arcs = np.argsort(left[start], kind="stable")  # in the order of nodes
        weight, log_weight, to = np.exp(lp[arcs]), lp[arcs], (start + length)[arcs]
        upto = np.concatenate(([0], np.cumsum(count[nodes])))
        total = np.ones(n_nodes)
        rest = np.zeros(n_nodes)
        near = left <= _NEAR
        for s, c in zip(*_groups(left[nodes]), strict=True):
            at, a, b = nodes[s : s + c], upto[s], upto[s + c]
            if near[at[0]]:
                total[at] = np.add.reduceat(weight[a:b] * total[to[a:b]], upto[s : s + c] - a)
                continue
            if left[at[0]] == _NEAR + 1:
                rest[near] = np.log(total[near])
            v = log_weight[a:b] + rest[to[a:b]]
            top = np.maximum.reduceat(v, upto[s : s + c] - a)
            rest[at] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count[at])), upto[s : s + c] - a))
        rest[near] = np.log(total[near])
        logc = np.minimum(lp + rest[start + length] - rest[start], 0.0)
        running = np.cumsum(np.exp(logc))
        cum = running - np.repeat(np.concatenate(([0.0], running))[first[:-1]], count)
        cum[(first[1:] - 1)[count > 0]] = 2.0  # the last arc takes what is left
        g = self.grown
        n0, a0, i0 = g["first"].size - 1, g["target"].size, g["ids"].size
        self.index.update(zip(names, range(g["start"].size, g["start"].size + len(size)), strict=True))
        new = {"start": begin + n0, "first": first[1:] + a0, "target": start + length + n0, "node": start + n0, "logc": logc, "cum": cum}
        if len(lost):
            new |= {"ids": ids[ranges((np.cumsum(n_ids) - n_ids)[order], n_ids[order])], "id_at": i0 + np.cumsum(n_ids[order])}
        else:
            new |= {"ids": ids[order], "id_at": np.arange(i0 + 1, i0 + 1 + len(ids))}
        new |= {"name": np.array(names, U64), "used": np.zeros(len(size), np.int32)}
        for name, values in new.items():
            g[name].add(values)
        self._name()

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first node of each word's lattice, text after text, and where a
        text's words begin. A word is a run of characters with the spaces before
        it; spaces at a text's end, and line feeds if no piece holds one among
        others, are words too. Each text has a space put before it. Words are
        told apart by their hashes, running sums over the texts' bytes."""
        raw = [b" " + t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
        flat = b"".join(raw)
        data = np.frombuffer(flat, np.uint8)
        ends = np.cumsum(np.array([len(r) for r in raw], np.int64))
        space = data == 0x20
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        if self.newline_apart:
            feed = np.flatnonzero(data == 0x0A)
            begins[feed] = True
            begins[np.minimum(feed + 1, len(data) - 1)] |= feed + 1 < len(data)
        begins[(ends - [len(r) for r in raw])[[len(r) > 0 for r in raw]]] = True
        at = np.flatnonzero(begins)
        upto = np.append(at[1:], len(data))
        n = len(data)
        if len(self.times) < n:
            self.times, self.back = powers(_TIMES, n), powers(pow(_TIMES, -1, 1 << 64), n)
        sums = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTES[data] * self.times[:n], dtype=U64)))
        value = mix((sums[upto] - sums[at]) * self.back[at] + (upto - at).astype(U64))
        coded = pa.array(value).dictionary_encode()
        names, which = coded.dictionary.to_numpy().tolist(), coded.indices.to_numpy()
        one = np.zeros(len(names), np.int64)
        one[which] = np.arange(len(which))  # any of the equal ones
        place = np.array(list(map(self.index.get, names, repeat(-1))), np.int64)
        if len(new := np.flatnonzero(place < 0)):
            place[new] = self.grown["start"].size + np.arange(len(new))
            for s in range(0, len(new), NEW):
                some = new[s : s + NEW]
                size = (upto - at)[one[some]]
                spelled = data[ranges(at[one[some]], size)]
                chars = np.frombuffer(spelled.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
                begins_char = ((spelled & 0xC0) != 0x80).astype(np.int64)
                self.add(chars, np.add.reduceat(begins_char, np.cumsum(size) - size), [names[i] for i in some.tolist()])
        self.used[place] += 1
        return self.start[place[which]], np.concatenate(([0], np.searchsorted(at, ends)))

    def draw(self, node: np.ndarray, key: np.ndarray, place: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """From each node a random walk to the end of its lattice: the arcs,
        walk after walk, and how many each has."""
        done = [self._draw(node[s : s + CHUNK], key[s : s + CHUNK], place[s : s + CHUNK], turn) for s in range(0, len(node), CHUNK)]
        if not done:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*done, strict=True))

    def _draw(self, node, key, place, turn):
        many = np.zeros(len(node), np.int64)
        drawn = key + place.view(U64) * _C1 + np.array([turn], U64) * _C2  # the draws' keys at step 0, as in uniform()
        walk, steps = np.arange(len(node)), []
        step = 0
        while True:
            arc = self.first[node]
            go = np.flatnonzero(self.first[node + 1] > arc)
            if not len(go):
                break
            walk, arc, drawn = walk[go], arc[go].astype(np.int64), drawn[go]
            u = _unit(drawn + np.array([step], U64) * _C3)
            on = np.flatnonzero(u > self.cum[arc])
            while len(on):
                arc[on] += 1
                on = on[u[on] > self.cum[arc[on]]]
            steps.append((walk, arc))
            many[walk] += 1
            node = self.target[arc].astype(np.int64)
            step += 1
        out = np.zeros(int(many.sum()), np.int64)
        begin = np.cumsum(many) - many
        for k, (w, arc) in enumerate(steps):
            out[begin[w] + k] = arc
        return out, many

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The texts of rows of piece ids, put one after another; the space
        put before a text is taken off."""
        if not len(ids):
            return [b""] * len(sizes)
        taken = self.pieces.take(pa.array(ids))
        ends = np.frombuffer(taken.buffers()[1], np.int64)
        flat = taken.buffers()[2].to_pybytes()
        at = ends[np.concatenate(([0], np.cumsum(sizes)))].tolist()
        return [flat[a + flat.startswith(b" ", a, b) : b] for a, b in zip(at, at[1:], strict=False)]


def _groups(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return first, np.diff(np.append(first, len(values)))


class _Search:
    """The A* search of one text."""

    def __init__(self, lattices: Lattices, key: np.uint64, starts: np.ndarray, k: int):
        self.lat, self.key, self.starts, self.k = lattices, key, starts, k
        self.heap: list[tuple] = []
        self.found: list[tuple[float, float, np.ndarray, np.ndarray]] = []  # value, log-probability, arcs, arcs a word
        self.opened: tuple | None = None

    def _draw(self, a: int, b: int, c: int) -> float:
        return float(uniform(np.array([self.key]), a, b, c)[0])

    def leaving(self, sample: int, begin: int, deep: float) -> tuple[np.ndarray, np.ndarray]:
        """Places of a found segmentation, from ``begin`` on, where others can
        leave it, and the log-probability up to there, down to ``deep``."""
        arcs = self.found[sample][2]
        some = len(arcs) if deep == -math.inf else 256  # most texts' first places are enough
        while True:
            logc = self.lat.logc[arcs[:some]]
            before = np.cumsum(logc) - logc
            if some >= len(arcs) or before[-1] < deep:
                break
            some *= 4
        upto = len(logc) if deep == -math.inf else int(np.searchsorted(-before, -deep, side="right"))
        at = begin + np.flatnonzero(logc[begin:upto] < 0)
        return at, before[at] + np.log(-np.expm1(logc[at]))

    def push(self, sample: int, places: np.ndarray, keys: np.ndarray) -> None:
        need = self.k + 1 - len(self.found)
        most = np.argpartition(-keys, need)[:need] if len(keys) > need else np.arange(len(keys))
        for t in most[np.argsort(-keys[most], kind="stable")].tolist():
            heapq.heappush(self.heap, (-float(keys[t]), sample, int(places[t]), ()))

    def worst(self) -> float:
        """The key that a set must reach to be opened, or to be the bar."""
        need = self.k + 1 - len(self.found)
        return -heapq.nsmallest(need, self.heap)[-1][0] if len(self.heap) >= need else -math.inf

    def first(self, drawn: float) -> None:
        self.opened = (-math.log(-math.log(drawn)), None, 0, None, ())

    def open(self) -> bool:
        """Take the set with the largest key, and an arc by which it leaves."""
        if not self.heap:
            self.opened = None
            return False
        negative, sample, t, gone = heapq.heappop(self.heap)
        arcs = self.found[sample][2]
        node = int(self.lat.node[arcs[t]])
        a, b = int(self.lat.first[node]), int(self.lat.first[node + 1])
        gone = {*gone, int(arcs[t])}
        choice = [x for x in range(a, b) if x not in gone]
        if not choice:  # rounding: all of the probability was already out
            return self.open()
        weight = np.cumsum(np.exp(self.lat.logc[choice]))
        u = self._draw(t, 2000 + len(self.found), len(gone)) * weight[-1]
        arc = choice[min(int(np.searchsorted(weight, u)), len(choice) - 1)]
        self.opened = (-negative, sample, t, arc, (*gone, arc))
        return True

    def walks(self) -> tuple[np.ndarray, int]:
        """Nodes from which the opened set's segmentation is still to be drawn,
        and the place of the first one's word."""
        _, sample, t, arc, _ = self.opened
        if sample is None:
            return self.starts, 0
        word = int(np.searchsorted(np.cumsum(self.found[sample][3]), t, side="right"))
        return np.concatenate(([self.lat.target[arc]], self.starts[word + 1 :])), word

    def close(self, drawn: np.ndarray, many: np.ndarray) -> int:
        value, sample, t, arc, gone = self.opened
        if sample is None:
            arcs, sizes, begin = drawn, many, 0
        else:
            _, _, old, old_sizes = self.found[sample]
            word = len(old_sizes) - len(many)
            arcs = np.concatenate((old[:t], [arc], drawn))
            done = t - int(old_sizes[:word].sum()) + 1
            sizes = np.concatenate((old_sizes[:word], [done + many[0]], many[1:]))
            begin = t + 1
        logc = self.lat.logc[arcs]
        self.found.append((value, float(logc.sum()), arcs, sizes))
        if sample is not None:  # the others of the opened set leave at the same arc
            node = int(self.lat.node[arc])
            left = [x for x in range(int(self.lat.first[node]), int(self.lat.first[node + 1])) if x not in set(gone)]
            if left:
                mass = float(logc[:t].sum() + np.log(np.exp(self.lat.logc[left]).sum()))
                wait = -math.log(self._draw(t, 3000 + len(self.found), len(gone)))
                heapq.heappush(self.heap, (-(mass - math.log(math.exp(mass - value) + wait)), len(self.found) - 1, t, tuple(x for x in gone if x != arc)))
        return begin

    def results(self) -> Iterator[tuple[float, float, float, np.ndarray]]:
        bar = -self.heap[0][0] if self.heap else -math.inf
        for value, logp, arcs, _ in self.found:
            inclusion = 1.0 if bar == -math.inf else -math.expm1(-math.exp(min(logp - bar, 700)))
            yield value, logp, inclusion, arcs


def _set_keys(searches: list[_Search], begins: list[int], deep: float) -> None:
    """Draw the keys of the sets that leave the segmentations found last, for
    many texts at once; down to ``deep``, or all for which that isn't enough."""
    parts = [s.leaving(len(s.found) - 1, b, deep) for s, b in zip(searches, begins, strict=True)]
    size = np.array([len(at) for at, _ in parts])
    at, mass = (np.concatenate(x) for x in zip(*parts, strict=True))
    sample = np.repeat(np.array([len(s.found) - 1 for s in searches]), size)
    value = np.repeat(np.array([s.found[-1][0] for s in searches]), size)
    wait = -np.log(uniform(np.repeat(np.array([s.key for s in searches], U64), size), at, 1000 + sample, 0))
    with np.errstate(over="ignore"):
        keys = mass - np.log(np.exp(mass - value) + wait)
    ends = np.cumsum(size)
    for s, old, b, e in zip(searches, begins, ends - size, ends, strict=True):
        held = list(s.heap)
        s.push(len(s.found) - 1, at[b:e], keys[b:e])
        if s.worst() < deep + _LARGEST and deep > -math.inf:
            s.heap = held
            heapq.heapify(s.heap)
            _set_keys([s], [old], -math.inf)


def sample_texts(lattices: Lattices, keys: np.ndarray, texts: list[str], k: int) -> list[list[tuple]]:
    """For each text its segmentations in falling order: perturbed value,
    log-probability, inclusion, ids."""
    if lattices.held() > CACHE:
        lattices.thin(CACHE // 2)
    nodes, cut = lattices.words(texts)
    search = [_Search(lattices, keys[i], nodes[cut[i] : cut[i + 1]], k) for i in range(len(texts))]
    for s, drawn in zip(search, uniform(keys, 0, 999, 0).tolist(), strict=True):
        s.first(drawn)
    todo = search
    for turn in range(k):
        if turn:
            todo = [s for s in todo if s.open()]
        walks = [s.walks() for s in todo]
        size = np.array([len(w) for w, _ in walks], np.int64)
        if not len(walks):
            break
        node = np.concatenate([w for w, _ in walks])
        place = np.concatenate([np.arange(first, first + len(w)) for w, first in walks])
        drawn, many = lattices.draw(node, np.repeat(np.array([s.key for s in todo], U64), size), place, turn)
        ends = np.cumsum(size)
        arcs = np.concatenate(([0], np.cumsum(many)))
        _set_keys(todo, [s.close(drawn[arcs[b] : arcs[e]], many[b:e]) for s, b, e in zip(todo, ends - size, ends, strict=True)], _DEEP)
    done = [list(s.results()) for s in search]
    arcs = np.concatenate([np.zeros(0, np.int64), *(r[3] for rows in done for r in rows)])
    begin = lattices.id_at[arcs].astype(np.int64)
    size = lattices.id_at[arcs + 1] - begin
    ids, upto = lattices.ids[ranges(begin, size)], np.concatenate(([0], np.cumsum(size)))
    ends = upto[np.cumsum([0] + [len(r[3]) for rows in done for r in rows])].tolist()
    spelled = iter(zip(ends, ends[1:], strict=False))
    return [[(value, logp, inclusion, ids[slice(*next(spelled))]) for value, logp, inclusion, _ in rows] for rows in done]


def _encoder(model, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = kept_in_worker("lattices", hash(model.value["logp"].tobytes()), lambda: Lattices(model.value))
        for batch in small_batches(batches, "text", SLICE):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            keys = mix(np.asarray(batch.column("seed")).view(U64))
            found = sample_texts(lattices, keys, texts, k)
            row, rank, flat = [], [], []
            for i, samples in enumerate(found):
                for n, sample in enumerate(samples):
                    row.append(i)
                    rank.append(n)
                    flat.append(sample)
            size = np.array([len(s[3]) for s in flat], np.int64)
            ids = np.concatenate([s[3] for s in flat]) if flat else np.zeros(0, np.int32)
            raw = [t.encode() for t in texts]
            back = [found == raw[i] for i, found in zip(row, lattices.decode(ids, size), strict=True)]
            yield pa.record_batch(
                [batch.column("key").take(pa.array(row, pa.int32())), pa.array(rank, pa.int32()), list_array(pa.array(ids, pa.int32()), size),
                 *(pa.array([s[c] for s in flat], pa.float64()) for c in range(3)), pa.array(back, pa.bool_())],
                names=["key", "sample", "ids", "perturbed", "log_prob", "inclusion", "exact"],
            )
        batch = texts = found = flat = ids = back = None
        lattices.forget()
        release_memory()

    return rows


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """Up to ``k`` rows for each document: the key (as it is), sample (from 0,
    by falling perturbed value), ids (array<int>), perturbed, log_prob,
    inclusion, exact (whether decoding gives the text back).

    A null or empty text has one segmentation, without pieces (log_prob 0,
    inclusion 1); a text with fewer segmentations than ``k`` has them all, with
    inclusion 1. Rows of one key and text have equal samples; a null key is a
    key like others. Further columns are not read. An empty table gives an
    empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load_model(model))
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{key}`"), F.lit(seed)).alias("seed"))
    out = rows.mapInArrow(_encoder(shared, k), f"key {kind}, sample int, ids array<int>, perturbed double, log_prob double, inclusion double, exact boolean")
    return out.withColumnRenamed("key", key)


def decode(rows: DataFrame, ids: str = "ids", out: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of each row's ids (null for null). A column that is
    called ``out`` already is replaced."""
    rows = rows.drop(out)
    shared = rows.sparkSession.sparkContext.broadcast(load_model(model))

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = Lattices(shared.value)
        for batch in batches:
            column = batch.column(ids)
            rows = [np.array(x or [], np.int64) for x in column.to_pylist()]
            found = lattices.decode(np.concatenate([*rows, np.zeros(0, np.int64)]), np.array([len(x) for x in rows], np.int64))
            decoded = [t.decode("utf-8", "replace") if known.as_py() else None for t, known in zip(found, column.is_valid(), strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(decoded, pa.string())], names=[*batch.schema.names, out])

    return rows.mapInArrow(texts, rows.withColumn(out, F.lit("").cast("string")).schema)


def op1_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


QUERIES = {"op1_gumbel_segmentations": op1_gumbel_segmentations}
