"""Sampled SentencePiece segmentations without replacement, and decoding.

A text is a lattice: states are byte offsets, edges are pieces.  Edge weights come from the
model's merge ranks; a backward pass turns them into the chance of each edge given its
state, so a walk from the start samples a segmentation.

Distinct samples come from a perturbed search (Gumbel top-k, top down).  The best
perturbed segmentation is one walk with a Gumbel value.  At every state of the walk the
edges not taken form a branch whose best value is a Gumbel variable truncated at the
walk's.  The search always opens the best branch of all, so segmentations come in falling
order of their perturbed values, none twice.  With the value after the k-th as threshold t,
a segmentation of probability p is included with probability 1 - exp(-p / exp(t)).

No piece crosses from a character to a following space, so texts are cut into words there,
long ones once more wherever no piece that occurs in them crosses; what is still long is one
lattice, built in blocks from its end.  Words share states with all others of their slice that end alike, and known words are kept,
up to a bound, for the rest of the task.  Random
numbers are hashes of (seed, row key, place), so every rerun gives the same samples.
"""

from __future__ import annotations

import heapq
import importlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents
from .shingles import mix

SAMPLES = 2
ALPHA = 0.5                 # inverse temperature of the edge weights
STATES = 1_000_000          # states that a worker keeps
SLICE_BYTES = 1 << 20       # of text sampled at once
MARK = "▁"             # fixed value: the model's sign for a space
STOPS = b",.;:!?|-"           # before which a word may be cut
LONG = 96                   # bytes of a word from which it is cut finely and built by itself
BLOCK = 1 << 16             # bytes of a long word built at once
FEW = 8                     # walks that go on one by one

ENCODED = ("doc_id long, rank int, n_pieces long, log_prob double, perturbed double, log_inclusion double, "
           "ids binary, exact boolean")


def public_model(name: str = "piece_bpe_32k.model") -> str:
    """Path of an installed public vocabulary."""
    return importlib.import_module("public_tokenizers").path(name)


class Vocabulary:
    """Pieces as bytes with spaces for marks; weights by rank (Zipf's law), bytes last.

    The pieces also lie in a trie, for walks along many words at once.
    """

    def __init__(self, path: str, alpha: float = ALPHA):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        weight = lambda rank: -alpha * math.log(rank + 10)
        self.pieces: dict[bytes, tuple[int, float]] = {}
        self.bytes_of: list[bytes] = [b""] * n
        self.byte_ids = {}
        for i in range(n):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:-1], 16)
                self.byte_ids[value], self.bytes_of[i] = i, bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                raw = model.id_to_piece(i).replace(MARK, " ").encode()
                self.pieces[raw] = i, weight(min(n, max(0.0, -model.get_score(i))))
                self.bytes_of[i] = raw
        self.byte_weight = weight(n)
        self.longest = max(map(len, self.pieces))
        # the trie of the pieces as sorted keys node * 256 + byte -> node; root is 0
        nodes, keys = {b"": 0}, []
        for raw in self.pieces:
            for k in range(1, len(raw) + 1):
                if raw[:k] not in nodes:
                    keys.append((nodes[raw[:k - 1]] * 256 + raw[k - 1], len(nodes)))
                    nodes[raw[:k]] = len(nodes)
        self.keys, self.nodes = np.array(sorted(keys), np.int64).T.copy()
        self.ends = np.full(len(nodes), -1, np.int32)             # piece that ends in a node
        self.weight = np.zeros(len(nodes))
        for raw, (i, w) in self.pieces.items():
            self.ends[nodes[raw]], self.weight[nodes[raw]] = i, w
        self.byte_piece = np.array([self.byte_ids[x] for x in range(256)], np.int32)
        sizes = np.array([len(x) for x in self.bytes_of])
        self.size, self.start = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)

        self.unit = re.compile(self.pattern())

    def pattern(self) -> bytes:
        """Words: spaces and what follows them, a new line, or a stop and what follows it.

        A cut before a stop is taken only after bytes that no piece joins with that stop, so
        it loses no segmentation.  Where a piece crosses a new line or the space after
        another character, texts are one word.
        """
        if any(b"\n" in p or b" " in p.lstrip(b" ") for p in self.pieces):
            return b"(?s:.+)"
        joined = {c: {p[i - 1] for p in self.pieces for i in range(1, len(p)) if p[i] == c} for c in STOPS}
        stops = b"".join(b"\\x%02x" % c for c in STOPS)
        plain = b"[^ \\n" + stops + b"]+"
        stop = b"|".join(b"(?<=[" + b"".join(b"\\x%02x" % x for x in sorted(before)) + b"])\\x%02x" % c
                         for c, before in joined.items() if before)
        return (b" *(?:" + plain + b"|[" + stops + b"])(?:" + b"|".join(filter(None, [plain, stop])) + b")*| +|\\n")

    def words(self, text: bytes) -> list[bytes]:
        """The text, cut where no piece crosses."""
        found = self.unit.findall(text)
        if max(map(len, found), default=0) <= LONG:
            return found
        return list(itertools.chain.from_iterable(self.cut(w) if len(w) > LONG else (w,) for w in found))

    def cut(self, word: bytes) -> Iterator[bytes]:
        """A long word, cut before every character that no piece in it joins with the one before."""
        data, begin = np.frombuffer(word, np.uint8), 0
        for at in range(0, len(word), BLOCK):
            first = max(0, at - self.longest)                  # pieces that cross into the block, too
            part = data[first:at + BLOCK + self.longest]
            own, _, size, _ = self.matches(part, np.arange(len(part)), np.full(len(part), len(part)))
            crossed = np.zeros(len(part) + 1, np.int64)
            np.add.at(crossed, own + 1, 1)
            np.add.at(crossed, own + size, -1)
            free = (np.cumsum(crossed)[:-1] == 0) & ((part & 0xC0) != 0x80)
            for i in (np.flatnonzero(free) + first).tolist():
                if max(at, begin + 1) <= i < at + BLOCK:
                    yield word[begin:i]
                    begin = i
        yield word[begin:]

    def matches(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges that leave `at`, each before its `end`: (index in `at`, piece, bytes, weight)."""
        lead = data[at]
        begins = (lead & 0xC0) != 0x80
        width = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        spelt = np.ones(len(at), bool)                         # no piece is this character
        own, piece, size, weight = [], [], [], []
        live, k = np.flatnonzero(begins), 0
        node = np.zeros(len(live), np.int64)
        while len(live):
            node = self.step(node, data[at[live] + k])
            on = node >= 0
            live, node, k = live[on], node[on], k + 1
            hit = self.ends[node] >= 0
            rows = live[hit]
            own.append(rows)
            piece.append(self.ends[node[hit]])
            size.append(np.full(len(rows), k))
            weight.append(self.weight[node[hit]])
            spelt[rows[width[rows] == k]] = False
            more = at[live] + k < end[live]
            live, node = live[more], node[more]
        rows = np.flatnonzero(spelt)
        own.append(rows)
        piece.append(self.byte_piece[lead[rows]])
        size.append(np.ones(len(rows), np.int64))
        weight.append(np.full(len(rows), self.byte_weight))
        return np.concatenate(own), np.concatenate(piece), np.concatenate(size), np.concatenate(weight)

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The trie node after `byte`, -1 where no piece goes on."""
        key = node * 256 + byte
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], -1)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text: all pieces' bytes in a row, without the space put before the first."""
        size = self.size[ids]
        if not len(size):
            return b""
        shift = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))].tobytes()[1:]


class Words(dict):
    """word -> its state; words not known yet get -1, -2, ... and wait in `new`."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.new.append(word)
        value = self[word] = -len(self.new)
        return value


class Lattice:
    """States and edges in growing arrays.  State 0 is the end of a word; the edges of state
    s are first[s-1]..first[s], the likeliest first."""

    EDGES = {"upto": np.float64, "piece": np.uint16, "next": np.int32, "log_q": np.float64, "log_rest": np.float64}

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.clear()

    def clear(self) -> None:
        self.words = Words()
        self.n_edges, self.n_states = 0, 1
        self.first, self.log_z = np.zeros(1 << 14, np.int32), np.zeros(1 << 14)
        for name, kind in self.EDGES.items():
            setattr(self, name, np.empty(1 << 15, kind))

    def _put(self, name: str, at: int, values: np.ndarray) -> None:
        old, end = getattr(self, name), at + len(values)
        if end > len(old):
            grown = np.empty(max(end, len(old) * 3 // 2), old.dtype)
            grown[:at] = old[:at]
            setattr(self, name, grown)
        getattr(self, name)[at:end] = values

    def states_of(self, rows: list[list[bytes]], n: int) -> np.ndarray:
        """The state of every word of the rows, new words added first."""
        places = np.fromiter(map(self.words.__getitem__, itertools.chain.from_iterable(rows)), np.int32, n)
        if self.words.new:
            added = self.add(self.words.new)
            self.words.update(zip(self.words.new, added.tolist()))
            self.words.new = []
            late = places < 0
            places[late] = added[-1 - places[late]]
        return places

    def add(self, words: list[bytes]) -> np.ndarray:
        """States of new words."""
        out = np.empty(len(words), np.int32)
        long = np.array([len(w) > LONG for w in words])
        if not long.all():
            out[~long] = self._add_short([w for w in words if len(w) <= LONG])
        for i in np.flatnonzero(long).tolist():
            out[i] = self._add_long(words[i])
        return out

    def _add_long(self, word: bytes) -> int:
        """The state of a word that has its states for itself, built block by block from its
        end: a block needs of what follows it only the states that a piece can reach."""
        data, n = np.frombuffer(word, np.uint8), len(word)
        state = np.zeros(n + 1, np.int32)
        for begin in range((n - 1) // BLOCK * BLOCK, -1, -BLOCK):
            stop = min(n, begin + BLOCK)
            at = np.arange(begin, stop)
            own, piece, size, weight = self.v.matches(data, at, np.full(len(at), n))
            order = np.argsort(own, kind="stable")
            own, piece, size, weight = own[order], piece[order], size[order], weight[order]
            first = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(at)))]).tolist()
            to, w = (own + size).tolist(), weight.tolist()
            z = [0.0] * len(at) + self.log_z[state[stop:stop + self.v.longest + 1]].tolist()
            for i in range(len(at) - 1, -1, -1):
                a, b = first[i], first[i + 1]
                if b - a == 1:
                    z[i] = w[a] + z[to[a]]
                else:
                    values = [w[e] + z[to[e]] for e in range(a, b)]
                    top = max(values)
                    z[i] = top + math.log(sum([math.exp(x - top) for x in values]))
            state[begin:stop] = self.n_states + np.arange(len(at))
            self._put("log_z", self.n_states, np.array(z[:len(at)]))
            self._put_states(len(at), own, piece, state[begin + own + size], weight)
        return int(state[0])

    def _add_short(self, words: list[bytes]) -> np.ndarray:
        """States of words, for all of them at once from their ends to their beginnings.
        Words with one rest share its states."""
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        size = np.array([len(w) for w in words])
        end = np.cumsum(size + 1) - 1
        state = np.zeros(len(data), np.int32)                 # of the rest that begins there
        order = np.argsort(-size, kind="stable")
        longer = len(words)
        for r in range(1, int(size.max()) + 1):
            longer = int(np.searchsorted(-size[order], -r, side="right"))
            at = end[order[:longer]] - r
            key = state[at + 1].astype(np.int64) * 256 + data[at]
            _, lead, back = np.unique(key, return_index=True, return_inverse=True)
            state[at] = (self.n_states + back).astype(np.int32)
            self._level(data, state, at[lead], end[order[lead]])
        return state[end - size]

    def _level(self, data: np.ndarray, state: np.ndarray, at: np.ndarray, end: np.ndarray) -> None:
        """Edges of the new states whose rests begin at `at`."""
        own, piece, size, weight = self.v.matches(data, at, end)
        self._put_states(len(at), own, piece, state[at[own] + size], weight)

    def _put_states(self, n: int, own: np.ndarray, piece: np.ndarray, to: np.ndarray, weight: np.ndarray) -> None:
        """Appends `n` states with their edges."""
        weight = weight + self.log_z[to]
        order = np.lexsort((-weight, own))
        own, piece, to, weight = own[order], piece[order], to[order], weight[order]
        count = np.bincount(own, minlength=n)
        last = np.cumsum(count)
        begin = last - count
        shifted = np.exp(weight - np.repeat(weight[begin], count))
        total = np.add.reduceat(shifted, begin)
        log_z = weight[begin] + np.log(total)
        log_q = weight - np.repeat(log_z, count)
        q = np.exp(log_q)
        upto = np.cumsum(q)
        upto -= np.repeat(upto[begin] - q[begin], count)
        upto[last - 1] = 1.0                                   # the last edge takes what is left
        with np.errstate(divide="ignore"):
            log_rest = np.log1p(-np.minimum(q, 1.0))
        log_rest[begin[count == 1]] = -np.inf
        for name, values in (("upto", upto), ("piece", piece), ("next", to), ("log_q", log_q), ("log_rest", log_rest)):
            self._put(name, self.n_edges, values)
        self._put("first", self.n_states, self.n_edges + last)
        self._put("log_z", self.n_states, log_z)
        self.n_edges += len(own)
        self.n_states += n

    def pick(self, states: np.ndarray, u: np.ndarray) -> np.ndarray:
        """The edge of each state whose summed chance first exceeds u."""
        edge = self.first[states - 1]
        late = np.flatnonzero(u >= self.upto[edge])
        while len(late):
            edge[late] += 1
            late = late[u[late] >= self.upto[edge[late]]]
        return edge

    def edges_of(self, edge: int) -> range:
        """All edges of the state that `edge` leaves."""
        k = int(np.searchsorted(self.first[: self.n_states], np.int32(edge), side="right"))
        return range(int(self.first[k - 1]), int(self.first[k]))

    def walk(self, states: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Samples every word on from its state: (edges word by word, edges per word)."""
        live = np.flatnonzero(states > 0)
        s, key = states[live], keys[live]
        count = np.zeros(len(states), np.int64)
        taken, taken_late, step = [], [], 0
        while len(live):
            if len(live) <= FEW and step >= LONG:
                taken_late = [(row, self._walk_on(int(i), k + np.uint64(step)))
                              for row, i, k in zip(live.tolist(), s, key)]
                for row, late in taken_late:
                    count[row] += len(late)
                break
            step += 1
            edge = self.pick(s, uniform(key + np.uint64(step)))
            count[live] += 1
            taken.append((live, edge))
            s = self.next[edge]
            on = s > 0
            live, s, key = live[on], s[on], key[on]
        at = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for k, (rows, edge) in enumerate(taken):
            out[at[rows] + k] = edge
        for row, late in taken_late:
            out[at[row] + step:at[row] + step + len(late)] = late
        return out, count

    def _walk_on(self, state: int, key: np.uint64) -> np.ndarray:
        """The edges of one walk from a state to the end of its word."""
        out, first, upto, to = [], self.first, self.upto, self.next
        while state > 0:
            for u in uniform(key + np.arange(1, 4097, dtype=np.uint64)).tolist():
                edge = first[state - 1]
                while u >= upto[edge]:
                    edge += 1
                out.append(edge)
                state = to[edge]
                if state <= 0:
                    break
            key += np.uint64(4096)
        return np.array(out, np.int32)


def uniform(keys: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1, by hashing."""
    return ((mix(keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52


class Path:
    """A segmentation: edges, the word of each, log chance before each edge."""

    def __init__(self, edges, word, value, log_q, root, taken):
        self.edges, self.word, self.value, self.root, self.taken = edges, word, value, root, taken
        self.before = np.concatenate([[0.0], np.cumsum(log_q)])

    def branches(self, lattice: Lattice, key: int) -> np.ndarray:
        """Best perturbed value of the edges not taken, per position from the root on."""
        mass = self.before[self.root:-1] + lattice.log_rest[self.edges[self.root:]]
        if self.taken and len(mass):                 # the root lost further edges before
            used = sum(math.exp(lattice.log_q[e]) for e in {*self.taken, int(self.edges[self.root])})
            many = lattice.edges_of(int(self.edges[self.root]))
            left = len(many) - len({*self.taken, int(self.edges[self.root])})
            mass[0] = self.before[self.root] + math.log(max(1 - used, 1e-300)) if left else -math.inf
        u = uniform(np.uint64(key) + np.arange(1, len(mass) + 1, dtype=np.uint64))
        with np.errstate(divide="ignore", over="ignore"):
            out = mass - np.log(np.exp(np.minimum(mass - self.value, 700)) - np.log(u))
        out[np.isneginf(mass)] = -np.inf
        return np.minimum(out, self.value)


def sample(lattice: Lattice, texts: list[bytes], keys: list[int], k: int) -> list[list[tuple[Path, float]]]:
    """Per text up to `k` (segmentation, log of its inclusion chance), best perturbed value first."""
    words = [lattice.v.words(b" " + t) if t else [] for t in texts]
    size = [len(w) for w in words]
    at = np.concatenate([[0], np.cumsum(size)])
    states = lattice.states_of(words, int(at[-1]))
    key = mix(np.array(keys, np.uint64))

    def word_key(i, salt):
        shift = np.uint64(salt * 0xD1342543DE82EF95 % (1 << 64))
        return mix(key[i:i + 1] + shift + (np.arange(size[i], dtype=np.uint64) << np.uint64(32)))

    found: list = [[] for _ in texts]
    queue: list = [[] for _ in texts]

    def opened(i, path):
        found[i].append(path)
        values = path.branches(lattice, int(mix(key[i:i + 1] + np.uint64(7919 * len(found[i])))[0]))
        order = np.argsort(-values, kind="stable")[: k + 1] if len(values) <= k + 1 else \
            np.argpartition(-values, k)[: k + 1]                  # no more can be among the k + 1 best
        for j in order.tolist():
            if values[j] > -np.inf:
                heapq.heappush(queue[i], (-float(values[j]), len(found[i]) - 1, path.root + j))

    edges, count = lattice.walk(states, np.concatenate([word_key(i, 1) for i in range(len(texts))] or [np.empty(0, np.uint64)]))
    ends = np.concatenate([[0], np.cumsum(count)])
    for i in range(len(texts)):
        own = edges[ends[at[i]]:ends[at[i + 1]]]
        word = np.repeat(np.arange(size[i]), count[at[i]:at[i + 1]])
        value = float(-np.log(-np.log(uniform(key[i:i + 1])))[0])
        opened(i, Path(own, word, value, lattice.log_q[own], 0, ()))
    for r in range(2, k + 1):
        jobs, starts, seeds = [], [], []
        for i in range(len(texts)):
            if not queue[i]:
                continue
            minus, parent, j = heapq.heappop(queue[i])
            path = found[i][parent]
            taken = (*(path.taken if j == path.root else ()), int(path.edges[j]))
            free = [e for e in lattice.edges_of(int(path.edges[j])) if e not in taken]
            q = np.exp(lattice.log_q[free])
            u = float(uniform(key[i:i + 1] + np.uint64(104729 * r))[0])
            edge = free[min(len(free) - 1, int(np.searchsorted(np.cumsum(q) / q.sum(), u, side="right")))]
            w = int(path.word[j])
            follow = states[at[i] + w:at[i + 1]].copy()
            follow[0] = lattice.next[edge]
            jobs.append((i, path, j, taken, edge, w, -minus, len(follow)))
            starts.append(follow)
            seeds.append(word_key(i, r)[w:])
        if not jobs:
            break
        edges, count = lattice.walk(np.concatenate(starts), np.concatenate(seeds))
        ends, first = np.concatenate([[0], np.cumsum(count)]), 0
        for i, path, j, taken, edge, w, value, n in jobs:
            tail, own = edges[ends[first]:ends[first + n]], count[first:first + n]
            first += n
            whole = np.concatenate([path.edges[:j], [edge], tail])
            word = np.concatenate([path.word[:j], [w], w + np.repeat(np.arange(n), own)])
            opened(i, Path(whole, word, value, lattice.log_q[whole], j, taken))
    out = []
    for i, paths in enumerate(found):
        threshold = -queue[i][0][0] if queue[i] else -math.inf
        out.append([(p, log_inclusion(p.before[-1] - threshold)) for p in paths])
    return out


def log_inclusion(x: float) -> float:
    """log(1 - exp(-exp(x))), for long texts far below what a chance can be written as."""
    return x if x < -30 else math.log(-math.expm1(-math.exp(min(x, 700.0))))


_kept: dict = {}


def vocabulary_of(path: str, alpha: float) -> Vocabulary:
    """This worker's vocabulary; it outlives a task, lattices do not."""
    if (path, alpha) not in _kept:
        _kept[path, alpha] = Vocabulary(path, alpha)
    return _kept[path, alpha]


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           samples: int = SAMPLES, alpha: float = ALPHA, seed: int = 0) -> DataFrame:
    """Up to `samples` distinct segmentations of every whole text (ENCODED).

    `ids` are little-endian 16-bit piece ids, `exact` says that they decode to the text.
    A null or empty text has one segmentation, without pieces; a text has fewer rows than
    `samples` if it has fewer segmentations.  Characters outside the vocabulary, the
    model's own space sign among them, are spelt in byte pieces.  The row key is the id
    (null: none), so rows that repeat an id and text repeat their samples.  `model` is the
    path of a model file that every executor can read.
    """
    model = model or public_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary_of(model, alpha))
        for batch in batches:
            ids, texts, at = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
            while at < len(ids):
                raw, size = [], 0
                while at + len(raw) < len(ids) and (not raw or size < SLICE_BYTES):
                    raw.append(texts[at + len(raw)].encode())
                    size += len(raw[-1])
                own = ids[at:at + len(raw)]
                at += len(raw)
                if lattice.n_states > STATES:
                    lattice.clear()
                keys = [xxhash.xxh3_64_intdigest(f"{seed}:{i}") for i in own]
                rows = []
                for i, text, found in zip(own, raw, sample(lattice, raw, keys, samples)):
                    for rank, (path, inclusion) in enumerate(found, 1):
                        pieces = lattice.piece[path.edges]
                        rows.append((i, rank, len(pieces), float(path.before[-1]), path.value, inclusion,
                                     pieces.astype("<u2").tobytes(), lattice.v.decode(pieces) == text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = [c.split()[0] for c in ENCODED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.bool_()]
    return documents(docs, id_col, text_col).mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """(doc_id, rank, text) of rows with ids."""
    model = model or public_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = vocabulary_of(model, ALPHA)
        for batch in batches:
            text = [vocabulary.decode(np.frombuffer(x, "<u2")).decode() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string())],
                                             ["doc_id", "rank", "text"])
    return encoded.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, text string")


def summary(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "rank", "n_pieces", "log_prob", "perturbed", "log_inclusion",
                          F.sha2("ids", 256).alias("ids_sha256"), "exact")
