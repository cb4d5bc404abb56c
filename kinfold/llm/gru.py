"""A small gated recurrent language model in numpy: class-factored softmax, truncated
backpropagation, state carried from window to window."""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 16, 24
CLASSES, MEMBERS = 36, 36          # of the smallest model, whose words are CLASSES * MEMBERS
STREAMS, WINDOW = 192, 16          # of training: parallel rows and steps of one update
SCORE_ROWS, SCORE_WINDOW = 512, 48
BLOCK = 4096                       # rows whose probabilities are worked out at once
PART = 1 << 14                     # parameters updated at once
LARGEST = 4.0                      # of a weight
END, UNK = 0, 1                    # model words that always exist

f32 = np.float32


def shapes(side: int) -> dict[str, tuple[int, ...]]:
    """Parameters of a model with `side` classes of `side` words."""
    return {"emb": (side * side, EMBED), "wx": (EMBED, 3 * HIDDEN), "u": (HIDDEN, 3 * HIDDEN),
            "b": (3 * HIDDEN,), "wc": (HIDDEN, side), "bc": (side,), "ww": (side, HIDDEN, side), "bw": (side, side)}


def n_parameters(side: int) -> int:
    return sum(int(np.prod(s)) for s in shapes(side).values())


class Model:
    """Parameters in one flat vector, with named views into it.  Its length gives the size."""

    def __init__(self, flat: np.ndarray | None = None, side: int = CLASSES):
        if flat is not None:
            side = int(np.sqrt(len(flat) / (EMBED + HIDDEN + 1)))     # never too small: side counts squared there
            while n_parameters(side) > len(flat):
                side -= 1
        self.side = side
        self.flat = np.zeros(n_parameters(side), f32) if flat is None else np.array(flat, f32)
        assert len(self.flat) == n_parameters(side)
        at = 0
        for name, shape in shapes(side).items():
            n = int(np.prod(shape))
            setattr(self, name, self.flat[at:at + n].reshape(shape))
            at += n
        self._rooms: dict[str, np.ndarray] = {}

    def _room(self, name: str, *shape: int) -> np.ndarray:
        """Room for a passing result, kept for the next call: new memory costs more than the sums."""
        size = int(np.prod(shape))
        kept = self._rooms.get(name)
        if kept is None or kept.size < size:
            kept = self._rooms[name] = np.empty(size, f32)
        return kept[:size].reshape(shape)

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 1) -> Model:
        """Small random weights; output biases that give the words' frequencies.

        Absent words (count below 0) get a bias that rules them out.
        """
        side = int(np.sqrt(len(counts)))
        m, rng = cls(side=side), np.random.default_rng(seed)
        for name, scale in (("emb", 0.3), ("wx", 0.3), ("u", 0.2), ("wc", 0.05), ("ww", 0.05)):
            view = getattr(m, name)
            view[...] = rng.normal(0, scale, view.shape)
        c = np.where(counts < 0, 0, counts + 0.1).reshape(side, side)
        m.bc[...] = np.log(np.maximum(c.sum(1), 1e-12) / c.sum())
        m.bw[...] = np.log(np.maximum(c, 1e-12) / np.maximum(c.sum(1, keepdims=True), 1e-12))
        m.bw[c == 0] = -60
        m.bc[c.sum(1) == 0] = -60
        return m

    def gates(self) -> np.ndarray:
        """One matrix for a step: rows r, z, what r scales, rest of n; columns state, input, bias."""
        H, E = HIDDEN, EMBED
        w = np.zeros((4 * H, H + E + 1), f32)
        w[:3 * H, :H] = self.u.T
        for rows, own in ((slice(0, 2 * H), slice(0, 2 * H)), (slice(3 * H, 4 * H), slice(2 * H, 3 * H))):
            w[rows, H:H + E], w[rows, -1] = self.wx[:, own].T, self.b[own]
        return w

    def _run(self, inputs: np.ndarray, h: np.ndarray, keep: bool) -> tuple[np.ndarray, ...]:
        """(states, what entered each step, gates, new parts), each (steps, features, rows): all
        slices of a step are contiguous.  `h` is (HIDDEN, rows).  Without `keep` only states."""
        H, E, (T, B) = HIDDEN, EMBED, inputs.shape
        w = self.gates()
        w[:2 * H] *= -1                                # exp(-x) without another pass
        n = T if keep else 1
        entered, gate, fresh = self._room("entered", n, H + E + 1, B), self._room("gate", n, 4 * H, B), self._room("fresh", n, H, B)
        states = self._room("states", T, H, B) if keep else np.empty((T, H, B), f32)
        entered[:, -1] = 1
        if keep:
            entered[:, H:H + E] = self.emb[inputs].transpose(0, 2, 1)
        going, part = inputs != END, np.empty((H, B), f32)
        for t in range(T):
            k = t if keep else 0
            x, c, new, out = entered[k], gate[k], fresh[k], states[t]
            if not keep:
                x[H:H + E] = self.emb[inputs[t]].T
            np.multiply(h, going[t], out=x[:H])        # an END input starts afresh
            np.matmul(w, x, out=c)
            rz = c[:2 * H]
            np.exp(rz, out=rz)
            rz += 1
            np.reciprocal(rz, out=rz)
            np.multiply(c[:H], c[2 * H:3 * H], out=part)
            part += c[3 * H:]
            np.tanh(part, out=new)
            np.subtract(x[:H], new, out=out)
            out *= c[H:2 * H]
            out += new
            h = out
        return states, entered, gate, fresh

    def steps(self, inputs: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Hidden states after each input, (steps, rows, HIDDEN).  An END input starts afresh."""
        return self._run(inputs, h.T, False)[0].transpose(0, 2, 1)

    def _by_class(self, kind: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
        """(order of the rows by class, (class, first row, end) of the classes that occur)."""
        order = np.argsort(kind.astype(np.uint16), kind="stable")      # sorted by radix
        ends = np.cumsum(np.bincount(kind, minlength=self.side)).tolist()
        return order, [(c, a, b) for c, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]

    def _member_logits(self, x: np.ndarray, classes) -> np.ndarray:
        """Logits of the words of each row's class; rows in the order of their classes.  They take
        the room of the classes' logits, which are done with by then."""
        out = self._room("logits", len(x), self.side)
        for c, a, b in classes:
            np.matmul(x[a:b], self.ww[c], out=out[a:b])
            out[a:b] += self.bw[c]
        return out

    def _taken(self, name: str, rows: np.ndarray, order: np.ndarray) -> np.ndarray:
        return np.take(rows, order, axis=0, out=self._room(name, len(order), rows.shape[1]), mode="clip")

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target after each state (rows of HIDDEN).

        States lie in -1..1 and LARGEST bounds the weights, so exp needs no shift.
        """
        out, ones = np.empty(len(targets), f32), np.ones(self.side, f32)
        for at in range(0, len(targets), BLOCK):
            flat, goal = states[at:at + BLOCK], targets[at:at + BLOCK]
            kind, rows = goal // self.side, np.arange(len(goal))
            logits = np.matmul(flat, self.wc, out=self._room("logits", len(goal), self.side))
            logits += self.bc
            own = logits[rows, kind] - np.log(np.exp(logits, out=logits) @ ones)
            order, classes = self._by_class(kind)
            inner = self._member_logits(self._taken("ordered", flat, order), classes)
            own[order] += inner[rows, (goal - kind * self.side)[order]] - np.log(np.exp(inner, out=inner) @ ones)
            out[at:at + BLOCK] = own
        return out

    def gradient(self, inputs, targets, h, with_loss: bool = True, g: Model | None = None) -> tuple[Model, np.ndarray, float]:
        """(gradient of the mean loss, state to carry on, summed loss if asked) of one window.
        `g` is an earlier gradient whose room is used again."""
        H, E, (T, B) = HIDDEN, EMBED, inputs.shape
        states, entered, gate, fresh = self._run(inputs, h.T, True)
        if g is None:
            g = Model(side=self.side)
        g.flat[...] = 0
        flat, goal = self._room("flat", T * B, H), targets.ravel()
        flat.reshape(T, B, H)[...] = states.transpose(0, 2, 1)
        kind, n, ones = goal // self.side, T * B, np.ones(self.side, f32)
        rows = np.arange(n)

        def softmax_less_target(logits, target):
            """(gradient of the mean loss by the logits, summed loss), in place."""
            np.exp(logits, out=logits)
            total = logits @ ones
            loss = -np.log(np.maximum(logits[rows, target] / total, 1e-30)).sum() if with_loss else 0.0
            logits *= (1 / (total * n))[:, None]
            logits[rows, target] -= 1 / n
            return logits, loss

        p = np.matmul(flat, self.wc, out=self._room("logits", n, self.side))
        p += self.bc
        p, loss = softmax_less_target(p, kind)
        g.wc[...], g.bc[...] = flat.T @ p, ones_of(n) @ p
        dh = np.matmul(p, self.wc.T, out=self._room("dh", n, H))
        order, classes = self._by_class(kind)
        x, ordered = self._taken("ordered", flat, order), kind[order]
        q, more = softmax_less_target(self._member_logits(x, classes), goal[order] - ordered * self.side)
        loss += more
        dx = self._room("dx", n, H)
        for c, a, b in classes:
            np.matmul(x[a:b].T, q[a:b], out=g.ww[c])
            np.matmul(ones_of(b - a), q[a:b], out=g.bw[c])
            np.matmul(q[a:b], self.ww[c].T, out=dx[a:b])
        dh[order] += dx
        by_state = self._room("by_state", T, H, B)
        by_state[...] = dh.reshape(T, B, H).transpose(0, 2, 1)
        r, z, scaled, before = gate[:, :H], gate[:, H:2 * H], gate[:, 2 * H:3 * H], entered[:, :H]
        by_new, by_z, by_r, less = (self._room(name, T, H, B) for name in ("by_new", "by_z", "by_r", "less"))
        np.subtract(1, z, out=less)
        np.multiply(fresh, fresh, out=by_new)
        np.subtract(1, by_new, out=by_new)
        by_new *= less
        np.subtract(before, fresh, out=by_z)
        by_z *= z
        by_z *= less
        np.subtract(1, r, out=by_r)
        by_r *= r
        by_r *= scaled
        d_gate, d_entered = self._room("d_gate", T, 4 * H, B), self._room("d_entered", T, H + E, B)
        w, going = np.ascontiguousarray(self.gates()[:, :-1].T), inputs != END
        back = np.zeros((H, B), f32)
        for t in range(T - 1, -1, -1):
            d, dg, de = by_state[t], d_gate[t], d_entered[t]
            d += back
            np.multiply(d, by_new[t], out=dg[3 * H:])
            np.multiply(d, by_z[t], out=dg[H:2 * H])
            np.multiply(dg[3 * H:], by_r[t], out=dg[:H])
            np.multiply(dg[3 * H:], r[t], out=dg[2 * H:3 * H])
            np.matmul(w, dg, out=de)
            np.multiply(d, z[t], out=back)
            back += de[:H]
            back *= going[t]
        by_gate = np.matmul(d_gate, entered.transpose(0, 2, 1)).sum(0)
        g.u[...] = by_gate[:3 * H, :H].T
        for rows_, own in ((slice(0, 2 * H), slice(0, 2 * H)), (slice(3 * H, 4 * H), slice(2 * H, 3 * H))):
            g.wx[:, own], g.b[own] = by_gate[rows_, H:H + E].T, by_gate[rows_, -1]
        tokens = inputs.ravel()
        order = np.argsort(tokens.astype(np.uint16) if len(self.emb) <= 1 << 16 else tokens, kind="stable")
        tokens = tokens[order]
        first = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
        by_input = self._room("by_input", T, B, E)
        by_input[...] = d_entered[:, H:].transpose(0, 2, 1)
        by_input = self._taken("sorted", by_input.reshape(n, E), order)
        g.emb[tokens[first]] = np.add.reduceat(by_input, first)
        return g, states[-1].T.copy(), float(loss)


def ones_of(n: int) -> np.ndarray:
    return np.ones(n, f32)


class Trainer:
    """Adam over a stream of token sequences, in windows that carry their state on."""

    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.steps, self.tokens = model, rate, 0, 0
        self.m = np.zeros_like(model.flat)
        self.v = np.zeros_like(model.flat)
        self.step = np.empty(PART, f32)
        self.g = Model(side=model.side)

    def feed(self, sequence: np.ndarray) -> None:
        """Learns from documents one after another, each closed by END."""
        width = min(STREAMS, max(1, len(sequence) // WINDOW))
        length = len(sequence) // width
        if not length:
            return
        before = np.concatenate([[END], sequence[:-1]])
        inputs = before[: width * length].reshape(width, length).T
        targets = sequence[: width * length].reshape(width, length).T
        h = np.zeros((width, HIDDEN), f32)
        for t in range(0, length, WINDOW):
            g, h, _ = self.model.gradient(inputs[t:t + WINDOW], targets[t:t + WINDOW], h, False, self.g)
            self.tokens += targets[t:t + WINDOW].size
            self.update(g.flat)
        rest = sequence[width * length:]
        if len(rest):
            g, _, _ = self.model.gradient(before[width * length:][:, None], rest[:, None],
                                          np.zeros((1, HIDDEN), f32), False, self.g)
            self.tokens += len(rest)
            self.update(g.flat)

    def update(self, g: np.ndarray) -> None:
        norm = float(np.sqrt(g @ g))
        share = 1 / max(1.0, norm)
        self.steps += 1
        fix = np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps)
        for at in range(0, len(g), PART):               # all passes over a part that stays in the cache
            part = slice(at, at + PART)
            grad, m, v = g[part], self.m[part], self.v[part]
            step = np.multiply(grad, 0.1 * share, out=self.step[:len(grad)])
            m *= 0.9
            m += step
            np.multiply(grad, grad, out=step)
            step *= 0.001 * share * share
            v *= 0.999
            v += step
            np.sqrt(v, out=step)
            step += 1e-6
            np.divide(m, step, out=step)
            step *= float(self.rate * fix)
            self.model.flat[part] -= step
        for name in ("emb", "wx", "u", "wc", "ww"):
            view = getattr(self.model, name)
            np.clip(view, -LARGEST, LARGEST, out=view)


def score(model: Model, documents: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each document (model words, END last), whole, window by
    window.  Documents of like length go together; finished ones drop out."""
    out = np.zeros(len(documents))
    sizes = np.array([len(d) for d in documents], np.int64)
    tokens = np.concatenate([*documents, [END]])
    firsts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    for at in range(0, len(order), SCORE_ROWS):
        group = order[at:at + SCORE_ROWS]
        size, first = sizes[group], firsts[group]
        h = np.zeros((len(group), HIDDEN), f32)
        for t in range(0, int(size[0]), SCORE_WINDOW):
            k = int(np.searchsorted(-size, -t, side="left"))       # documents longer than t
            place = np.arange(t, min(t + SCORE_WINDOW, int(size[0])))[:, None]
            valid = place < size[:k]
            spot = np.where(valid, first[:k] + place, len(tokens) - 1)     # END after a document's end
            inputs = np.where(place > 0, tokens[spot - 1], END)
            states = model.steps(inputs, h[:k])
            h = states[-1]
            value = np.zeros(valid.shape)
            value[valid] = model.log_probs(np.ascontiguousarray(states)[valid], tokens[spot[valid]])
            out[group[:k]] += value.sum(0)
    return out
