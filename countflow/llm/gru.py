"""A small gated recurrent language model in numpy, with a class-factored output.

Words fall into classes, and P(word | state) = P(class | state) * P(word | class, state). The most frequent words make up classes of equal size,
each with a softmax of its own. All others fall into open classes, whose words keep their corpus frequencies: there the model gives
the class's probability only. Symbols are the frequent words 0 .. heads - 1 (0 ends a document), then one for each open class.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
CLASS_SIZE = 64
STEPS = 16  # of a window: gradients go back this far, states and their values go on
STREAMS = 512
LANES = 1024  # documents that are scored side by side
BLOCK = 4096  # rows that go through the class softmax at once


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _log_share(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The log probability of each row's entry ``at``, and the rows' sums; ``x`` becomes the entries' exponentials. Logits start at 0 or below; beyond 80
    they'd overflow and are cut."""
    np.minimum(x, 80, out=x)
    logit = x[np.arange(len(x)), at].astype(np.float64)
    np.exp(x, out=x)
    total = x @ np.ones(x.shape[1], x.dtype)
    return logit - np.log(total), total


class Gru:
    def __init__(self, mass: np.ndarray, opened: np.ndarray, seed: int = 1):
        """mass: the frequent words' frequencies, opened: the open classes'. Output biases start from them, so an untrained model is the unigram model."""
        self.heads, self.open = len(mass), len(opened)
        self.classes = -(-self.heads // CLASS_SIZE)
        full = np.zeros(self.classes * CLASS_SIZE)
        full[: self.heads] = mass
        full = full.reshape(self.classes, CLASS_SIZE)
        rng = np.random.default_rng(seed)
        g = 3 * HIDDEN
        with np.errstate(divide="ignore"):
            self.p = {
                "table": rng.normal(0, 0.3, (self.heads + self.open, g)),
                "recur": rng.normal(0, HIDDEN**-0.5, (HIDDEN, g)),
                "class_w": np.zeros((HIDDEN, self.classes + self.open)),
                "class_b": np.maximum(np.log(np.concatenate([full.sum(1), opened]) / (full.sum() + opened.sum())), -30.0),
                "word_w": np.zeros((self.classes, HIDDEN, CLASS_SIZE)),
                "word_b": np.maximum(np.log(full / np.maximum(full.sum(1, keepdims=True), 1e-30)), -30.0),
            }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.p["table"][:, :HIDDEN] += 1  # gates that keep most of the state to begin with
        self.sums: dict[str, np.ndarray] = {}

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()]).astype(np.float64)

    def load(self, flat: np.ndarray) -> Gru:
        at = 0
        for k, v in self.p.items():
            self.p[k] = flat[at : at + v.size].reshape(v.shape).astype(np.float32)
            at += v.size
        return self

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """x: rows of the table; returns the next state and what the backward step needs."""
        u = h @ self.p["recur"]
        gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        un = u[:, 2 * HIDDEN :]
        n = np.tanh(x[:, 2 * HIDDEN :] + r * un)
        return n + z * (h - n), z, r, n, un

    def output(self, hs: np.ndarray, y: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probabilities of symbols ``y`` at states ``hs``; with ``grads``, fills in the output layer's and returns the states'.

        Rows are sorted by class, so that each class's are next to each other, and go through the class softmax in blocks that a core's cache holds.
        """
        p, scale = self.p, np.float32(1 / max(1, len(y)))
        own = np.where(y < self.heads, y // CLASS_SIZE, y - self.heads + self.classes).astype(np.int16)
        order = np.argsort(own, kind="stable")
        hs, own, y = hs[order], own[order], y[order]
        out = np.empty(len(y))
        dh = None
        if grads is not None:
            dh = np.empty_like(hs)
            grads |= {n: np.zeros_like(p[n]) for n in ("class_w", "class_b", "word_w", "word_b")}
        for lo in range(0, len(y), BLOCK):
            s, c = hs[lo : lo + BLOCK], own[lo : lo + BLOCK]
            d = s @ p["class_w"]
            d += p["class_b"]
            out[lo : lo + BLOCK], total = _log_share(d, c)
            if grads is not None:
                d *= (scale / total)[:, None]
                d[np.arange(len(c)), c] -= scale
                grads["class_w"] += s.T @ d
                grads["class_b"] += d.sum(0)
                dh[lo : lo + BLOCK] = d @ p["class_w"].T
        edge = np.searchsorted(own, np.arange(self.classes + 1)).tolist()
        for k in range(self.classes):
            lo, hi = edge[k], edge[k + 1]
            if lo < hi:
                s, word = hs[lo:hi], y[lo:hi] - k * CLASS_SIZE
                d = s @ p["word_w"][k]
                d += p["word_b"][k]
                logp, total = _log_share(d, word)
                out[lo:hi] += logp
                if grads is not None:
                    d *= (scale / total)[:, None]
                    d[np.arange(hi - lo), word] -= scale
                    grads["word_w"][k], grads["word_b"][k] = s.T @ d, d.sum(0)
                    dh[lo:hi] += d @ p["word_w"][k].T
        logp = np.empty_like(out)
        logp[order] = out
        if dh is None:
            return logp, None
        back = np.empty_like(dh)
        back[order] = dh
        return logp, back

    def _update(self, name: str, grad: np.ndarray, rate: float, rows: np.ndarray | None = None) -> None:
        """Adagrad; for some ``rows`` only of a table."""
        if name not in self.sums:
            self.sums[name] = np.full(self.p[name].shape, 1e-6, np.float32)
        s = self.sums[name]
        if rows is None:
            s += grad * grad
            self.p[name] -= rate * grad / np.sqrt(s)
        else:
            s[rows] += grad * grad
            self.p[name][rows] -= rate * grad / np.sqrt(s[rows])

    def train_window(self, x: np.ndarray, y: np.ndarray, fresh: np.ndarray, h: np.ndarray, rate: float) -> np.ndarray:
        """One truncated backpropagation over (steps, streams) inputs ``x`` and targets ``y``; ``fresh`` marks where a document begins.
        Returns the last state, which the next window starts from."""
        p, kept, states = self.p, [], []
        for t in range(len(x)):
            if fresh[t].any():
                h = np.where(fresh[t][:, None], np.float32(0), h)
            nxt, z, r, n, un = self.step(p["table"][x[t]], h)
            kept.append((h, z, r, n, un))
            states.append(nxt)
            h = nxt
        grads: dict = {}
        _, dhs = self.output(np.concatenate(states), y.ravel(), grads)
        dhs = dhs.reshape(len(x), -1, HIDDEN)
        dh = np.zeros_like(h)
        gates, back = np.empty((len(x), h.shape[0], 3 * HIDDEN), h.dtype), np.empty((len(x), h.shape[0], 3 * HIDDEN), h.dtype)
        recur = np.ascontiguousarray(p["recur"].T)
        for t in reversed(range(len(x))):
            prev, z, r, n, un = kept[t]
            dh += dhs[t]
            dn = dh * (1 - z)
            dn *= 1 - n * n
            g, b = gates[t], back[t]
            np.multiply(dh * (prev - n), z * (1 - z), out=g[:, :HIDDEN])
            np.multiply(dn * un, r * (1 - r), out=g[:, HIDDEN : 2 * HIDDEN])
            g[:, 2 * HIDDEN :] = dn
            b[:, : 2 * HIDDEN] = g[:, : 2 * HIDDEN]
            np.multiply(dn, r, out=b[:, 2 * HIDDEN :])
            dh *= z
            dh += b @ recur
            if fresh[t].any():
                dh[fresh[t]] = 0
        d_recur = np.concatenate([k[0] for k in kept]).T @ back.reshape(-1, 3 * HIDDEN)
        ids = x.ravel().astype(np.int16 if len(p["table"]) <= 1 << 15 else np.int32)  # short integers are sorted by their digits
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        rows = ids[first].astype(np.int64)
        d_table = np.add.reduceat(gates.reshape(-1, 3 * HIDDEN)[order], first)
        self._update("table", np.clip(d_table, -1, 1), rate, rows)
        for name, g in (("recur", d_recur), *grads.items()):
            self._update(name, np.clip(g, -1, 1), rate)
        return h

    def train(self, documents: list[np.ndarray], rate: float = 0.08) -> None:
        """One pass over documents of symbols, each ending in 0. Laid end to end they are cut into ``STREAMS`` streams; states go on from
        window to window and start anew with each document."""
        y = np.concatenate(documents)
        x = np.concatenate([[0], y[:-1]])
        fresh = np.zeros(len(y), bool)
        fresh[np.concatenate([[0], np.cumsum([len(d) for d in documents])[:-1]]).astype(int)] = True
        streams = max(1, min(STREAMS, len(y) // (4 * STEPS)))
        length, longer = divmod(len(y), streams)  # so many streams are one symbol longer than the others
        begins = np.arange(streams) * length + np.minimum(np.arange(streams), longer)
        at = begins + np.arange(length)[:, None]
        h = np.zeros((streams, HIDDEN), np.float32)
        for t in range(0, length, STEPS):
            own = at[t : t + STEPS]
            h = self.train_window(x[own], y[own], fresh[own], h, rate)
        if longer:
            own = begins[None, :longer] + length
            self.train_window(x[own], y[own], fresh[own], h[:longer], rate)

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log likelihood of each whole document of symbols, each ending in 0 (open classes: of the class only).

        Documents, longest first, go to the lane with least in it; a window runs over the lanes that aren't done, and each lane's state goes on
        to the next window and starts anew with each document.
        """
        out = np.zeros(len(documents))
        sizes = np.array([len(d) for d in documents])
        lanes: list[list[int]] = [[] for _ in range(min(LANES, len(documents)))]
        heap = [(0, k) for k in range(len(lanes))]
        for i in np.argsort(-sizes, kind="stable").tolist():
            n, k = heapq.heappop(heap)
            lanes[k].append(i)
            heapq.heappush(heap, (n + int(sizes[i]), k))
        lanes.sort(key=lambda own: -sum(int(sizes[i]) for i in own))
        lengths = np.array([sum(int(sizes[i]) for i in own) for own in lanes])
        begins = np.concatenate([[0], np.cumsum(lengths)])
        order = [i for own in lanes for i in own]
        y = np.concatenate([documents[i] for i in order]) if order else np.empty(0, int)
        who = np.repeat(np.array(order, np.int32), sizes[order]) if order else np.empty(0, np.int32)
        x = np.concatenate([np.zeros(1, y.dtype), y[:-1]]) if len(y) else y
        fresh = np.concatenate([[True], who[1:] != who[:-1]]) if len(y) else np.empty(0, bool)
        h = np.zeros((len(lanes), HIDDEN), np.float32)
        table = self.p["table"]
        for t in range(0, int(lengths.max(initial=0)), 2 * STEPS):
            states, at = [], []
            for s in range(t, min(t + 2 * STEPS, int(lengths[0]))):
                n = int(np.searchsorted(-lengths, -s, "left"))  # lanes longer than s
                pos = begins[:n] + s
                h = h[:n]
                if (begun := fresh[pos]).any():
                    h = np.where(begun[:, None], np.float32(0), h)
                h = self.step(table[x[pos]], h)[0]
                states.append(h)
                at.append(pos)
            at = np.concatenate(at)
            logp, _ = self.output(np.concatenate(states), y[at])
            out += np.bincount(who[at], logp, len(documents))
        return out
