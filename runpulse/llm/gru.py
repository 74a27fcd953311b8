"""A gated recurrent word model in numpy: class-factored softmax, truncated backpropagation, carried state.

Frequent words have ids of their own and share classes of neighbouring frequency. Every other word belongs to one of
several rest classes by its first two bytes; within a rest class the caller spreads the probability by corpus
counts. A text starts from a zero state and the end token as its input.
"""

from __future__ import annotations

import numpy as np

#: Words per class; units; width of the inputs; steps of a window.
PER_CLASS, UNITS, WIDTH, WINDOW = 32, 24, 16, 32
#: Rows whose probabilities are worked out at once.
ROWS = 1 << 14


def _ordered(values: np.ndarray, limit: int) -> np.ndarray:
    """A stable order of whole numbers below `limit`; numbers of two bytes are put in order without comparisons."""
    return np.argsort(values.astype(np.uint16) if limit <= 1 << 16 else values, kind="stable")


class Gru:
    """Parameters for `words` frequent words (a multiple of PER_CLASS, id 0 is the end) and `rest` rest classes."""

    def __init__(self, words: int, rest: int, seed: int = 1, parameters: dict | None = None):
        self.words, self.rest, self.classes = words, rest, words // PER_CLASS
        if parameters:
            self.p = parameters
            return
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
        zero = lambda *shape: np.zeros(shape, dtype=np.float32)
        self.p = {
            "emb": draw(words + rest, WIDTH), "wx": draw(WIDTH, 3 * UNITS), "b": zero(3 * UNITS),
            "wh": draw(UNITS, 3 * UNITS), "wc": draw(UNITS, self.classes + rest) * np.float32(0.1), "bc": zero(self.classes + rest),
            "wo": draw(self.classes, UNITS, PER_CLASS) * np.float32(0.1), "bo": zero(self.classes, PER_CLASS),
        }

    def start_from(self, counts: np.ndarray) -> None:
        """Set the output biases to the log frequencies of words and rest classes."""
        logs = np.log(np.maximum(counts, 0.5)).astype(np.float32)
        per_word = logs[: self.words].reshape(self.classes, PER_CLASS)
        self.p["bo"][:] = per_word - per_word.mean(axis=1, keepdims=True)
        whole = np.concatenate([np.exp(per_word).sum(axis=1), np.exp(logs[self.words :])])
        self.p["bc"][:] = np.log(whole / whole.sum())

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // PER_CLASS, ids - self.words + self.classes)

    def forward(self, inputs: np.ndarray, state: np.ndarray, table: np.ndarray, keep: bool = False, fresh: np.ndarray | None = None):
        """States after each step of a window (steps, texts, UNITS); with `keep` what backpropagation needs.

        Where `fresh` (steps, texts) holds, a text begins: the state before is zero.
        """
        wh, u = self.p["wh"], UNITS
        shape = inputs.shape
        out = np.empty((*shape, u), dtype=np.float32)
        kept = [np.empty((*shape, k * u), dtype=np.float32) for k in (1, 2, 1, 1)] if keep else None
        some = fresh.any(axis=1) if fresh is not None else np.zeros(len(inputs), dtype=bool)
        hidden, x = np.empty((shape[1], 3 * u), dtype=np.float32), np.empty((shape[1], 3 * u), dtype=np.float32)
        gates, n = np.empty((shape[1], 2 * u), dtype=np.float32), np.empty((shape[1], u), dtype=np.float32)
        for t, ids in enumerate(inputs):
            if some[t]:
                state = state * ~fresh[t][:, None]
            if keep:
                gates, n = kept[1][t], kept[2][t]
            np.take(table, ids, axis=0, out=x, mode="clip")
            np.matmul(state, wh, out=hidden)
            np.add(x[:, : 2 * u], hidden[:, : 2 * u], out=gates)
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            np.multiply(gates[:, u:], hidden[:, 2 * u :], out=n)
            n += x[:, 2 * u :]
            np.tanh(n, out=n)
            if keep:
                kept[0][t], kept[3][t] = state, hidden[:, 2 * u :]
            step = out[t]
            np.subtract(state, n, out=step)
            step *= gates[:, :u]
            step += n
            state = step
        return out, kept

    def table(self) -> np.ndarray:
        """What each input adds to the gates."""
        return self.p["emb"] @ self.p["wx"] + self.p["b"]

    def _words_by_class(self, states: np.ndarray, kind: np.ndarray):
        """Rows of words in order of their class, where each class begins, and the logits inside the classes."""
        order = _ordered(kind, self.classes + self.rest)
        bounds = np.searchsorted(kind[order], np.arange(self.classes + 1))
        order = order[: bounds[-1]]
        sorted_states = states.take(order, axis=0)
        inner = self.p["bo"].take(kind[order], axis=0)
        for c in np.flatnonzero(np.diff(bounds)):
            inner[bounds[c] : bounds[c + 1]] += sorted_states[bounds[c] : bounds[c + 1]] @ self.p["wo"][c]
        inner -= inner.max(axis=1, keepdims=True)
        return order, bounds, sorted_states, inner

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probability of each target id (for a rest class: of the class)."""
        logits = states @ self.p["wc"]
        logits += self.p["bc"]
        logits -= logits.max(axis=1, keepdims=True)
        kind = self.class_of(targets)
        out = logits[np.arange(len(targets)), kind] - np.log(np.exp(logits, out=logits).sum(axis=1))
        order, _, _, inner = self._words_by_class(states, kind)
        out[order] += inner[np.arange(len(order)), targets[order] % PER_CLASS] - np.log(np.exp(inner, out=inner).sum(axis=1))
        return out

    def score(self, ids: np.ndarray, counts: np.ndarray, extra: np.ndarray) -> np.ndarray:
        """Per text the sum of log probabilities of all its ids plus `extra[id]`, the state carried from window to window."""
        total = np.zeros(len(counts))
        order = np.argsort(-counts, kind="stable")
        length, begin = counts[order], (np.cumsum(counts) - counts)[order]
        table = self.table()
        state = np.zeros((len(counts), UNITS), dtype=np.float32)
        at = 0
        last = np.zeros(len(counts), dtype=np.int64)
        while len(length) and at < length[0]:
            live = int(np.searchsorted(-length, -at, side="left"))  # texts longer than `at`
            state, last = state[:live], last[:live]
            steps = min(WINDOW, int(length[0]) - at)
            place = begin[:live] + at + np.arange(steps)[:, None]
            real = at + np.arange(steps)[:, None] < length[:live]
            targets = np.where(real, ids[np.minimum(place, len(ids) - 1)], 0)
            states, _ = self.forward(np.concatenate([last[None], targets[:-1]]), state, table)
            flat = real.ravel()
            logs = np.zeros(real.size)
            wanted = targets.ravel()[flat]
            after, known = states.reshape(-1, UNITS)[flat], np.empty(len(wanted))
            for first in range(0, len(wanted), ROWS):
                known[first : first + ROWS] = self.log_probs(after[first : first + ROWS], wanted[first : first + ROWS])
            logs[flat] = known + extra[wanted]
            total[order[:live]] += logs.reshape(real.shape).sum(axis=0)
            state, last = states[-1], targets[-1]
            at += steps
        return total

    def train(self, ids: np.ndarray, rate: float = 0.01, lanes: int = 32, memory: dict | None = None) -> None:
        """One pass of Adam over a stream of texts, each ending with the end token.

        The stream is cut into `lanes` equal stretches that are read side by side, window by window, so every window is full and
        a very long text costs what other texts of its length cost. The state goes on to the next window and is zero where a text
        begins, and at the start of a stretch. `memory` keeps the moments from one call to the next.
        """
        lanes = max(1, min(lanes, len(ids) // WINDOW))
        length = -(-len(ids) // lanes)
        stream = np.zeros(lanes * length + 1, dtype=ids.dtype)
        stream[1 : len(ids) + 1] = ids
        targets, inputs = stream[1:].reshape(lanes, length).T, stream[:-1].reshape(lanes, length).T
        real = (np.arange(lanes * length) < len(ids)).reshape(lanes, length).T
        memory = {} if memory is None else memory
        if not memory:
            memory.update(first={k: np.zeros_like(v) for k, v in self.p.items()}, second={k: np.zeros_like(v) for k, v in self.p.items()}, step=0)
        first, second = memory["first"], memory["second"]
        state = np.zeros((lanes, UNITS), dtype=np.float32)
        for at in range(0, length, WINDOW):
            before, wanted = (x[at : at + WINDOW].astype(np.int64) for x in (inputs, targets))
            grads, state = self._gradients(before, wanted, real[at : at + WINDOW], state, before == 0)
            memory["step"] += 1
            scale = np.float32(rate / (1 - 0.9 ** memory["step"]))
            spread = np.float32(1 / (1 - 0.99 ** memory["step"]))
            for k, g in grads.items():
                change = g - first[k]
                change *= np.float32(0.1)
                first[k] += change
                np.multiply(g, g, out=g)
                g -= second[k]
                g *= np.float32(0.01)
                second[k] += g
                np.multiply(second[k], spread, out=g)
                np.sqrt(g, out=g)
                g += np.float32(1e-6)
                np.multiply(first[k], scale, out=change)
                change /= g
                self.p[k] -= change

    def _gradients(self, inputs, targets, mask, state, fresh=None):
        p, u = self.p, UNITS
        states, (before, gates, n, hn) = self.forward(inputs, state, self.table(), keep=True, fresh=fresh)
        flat = mask.ravel()
        every = flat.all()  # but for the last windows
        h, wanted = states.reshape(-1, u), targets.ravel()
        if not every:
            h, wanted = h[flat], wanted[flat]
        count = np.float32(max(len(wanted), 1))
        g = {}
        kind = self.class_of(wanted)
        d = h @ p["wc"]
        d += p["bc"]
        d -= d.max(axis=1, keepdims=True)
        np.exp(d, out=d)
        d /= d.sum(axis=1, keepdims=True)
        d[np.arange(len(wanted)), kind] -= 1
        d /= count
        g["wc"], g["bc"] = h.T @ d, d.sum(axis=0)
        dh = d @ p["wc"].T
        order, bounds, sorted_h, e = self._words_by_class(h, kind)
        np.exp(e, out=e)
        e /= e.sum(axis=1, keepdims=True)
        e[np.arange(len(order)), wanted[order] % PER_CLASS] -= 1
        e /= count
        back = np.empty_like(sorted_h)
        g["wo"], g["bo"] = np.zeros_like(p["wo"]), np.zeros_like(p["bo"])
        for c in np.flatnonzero(np.diff(bounds)):
            rows = slice(bounds[c], bounds[c + 1])
            g["wo"][c], g["bo"][c] = sorted_h[rows].T @ e[rows], e[rows].sum(axis=0)
            back[rows] = e[rows] @ p["wo"][c].T
        dh[order] += back
        up = dh
        if not every:
            up = np.zeros((mask.size, u), dtype=np.float32)
            up[flat] = dh
        up = up.reshape(*mask.shape, u)
        z, r = gates[..., :u], gates[..., u:]
        rest = 1 - z
        by_n = rest * (1 - n * n)
        factors = np.empty((*mask.shape, 3, u), dtype=np.float32)
        by_z, by_r = factors[:, :, 0], factors[:, :, 1]
        np.multiply(before - n, z, out=by_z)
        by_z *= rest
        np.multiply(by_n, hn, out=by_r)
        by_r *= r
        by_r *= 1 - r
        np.multiply(by_n, r, out=factors[:, :, 2])
        dg = np.empty((*mask.shape, 3, u), dtype=np.float32)
        some = fresh.any(axis=1) if fresh is not None else np.zeros(len(up), dtype=bool)
        carry, wt = np.zeros_like(state), np.ascontiguousarray(p["wh"].T)
        for t in range(len(up) - 1, -1, -1):
            carry += up[t]
            up[t] = carry
            np.multiply(carry[:, None], factors[t], out=dg[t])
            carry *= z[t]
            carry += dg[t].reshape(-1, 3 * u) @ wt
            if some[t]:
                carry *= ~fresh[t][:, None]
        dx = dg.reshape(-1, 3 * u)
        g["wh"] = before.reshape(-1, u).T @ dx
        dx[:, 2 * u :] = (up * by_n).reshape(-1, u)
        ids = inputs.ravel()
        order = _ordered(ids, self.words + self.rest)
        ids = ids[order]
        begin = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sums = np.add.reduceat(dx.take(order, axis=0), begin, axis=0)
        g["wx"], g["b"] = p["emb"][ids[begin]].T @ sums, dx.sum(axis=0)
        g["emb"] = np.zeros_like(p["emb"])
        g["emb"][ids[begin]] = sums @ p["wx"].T
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        if norm > 1:
            for x in g.values():
                x /= np.float32(norm)
        return g, states[-1]
