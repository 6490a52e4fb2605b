"""Character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np

#: What is kept out of a path.
NEVER = -1e4


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax_loss(scores: np.ndarray, tags: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log likelihood of the tags (length, n) by their own scores alone, and its gradient."""
    shares = np.exp(scores - scores.max(axis=2, keepdims=True))
    shares /= shares.sum(axis=2, keepdims=True)
    picked = np.take_along_axis(shares, tags[:, :, None], axis=2)
    np.put_along_axis(shares, tags[:, :, None], picked - 1, axis=2)
    return -float(np.log(picked + 1e-300).sum()), shares


def bio_transitions(kinds: int) -> np.ndarray:
    """0 where a tag may follow another, else ``NEVER``; tags are outside, then begin and inside of each kind."""
    allowed = np.zeros((2 * kinds + 1, 2 * kinds + 1))
    for k in range(kinds):
        allowed[:, 2 * k + 2] = NEVER
        allowed[[2 * k + 1, 2 * k + 2], 2 * k + 2] = 0
    return allowed


class Tagger:
    """``symbols`` input symbols, ``tags`` output tags; ``mask`` is added to the transitions."""

    def __init__(self, symbols: int, tags: int, hidden: int, mask: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.symbols, self.tags, self.hidden, self.mask = symbols, tags, hidden, mask
        self.p: dict[str, np.ndarray] = {}
        for way in ("f", "b"):
            self.p[f"{way}_in"] = rng.normal(0, 0.3, (symbols, 4 * hidden))
            self.p[f"{way}_rec"] = rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 4 * hidden))
            bias = np.zeros(4 * hidden)
            bias[hidden : 2 * hidden] = 1
            self.p[f"{way}_bias"] = bias
        self.p["out"] = rng.normal(0, 0.3, (2 * hidden, tags))
        self.p["out_bias"] = np.zeros(tags)
        self.p["trans"] = np.zeros((tags, tags))
        self.p["start"] = np.zeros(tags)

    def narrowed(self) -> Tagger:
        """The same model in single precision, for decoding."""
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        return self

    def _run(self, way: str, codes: np.ndarray):
        """Hidden states (length, n, hidden) of one direction over codes (length, n), and what training needs."""
        h = self.hidden
        table = self.p[f"{way}_in"] + self.p[f"{way}_bias"]
        rec = self.p[f"{way}_rec"]
        length, n = codes.shape
        states = np.zeros((length, n, h), rec.dtype)
        state = np.zeros((n, h), rec.dtype)
        cell = np.zeros((n, h), rec.dtype)
        trace = []
        for t in range(length) if way == "f" else range(length - 1, -1, -1):
            z = table[codes[t]] + state @ rec
            gates = _sigmoid(z[:, : 3 * h])
            new = np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            past, before = cell, state
            cell = f * past + i * new
            bent = np.tanh(cell)
            state = o * bent
            states[t] = state
            trace.append((t, i, f, o, new, past, bent, before))
        return states, trace

    def _states(self, way: str, codes: np.ndarray, to: int, whole: np.ndarray | None = None) -> np.ndarray:
        """Hidden states (length, hidden, n) of one direction over codes (length, n); windows lie side by side, so that
        every step is a few operations on whole rows.

        Forward steps end before position ``to``. Backward ones end at it, and go on to the beginning only in the ``whole``
        windows (all, if not given). States of positions not reached are zero.
        """
        h = self.hidden
        dtype = self.p["out"].dtype
        # A gate is half of a tanh of half its input, plus a half.
        scale = np.concatenate([np.full(3 * h, 0.5), np.ones(h)]).astype(dtype)
        table = np.ascontiguousarray(((self.p[f"{way}_in"] + self.p[f"{way}_bias"]) * scale).T)
        rec = np.ascontiguousarray((self.p[f"{way}_rec"] * scale).T)
        length, n = codes.shape
        states = np.empty((to if way == "f" else length, h, n), dtype)
        state, cell = np.zeros((h, n), dtype), np.zeros((h, n), dtype)
        z, given, bent = np.empty((4 * h, n), dtype), np.empty((4 * h, n), dtype), np.empty((h, n), dtype)
        gates, new = z[: 3 * h], z[3 * h :]
        for t in range(to) if way == "f" else range(length - 1, -1 if whole is None else to - 1, -1):
            np.take(table, codes[t], axis=1, out=given, mode="clip")
            np.matmul(rec, state, out=z)
            z += given
            np.tanh(z, out=z)
            gates += 1
            gates *= 0.5
            cell *= z[h : 2 * h]
            new *= z[:h]
            cell += new
            np.tanh(cell, out=bent)
            state = np.multiply(z[2 * h : 3 * h], bent, out=states[t])
        if way == "b" and whole is not None:
            states[:to] = 0
            state, cell = state[:, whole], cell[:, whole]
            for t in range(to - 1, -1, -1):
                z = np.tanh(rec @ state + table[:, codes[t, whole]])
                cell = cell * ((z[h : 2 * h] + 1) * 0.5) + z[3 * h :] * ((z[:h] + 1) * 0.5)
                state = (z[2 * h : 3 * h] + 1) * 0.5 * np.tanh(cell)
                states[t][:, whole] = state
        return states

    def scores(self, codes: np.ndarray, rows: int, first: int = 0, whole: np.ndarray | None = None) -> np.ndarray:
        """Scores (rows, tags, n) of the first positions of windows of codes (length, n).

        With ``whole``, indices of windows, those of the positions before ``first`` are only true for these windows.
        """
        h = self.hidden
        codes = np.ascontiguousarray(codes, np.intp)
        out = np.matmul(np.ascontiguousarray(self.p["out"][:h].T), self._states("f", codes, rows))
        out += np.matmul(np.ascontiguousarray(self.p["out"][h:].T), self._states("b", codes, first, whole)[:rows])
        out += self.p["out_bias"][:, None]
        return out

    def emissions(self, codes: np.ndarray) -> np.ndarray:
        """Scores (n, length, tags) of windows of codes (n, length)."""
        return self.scores(codes.T, codes.shape[1]).transpose(2, 0, 1)

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean loss per window and its gradients. ``codes``, ``tags``: (n, length).

        The loss is the negative log likelihood of the path, and of every tag by its own scores. Without the second part the scores
        of inside tags would mean nothing outside, where a path cannot reach them.
        """
        codes, tags = np.ascontiguousarray(codes.T), np.ascontiguousarray(tags.T)
        length, n = codes.shape
        forward, f_trace = self._run("f", codes)
        backward, b_trace = self._run("b", codes)
        both = np.concatenate([forward, backward], axis=2)
        scores = both @ self.p["out"] + self.p["out_bias"]
        loss, d_scores, d_trans, d_start = self._crf(scores, tags)
        alone, d_alone = _softmax_loss(scores, tags)
        loss, d_scores = loss + alone, d_scores + d_alone
        g = {"trans": d_trans / n, "start": d_start / n}
        d_scores /= n
        g["out"] = np.einsum("lnh,lnt->ht", both, d_scores)
        g["out_bias"] = d_scores.sum(axis=(0, 1))
        d_both = d_scores @ self.p["out"].T
        h = self.hidden
        for way, trace, d_states in (("f", f_trace, d_both[:, :, :h]), ("b", b_trace, d_both[:, :, h:])):
            rec = self.p[f"{way}_rec"]
            g_in, g_rec, g_bias = np.zeros_like(self.p[f"{way}_in"]), np.zeros_like(rec), np.zeros(4 * h)
            d_state, d_cell = np.zeros((n, h)), np.zeros((n, h))
            for t, i, f, o, new, past, bent, before in reversed(trace):
                d = d_states[t] + d_state
                d_cell = d_cell + d * o * (1 - bent * bent)
                z = np.concatenate(
                    [d_cell * new * i * (1 - i), d_cell * past * f * (1 - f), d * bent * o * (1 - o), d_cell * i * (1 - new * new)], axis=1
                )
                g_rec += before.T @ z
                g_bias += z.sum(axis=0)
                g_in += np.eye(self.symbols)[codes[t]].T @ z
                d_state = z @ rec.T
                d_cell = d_cell * f
            g[f"{way}_in"], g[f"{way}_rec"], g[f"{way}_bias"] = g_in, g_rec, g_bias
        return loss / n, g

    def _crf(self, scores: np.ndarray, tags: np.ndarray):
        """Negative log likelihood of the tags (length, n), and its gradients by score, transition and start."""
        length, n, k = scores.shape
        trans = self.p["trans"] + self.mask
        moves = np.exp(trans)
        rows = np.arange(n)
        ahead = np.zeros_like(scores)
        ahead[0] = scores[0] + self.p["start"]
        for t in range(1, length):
            top = ahead[t - 1].max(axis=1, keepdims=True)
            ahead[t] = scores[t] + top + np.log(np.exp(ahead[t - 1] - top) @ moves + 1e-300)
        behind = np.zeros_like(scores)
        for t in range(length - 2, -1, -1):
            future = behind[t + 1] + scores[t + 1]
            top = future.max(axis=1, keepdims=True)
            behind[t] = top + np.log(np.exp(future - top) @ moves.T + 1e-300)
        top = ahead[-1].max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(ahead[-1] - top).sum(axis=1))
        grad = np.exp(ahead + behind - total[None, :, None])
        d_start = grad[0].sum(axis=0)
        d_trans = np.zeros_like(trans)
        gold = scores[0][rows, tags[0]] + self.p["start"][tags[0]]
        for t in range(1, length):
            left = ahead[t - 1]
            right = scores[t] + behind[t]
            a, b = left.max(axis=1, keepdims=True), right.max(axis=1, keepdims=True)
            weight = np.exp(a + b - total[:, None])
            d_trans += moves * ((np.exp(left - a) * weight).T @ np.exp(right - b))
            np.subtract.at(d_trans, (tags[t - 1], tags[t]), 1)
            gold = gold + scores[t][rows, tags[t]] + trans[tags[t - 1], tags[t]]
        np.subtract.at(d_start, tags[0], 1)
        for t in range(length):
            grad[t][rows, tags[t]] -= 1
        return float((total - gold).sum()), grad, d_trans, d_start

    def train(self, codes: np.ndarray, tags: np.ndarray, rounds: int, batch: int, rate: float, seed: int) -> Tagger:
        """Adam over shuffled batches; the rate falls to nothing by the end."""
        steps = rounds * -(-len(codes) // batch)
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), batch):
                own = order[at : at + batch]
                _, g = self.gradients(codes[own], tags[own])
                size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v * min(1.0, 5.0 / (size + 1e-12))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] -= rate * (1 - (step - 1) / steps) * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def best_path(self, scores: np.ndarray) -> np.ndarray:
        """The tags (n, length) of the best path through scores (n, length, tags)."""
        n, length, k = scores.shape
        trans = (self.p["trans"] + self.mask).astype(scores.dtype)
        best = scores[:, 0] + self.p["start"].astype(scores.dtype)
        came = np.zeros((length, n, k), np.int8)
        for t in range(1, length):
            each = best[:, :, None] + trans
            came[t] = each.argmax(axis=1)
            best = each.max(axis=1) + scores[:, t]
        path = np.zeros((n, length), np.int8)
        path[:, -1] = best.argmax(axis=1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = came[t][rows, path[:, t]]
        return path
