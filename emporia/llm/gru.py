"""A gated recurrent language model with a class-factored softmax, in numpy.

Token ids run from 0 by falling count; class k holds ids SIZE * k .. SIZE * k + SIZE - 1,
and p(token) = p(class | state) * p(token | class, state).  Texts run in lanes, a
window of steps at a time; a lane's state goes on into its text's next window, and a
lane whose text has ended takes the next one.  Training cuts gradients at the
windows' borders.
"""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np

CLASSES, SIZE, HIDDEN, WINDOW = 32, 32, 16, 32
TOKENS = CLASSES * SIZE
END = TOKENS - 1  # the end of a text, and what stands before its first token
NAMES = ["input", "state", "bias", "cls", "cls_bias", "word", "word_bias"]


class Window(NamedTuple):
    """Steps by lanes.  Targets beyond a text's end are -1; ``text`` is each lane's
    text, ``kept`` the lane of the last window that a lane goes on from, or -1."""

    inputs: np.ndarray
    targets: np.ndarray
    text: np.ndarray
    kept: np.ndarray


def windows(texts: list[np.ndarray], lanes: int) -> Iterator[Window]:
    """Longer texts start first, so that lanes end at about the same time."""
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate([*texts, np.empty(0, np.int64)]).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.empty(0, np.int64)
    queue = np.argsort(-sizes, kind="stable")
    queue = queue[sizes[queue] > 0]
    text, at, kept, taken = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 0
    step = np.arange(WINDOW)[:, None]
    while True:
        more = queue[taken : taken + lanes - len(text)]
        taken += len(more)
        text, at, kept = np.append(text, more), np.append(at, np.zeros(len(more), np.int64)), np.append(kept, np.full(len(more), -1))
        if not len(text):
            return
        place = at + step
        inside = place < sizes[text]
        targets = np.where(inside, flat[np.minimum(begin[text] + place, len(flat) - 1)], -1)
        inputs = np.where(place == 0, END, flat[np.clip(begin[text] + place - 1, 0, len(flat) - 1)])
        yield Window(inputs, targets, text, kept)
        on = np.flatnonzero(at + WINDOW < sizes[text])
        text, at, kept = text[on], at[on] + WINDOW, on


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def log_softmax(x: np.ndarray) -> np.ndarray:
    # Rows need no shift where no exponential can over- or underflow.
    if x.size and max(float(x.max()), -float(x.min())) > 50:
        x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x) @ np.ones((x.shape[-1], 1), x.dtype))


def by_class(cls: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The sorting of tokens by class, and where each class begins and the last ends."""
    by = np.argsort(cls.astype(np.int8), kind="stable")
    return by, np.searchsorted(cls[by], np.arange(CLASSES + 1)).tolist()


class GRU:
    def __init__(self, counts: np.ndarray, seed: int = 5):
        """``counts`` of the token ids set the biases, so that the untrained model gives
        about their shares."""
        rng = np.random.default_rng(seed)
        share = (counts + 0.5) / (counts + 0.5).sum()
        per = share.reshape(CLASSES, SIZE)
        self.p = {
            "input": rng.normal(0, 0.3, (TOKENS, 3 * HIDDEN)),
            "state": rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN)),
            "bias": np.zeros(3 * HIDDEN),
            "cls": rng.normal(0, 0.1, (HIDDEN, CLASSES)),
            "cls_bias": np.log(per.sum(axis=1)),
            "word": rng.normal(0, 0.1, (CLASSES, HIDDEN, SIZE)),
            "word_bias": np.log(per / per.sum(axis=1, keepdims=True)),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def run(self, w: Window, h: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """States after each step from ``h``, and what the backward pass needs: the states
        before, the gates, the new values and what the reset gate scales."""
        p, (steps, lanes) = self.p, w.inputs.shape
        x = p["input"][w.inputs]
        states, gates = np.empty((steps + 1, lanes, HIDDEN), np.float32), np.empty((steps, lanes, 2 * HIDDEN), np.float32)
        new, held = np.empty((steps, lanes, HIDDEN), np.float32), np.empty((steps, lanes, HIDDEN), np.float32)
        states[0] = h
        for t in range(steps):
            g = states[t] @ p["state"] + p["bias"]
            gates[t] = sigmoid(x[t, :, : 2 * HIDDEN] + g[:, : 2 * HIDDEN])
            held[t] = g[:, 2 * HIDDEN :]
            z, r = gates[t, :, :HIDDEN], gates[t, :, HIDDEN:]
            new[t] = np.tanh(x[t, :, 2 * HIDDEN :] + r * held[t])
            states[t + 1] = new[t] + z * (states[t] - new[t])
        return states[1:], (states[:-1], gates, new, held)

    def next_state(self, w: Window, last: np.ndarray | None) -> np.ndarray:
        h = np.zeros((len(w.kept), HIDDEN), np.float32)
        on = w.kept >= 0
        if last is not None:
            h[on] = last[w.kept[on]]
        return h

    def log_probs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log probabilities of ``targets`` (flat) after ``states`` (rows)."""
        cls = targets // SIZE
        out = log_softmax(states @ self.p["cls"] + self.p["cls_bias"])[np.arange(len(targets)), cls]
        by, cut = by_class(cls)
        inner = log_softmax(self.word_scores(states[by], cls[by], cut))
        out[by] += inner[np.arange(len(by)), targets[by] % SIZE]
        return out

    def word_scores(self, states: np.ndarray, cls: np.ndarray, cut: list[int]) -> np.ndarray:
        """Scores of the words of each row's class; rows are sorted by class."""
        out = self.p["word_bias"][cls]
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if b > a:
                out[a:b] += states[a:b] @ self.p["word"][k]
        return out

    def score(self, texts: list[np.ndarray], lanes: int = 512) -> np.ndarray:
        """Natural log probability of every text of token ids, all of it."""
        total, last = np.zeros(len(texts)), None
        for w in windows(texts, lanes):
            states, _ = self.run(w, self.next_state(w, last))
            last = states[-1]
            inside = w.targets >= 0
            owner = np.broadcast_to(w.text, w.targets.shape)[inside]
            total += np.bincount(owner, self.log_probs(states[inside], w.targets[inside]), len(texts))
        return total

    def gradient(self, w: Window, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        p, (states, (before, gates, new, held)) = self.p, self.run(w, h)
        inside = w.targets >= 0
        y = w.targets[inside]
        # Sorted by class, a class is a slice.
        by, cut = by_class(y // SIZE)
        s, y = states[inside][by], y[by]
        cls, row, scale = y // SIZE, np.arange(len(y)), np.float32(1 / max(1, len(y)))
        d = np.exp(log_softmax(s @ p["cls"] + p["cls_bias"])) * scale
        d[row, cls] -= scale
        e = np.exp(log_softmax(self.word_scores(s, cls, cut))) * scale
        e[row, y % SIZE] -= scale
        g = {"cls": s.T @ d, "cls_bias": d.sum(axis=0), "word": np.zeros_like(p["word"]), "word_bias": np.zeros_like(p["word_bias"])}
        ds = d @ p["cls"].T
        for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
            if b > a:
                g["word"][k], g["word_bias"][k] = s[a:b].T @ e[a:b], np.ones(b - a, e.dtype) @ e[a:b]
                ds[a:b] += e[a:b] @ p["word"][k].T
        dstates = np.zeros_like(states)
        dstates[tuple(x[by] for x in np.nonzero(inside))] = ds
        steps, lanes = w.inputs.shape
        dx, dg = np.empty((steps, lanes, 3 * HIDDEN), np.float32), np.empty((steps, lanes, 3 * HIDDEN), np.float32)
        z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
        # What does not depend on the later steps, for all steps at once.
        by_new, by_gate, by_reset = (1 - z) * (1 - new * new), (before - new) * z * (1 - z), held * r * (1 - r)
        dh, state = np.zeros_like(h), np.ascontiguousarray(p["state"].T)
        for t in range(steps - 1, -1, -1):
            dh += dstates[t]
            da = dh * by_new[t]
            dx[t, :, :HIDDEN] = dh * by_gate[t]
            dx[t, :, HIDDEN : 2 * HIDDEN] = da * by_reset[t]
            dx[t, :, 2 * HIDDEN :] = da
            dg[t, :, : 2 * HIDDEN] = dx[t, :, : 2 * HIDDEN]
            dg[t, :, 2 * HIDDEN :] = da * r[t]
            dh = dh * z[t] + dg[t] @ state
        flat = dg.reshape(-1, 3 * HIDDEN)
        g["state"], g["bias"] = before.reshape(-1, HIDDEN).T @ flat, np.ones(len(flat), flat.dtype) @ flat
        inputs = w.inputs.ravel()
        order = np.argsort(inputs, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(inputs[order]) != 0))
        g["input"] = np.zeros_like(p["input"])
        g["input"][inputs[order][first]] = np.add.reduceat(dx.reshape(-1, 3 * HIDDEN)[order], first, axis=0)
        return g, states[-1]

    def fit(self, texts: list[np.ndarray], rounds: int = 2, lanes: int = 48, rate: float = 0.01) -> None:
        """Truncated backpropagation through time with Adam; gradients are clipped."""
        m, v, t = *self.moments(), 0
        steps = rounds * max(1, sum(map(len, texts)) // (lanes * WINDOW))
        for _ in range(rounds):
            last = None
            for w in windows(texts, lanes):
                g, last = self.gradient(w, self.next_state(w, last))
                t += 1
                self.descend(g, m, v, t, rate * max(0.05, 1 - t / (steps + 1)))

    def moments(self) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
        return {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}

    def descend(self, g: dict[str, np.ndarray], m: dict[str, np.ndarray], v: dict[str, np.ndarray], t: int, pace: float) -> None:
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        for k in NAMES:
            x = g[k] * np.float32(min(1, 1 / (norm + 1e-9)))
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.99 * v[k] + 0.01 * x * x
            self.p[k] -= (pace * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-6)).astype(np.float32)

    def go_on(self, parts: Iterable[list[np.ndarray]], lanes: int = 128, rate: float = 0.01) -> int:
        """Train once on every text of ``parts``, however many; the number of tokens.  The
        pace falls with the steps taken, and windows of few tokens move the weights less."""
        m, v, t = *self.moments(), 0
        tokens = 0
        for texts in parts:
            last = None
            for w in windows(texts, lanes):
                g, last = self.gradient(w, self.next_state(w, last))
                here, t = int((w.targets >= 0).sum()), t + 1
                tokens += here
                self.descend(g, m, v, t, rate / np.sqrt(1 + t / 20) * min(1, here / (16 * WINDOW)))
        return tokens

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in NAMES]).astype(np.float64)

    def take(self, flat: np.ndarray) -> None:
        cuts = np.cumsum([self.p[k].size for k in NAMES])[:-1]
        for k, x in zip(NAMES, np.split(flat, cuts), strict=True):
            self.p[k] = x.reshape(self.p[k].shape).astype(np.float32)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> GRU:
        model = GRU(np.ones(TOKENS))
        with np.load(io.BytesIO(raw)) as got:
            model.p = {k: got[k] for k in NAMES}
        return model
