"""A small bidirectional GRU with attention pooling, in numpy.

A word's input is a hashed word embedding beside the mean of the embeddings of
its hashed character n-grams, so unseen forms of a word are close to seen
ones. Inputs are projected once for each distinct word of a batch; the
recurrence then runs over all windows of the batch at once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from tillsense.llm.hashing import mix64, span_hashes

WORDS, CHARS = 2**18, 2**16
DIM, HIDDEN = 12, 8
GRAM = 4

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Vocabulary:
    """The distinct words of a batch: their embedding rows, their character
    n-gram rows (CSR), and the word number of each position of the texts."""

    word_rows: np.ndarray
    gram_rows: np.ndarray
    gram_ptr: np.ndarray
    at: np.ndarray
    ptr: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))


def read_words(texts: list[str]) -> Vocabulary:
    """Words (runs of letters, A-Z in lower case) of texts; those of text ``i``
    are ``at[ptr[i]:ptr[i + 1]]``, of a run of equal words only the first. Word 0
    is the padding."""
    data = _LOWER[np.frombuffer(" ".join(["", *texts, ""]).encode("utf-8", "surrogatepass"), dtype=np.uint8)]
    letter = _LETTER[data]
    edge = np.diff(np.concatenate([[False], letter]).astype(np.int8))
    starts, ends = np.nonzero(edge == 1)[0], np.nonzero(edge == -1)[0]
    after = 1 + np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    ptr = np.concatenate([[0], np.searchsorted(starts, after, side="left")]).astype(np.int64)
    hashes = span_hashes(data, starts, ends) if len(starts) else np.zeros(0, dtype=np.uint64)
    distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
    # n-grams of the word with one separator on either side
    lo, hi = starts[first] - 1, np.minimum(ends[first] + 1, len(data))
    count = np.maximum(hi - lo - GRAM + 1, 1)
    gram_ptr = np.concatenate([[0, 1], 1 + np.cumsum(count)]).astype(np.int64)
    begin = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
    shown = np.where(letter, data, 0)
    code = np.zeros(len(begin), dtype=np.uint64)
    for k in range(GRAM):
        code = code * np.uint64(257) + shown[np.minimum(begin + k, len(data) - 1)]
    gram_rows = np.concatenate([[0], 1 + (mix64(code) % np.uint64(CHARS - 1)).astype(np.int64)])
    word_rows = np.concatenate([[0], 1 + (distinct % np.uint64(WORDS - 1)).astype(np.int64)])
    at = at.reshape(-1) + 1
    new = np.ones(len(at), dtype=bool)
    new[1:] = at[1:] != at[:-1]
    new[ptr[:-1][ptr[:-1] < len(at)]] = True
    return Vocabulary(word_rows, gram_rows, gram_ptr, at[new], np.concatenate([[0], np.cumsum(new)])[ptr])


def windows(n: int, width: int, stride: int) -> list[int]:
    """Starts of the windows over n words; the last one ends with the text."""
    if n <= width:
        return [0]
    return [*range(0, n - width, stride), n - width]


def window_grid(vocab: Vocabulary, width: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(grid[window, width] of word numbers, 0: padding; text of each window)."""
    n = np.diff(vocab.ptr)
    starts = [windows(int(k), width, stride) for k in n]
    owner = np.repeat(np.arange(len(n)), [len(s) for s in starts])
    first = np.concatenate([np.asarray(s, dtype=np.int64) for s in starts]) if starts else np.zeros(0, dtype=np.int64)
    cols = first[:, None] + np.arange(width)
    inside = cols < n[owner][:, None]
    if not len(vocab.at):
        return np.zeros_like(cols), owner
    return np.where(inside, vocab.at[np.minimum(cols + vocab.ptr[owner][:, None], len(vocab.at) - 1)], 0), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1.0)


def start_params(seed: int) -> dict[str, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(seed))

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (r.standard_normal(shape) * scale).astype(np.float32)

    # rows that training never meets stay 0 and say nothing
    p = {"word": np.zeros((WORDS, DIM), dtype=np.float32), "char": np.zeros((CHARS, DIM), dtype=np.float32)}
    for d in ("f", "b"):
        p[f"in_{d}"] = normal(2 * DIM, 3 * HIDDEN, scale=0.4)
        p[f"bias_{d}"] = np.zeros(3 * HIDDEN, dtype=np.float32)
        p[f"rec_{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
    return p | {"attend": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.3), "const": np.zeros(1, dtype=np.float32)}


def word_inputs(p: dict, v: Vocabulary, keep_word: np.ndarray | None = None) -> np.ndarray:
    chars = np.add.reduceat(p["char"][v.gram_rows], v.gram_ptr[:-1], axis=0) / np.diff(v.gram_ptr)[:, None].astype(np.float32)
    words = p["word"][v.word_rows]
    return np.concatenate([words if keep_word is None else words * keep_word, chars], axis=1)


def _recur(pre: np.ndarray, u: np.ndarray, grid: np.ndarray, mask: np.ndarray, order: range, keep: bool):
    n, h_dim = len(grid), HIDDEN
    h = np.zeros((n, h_dim), dtype=np.float32)
    states = np.zeros((grid.shape[1], n, h_dim), dtype=np.float32)
    saved = {}
    for t in order:
        g = pre[grid[:, t]]
        rec = h @ u
        gates = _sigmoid(g[:, : 2 * h_dim] + rec[:, : 2 * h_dim])
        z, r = gates[:, :h_dim], gates[:, h_dim:]
        c = np.tanh(g[:, 2 * h_dim :] + r * rec[:, 2 * h_dim :])
        m = mask[:, t, None]
        if keep:
            saved[t] = (h, z, r, c, rec[:, 2 * h_dim :])
        h = h + m * (1 - z) * (c - h)
        states[t] = h
    return states, saved


def forward(p: dict, x: np.ndarray, grid: np.ndarray, keep: bool = False):
    """Logit of each window; with ``keep``, also what :func:`gradients` needs."""
    mask = (grid > 0).astype(np.float32)
    steps = grid.shape[1]
    f, sf = _recur(x @ p["in_f"] + p["bias_f"], p["rec_f"], grid, mask, range(steps), keep)
    b, sb = _recur(x @ p["in_b"] + p["bias_b"], p["rec_b"], grid, mask, range(steps - 1, -1, -1), keep)
    states = np.concatenate([f, b], axis=2)
    e = states @ p["attend"] + np.where(mask.T > 0, 0.0, -30.0).astype(np.float32)
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = np.einsum("tn,tnh->nh", w, states)
    logit = pooled @ p["out"] + p["const"][0]
    return (logit, (mask, sf, sb, states, w, pooled)) if keep else logit


def gradients(p: dict, v: Vocabulary, x: np.ndarray, grid: np.ndarray, kept: tuple, dlogit: np.ndarray, keep_word: np.ndarray) -> dict[str, np.ndarray]:
    """Back-propagation through time of ``sum(dlogit * logit)``."""
    mask, sf, sb, states, w, pooled = kept
    g = {"out": pooled.T @ dlogit, "const": np.array([dlogit.sum()], dtype=np.float32)}
    dpool = dlogit[:, None] * p["out"]
    dw = np.einsum("nh,tnh->tn", dpool, states)
    de = w * (dw - (w * dw).sum(axis=0))
    g["attend"] = np.einsum("tn,tnh->h", de, states)
    dstates = w[:, :, None] * dpool + de[:, :, None] * p["attend"]
    dx = np.zeros_like(x)
    k = HIDDEN
    steps = grid.shape[1]
    for name, saved, part, order in (("f", sf, slice(0, k), range(steps - 1, -1, -1)), ("b", sb, slice(k, 2 * k), range(steps))):
        u = p[f"rec_{name}"]
        du = np.zeros_like(u)
        dpre = np.zeros((len(x), 3 * k), dtype=np.float32)
        dh = np.zeros((len(grid), k), dtype=np.float32)
        for t in order:
            h, z, r, c, rec_c = saved[t]
            dh = dh + dstates[t][:, part]
            live = dh * mask[:, t, None]
            dc = live * (1 - z) * (1 - c * c)
            dz = live * (h - c) * z * (1 - z)
            dr = dc * rec_c * r * (1 - r)
            drec = np.concatenate([dz, dr, dc * r], axis=1)
            du += h.T @ drec
            np.add.at(dpre, grid[:, t], np.concatenate([dz, dr, dc], axis=1))
            dh = dh - live * (1 - z) + drec @ u.T
        g[f"rec_{name}"], g[f"in_{name}"], g[f"bias_{name}"] = du, x.T @ dpre, dpre.sum(axis=0)
        dx += dpre @ p[f"in_{name}"].T
    g["word"] = _by_row(v.word_rows, dx[:, :DIM] * keep_word)
    sizes = np.diff(v.gram_ptr)
    g["char"] = _by_row(v.gram_rows, np.repeat(dx[:, DIM:] / sizes[:, None].astype(np.float32), sizes, axis=0))
    return g


def _by_row(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a table and the sums of their gradients."""
    distinct, at = np.unique(rows, return_inverse=True)
    total = np.zeros((len(distinct), values.shape[1]), dtype=values.dtype)
    np.add.at(total, at.reshape(-1), values)
    return distinct, total


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float) -> None:
        self.p, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(a) for k, a in params.items()}
        self.s = {k: np.zeros_like(a) for k, a in params.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.t += 1
        fix = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, a in self.p.items():
            rows, d = g[k] if isinstance(g[k], tuple) else (slice(None), g[k])  # of tables, the rows met
            m = self.m[k][rows] * 0.9 + 0.1 * d
            s = self.s[k][rows] * 0.999 + 0.001 * d * d
            self.m[k][rows], self.s[k][rows] = m, s
            a[rows] -= (fix * m / (np.sqrt(s) + 1e-8)).astype(a.dtype)


def fit(texts: list[str], labels: np.ndarray, width: int, epochs: int = 8, batch: int = 256, steps: int = 600, rate: float = 0.01, seed: int = 10) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """(parameters, best window logit of each text).

    A text of label 1 need only have one window that shows it: after two epochs
    on all its windows, its positive ones are its best one and those the model
    is sure of, and its others do not train. Of the windows of label 0, an
    epoch takes a quarter at random, and all that the model is unsure of. A
    small sample takes smaller batches and more epochs, to make some ``steps``."""
    r = np.random.Generator(np.random.PCG64(seed))
    v = read_words(texts)
    grid, owner = window_grid(v, width, width)
    p = start_params(seed)
    adam = Adam(p, rate)
    y = labels[owner].astype(np.float32)
    logits = np.zeros(len(grid), dtype=np.float32)
    sizes = np.diff(v.gram_ptr)
    batch = int(np.clip(len(grid) // 40, 32, batch))
    epochs = max(epochs, min(4 * epochs, steps * batch * 2 // max(1, len(grid))))
    for epoch in range(epochs):
        use = np.where(y == 1, True, (r.random(len(y)) < 0.25) | ((epoch > 0) & (logits > -3.0)))
        if epoch >= 2:
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, owner, logits)
            use &= (y == 0) | (logits >= best[owner]) | (logits > 2.0)
        rows = r.permutation(np.nonzero(use)[0])
        balance = (y[rows] == 0).sum() / max(1, (y[rows] == 1).sum())
        adam.rate = rate if epoch < epochs * 5 // 8 else rate / 5
        for lo in range(0, len(rows), batch):
            at = rows[lo : lo + batch]
            words, local = np.unique(np.concatenate([[0], grid[at].reshape(-1)]), return_inverse=True)  # the padding stays word 0
            local = local.reshape(-1)[1:].reshape(len(at), width)
            span = sizes[words]
            grams = v.gram_rows[np.arange(span.sum()) + np.repeat(v.gram_ptr[words] - (np.cumsum(span) - span), span)]
            part = Vocabulary(v.word_rows[words], grams, np.concatenate([[0], np.cumsum(span)]), local)
            keep_word = (r.random((len(words), 1)) > 0.3).astype(np.float32)  # forms unseen in training have characters only
            x = word_inputs(p, part, keep_word)
            logit, kept = forward(p, x, local, keep=True)
            weight = np.where(y[at] == 1, np.clip(balance, 0.5, 4.0), 1.0)
            d = ((_sigmoid(logit) - y[at]) * weight / len(at)).astype(np.float32)
            adam.step(gradients(p, part, x, local, kept, d, keep_word))
        x = word_inputs(p, v)
        logits = np.concatenate([forward(p, x, grid[lo : lo + 2048]) for lo in range(0, len(grid), 2048)])
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, owner, logits)
    return p, best
