"""A bidirectional gated recurrent network with attention pooling, over characters and words, in numpy.

Two levels: a character network turns each distinct word into a vector by attention pooling; a word
network reads windows of those vectors, joined with hashed word embeddings, and pools again into one
logit. A document is a bag of overlapping windows; training uses the noisy-or of its windows, so that
every window of a clean document counts as clean and the windows of a toxic one share the credit.

Sequences are (steps, features, rows). Rows of one length go together, so nothing is padded.
"""

from __future__ import annotations

import zlib

import numpy as np

WINDOW, STRIDE, PIECE, FILL = 32, 24, 20, 4
CHARS, BUCKETS = 256, 8192
D_CHAR, H_CHAR, D_WORD, H_WORD = 12, 10, 6, 8
ROWS = 2048


def pieces(text: str | None) -> list[str]:
    """Lower-cased words of the whole text; a longer word comes in pieces of PIECE characters."""
    words = (text or "").lower().split()
    if max(map(len, words), default=0) <= PIECE:
        return words
    return [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]


def starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows that cover n words; the last one ends at the last word."""
    return np.array([0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW])


def windows(ids: np.ndarray) -> np.ndarray:
    """(windows, length) matrix of word ids; the length is WINDOW, or that of a shorter text."""
    return ids[starts(len(ids))[:, None] + np.arange(min(WINDOW, len(ids)))]


def drawn_windows(text: str, most: int, seed: int) -> list[str]:
    """At most ``most`` windows, drawn without replacement from those of the whole text, words joined by spaces."""
    words = pieces(text)
    at = starts(len(words)) if words else np.array([], int)
    if len(at) > most:
        at = np.sort(np.random.default_rng(seed).choice(at, most, replace=False))
    return [" ".join(words[s:s + WINDOW]) for s in at]


def by_length(words: list[str]):
    """Positions and character classes (length, rows) of the words of about each length; class 0 fills a
    word up to a multiple of FILL."""
    sizes = -(-np.fromiter(map(len, words), np.int64, len(words)) // FILL) * FILL
    order = np.argsort(sizes, kind="stable")
    for same in np.split(order, np.nonzero(np.diff(sizes[order]))[0] + 1):
        for at in range(0, len(same), ROWS):
            some = same[at:at + ROWS]
            points = np.frombuffer("".join([words[i].ljust(sizes[i], "\0") for i in some]).encode("utf-32-le", "replace"), "<u4")
            points = points.reshape(len(some), -1).T.astype(np.int64)
            yield some, np.where(points < 128, points, 128 + points % 127)


def buckets(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.encode("utf-8", "replace")) % BUCKETS for w in words], np.int64)


def _sigmoid(x):
    x = np.negative(x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _tanh(x):
    x = _sigmoid(2 * x)
    x *= 2
    x -= 1
    return x


def _gru(x, u, keep=False):
    """x: (steps, 3H, rows) input parts, u: (3H, H). States of each step, and what the gradient needs."""
    steps, h3, rows = x.shape
    k = h3 // 3
    h, states, kept = np.zeros((k, rows), np.float32), np.empty((steps, k, rows), np.float32), []
    for t in range(steps):
        a = u @ h
        g = a[:2 * k] + x[t, :2 * k]
        g = _sigmoid(g)
        n = g[k:] * a[2 * k:]
        n += x[t, 2 * k:]
        n = _tanh(n)
        if keep:
            kept.append((h, g, n, a[2 * k:]))
        h = np.subtract(h, n, out=states[t])
        h *= g[:k]
        h += n
    return states, kept


def _gru_back(ds, u, kept):
    steps, k, rows = ds.shape
    dx, du, dh = np.empty((steps, 3 * k, rows), np.float32), np.zeros_like(u), np.zeros((k, rows), np.float32)
    for t in range(steps - 1, -1, -1):
        h, g, n, an = kept[t]
        z, r = g[:k], g[k:]
        dh = dh + ds[t]
        dn = dh * (1 - z) * (1 - n * n)
        dx[t, :k] = dh * (h - n) * z * (1 - z)
        dx[t, k:2 * k] = dn * an * r * (1 - r)
        dx[t, 2 * k:] = dn
        da = dx[t].copy()
        da[2 * k:] *= r
        du += da @ h.T
        dh = dh * z + u.T @ da
    return dx, du


def _pool(fw, bw, a):
    """Attention pooling of both directions' states: (2H, rows) and the weights (steps, rows)."""
    k = fw.shape[1]
    e = np.tensordot(fw, a[:k], (1, 0)) + np.tensordot(bw, a[k:], (1, 0))
    w = np.exp(e - e.max(0))
    w /= w.sum(0)
    return np.concatenate([(fw * w[:, None]).sum(0), (bw * w[:, None]).sum(0)]), w


def _encode(x, p, name, keep=False):
    """x: (steps, D, rows). Both directions, attention-pooled to (2H, rows)."""
    fw, kf = _gru(p[name + "Wf"] @ x + p[name + "bf"][:, None], p[name + "Uf"], keep)
    bw, kb = _gru(p[name + "Wb"] @ x[::-1] + p[name + "bb"][:, None], p[name + "Ub"], keep)
    bw = bw[::-1]
    pooled, w = _pool(fw, bw, p[name + "a"])
    return pooled, (x, kf, kb, fw, bw, w)


def _encode_back(dpool, kept, p, name, grad):
    x, kf, kb, fw, bw, w = kept
    k, a = fw.shape[1], p[name + "a"]
    dw = (fw * dpool[:k]).sum(1) + (bw * dpool[k:]).sum(1)
    de = w * (dw - (w * dw).sum(0))
    grad[name + "a"] += np.concatenate([np.tensordot(fw, de, ((0, 2), (0, 1))), np.tensordot(bw, de, ((0, 2), (0, 1)))])
    out = 0
    for s, d, ak, flip, k_ in (("f", dpool[:k], a[:k], 1, kf), ("b", dpool[k:], a[k:], -1, kb)):
        ds = d[None] * w[:, None] + de[:, None] * ak[:, None]
        dx, du = _gru_back(ds[::flip], p[name + "U" + s], k_)
        dx = dx[::flip]
        grad[name + "U" + s] += du
        grad[name + "W" + s] += np.tensordot(dx, x, ((0, 2), (0, 2)))
        grad[name + "b" + s] += dx.sum((0, 2))
        out = out + p[name + "W" + s].T @ dx
    return out


def new_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {"chars": r.normal(0, 0.3, (CHARS, D_CHAR)), "words": np.zeros((BUCKETS, D_WORD))}
    for name, d, h in (("c", D_CHAR, H_CHAR), ("w", 2 * H_CHAR + D_WORD, H_WORD)):
        for s in "fb":
            p[name + "W" + s] = r.normal(0, 1 / np.sqrt(d), (3 * h, d))
            p[name + "U" + s] = r.normal(0, 1 / np.sqrt(h), (3 * h, h))
            p[name + "b" + s] = np.zeros(3 * h)
        p[name + "a"] = r.normal(0, 0.3, 2 * h)
    p["out"], p["bias"], p["scale"] = r.normal(0, 0.3, 2 * H_WORD), np.array([-4.0]), np.array([1.0, 0.0])
    return {k: v.astype(np.float32) for k, v in p.items()}


def word_vectors(words: list[str], p) -> np.ndarray:
    """(D, words): character vector and hashed embedding of each word."""
    out = np.empty((2 * H_CHAR + D_WORD, len(words)), np.float32)
    for some, codes in by_length(words):
        out[:2 * H_CHAR, some] = _encode(p["chars"][codes].transpose(0, 2, 1), p, "c")[0]
    out[2 * H_CHAR:] = p["words"][buckets(words)].T
    return out


class Scorer:
    """Scores texts; keeps the word network's input parts of up to ``cache`` words."""

    def __init__(self, p, cache: int = 250_000, group: int = 120_000):
        self.p, self.cache, self.group, self.ids = p, cache, group, {}
        self.table = np.zeros((cache + group, 6 * H_WORD), np.float32)

    def _number(self, words: list[str]) -> np.ndarray:
        if len(self.ids) >= self.cache:
            self.ids.clear()
        ids, p = self.ids, self.p
        if fresh := [w for w in dict.fromkeys(words) if w not in ids]:
            v, at = word_vectors(fresh, p), len(ids)
            self.table[at:at + len(fresh)] = np.concatenate([p["wW" + s] @ v + p["wb" + s][:, None] for s in "fb"]).T
            ids.update(zip(fresh, range(at, at + len(fresh))))
        return np.fromiter(map(ids.__getitem__, words), np.int32, len(words))

    def _logits(self, index: np.ndarray) -> np.ndarray:
        out, p, k = np.empty(len(index), np.float32), self.p, 3 * H_WORD
        for at in range(0, len(index), ROWS):
            x = np.ascontiguousarray(self.table[index[at:at + ROWS]].transpose(1, 2, 0))
            fw, bw = _gru(x[:, :k], p["wUf"])[0], _gru(x[::-1, k:], p["wUb"])[0][::-1]
            out[at:at + ROWS] = p["out"] @ _pool(fw, bw, p["wa"])[0] + p["bias"][0]
        return out

    def _flush(self, group: list[list[str]]) -> np.ndarray:
        """Highest window logit of each list of words (none is empty, all together at most ``group`` words)."""
        numbers = self._number([w for words in group for w in words])
        ends = np.cumsum([len(words) for words in group])
        best, same = np.empty(len(group), np.float32), {}
        for i, (end, words) in enumerate(zip(ends, group)):
            same.setdefault(min(WINDOW, len(words)), []).append((i, windows(numbers[end - len(words):end])))
        for found in same.values():
            logits = self._logits(np.concatenate([x for _, x in found]))
            first = np.cumsum([0] + [len(x) for _, x in found])[:-1]
            best[[i for i, _ in found]] = np.maximum.reduceat(logits, first)
        return best

    def scores(self, texts):
        """(position, highest window logit) of the parts of each whole text that has words."""
        parts, held = [], 0  # of the texts, none over the size of a group
        for i, t in enumerate(texts):
            words = pieces(t)
            step = max(1, (self.group - WINDOW) // STRIDE) * STRIDE  # of a text's parts, whose windows are the text's
            for at in range(0, max(1, len(words) - WINDOW), step):
                last = at + step >= len(words) - WINDOW
                parts += [(i, words[at:] if last else words[at:at + step - STRIDE + WINDOW])] if words else []
            held += len(words)
            if held >= self.group:
                yield from self._some(parts)
                parts, held = [], 0
        yield from self._some(parts)

    def _some(self, parts):
        at = 0
        while at < len(parts):
            held, end = 0, at
            while end < len(parts) and held + len(parts[end][1]) <= self.group:
                held, end = held + len(parts[end][1]), end + 1
            yield from zip((i for i, _ in parts[at:end]), self._flush([w for _, w in parts[at:end]]))
            at = end

    def highest(self, texts: list) -> np.ndarray:
        """Highest window logit of each whole text, -inf for a text without words."""
        best = np.full(len(texts), -np.inf)
        for i, x in self.scores(texts):
            best[i] = max(best[i], x)
        return best

    def __call__(self, texts: list) -> np.ndarray:
        """Calibrated score of each whole text; a text without words scores 0."""
        best = self.highest(texts)
        a, b = self.p["scale"].astype(np.float64)
        return np.where(np.isinf(best), 0.0, _sigmoid(a * np.where(np.isinf(best), 0, best) + b))


def _gradient(bags: list[list[list[str]]], y: np.ndarray, p):
    """Loss and gradient of a batch of documents, each a list of windows (lists of words)."""
    words = list(dict.fromkeys(w for bag in bags for win in bag for w in win))
    number = {w: i for i, w in enumerate(words)}
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    vec, kept = np.empty((2 * H_CHAR + D_WORD, len(words)), np.float32), []
    for some, codes in by_length(words):
        pooled, back = _encode(p["chars"][codes].transpose(0, 2, 1), p, "c", True)
        vec[:2 * H_CHAR, some] = pooled
        kept.append((some, codes, back))
    hashed = buckets(words)
    vec[2 * H_CHAR:] = p["words"][hashed].T
    flat = [(len(win), i, [number[w] for w in win]) for i, bag in enumerate(bags) for win in bag]
    flat.sort(key=lambda f: f[0])
    sizes, owner = np.array([f[0] for f in flat]), np.array([f[1] for f in flat])
    groups, prob = [], np.empty(len(flat))
    for rows in np.split(np.arange(len(flat)), np.nonzero(np.diff(sizes))[0] + 1):
        index = np.array([flat[i][2] for i in rows]).T
        pooled, back = _encode(vec.T[index].transpose(0, 2, 1), p, "w", True)
        prob[rows] = _sigmoid((p["out"] @ pooled + p["bias"][0]).astype(np.float64))
        groups.append((rows, index, pooled, back))
    none = np.exp(np.bincount(owner, np.log1p(-np.minimum(prob, 1 - 1e-7)), len(bags)))
    some_ = np.clip(1 - none, 1e-6, 1)
    loss = -np.where(y > 0, np.log(some_), np.log(np.maximum(none, 1e-12))).mean()
    d = (np.where(y[owner] > 0, -(none / some_)[owner] * prob, prob) / len(bags)).astype(np.float32)
    dvec = np.zeros(vec.T.shape, np.float32)
    for rows, index, pooled, back in groups:
        grad["out"] += pooled @ d[rows]
        grad["bias"] += d[rows].sum()
        dx = _encode_back(p["out"][:, None] * d[rows], back, p, "w", grad)
        np.add.at(dvec, index, dx.transpose(0, 2, 1))
    np.add.at(grad["words"], hashed, dvec[:, 2 * H_CHAR:])
    for some, codes, back in kept:
        dx = _encode_back(dvec[some, :2 * H_CHAR].T, back, p, "c", grad)
        for c, row in zip(codes, dx):
            np.add.at(grad["chars"], c, row.T)
    return loss, grad


def train(bags: list[list[str]], labels: list[int], epochs: int = 4, batch: int = 12, rate: float = 0.02,
          most: int = 40, least_steps: int = 600, seed: int = 7) -> dict:
    """Parameters fitted with Adam to texts, each a list of windows (see ``drawn_windows``), on at most
    ``most`` windows of a text in each epoch, drawn anew, in at least ``least_steps`` steps; not calibrated.
    """
    r, y, p = np.random.default_rng(seed), np.array(labels, np.int64), new_parameters(seed)
    fit = np.nonzero([len(b) > 0 for b in bags])[0]
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    rounds = -(-len(fit) // batch)
    epochs = max(epochs, -(-least_steps // max(rounds, 1)))
    total = epochs * rounds
    for _ in range(epochs):
        order = r.permutation(fit)
        for at in range(0, len(order), batch):
            some = order[at:at + batch]
            drawn = [bags[i] if len(bags[i]) <= most else [bags[i][k] for k in r.choice(len(bags[i]), most, replace=False)] for i in some]
            _, grad = _gradient([[window.split(" ") for window in bag] for bag in drawn], y[some], p)
            step += 1
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * (1 - 0.9 * step / total) * min(1, step / 20)
            for k, g in grad.items():
                g *= min(1, 5 / max(norm, 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                p[k] -= (now * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return p


def calibration(x, y, prior: float) -> np.ndarray:
    """Slope and offset of a logistic curve over the highest window logits of whole texts, weighted to
    ``prior``, the share of label 1 among all labels."""
    x, y = np.clip(np.asarray(x, np.float64), -20, 20), np.asarray(y, np.int64)
    share = y.mean()
    if 0 < share < 1 and 0 < prior < 1:
        weight = np.where(y > 0, prior / share, (1 - prior) / (1 - share))
    else:
        weight = np.ones(len(y))
    a, b = 1.0, 0.0
    for _ in range(50):
        q = _sigmoid(a * x + b)
        w, g = weight * q * (1 - q), weight * (q - y)
        grad = np.array([(g * x).sum() + 0.1 * (a - 1), g.sum() + 0.1 * b])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        a, b = np.array([a, b]) - np.clip(np.linalg.solve(hess, grad), -1, 1)
    return np.array([max(a, 0.1), b], np.float32)
