"""A small causal self-attention language model in numpy over subword classes.

P(id | context) = P(class of id | context) * P(id | its class, class of the id before).

The first factor is one causal attention layer over the last subword ids, trained
by gradient descent.  The second holds counts of all training documents; its table is
classes x vocabulary, whatever the corpus size.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

VOCABULARY = 50257
END = 50256
CLASSES = 96
DIM = 16
HASHED = 8192
#: Context window, and how many of its tokens are there for context only (but in a text's first window).
WINDOW, OVERLAP = 32, 4
STEP = WINDOW - OVERLAP
#: Windows of one gradient step.
BATCH = 16
#: Strength of the class's own distribution in the count table.
ALPHA = 40.0
#: What stands before or after an id is counted in so many places: the most frequent (low) ids have their own, the rest share.
OWN_PLACES, PLACES = 24, 32
#: Bound of every exponent, so that none overflows.
LARGEST = np.float32(60)

_CAUSAL = np.triu(np.full((WINDOW, WINDOW), -1e9, np.float32), 1)
#: Sums over a window's places are products with ones, which take a fifth of the time of ``sum``.
_ONES = np.ones(WINDOW, np.float32)
SHAPES = {"emb": (HASHED, DIM), "pos": (WINDOW, DIM), "qkv": (DIM, 3 * DIM), "o": (DIM, DIM), "out": (DIM, CLASSES), "bias": (CLASSES,)}

_IDS = np.arange(VOCABULARY)
#: Embedding row of every id: frequent (low) ids have their own, the rest share.
ROW = np.where(_IDS < HASHED // 2, _IDS, HASHED // 2 + _IDS * 2654435761 % (HASHED // 2)).astype(np.uint16)
PLACE = np.where(_IDS < OWN_PLACES, _IDS, OWN_PLACES + _IDS % (PLACES - OWN_PLACES)).astype(np.int64)


def fresh(seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {n: (np.zeros(s) if n == "bias" else rng.normal(0, 0.1 if n in ("emb", "pos") else 0.25, s)).astype(np.float32)
            for n, s in SHAPES.items()}


def flat(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[n].ravel() for n in SHAPES])


def unflat(v: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n, s in SHAPES.items():
        size = int(np.prod(s))
        out[n] = np.asarray(v[at : at + size], np.float32).reshape(s)
        at += size
    return out


def _exp(z: np.ndarray) -> np.ndarray:
    """exp in place; exponents beyond the bound, which hardly ever come, are cut to it."""
    if z.size and z.max() > LARGEST:
        np.minimum(z, LARGEST, out=z)
    return np.exp(z, out=z)


def _forward(w, ids):
    """Embedded inputs, queries, keys, values, attention, its output, and the states that predict; rows are windows' places."""
    n = len(ids)
    x = w["emb"].take(ROW.take(ids.ravel()), axis=0)
    x.reshape(n, WINDOW, DIM)[...] += w["pos"]
    qkv = (x @ w["qkv"]).reshape(n, WINDOW, 3 * DIM)
    q, k, v = qkv[..., :DIM], qkv[..., DIM : 2 * DIM], qkv[..., 2 * DIM :]
    a = q @ k.transpose(0, 2, 1)
    a += _CAUSAL
    _exp(a)
    a *= (1 / np.maximum(a @ _ONES, np.float32(1e-30)))[..., None]
    o = (a @ v).reshape(-1, DIM)
    return x, q, k, v, a, o, x + o @ w["o"]


def class_log_probs(w, ids: np.ndarray, scored: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log-probability of the class ``wanted`` at the ``scored`` places of each window."""
    h = _forward(w, ids)[-1][scored.ravel()]
    z = h @ w["out"]
    own = np.minimum(z[np.arange(len(z)), wanted], LARGEST) + w["bias"][wanted]
    return own - np.log(_exp(z) @ np.exp(w["bias"]))


class Trainer:
    """Adagrad over batches of full windows."""

    def __init__(self, w: dict[str, np.ndarray], rate: float = 0.08):
        self.rate, self.seen = np.float32(rate), 0
        # weights that every step changes whole lie in one vector, so that their update is one; the dictionaries hold views of it
        dense = [n for n in SHAPES if n != "emb"]
        self._w = np.concatenate([w[n].ravel() for n in dense]).astype(np.float32)
        self._g, self._grad = np.full_like(self._w, 1e-6), np.empty_like(self._w)
        view = lambda v: dict(zip(dense, (x.reshape(SHAPES[n]) for n, x in zip(dense, np.split(v, np.cumsum([w[n].size for n in dense])[:-1])))))
        self.w = {"emb": w["emb"].astype(np.float32), **view(self._w)}
        self.g = {"emb": np.full(SHAPES["emb"], 1e-6, np.float32), **view(self._g)}
        self.grad = view(self._grad)

    def step(self, ids: np.ndarray, wanted: np.ndarray, valid: np.ndarray) -> None:
        """One step on windows ``ids`` (what stands before) towards classes ``wanted`` at the ``valid`` places."""
        w, n = self.w, len(ids)
        x, q, k, v, a, o, h = _forward(w, ids)
        wanted, valid = wanted.ravel(), valid.ravel()
        # p - onehot of a row is scale * (z * lift - onehot * total): the scale goes to the narrow side of each product
        z = _exp(h @ w["out"])
        lift = np.exp(w["bias"])
        total = z @ lift
        at = np.arange(0, z.size, CLASSES) + wanted
        z.ravel()[at] -= total / lift[wanted]
        scale = (valid / (total * np.float32(max(1, int(valid.sum()))))).astype(np.float32)
        grad = self.grad
        np.multiply((z.T @ (h * scale[:, None])).T, lift, out=grad["out"])
        np.multiply(scale @ z, lift, out=grad["bias"])
        dh = (z @ (w["out"] * lift).T) * scale[:, None]
        np.matmul(o.T, dh, out=grad["o"])
        do = (dh @ w["o"].T).reshape(n, WINDOW, DIM)
        ds = do @ v.transpose(0, 2, 1)
        ds *= a
        ds -= a * (ds @ _ONES)[..., None]
        d = np.empty((n, WINDOW, 3 * DIM), np.float32)
        np.matmul(ds, k, out=d[..., :DIM])
        np.matmul(ds.transpose(0, 2, 1), q, out=d[..., DIM : 2 * DIM])
        np.matmul(a.transpose(0, 2, 1), do, out=d[..., 2 * DIM :])
        d = d.reshape(-1, 3 * DIM)
        dx = dh + d @ w["qkv"].T
        grad["qkv"][...] = (d.T @ x).T
        np.sum(dx.reshape(n, WINDOW, DIM), axis=0, out=grad["pos"])
        g = self._grad
        self._g += g * g
        self._w -= self.rate * g / np.sqrt(self._g)
        # each embedding row's gradient: the sum over its places
        row = ROW.take(ids.ravel())
        order = np.argsort(row, kind="stable")
        row = row[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        g = np.add.reduceat(dx.take(order, axis=0), first, axis=0)
        row = row[first]
        held = self.g["emb"].take(row, axis=0) + g * g
        self.g["emb"][row] = held
        w["emb"][row] -= self.rate * g / np.sqrt(held)
        self.seen += n


def neighbours(before: np.ndarray, after: np.ndarray, table: np.ndarray) -> None:
    """Adds to ``table`` (id, place) what stands before each id (first half of the places) and after it."""
    one = table.dtype.type(1)
    np.add.at(table.ravel(), after * (2 * PLACES) + PLACE.take(before), one)
    np.add.at(table.ravel(), before * (2 * PLACES) + PLACES + PLACE.take(after), one)


def cluster(table: np.ndarray, classes: int = CLASSES, seed: int = 5) -> np.ndarray:
    """Class of every vocabulary id from the table of its neighbours.

    k-means over the distributions of what stands before and after an id; ids that never occurred
    share class 0; the end id has a class of its own.
    """
    count = table.sum(axis=1, dtype=np.float64).astype(np.float32)
    known = np.flatnonzero(count > 0)
    out = np.zeros(VOCABULARY, np.int64)
    out[END] = classes - 1
    if not len(known):
        return out
    m = np.sqrt(table[known] / count[known, None])
    rng = np.random.default_rng(seed)
    order = np.argsort(-count[known], kind="stable")
    centre = m[order[: classes - 2]]
    if len(centre) < classes - 2:
        centre = np.vstack([centre, rng.random((classes - 2 - len(centre), m.shape[1]), np.float32)])
    weight = np.sqrt(count[known])
    for _ in range(12):
        near = (m @ centre.T - 0.5 * (centre**2).sum(axis=1)).argmax(axis=1)
        total = np.bincount(near, weight, minlength=classes - 2)
        for c in range(m.shape[1]):
            centre[:, c] = np.where(total > 0, np.bincount(near, weight * m[:, c], minlength=classes - 2) / np.maximum(total, 1e-9), centre[:, c])
    out[known] = near + 1
    out[END] = classes - 1
    return out


def count_table(pairs: np.ndarray, classes_of: np.ndarray) -> np.ndarray:
    """log10 P(id | class of id, class before) from counts[class before, id], smoothed to every id."""
    own = pairs.sum(axis=0, dtype=np.float64)
    member = np.bincount(classes_of, minlength=CLASSES)
    in_class = np.bincount(classes_of, own, minlength=CLASSES)
    base = (own + 1) / (in_class + member)[classes_of]
    out = np.empty(pairs.shape, np.float32)
    for c in range(CLASSES):
        total = np.bincount(classes_of, pairs[c], minlength=CLASSES)
        out[c] = np.log10((pairs[c] + ALPHA * base) / (total + ALPHA)[classes_of])
    return out


@dataclass
class Windows:
    """Windows over many texts' tokens."""

    ids: np.ndarray  # windows x WINDOW, what stands before
    wanted: np.ndarray  # windows x WINDOW, the id to predict
    scored: np.ndarray  # windows x WINDOW
    at: np.ndarray  # windows x WINDOW, the place of the id to predict
    text: np.ndarray  # the text of each window
    nth: np.ndarray  # its number in the text


def windows(tokens: np.ndarray, ends: np.ndarray, overlap: int = OVERLAP, pick: Callable | None = None) -> Windows:
    """Windows of texts whose tokens (each text's end id included) stop at ``ends``; every token is scored in exactly one.

    ``pick`` chooses windows by their texts and numbers there: all in order if it is missing.
    """
    begins = np.concatenate([[0], ends[:-1]])
    size = ends - begins
    step = WINDOW - overlap
    many = 1 + np.maximum(0, -(-(size - WINDOW) // step))
    text = np.repeat(np.arange(len(ends)), many)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    if pick is not None:
        chosen = pick(text, nth)
        text, nth = text[chosen], nth[chosen]
    place = (nth * step)[:, None] + np.arange(WINDOW)
    inside = place < size[text][:, None]
    at = np.minimum(place + begins[text][:, None], len(tokens) - 1)
    wanted = tokens[at]
    ids = tokens[np.maximum(at - 1, 0)]
    ids[nth == 0, 0] = END
    scored = inside & ((np.arange(WINDOW) >= overlap) | (nth == 0)[:, None])
    return Windows(ids, wanted, scored, at, text, nth)


@dataclass
class Model:
    weights: dict[str, np.ndarray]
    classes_of: np.ndarray
    in_class: np.ndarray

    def token_log10(self, tokens: np.ndarray, ends: np.ndarray, batch: int = 128) -> np.ndarray:
        """log10 probability of every token; ``tokens`` hold each text's ids and its end id."""
        w = windows(tokens, ends)
        out = np.zeros(len(tokens), np.float32)
        for i in range(0, len(w.ids), batch):
            part = slice(i, i + batch)
            ids, wanted, scored = w.ids[part], w.wanted[part], w.scored[part]
            next_id, before = wanted[scored], self.classes_of[ids[scored]]
            score = class_log_probs(self.weights, ids, scored, self.classes_of[next_id]) * np.float32(1 / np.log(10))
            out[w.at[part][scored]] = score + self.in_class[before, next_id]
        return out
