"""Vectors of tokens and records: random walks over the graph record - attribute - token, and skip-gram on them.

A record has four attributes: title, authors, year, DOI. A walk goes from a record to an attribute, to one of its tokens, to another
record that has the token, and so on; tokens met near each other on walks are companions. A token's vector is the sum of the
vectors of its character trigrams, so that a word with a slip or a name that no walk met lies near its like; skip-gram with
negative sampling trains them by its expected gradient over all companions.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import xxhash

from assayloom.llm.compare import Record

DIM = 64
#: Tokens trained on: the most frequent on the walks. The others get their vectors from their trigrams.
TRAINED = 2_000
SEED = 11
#: Chance of the next attribute: title, authors, year, DOI, among those a record has.
TURNS = (0.5, 0.35, 0.03, 0.12)


class Graph(NamedTuple):
    """Tokens of attributes and records of tokens, each as starts and flat values; attribute k of record r is number 4 r + k."""

    tokens: list[str]
    starts: np.ndarray
    flat: np.ndarray
    held_starts: np.ndarray
    held: np.ndarray


def graph(records: list[Record]) -> Graph:
    at: dict[str, int] = {}
    flat, starts, of = [], [0], []
    for r, x in enumerate(records):
        for part in (f"{x.main} {x.sub}".split(), x.authors, (f"year {x.year}",) if x.year else (), (f"doi {x.doi}",) if x.doi else ()):
            ids = [at.setdefault(t, len(at)) for t in part]
            flat += ids
            of += [r] * len(ids)
            starts.append(len(flat))
    flat, of = np.array(flat, dtype=np.int64), np.array(of, dtype=np.int64)
    order = np.argsort(flat, kind="stable")
    return Graph(list(at), np.array(starts), flat, np.searchsorted(flat[order], np.arange(len(at) + 1)), of[order])


def walks(g: Graph, rng: np.random.Generator, per_record: int = 2, length: int = 10) -> np.ndarray:
    """Token numbers along walks, one walk a row; -1 behind a record without any attribute."""
    n = (len(g.starts) - 1) // 4
    at = np.tile(np.arange(n), per_record)
    out = np.full((len(at), length), -1, dtype=np.int64)
    if not len(g.flat):
        return out
    sizes = np.diff(g.starts).reshape(n, 4)
    odds = np.cumsum((sizes > 0) * np.array(TURNS), axis=1)
    alive = odds[at, -1] > 0
    for step in range(length):
        dice = rng.random((3, len(at)))
        turn = np.minimum((odds[at] <= (dice[0] * odds[at, -1])[:, None]).sum(1), 3)
        part = at * 4 + turn
        token = g.flat[np.minimum(g.starts[part] + (dice[1] * sizes[at, turn]).astype(np.int64), len(g.flat) - 1)]
        out[alive, step] = token[alive]
        many = g.held_starts[token + 1] - g.held_starts[token]
        at = np.where(alive, g.held[g.held_starts[token] + (dice[2] * many).astype(np.int64)], at)
    return out


def grams(token: str) -> list[str]:
    s = f"^{token}$"
    return [s[i : i + 3] for i in range(len(s) - 2)]


def untrained(gram: str) -> np.ndarray:
    """The vector that training starts from: pseudo-random signs, one set for each trigram."""
    return (np.unpackbits(np.frombuffer(xxhash.xxh64_digest(gram, seed=SEED), np.uint8)).astype(np.float32) * 2 - 1) / 8


def companions(walked: np.ndarray, window: int, size: int) -> np.ndarray:
    """How often two tokens stand within a window on the walks: size x size."""
    counts = np.zeros(size * size, dtype=np.float32)
    for d in range(1, window + 1):
        a, b = walked[:, :-d].ravel(), walked[:, d:].ravel()
        on = (a >= 0) & (b >= 0) & (a != b)
        counts += np.bincount(a[on] * size + b[on], minlength=size * size).astype(np.float32)
    counts = counts.reshape(size, size)
    return counts + counts.T


def skipgram(walked: np.ndarray, tokens: list[str], window: int = 3, negatives: int = 3, rate: float = 0.1, epochs: int = 6) -> dict[str, np.ndarray]:
    """Trained vectors of the trigrams of `tokens`; walks hold numbers of tokens, -1 for none.

    A batch is all companions at once: of the samples the exact expectation is taken, so the result is free of sampling noise.
    """
    at: dict[str, int] = {}
    parts = [[at.setdefault(x, len(at)) for x in grams(t)] for t in tokens]
    vectors = np.stack([untrained(x) for x in at]) if at else np.zeros((0, DIM), np.float32)
    seen = np.bincount(walked[walked >= 0], minlength=len(tokens))
    chosen = np.argsort(-seen, kind="stable")[:TRAINED]
    chosen = chosen[seen[chosen] > 1]
    if len(chosen) < 2:
        return dict(zip(at, vectors))
    number = np.full(len(tokens) + 1, -1)
    number[chosen] = np.arange(len(chosen))
    positive = companions(number[walked], window, len(chosen))
    times = positive.sum(1, keepdims=True)
    noise = positive.sum(0) ** 0.75
    negative = negatives * times * (noise / noise.sum())
    scale = 1 / np.maximum(times, 1)
    positive, negative = positive * scale, negative * scale  # every token learns at one pace
    row = np.repeat(np.arange(len(chosen)), [len(parts[c]) for c in chosen])
    of = np.concatenate([parts[c] for c in chosen])
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    share = 1 / np.sqrt(np.bincount(row))[:, None].astype(np.float32)
    order = np.argsort(of, kind="stable")
    ends = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]])
    used = of[order][ends]
    held = np.bincount(of, minlength=len(vectors))[used, None]
    context = np.zeros((len(chosen), DIM), np.float32)
    for _ in range(epochs):
        x = np.add.reduceat(vectors[of], starts) * share
        g = 1 / (1 + np.exp(-np.clip(x @ context.T, -30, 30)))
        g = (positive + negative) * g - positive
        dx, dc = (g @ context) * share, g.T @ x
        context -= rate * dc
        vectors[used] -= rate * np.add.reduceat(dx[row[order]], ends) / np.sqrt(held)
    return dict(zip(at, vectors.astype(np.float32)))


#: Words of a head, a title's end, its middle, and of the beginning that stands beside an author.
HEAD, END, MIDDLE, LEAD = 9, 6, (3, 9), 6
#: Views of a record, each a stretch of title words and the place of an author that joins it (-1 for none).
VIEWS = {"title": -1, "head": -1, "lead": 0, "second": 1, "end": 0, "middle": -1}


class Embedder:
    """Vectors of tokens and of views of records."""

    def __init__(self, vectors: dict[str, np.ndarray], weight: dict[str, float], rare: float):
        self.vectors, self.weight, self.rare = vectors, weight, rare
        self.mean = {view: np.zeros(DIM, np.float32) for view in VIEWS}
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.matrix = np.zeros((1 << 12, DIM), np.float32)

    def __getstate__(self):
        return (self.vectors, self.weight, self.rare, self.mean)

    def __setstate__(self, state):
        self.vectors, self.weight, self.rare, self.mean = state
        self._forget()

    def number(self, w: str) -> int:
        """The row of a token in the matrix of weighted unit vectors."""
        i = self.at.get(w)
        if i is None:
            i = len(self.at)
            if i == len(self.matrix):
                self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
            v = np.sum([self.vectors[x] if x in self.vectors else untrained(x) for x in grams(w)], axis=0)
            self.matrix[i] = v / (np.linalg.norm(v) or 1) * self.weight.get(w, self.rare)
            self.at[w] = i
        return i

    def views(self, mains: list[str], authors: list[tuple[str, ...]], wanted=tuple(VIEWS)) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Of each view the records that have it, and their centred vectors; a record whose tokens have no vector has no view."""
        if len(self.at) > 1 << 17:
            self._forget()
        number = self.number
        words, counts = [], np.zeros(len(mains), dtype=np.int64)
        for i, m in enumerate(mains):
            ids = [number(w) for w in m.split()]
            words += ids
            counts[i] = len(ids)
        words, first = np.array(words, dtype=np.int64), np.cumsum(counts) - counts
        out = {}
        for view in wanted:
            k = VIEWS[view]
            if view == "title":
                has, lo, hi = counts > 0, first, first + counts
            elif view == "head":
                has, lo, hi = counts >= 8, first, first + np.minimum(counts, HEAD)
            elif view == "middle":
                has, lo, hi = counts >= 10, first + MIDDLE[0], first + MIDDLE[1]
            elif view == "end":
                has, lo, hi = counts >= 8, first + counts - END, first + counts
            else:
                has, lo, hi = counts >= 3, first, first + np.minimum(counts, LEAD)
            if k >= 0:
                has = has & np.array([len(a) > k for a in authors], dtype=bool)
            rows = np.flatnonzero(has)
            if not len(rows):
                continue
            lo, n = lo[rows], (hi - lo)[rows]
            v = np.empty((len(rows), DIM), np.float32)
            for size in np.unique(n):
                on = n == size
                v[on] = self.matrix[words[lo[on][:, None] + np.arange(size)]].sum(1)
            if k >= 0:
                names = [number(authors[i][k]) for i in rows]  # may replace the matrix
                v = v + 2 * self.matrix[names]
            told = v.any(axis=1)  # without any vector there is nothing to hash
            out[view] = (rows[told], v[told] - self.mean[view])
        return out

    def centre(self, records: list[Record]) -> None:
        for view, (_, v) in self.views([r.main for r in records], [r.authors for r in records]).items():
            if len(v):
                self.mean[view] = v.mean(0).astype(np.float32)

    def cosines(self, a: list[str], b: list[str]) -> np.ndarray:
        """Cosines of the titles of pairs; 0 where a title has no word."""
        out = np.zeros(len(a))
        if not len(a):
            return out
        none = [()] * len(a)
        both = [self.views(side, none, ("title",)).get("title", (np.zeros(0, int), np.zeros((0, DIM)))) for side in (a, b)]
        x, y = np.zeros((len(a), DIM)), np.zeros((len(a), DIM))
        x[both[0][0]], y[both[1][0]] = both[0][1], both[1][1]
        norm = np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1)
        return np.divide((x * y).sum(1), norm, out=out, where=norm > 0)
