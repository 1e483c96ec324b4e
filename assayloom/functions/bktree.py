"""Edit distance by bit vectors, and a BK-tree over it."""

from __future__ import annotations

from collections.abc import Iterable


class Pattern:
    """A text prepared for many Levenshtein distances (Myers' bit vectors over one big integer)."""

    __slots__ = ("last", "mask", "peq", "text")

    def __init__(self, text: str):
        self.text = text
        self.mask = (1 << len(text)) - 1
        self.last = 1 << max(0, len(text) - 1)
        self.peq: dict[str, int] = {}
        for i, c in enumerate(text):
            self.peq[c] = self.peq.get(c, 0) | 1 << i

    def distance(self, other: str) -> int:
        """Levenshtein distance, a true metric."""
        d = len(self.text)
        if not d:
            return len(other)
        if self.text == other:
            return 0
        mask, last, get = self.mask, self.last, self.peq.get
        pv, mv = mask, 0
        for c in other:
            eq = get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | ~(xh | pv) & mask
            mh = pv & xh
            if ph & last:
                d += 1
            elif mh & last:
                d -= 1
            ph = ph << 1 | 1
            pv = (mh << 1 | ~(xv | ph)) & mask
            mv = ph & xv & mask
        return d


class BKTree:
    """Entries reachable by distance; `search` returns every entry within a threshold and prunes by the triangle inequality."""

    def __init__(self, words: Iterable[str]):
        self.words: list[str] = []
        self.edges: list[dict[int, int]] = []
        for w in words:
            self.add(w)

    def add(self, word: str) -> None:
        if not self.words:
            self.words.append(word)
            self.edges.append({})
            return
        p, at = Pattern(word), 0
        while d := p.distance(self.words[at]):
            nxt = self.edges[at].get(d)
            if nxt is None:
                self.edges[at][d] = len(self.words)
                self.words.append(word)
                self.edges.append({})
                return
            at = nxt

    def search(self, text: str, limit: int) -> list[tuple[int, str]]:
        """(distance, entry) of every entry within `limit`, nearest first."""
        if not self.words:
            return []
        p, out, todo = Pattern(text), [], [0]
        while todo:
            at = todo.pop()
            d = p.distance(self.words[at])
            if d <= limit:
                out.append((d, self.words[at]))
            lo, hi = d - limit, d + limit
            todo.extend(child for edge, child in self.edges[at].items() if lo <= edge <= hi)
        return sorted(out)
