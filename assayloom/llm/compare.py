"""Exact comparison of two bibliographic records that share a block."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

from assayloom.llm.bibkeys import edits, same_word


class Record(NamedTuple):
    """A paper in comparable form; `preprint` tells whether its DOI is of a preprint server, not of a journal."""

    kind: str
    main: str
    sub: str
    cut: bool
    authors: tuple[str, ...]
    year: int | None
    doi: str | None
    preprint: bool = False


def _segment(a: list[str], b: list[str], frequent: dict[str, int]) -> bool:
    """Whether two differing stretches of words are one stretch with slips or an abbreviation."""
    if not a or not b:
        return False
    x, y = "".join(a), "".join(b)
    if x == y:
        return True
    if len(a) == len(b) == 1 and (len(x) == 1 or len(y) == 1) and x[0] == y[0] and not x[0].isdigit() and max(len(x), len(y)) > 3:
        return True  # a genus abbreviated
    if not (x.isascii() and x.isalpha() and y.isascii() and y.isalpha()) and [c for c in x if c.isdigit() or c > "z"] != [c for c in y if c.isdigit() or c > "z"]:
        return False
    if all(w in frequent for w in a) and all(w in frequent for w in b):
        fewer, more = sorted((min(frequent[w] for w in a), min(frequent[w] for w in b)))
        if fewer * RARER > more:
            return False
    n = max(len(x), len(y))
    most = 1 if n < 5 else 2 if n < 14 else 3
    return n >= 2 and abs(len(x) - len(y)) <= most and len(set(x) ^ set(y)) <= 2 * most and edits(x, y) <= most


#: A frequent word this many times rarer than another may still be a slip of it.
RARER = 40


@lru_cache(maxsize=1 << 14)
def _split(text: str) -> list[str]:
    return text.split()


def words_agree(a: str, b: str, frequent: dict[str, int], prefix: bool = False) -> tuple[bool, float]:
    """(whether two word sequences are one text with slips, share of equal words); `prefix`: the shorter one may be cut anywhere."""
    if a == b:
        return True, 1.0
    x, y = _split(a), _split(b)
    if len(x) > len(y):
        x, y = y, x
    if prefix:
        joined, other = "".join(x), "".join(y)
        if other.startswith(joined):
            return True, 1.0
        last = x[-1] if x else ""
        x = x[:-1]
        y = y[: len(x)] if not _later(x, y) else y[: len(x) + _later(x, y)]
        if len(x) < 2:
            return False, 0.0
        del last
    # equal beginnings, and ends unless the end is open, need no alignment
    lo, hi, most = 0, 0, min(len(x), len(y))
    while lo < most and x[lo] == y[lo]:
        lo += 1
    while not prefix and hi < most - lo and x[-1 - hi] == y[-1 - hi]:
        hi += 1
    same = lo + hi
    x, y = x[lo : len(x) - hi], y[lo : len(y) - hi]
    longest = max(len(x), len(y)) + same
    if not x and not y:
        return True, same / max(longest, 1)
    ops = [("replace", 0, len(x), 0, len(y))] if set(x).isdisjoint(y) else SequenceMatcher(None, x, y, autojunk=False).get_opcodes()
    for op, i, j, k, m in ops:
        if op == "equal":
            same += j - i
            continue
        p, q = x[i:j], y[k:m]
        if prefix and j == len(x) and len(p) + len(q) <= 2:
            continue
        if not _segment(p, q, frequent) and not (len(p) == len(q) and all(u == v or _segment([u], [v], frequent) for u, v in zip(p, q))):
            return False, 0.0
    return True, same / max(longest, 1)


@lru_cache(maxsize=1 << 14)
def _word_set(text: str) -> frozenset[str]:
    return frozenset(text.split())


def cannot_agree(a: str, b: str, frequent: dict[str, int]) -> bool:
    """A quick sign that two titles differ: the shorter has a frequent word that nothing in the longer can be a slip of.

    Such a word stands in the longer title as it is, with a slip (then a rare word, or a word far rarer), joined to others (a rare
    word), parted (its beginning or end) or abbreviated (its first letter); there must be enough such words, and no slip leaves more
    than three letters out. The last word may be cut and is left out.
    """
    if len(a) > len(b):
        a, b = b, a
    x, y = _word_set(a), _word_set(b)
    lost = x - y
    if not lost:
        return False
    extra = y - x
    last = a.rsplit(" ", 1)[-1]
    known = [w for w in lost if len(w) > 3 and w in frequent and w != last]
    if not known:
        return False
    often = max(frequent[w] for w in known) / RARER
    stand = [w for w in extra if len(w) < 4 or frequent.get(w, 0) <= often]
    if len(stand) * 3 < len(known):  # three words at most are joined to one
        return True
    for w in known:
        n = len(w) - 3
        if not any(len(e) >= n or w.startswith(e) or w.endswith(e) for e in stand):
            return True
    return False


def _later(x: list[str], y: list[str]) -> int:
    """How many words of `y` more the stretch of `x` takes up because words were split or joined."""
    n, at = len("".join(x)), 0
    for k, w in enumerate(y):
        at += len(w)
        if at >= n:
            return k + 1 - len(x)
    return 0


def authors_agree(a: tuple[str, ...], b: tuple[str, ...]) -> float | None:
    """Share of the shorter author list found in the longer; None where a list is missing.

    Names may have slips, but lists of two or more that share no name as written do not agree.
    """
    if not a or not b:
        return None
    if len(a) > len(b):
        a, b = b, a
    rest = set(b)
    lost = [s for s in a if s not in rest]
    hits = len(a) - len(lost)
    if not hits and len(a) > 1:
        return 0.0
    if hits * 2 < len(a):  # a slip leaves the beginning or the end of a name
        for s in lost:
            begins, ends = s[:2], s[-3:]
            for t in rest:
                if (t.startswith(begins) or t.endswith(ends)) and (t[:2] == begins or t[-3:] == ends) and same_word(s, t):
                    hits += 1
                    break
    return hits / len(a)


def compare(a: Record, b: Record, frequent: dict[str, int]) -> tuple[float, str]:
    """(agreement from 0 to 1, reason): 0 for records that cannot be one work.

    Corrections, replies and numbered parts only match their like; numbers and frequent words in titles must agree, rare words
    may differ by a slip; a title may be cut or lack its subtitle; years differ by one at most.
    """
    if a.doi and b.doi and a.doi != b.doi and a.preprint == b.preprint:
        short, long = sorted((a.doi, b.doi), key=len)
        if len(short) == len(long) or not long.startswith(short):
            return 0.0, "doi"
    years = None if a.year is None or b.year is None else abs(a.year - b.year)
    if years is not None and years > 2:
        return 0.0, "year"
    who = authors_agree(a.authors, b.authors)
    if who is not None and who < 0.5:
        return 0.0, "authors"
    cut = a.cut or b.cut
    if not a.main or not b.main:
        return 0.0, "title"
    same_doi = bool(a.doi) and a.doi == b.doi
    if cannot_agree(a.main, b.main, frequent):
        return 0.0, "main"
    ok, share = words_agree(a.main, b.main, frequent)
    part_cut = False
    if not ok:
        shorter = a if len(a.main) < len(b.main) else b
        if shorter.sub or len(shorter.main) < 24:
            return 0.0, "main"
        ok, share = words_agree(a.main, b.main, frequent, prefix=True)
        if not ok:
            return 0.0, "main"
        cut = part_cut = True
        if (years or 0) > 1 or (who is None and (years != 0 or len(shorter.main) < 36)):
            return 0.0, "cut"
    if a.sub and b.sub and not words_agree(a.sub, b.sub, frequent)[0]:
        if not words_agree(a.sub, b.sub, frequent, prefix=True)[0]:
            return 0.0, "sub"
    if a.kind != b.kind:
        letters = [k.rstrip("0123456789ivx") for k in (a.kind, b.kind)]
        bare = (a if not a.kind.strip("cr") else b).cut or part_cut
        if letters[0] != letters[1] or not (bare and years == 0):
            return 0.0, "kind"
    if years == 2 and not (who or 0) >= 0.5:
        return 0.0, "year2"
    score = 0.55 + 0.25 * share + (0.15 * who if who is not None else 0.02) + (0.05 if years == 0 else 0.02 if years == 1 else 0.0) - (0.15 if part_cut else 0.0) - (0.05 if cut else 0.0)
    return min(1.0, score + 0.1 * same_doi), "match"
