"""Bibliographic fields in comparable form: titles, author lists, DOIs."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from assayloom.llm.markup import clean, may_be_marked

# Letters without a decomposition, spellings of Greek letters, and one spelling of words with several.
_LETTERS = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ı": "i", "ß": "s", "æ": "e", "œ": "e", "þ": "t", "ð": "d"})
_GREEK = {"alpha": "α", "beta": "β", "gamma": "γ", "delta": "δ"}
_SPELLING = {"behavior": "behaviour", "color": "colour", "tumor": "tumour", "sulfur": "sulphur"}
_ZED = re.compile(r"(?<=[a-z]{2}[iy])z(?=[aei])")
_CORRECTION = re.compile(r"^(?:author |publisher )?(?:correction|erratum|corrigendum|addendum|retraction(?: note)?|expression of concern)\b(?: (?:to|for|on|of))?", re.I)
_REPLY = re.compile(r"^(?:(?:a )?(?:reply|response|comment|commentary|rebuttal|letter)\b(?: (?:to|on))|re)\b", re.I)
_PART = re.compile(r"[\s.,:;(-]*\b(?:part|pt)\.? ?(\d+|[ivx]+)\b[).\s]*$", re.I)
_ELLIPSIS = re.compile(r"\s*(?:…|\.\.\.|\[…\]|\[\.\.\.\])\s*$")
_WORD = re.compile(r"[^\W\d_]+|\d+")


@lru_cache(maxsize=1 << 15)
def fold(text: str) -> str:
    """Lower case without diacritics."""
    if text.isascii():
        return text.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text.lower().translate(_LETTERS)) if not unicodedata.combining(c)).translate(_LETTERS)


def title_key(title: str | None) -> tuple[str, str, str, bool]:
    """(kind, main part, subtitle, whether cut): main part and subtitle as blank-separated words.

    Kind is "" for a work, "c" for a correction, "r" for a reply, followed by the number of a part.
    """
    if not title:
        return "", "", "", False
    text = clean(title)[0] if may_be_marked(title) else title
    text = " ".join(text.replace("&", " and ").split()).strip(" \"'")
    cut = ("…" in text or "..." in text) and bool(_ELLIPSIS.search(text))
    text = (_ELLIPSIS.sub("", text) if cut else text).lower().strip()
    kind = ""
    for mark, pattern in (("c", _CORRECTION), ("r", _REPLY)) if ":" in text or "-" in text or "–" in text or "—" in text else ():
        m = pattern.match(text)
        if m and re.match(r"\s*[:\-–—]", text[m.end() :]):
            kind, text = kind + mark, text[m.end() :].lstrip(" :-–—")
    m = _PART.search(text) if "pt" in text or "part" in text else None
    if m:
        kind, text = kind + m[1], text[: m.start()]
    main, _, sub = text.partition(": ")
    if not sub:
        main, _, sub = text.partition(" - ")
    return kind, _words(main), _words(sub), cut


def _words(text: str) -> str:
    return " ".join(filter(None, map(_piece, text.split())))


@lru_cache(maxsize=1 << 16)
def _piece(piece: str) -> str:
    """The words of a piece of text without blanks, folded and in one spelling."""
    out = []
    for w in _WORD.findall(fold(piece)):
        w = _GREEK.get(w, w)
        out.append(_SPELLING.get(w, _ZED.sub("s", w)))
    return " ".join(out)


@lru_cache(maxsize=1 << 16)
def surname(author: str) -> str | None:
    """The folded family name of an author written in any of the usual orders; None for "et al." and ellipses."""
    a = author.strip()
    if not a or a in ("…", "...") or a.lower().startswith("et al"):
        return None
    if "," in a:
        return fold(a.split(",")[0].strip()) or None
    parts = a.split()
    capital = [p for p in parts if len(p) > 3 and p.isupper() and "." not in p]
    if capital:
        return fold(capital[0])
    full = [p for p in parts if len(p.replace(".", "")) > 2 and not (p.isupper() and len(p) <= 3)]
    if len(full) == 1:
        return fold(full[0])
    return fold(full[-1] if full else parts[-1])


def surnames(authors) -> list[str]:
    return [s for s in (surname(a) for a in (authors if authors is not None else []) if a) if s]


def same_word(a: str, b: str) -> bool:
    """Whether two words may be one word with a slip: numbers never, words up to one edit in five letters."""
    if a == b:
        return True
    if a[0].isdigit() or b[0].isdigit() or abs(len(a) - len(b)) > 2 or min(len(a), len(b)) < 3:
        return False
    most = 1 if max(len(a), len(b)) < 8 else 2
    # an edit changes two letters of the set at most
    return len(set(a) ^ set(b)) <= 2 * most and edits(a, b) <= most


@lru_cache(maxsize=1 << 15)
def edits(a: str, b: str) -> int:
    """Edit distance with transpositions."""
    prev2, prev = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, prev2[j - 2] + 1)
            row.append(d)
        prev2, prev = prev, row
    return prev[-1]
