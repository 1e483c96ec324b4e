"""One consistent form for text that looks the same.

`consistent(text)` applies compatibility composition (NFKC), maps every white space to one blank, removes
default-ignorable characters and replaces letters of other scripts by the Latin letter they are drawn like.
Letter case is kept, since `nM` and `nm` are different units; `folded(text)` adds full case folding.
Null gives None, text of ignorable characters only gives the empty string.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

# Letters of other scripts and signs that are drawn like a Latin letter or an ASCII sign (Unicode TR 39).
_DRAWN_LIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "У": "Y", "Ѕ": "S", "І": "I", "Ј": "J",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ӏ": "l", "к": "k",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϝ": "F",
    "ο": "o", "α": "a", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j", "ι": "i", "κ": "k", "υ": "u", "ⲟ": "o",
    "ո": "n", "օ": "o", "հ": "h", "ս": "u", "ց": "g", "զ": "q", "յ": "j", "Ս": "U", "Օ": "O", "Տ": "S", "Լ": "L", "ւ": "i",
    "ɡ": "g", "ı": "i", "ɑ": "a", "ʟ": "L", "ᴍ": "m", "ᴏ": "o", "ℓ": "l", "ꞵ": "B", "ƽ": "s",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹣": "-", "⁃": "-", "˗": "-", "⁄": "/", "∕": "/", "╱": "/", "⧸": "/",
    "˚": "°", "º": "°", "∘": "°", "⁰": "°", "٪": "%", "⁒": "%", "․": ".", "‚": ",", "ʼ": "'", "’": "'", "‘": "'", "µ": "μ", "ꭎ": "u",
}
_BEFORE = str.maketrans({c: _DRAWN_LIKE[c] for c in "˚º⁰ϲϹ"})  # NFKC would turn these into something else
_AFTER = str.maketrans(_DRAWN_LIKE)
_SPACE = re.compile(r"[\s   -     　]+")
# Default_Ignorable_Code_Point: format characters, joiners, fillers, variation selectors and tags.
_IGNORABLE = re.compile(
    "[­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ￰-￸"
    "\U0001bca0-\U0001bca3\U0001d173-\U0001d17a\U000e0000-\U000e0fff]"
)


@lru_cache(maxsize=1 << 16)
def consistent(text: str | None) -> str | None:
    """The consistent form, case kept."""
    if text is None:
        return None
    if text.isascii():
        return _SPACE.sub(" ", text).strip()
    text = _IGNORABLE.sub("", text).translate(_BEFORE)
    text = _IGNORABLE.sub("", unicodedata.normalize("NFKC", text)).translate(_AFTER)
    return _SPACE.sub(" ", unicodedata.normalize("NFC", text)).strip()


@lru_cache(maxsize=1 << 16)
def folded(text: str | None) -> str | None:
    """The consistent form under full case folding."""
    return None if text is None else consistent(unicodedata.normalize("NFKC", consistent(text).casefold()))
