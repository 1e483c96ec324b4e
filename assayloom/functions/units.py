"""Unit expressions as exponent vectors, and numbers with comparators, spreads and ranges.

A unit is (scale, offset, dimensions): a quantity of `x` units is `x * scale + offset` in base units, and `dimensions` maps
base names to exponents. Base names: m (length), g (mass), mol, K, prop (stated proportion) and one per counted thing
(IU, CFU, disc), so that a count never passes for a plain number.
"""

from __future__ import annotations

import re
from fractions import Fraction
from functools import lru_cache

from assayloom.functions.glyphs import consistent

_ONE = Fraction(1)
# SI prefixes by symbol and by name.
_PREFIX = {"p": -12, "n": -9, "μ": -6, "u": -6, "mc": -6, "m": -3, "c": -2, "d": -1, "k": 3, "M": 6}
_PREFIX_NAME = {"pico": -12, "nano": -9, "micro": -6, "μ-": -6, "milli": -3, "centi": -2, "deci": -1, "kilo": 3, "mega": 6}
# Atoms that take a prefix; M is mol/L, Da is g/mol.
_ATOM = {
    "m": (_ONE, {"m": 1}),
    "g": (_ONE, {"g": 1}),
    "mol": (_ONE, {"mol": 1}),
    "L": (Fraction(1, 1000), {"m": 3}),
    "l": (Fraction(1, 1000), {"m": 3}),
    "M": (Fraction(1000), {"mol": 1, "m": -3}),
    "Da": (_ONE, {"g": 1, "mol": -1}),
}
_NAMED = {"meter": "m", "metre": "m", "gram": "g", "gramme": "g", "mole": "mol", "mol": "mol", "litre": "L", "liter": "L", "molar": "M", "dalton": "Da"}
# Atoms without a prefix, by lower-case text: scale, offset, dimensions.
_WHOLE = {
    "k": (_ONE, Fraction(0), {"K": 1}),
    "kelvin": (_ONE, Fraction(0), {"K": 1}),
    "kelvins": (_ONE, Fraction(0), {"K": 1}),
    "celsius": (_ONE, Fraction("273.15"), {"K": 1}),
    "centigrade": (_ONE, Fraction("273.15"), {"K": 1}),
    "fahrenheit": (Fraction(5, 9), Fraction("273.15") - Fraction(160, 9), {"K": 1}),
    "%": (Fraction(1, 100), Fraction(0), {"prop": 1}),
    "percent": (Fraction(1, 100), Fraction(0), {"prop": 1}),
    "percentage": (Fraction(1, 100), Fraction(0), {"prop": 1}),
    "pct": (Fraction(1, 100), Fraction(0), {"prop": 1}),
    "‰": (Fraction(1, 1000), Fraction(0), {"prop": 1}),
    "permille": (Fraction(1, 1000), Fraction(0), {"prop": 1}),
    "fraction": (_ONE, Fraction(0), {"prop": 1}),
    "å": (Fraction(1, 10**10), Fraction(0), {"m": 1}),
    "ångström": (Fraction(1, 10**10), Fraction(0), {"m": 1}),
    "angstrom": (Fraction(1, 10**10), Fraction(0), {"m": 1}),
    "iu": (_ONE, Fraction(0), {"IU": 1}),
    "cfu": (_ONE, Fraction(0), {"CFU": 1}),
    "disc": (_ONE, Fraction(0), {"disc": 1}),
    "disk": (_ONE, Fraction(0), {"disc": 1}),
    "rpm": (_ONE, Fraction(0), {"rpm": 1}),
    "h": (Fraction(3600), Fraction(0), {"s": 1}),
    "min": (Fraction(60), Fraction(0), {"s": 1}),
    "s": (_ONE, Fraction(0), {"s": 1}),
}
_DEGREE = re.compile(r"(?:°|deg(?:rees?)?\.?)\s*(celsius|centigrade|fahrenheit|kelvin|[CFK])(?![A-Za-z])", re.I)
_DEGREE_TO = {"c": "celsius", "f": "fahrenheit", "k": "kelvin"}
_POWER_OF_TEN = re.compile(r"[×x*·]?\s*(?:10\s*\^?\s*([-+]?\d+)|1[eE]([-+]?\d+))(?=\s*[A-Za-zμ])\s*")
_TOKEN = re.compile(r"\s*(?:(per(?=[\s\d])|/)|([·*])|(\d+(?:\.\d+)?)|([A-Za-zμµ°%‰åÅöΩ]+(?:-(?=[A-Za-z]))?[A-Za-zöÅå]*)(?:\^?(-?\d+))?)")
Unit = tuple[Fraction, Fraction, tuple[tuple[str, int], ...]]


def _atom(text: str) -> tuple[Fraction, Fraction, dict[str, int]] | None:
    low = text.lower()
    if low in _WHOLE:
        return _WHOLE[low]
    if text in _ATOM:
        return (_ATOM[text][0], Fraction(0), _ATOM[text][1])
    for symbol, power in _PREFIX.items():
        if text.startswith(symbol) and (rest := text[len(symbol) :]) in _ATOM:
            return (_ATOM[rest][0] * Fraction(10) ** power, Fraction(0), _ATOM[rest][1])
    name = low[:-1] if low.endswith("s") and len(low) > 3 else low
    if name in _NAMED:
        return _atom(_NAMED[name])
    for prefix, power in _PREFIX_NAME.items():
        if name.startswith(prefix) and (rest := name[len(prefix) :]) in _NAMED:
            scale, dims = _ATOM[_NAMED[rest]]
            return (scale * Fraction(10) ** power, Fraction(0), dims)
    # atoms written without a sign between them: one split into two units, such as a mass and a volume
    return None


def _joined(text: str) -> list[str] | None:
    """Two atoms written together ("μgmL"), or None."""
    for k in range(1, len(text)):
        if _atom(text[:k]) and _atom(text[k:]) and text[:k].lower() not in _WHOLE and text[k:].lower() not in _WHOLE:
            return [text[:k], text[k:]]
    return None


@lru_cache(maxsize=1 << 15)
def parse_unit(text: str | None) -> Unit | None:
    """A unit expression as (scale, offset, dimensions); None where it is no unit.

    Look-alike and invisible characters are resolved first. Grammar: an optional power of ten, then factors joined by blank,
    dot, "/" or "per"; a factor is a number or a (prefixed) unit with an optional exponent.
    """
    if text is None:
        return None
    s = consistent(text).strip(" .;:,")
    if s.startswith("(") and s.endswith(")"):
        s = s[1:-1].strip()
    s = s.replace("per cent", "percent").replace("per mille", "permille").replace("−", "-").replace("deg. ", "deg ")
    s = _DEGREE.sub(lambda m: " " + _DEGREE_TO.get(m[1].lower(), m[1].lower()), s).strip()
    if not s:
        return None
    scale, offset, dims, sign, factors = _ONE, Fraction(0), {}, 1, 0
    if m := _POWER_OF_TEN.match(s):
        scale, s = Fraction(10) ** int(m[1] or m[2]), s[m.end() :]
    at, one = 0, False
    while at < len(s):
        m = _TOKEN.match(s, at)
        if not m or m.end() == at:
            return None
        at = m.end()
        if m[1]:
            sign, one = -1, True
        elif m[2]:
            continue
        elif m[3]:
            scale *= Fraction(m[3]) ** sign
        else:
            power, word = int(m[5] or 1), m[4]
            parts = [word] if _atom(word) else _joined(word)
            if parts is None:
                return None
            for k, part in enumerate(parts):
                unit = _atom(part)
                p = sign * (power if k == len(parts) - 1 else 1)
                scale *= unit[0] ** p
                offset = unit[1]
                factors += 1
                for base, e in unit[2].items():
                    dims[base] = dims.get(base, 0) + e * p
    if not factors or (one and sign == -1 and factors < 2):
        return None
    if factors > 1:
        offset = Fraction(0)
    return scale, offset, tuple(sorted((b, e) for b, e in dims.items() if e))


#: The common unit of each kind: dimensions, then its scale and offset in base units.
COMMON = {
    (("m", -3), ("mol", 1)): ("nM", Fraction(1, 10**6), Fraction(0)),
    (("g", 1), ("m", -3)): ("g/L", Fraction(1000), Fraction(0)),
    (("K", 1),): ("degC", _ONE, Fraction("273.15")),
    (("g", 1), ("mol", -1)): ("g/mol", _ONE, Fraction(0)),
    (("prop", 1),): ("%", Fraction(1, 100), Fraction(0)),
}

_EXP = r"(?:[eE][-+]?\d+|\s*[×x*·]\s*10\s*(?:\^\s*)?[-+]?\d+)?"
_NUM = r"[-+]?(?:\d{1,3}(?: \d{3})+(?!\d)|\d+|(?=[.,]\d))(?:[.,]\d+)?" + _EXP
_VALUE = re.compile(
    rf"^\s*(?P<op><=|>=|=<|=>|<<|>>|[<>≤≥=~≈∼⩽⩾])?\s*(?:ca\.?|about|approx\.?)?\s*(?P<a>{_NUM})"
    rf"(?:\s*(?P<to>to|-|–|—|\.\.\.?|…)\s*(?P<b>{_NUM}))?"
    rf"(?:\s*\(?\s*(?:±|\+/-|\+-|\+\\-)\s*(?:{_NUM})\s*\)?)?\s*(?P<rest>.*)$",
    re.S,
)
_EXP_SPLIT = re.compile(r"^(.*?)(?:[eE]([-+]?\d+)|\s*[×x*·]\s*10\s*(?:\^\s*)?([-+]?\d+))?$", re.S)


def _number(text: str) -> Fraction | None:
    m = _EXP_SPLIT.match(text.strip())
    power = int(m[2] or m[3] or 0)
    if abs(power) > 400:  # beyond what a double can hold
        return None
    return Fraction(m[1].replace(" ", "").replace(",", ".")) * Fraction(10) ** power


@lru_cache(maxsize=1 << 16)
def parse_number(text: str | None) -> tuple[Fraction, str] | None:
    """The number of a value text and what follows it; None where no number leads.

    Comparators and spreads are ignored, a range counts as its middle, a comma is a decimal comma, blanks group thousands.
    """
    if text is None:
        return None
    s = consistent(text).replace("−", "-")
    m = _VALUE.match(s)
    if not m:
        return None
    a = _number(m["a"])
    b = _number(m["b"]) if m["b"] else a
    if a is None or b is None:
        return None
    return (a + b) / 2, m["rest"].strip()


@lru_cache(maxsize=1 << 15)
def to_common(value: Fraction, unit: Unit) -> tuple[str, Fraction] | None:
    """(common unit, value in it); None for units of another kind."""
    kind = COMMON.get(unit[2])
    if kind is None:
        return None
    return kind[0], (value * unit[0] + unit[1] - kind[2]) / kind[1]
