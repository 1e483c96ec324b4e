"""Markup residue in texts: HTML/XML, Markdown, wiki and LaTeX read into one DOM, and the DOM written as clean text.

Pages of one host share a wrapper. It is induced by aligning their DOM trees with simple tree matching; like siblings are one
repeated node, and the sentences of a node are its leaves. Leaves that stand on many pages of the host with one text are template
(notices, boilerplate), the others are content. Clean text keeps headings (`## x`), list items (`- x`, `1. x`), code (fenced),
formulas (`$x$`) and table rows (`a | b`); emphasis, links, references and template go, links keeping their text.
"""

from __future__ import annotations

import html
import itertools
import json
import re
from collections.abc import Iterator, Mapping
from html.entities import html5

import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayloom.session import cut

# Element names of HTML, JATS and MathML that occur without a prefix.
_NAMES = set(
    "a abbr abstract article b big blockquote body bold br caption center cite code dd div dl dt em fig font footer h1 h2 h3 h4 h5 h6 head header hr html i img "
    "inline-formula italic kbd label li list list-item math mark nav ol p pre q ref roman s sc sec section small span strike strong sub sup table tbody td tex-math "
    "tfoot th thead title tr tt u ul underline var xref".split()
)
_INLINE = {"a", "abbr", "b", "big", "bold", "cite", "code", "em", "font", "i", "italic", "kbd", "mark", "q", "roman", "s", "sc", "small", "span", "strike", "strong", "sub", "sup", "tt", "u", "underline", "var", "xref", "math", "inline-formula", "ref", "mi", "mn", "mo", "mrow", "msub", "msup"}
_DROPPED = {"ref", "xref", "img", "hr"}
_VOID = {"br", "hr", "img", "ref"}
_HEADS = {"h1", "h2", "h3", "h4", "h5", "h6", "title"}
_NONE: Mapping[str, frozenset[str]] = {}
_LT, _GT, _AMP = "\ue001", "\ue002", "\ue003"
_ESC = {"<": _LT, ">": _GT}

_ENTITY = re.compile(r"&(#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")
_COMMENT = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[|\]\]>|<\?xml[^>]*>|<!DOCTYPE[^>]*>", re.S | re.I)
_TAG = re.compile(r"<\s*(/?)\s*([A-Za-z][\w.-]*(?::[A-Za-z][\w.-]*)?)((?:\s+[^<>]*?)?)\s*(/?)\s*>")
_FENCE = re.compile(r"^[ \t]*(```|~~~)[^\n]*\n(.*?)(?:^[ \t]*\1[ \t]*$|\Z)", re.S | re.M)
_TICKS = re.compile(r"`([^`\n]+)`")
_MATH = [
    re.compile(r"\$\$(.+?)\$\$", re.S),
    re.compile(r"\\\[(.+?)\\\]", re.S),
    re.compile(r"\\\((.+?)\\\)", re.S),
    re.compile(r"\\begin\{(?:equation|align|displaymath)\*?\}(.+?)\\end\{(?:equation|align|displaymath)\*?\}", re.S),
    re.compile(r"(?<![\\\w$])\$(?=\S)((?:[^$\n]*[\\^_{][^$\n]*|[A-Za-z]))(?<=\S)\$(?![\d$])"),
]
_RULES: list[tuple[re.Pattern, object]] = [
    # LaTeX
    (re.compile(r"\\(?:begin|end)\{(itemize|enumerate|description)\}\s*"), lambda m: "<ul>" if m[0].startswith("\\b") else "</ul>"),
    (re.compile(r"\\(?:begin|end)\{[A-Za-z]+\*?\}"), lambda m: "<div>" if m[0].startswith("\\b") else "</div>"),
    (re.compile(r"\\item\b\s*"), lambda m: "<li>"),
    (re.compile(r"\\(?:sub)*(?:section|paragraph|title|chapter)\*?\{([^{}]*)\}[ \t]*"), lambda m: f"<h2>{m[1]}</h2>"),
    (re.compile(r"[~ ]?\\(?:cite[tp]?|ref|label|footnote|eqref)\*?(?:\[[^\]]*\])?\{[^{}]*\}"), lambda m: "<ref>"),
    (re.compile(r"\{\\(?:it|bf|em|sl|sc|rm|tt|itshape|bfseries)\s+([^{}]*)(?:\}|\Z)"), lambda m: f"<em>{m[1]}</em>"),
    (re.compile(r"\\(?:text\w{2,6}|emph|underline|mathrm|mathbf|mbox|url|href)\{([^{}]*)(?:\}|\Z)"), lambda m: f"<em>{m[1]}</em>"),
    (re.compile(r"(?<![\w:\\])\\[A-Za-z]+\*?\{([^{}]*)(?:\}|\Z)"), lambda m: f"<em>{m[1]}</em>"),
    (re.compile(r"(?<=\S)\\([%&_#$])"), lambda m: f"<em>{m[1]}</em>"),
    # wiki
    (re.compile(r"^\{\|(.*?)(?:^\|\}|\Z)", re.S | re.M), lambda m: _wiki_table(m[1])),
    (re.compile(r"\{\{[^{}]*(?:\}\}|\Z)"), lambda m: "<ref>"),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)(?:\]\]|\Z)"), lambda m: f"<a>{m[1]}</a>"),
    (re.compile(r"'''(.+?)(?:'''|\Z)", re.S), lambda m: f"<b>{m[1]}</b>"),
    (re.compile(r"''(.+?)(?:''|\Z)", re.S), lambda m: f"<i>{m[1]}</i>"),
    (re.compile(r"^[ \t]*(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", re.M), lambda m: f"<h2>{m[2]}</h2>"),
    # Markdown
    (re.compile(r"^[ \t]*#{1,6}[ \t]+([^\n]+?)[ \t]*#*[ \t]*$", re.M), lambda m: f"<h2>{m[1]}</h2>"),
    (re.compile(r"^([^\n|]+)\n[ \t]*(?:={3,}|-{3,})[ \t]*$", re.M), lambda m: f"<h2>{m[1].strip()}</h2>"),
    (re.compile(r"^[ \t]*\|(.+)\|[ \t]*\n[ \t]*\|(?:[ \t:]*-{2,}[ \t:]*\|)+[ \t]*((?:\n[ \t]*\|.*)*)", re.M), lambda m: _md_table(m[1], m[2])),
    (re.compile(r"^[ \t]*\ue002[ \t]+(.*(?:\n(?![ \t]*\n)[ \t]*\ue002?.*)*)", re.M), lambda m: f"<blockquote>{m[1]}</blockquote>"),
    (re.compile(r"^[ \t]*[-*+•][ \t]+(\S.*)$", re.M), lambda m: f"<li>{m[1]}</li>"),
    (re.compile(r"^[ \t]*(\d{1,3})[.)][ \t]+(\S.*)$", re.M), lambda m: f"<li n={m[1]}>{m[2]}</li>"),
    (re.compile(r"!\[([^\]\n]*)\]\([^)\n]*\)"), lambda m: "<img>"),
    (re.compile(r"\[([^\]\n]+)\]\([^)\s]+\)"), lambda m: f"<a>{m[1]}</a>"),
    (re.compile(r"\*\*(?=\S)(.+?)(?<=\S)\*\*", re.S), lambda m: f"<b>{m[1]}</b>"),
    (re.compile(r"(?<![\w_])__(?=\S)(.+?)(?<=\S)__(?![\w_])", re.S), lambda m: f"<b>{m[1]}</b>"),
    (re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])"), lambda m: f"<i>{m[1]}</i>"),
    (re.compile(r"(?<![\w_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])"), lambda m: f"<i>{m[1]}</i>"),
]
#: What every markup has: a cheap superset of what the parser recognises, for the JVM and for Python.
MAY_HAVE = (
    r"&(?:#\d+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]+);|<\s*/?\s*[A-Za-z][\w.:-]*(?:\s[^<>]*)?/?\s*>|<!|"
    r"(?:^|\n)[ \t]*(?:#{1,6}[ \t]|>[ \t]|[-*+•][ \t]|\d{1,3}[.)][ \t]|={2,}|-{3,}|\{\||\||```|~~~)|\*\*|(?:^|[^\w*])\*[^\s*]|(?:^|[^\w])__?[^\s_]|`|''|\[\[|\{\{|\]\(|"
    r"\\[A-Za-z]+\*?\{|\\item|\\[()\[\]%&_#$]|\{\\|\$\$|\$\S*[\\^_{]|\$[A-Za-z]\$"
)
_MAY = re.compile(MAY_HAVE)
#: A sign that every alternative of `MAY_HAVE` needs.
HINT = r"[&<`\[{\\$*_]|''|\]\(|(?:^|\n)[ \t]*[#>\-+•=|~\d]"
_HINT = re.compile(HINT)


def may_be_marked(text: str) -> bool:
    """Whether a text holds a sign that every markup needs."""
    return _HINT.search(text) is not None


def _wiki_table(body: str) -> str:
    rows, cells = [], []
    for line in body.split("\n")[1:]:
        if line.startswith("|-"):
            rows, cells = rows + [cells], []
        elif line[:1] in "|!":
            cells.append(line[1:].strip())
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in [*rows, cells] if r) + "</table>"


def _md_table(head: str, body: str) -> str:
    lines = [head, *(x.strip().strip("|") for x in body.strip().split("\n") if x.strip())]
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c.strip()}</td>" for c in x.split("|")) + "</tr>" for x in lines) + "</table>"


#: Elements nested deeper than this become siblings.
DEPTH = 100


class Node:
    """An element (tag, children) or, with tag "", a text."""

    __slots__ = ("kids", "n", "tag", "text")

    def __init__(self, tag: str, text: str = "", n: str = ""):
        self.tag, self.text, self.n, self.kids = tag, text, n, []


def _unescape(text: str) -> tuple[str, int]:
    n = 0

    def one(m):
        nonlocal n
        if m[1][0] != "#" and m[1] + ";" not in html5:
            return m[0]
        n += 1
        return html.unescape(m[0])

    for _ in range(3):  # markup may be encoded more than once
        before = n
        text = _ENTITY.sub(one, text)
        if n == before:
            break
    return text, n


def parse(text: str) -> tuple[Node, int]:
    """(DOM, number of marks). Signs with their plain meaning and line breaks make no mark."""
    root, marks = Node("doc"), 0
    if not _HINT.search(text) or not _MAY.search(text):
        root.kids.append(Node("", text))
        return root, 0
    text, marks = _unescape(text)
    text, k = _COMMENT.subn("", text)
    marks += k
    code: list[str] = []

    def keep(kind: str):
        def put(m):
            code.append(m[m.lastindex])
            return f"\n<{kind}>\ue010{len(code) - 1}\ue011</{kind}>\n" if kind == "pre" else f"<{kind}>\ue010{len(code) - 1}\ue011</{kind}>"

        return put

    text, k = _FENCE.subn(keep("pre"), text)
    marks += k

    def tag(m):
        nonlocal marks
        prefix, _, name = m[2].lower().rpartition(":")
        if not prefix and name not in _NAMES:
            return m[0].replace("<", _LT).replace(">", _GT)
        marks += 1
        return f"\ue004{m[1]}{name}{'/' if m[4] else ''}\ue005"

    text = _TAG.sub(tag, text).replace("<", _LT).replace(">", _GT).replace("\ue004", "<").replace("\ue005", ">")
    text, k = _TICKS.subn(keep("code"), text)
    marks += k
    for pattern in _MATH:
        text, k = pattern.subn(keep("math"), text)
        marks += k
    for pattern, to in _RULES:
        text, k = pattern.subn(to, text)
        marks += k
    if not marks:
        root.kids.append(Node("", text.replace(_LT, "<").replace(_GT, ">")))
        return root, 0
    stack, at = [root], 0
    for m in re.finditer(r"<(/?)([a-z][\w.-]*)(?: n=(\d+))?(/?)>", text):
        if m.start() > at:
            stack[-1].kids.append(Node("", text[at : m.start()]))
        at = m.end()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == m[2]:
                    del stack[i:]
                    break
        else:
            if m[2] == "li":
                while stack[-1].tag in _INLINE | {"li", "p"} and any(x.tag == "li" for x in stack):
                    stack.pop()
            node = Node(m[2], n=m[3] or "")
            stack[-1].kids.append(node)
            if not m[4] and m[2] not in _VOID and len(stack) < DEPTH:
                stack.append(node)
    if at < len(text):
        stack[-1].kids.append(Node("", text[at:]))
    _fill(root, code)
    return root, marks


def _fill(node: Node, code: list[str]) -> None:
    for kid in node.kids:
        if kid.tag:
            _fill(kid, code)
        else:
            kid.text = re.sub("\ue010(\\d+)\ue011", lambda m: code[int(m[1])], kid.text).replace(_LT, "<").replace(_GT, ">")


def to_json(node: Node) -> list:
    """A DOM as nested lists [tag, number, child ...], texts as strings."""
    return [node.tag, node.n, *(to_json(k) if k.tag else k.text for k in node.kids)]


def from_json(data: list) -> Node:
    node = Node(data[0], n=data[1])
    node.kids = [Node("", k) if isinstance(k, str) else from_json(k) for k in data[2:]]
    return node


def render(node: Node, template: Mapping[str, frozenset[str]] = _NONE, path: str = "doc") -> str:
    """Clean text of a DOM without the template: the leaves that it names for their node's path."""
    out: list[str] = []
    _write(node, out, template, path)
    text = "".join(out).replace("\xa0", " ")
    lines = [re.sub(r"[ \t]+", " ", x).strip() if not x.startswith("\ue020") else x[1:] for x in text.split("\n")]
    text = re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()
    return _ITEMS.sub(r"\1\n", text)


_ITEMS = re.compile(r"(?m)^((?:- |\d+\. ).*)\n\n(?=- |\d+\. )")


def _write(node: Node, out: list[str], template: Mapping[str, frozenset[str]], path: str, amid: bool = False) -> None:
    gone = template.get(path)
    for i, kid in enumerate(node.kids):
        tag, slot = kid.tag, f"{path}/{kid.tag}"
        if not tag:
            out.append("".join(gap if leaf in gone else sentence + gap for sentence, gap, leaf in leaves(node, i, amid)) if gone else kid.text)
        elif tag in _DROPPED:
            continue
        elif tag == "br":
            out.append("\n")
        elif tag == "pre":
            body = "".join(x.text for x in kid.kids).strip("\n")
            out.append("\n\n" + "\n".join("\ue020" + x for x in ["```", *body.split("\n"), "```"]) + "\n\n")
        elif tag in ("code", "tt", "kbd"):
            out.append("`" + "".join(x.text for x in kid.kids) + "`")
        elif tag in ("math", "tex-math", "inline-formula"):
            out.append("$" + _flat(kid).strip() + "$")
        elif tag in _HEADS:
            out.append("\n\n## ")
            _write(kid, out, template, slot)
            out.append("\n")
        elif tag in ("li", "list-item"):
            out.append(f"\n{kid.n}. " if kid.n else "\n- ")
            _write(kid, out, template, slot)
        elif tag == "tr":
            cells = [render(c, template, f"{slot}/{c.tag}").replace("\n", " ") for c in kid.kids if c.tag]
            out.append("\n" + " | ".join(cells))
        elif tag in ("sub", "sup") or tag in _INLINE:
            _write(kid, out, template, slot, amid or _amid(node, i))
        else:
            out.append("\n")
            _write(kid, out, template, slot)
            out.append("\n")


def _flat(node: Node) -> str:
    return node.text + "".join(_flat(k) for k in node.kids)


_LEAF = re.compile(r"(.*?(?:(?<=[.!?])(?=\s|\Z)|(?=\n)|\Z))(\s*)", re.S)


def _amid(node: Node, i: int) -> bool:
    """Whether a child is an inline element beside text."""
    kids = node.kids
    return kids[i].tag in _INLINE and any(0 <= j < len(kids) and not kids[j].tag and kids[j].text.strip() for j in (i - 1, i + 1))


def leaves(node: Node, i: int, amid: bool = False) -> list[tuple[str, str, str]]:
    """(sentence, white space behind it, its digest) of a text child.

    The digest is the sentence, a long one by a digest of all of it; empty for stretches that are no sentence of their own:
    short ones, those that go on in an inline element, and those that do not end in an element `amid` other text.
    """
    kids, out = node.kids, []
    text = kids[i].text
    joined_before = i > 0 and kids[i - 1].tag in _INLINE
    joined_behind = i + 1 < len(kids) and kids[i + 1].tag in _INLINE
    for m in _LEAF.finditer(text):
        sentence, gap = m[1], m[2]
        if not m[0]:
            continue
        body = sentence.strip()
        own = len(body) >= 8 and (not amid or body[-1] in ".!?") and not (joined_before and m.start() == 0) and (not joined_behind or m.end() < len(text) or body[-1] in ".!?")
        out.append((sentence, gap, (body if len(body) <= 64 else body[:33] + xxhash.xxh3_128_hexdigest(body)) if own else ""))
    return out


def clean(text: str | None, template: Mapping[str, frozenset[str]] = _NONE) -> tuple[str, int] | None:
    """(clean text, number of marks)."""
    if text is None:
        return None
    dom, marks = parse(text)
    return (render(dom, template), marks) if marks else (text, 0)


# ---- wrapper induction -------------------------------------------------------------------------------------------------
# A wrapper node is [tag, pages, counters, kids, ids]: `counters` tell on how many pages each leaf stands in the node. They leave the
# task batch by batch under the node's id and are summed by Spark, all of them; of a wrapper only its nodes travel, with the ids they had.
_NO_LEAVES = _HEADS | {"math", "tex-math", "inline-formula", "code", "tt", "kbd", "pre", "td", "th", "tr", "li", "list-item"}


def _tree(node: Node) -> list:
    """The tree of a page; siblings of one tag are one repeated node, and a leaf counts once in a node."""
    tree: list = [node.tag, 1, {}, [], []]
    _grow(tree, node, {})
    return tree


def _grow(tree: list, node: Node, kids: dict[str, tuple[list, dict]], amid: bool = False) -> None:
    for i, kid in enumerate(node.kids):
        if kid.tag:
            if kid.tag not in kids:
                kids[kid.tag] = [kid.tag, 1, {}, [], []], {}
                tree[3].append(kids[kid.tag][0])
            sub, below = kids[kid.tag]
            _grow(sub, kid, below, amid and kid.tag in _INLINE or _amid(node, i))
        elif node.tag not in _NO_LEAVES:
            for *_, leaf in leaves(node, i, amid):
                if leaf:
                    tree[2][leaf] = 1  # once a page


def tree_match(a: list, b: list) -> tuple[int, list[tuple[int, int]]]:
    """Simple tree matching: (size of the greatest order-keeping matching, matched pairs of children)."""
    if a[0] != b[0]:
        return 0, []
    m, n = len(a[3]), len(b[3])
    if not m or not n:
        return 1, []
    w = [[0] * (n + 1) for _ in range(m + 1)]
    score = [[tree_match(x, y)[0] for y in b[3]] for x in a[3]]
    for i in range(1, m + 1):
        for j in range(1, n + 1):
            w[i][j] = max(w[i - 1][j], w[i][j - 1], w[i - 1][j - 1] + score[i - 1][j - 1])
    pairs, i, j = [], m, n
    while i and j:
        if score[i - 1][j - 1] and w[i][j] == w[i - 1][j - 1] + score[i - 1][j - 1]:
            pairs.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif w[i][j] == w[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return 1 + w[m][n], pairs[::-1]


def _count(into: dict[str, int], more: dict[str, int]) -> None:
    for k, v in more.items():
        into[k] = into.get(k, 0) + v


def merge(into: list, tree: list, seen: dict | None = None) -> None:
    """Aligns `tree` to the wrapper `into`; matched nodes add up, unmatched ones become optional nodes.

    A node of a page has one child per tag, so a wrapper is bounded by the tags and their orders, not by the number of pages.
    """
    into[1] += tree[1]
    into[4] += tree[4]
    _count(into[2], tree[2])
    if not tree[3]:
        return
    shape = None
    if seen is not None:
        shape = (id(into), len(into[3]), _shape(tree))
    pairs = seen.get(shape) if shape else None
    if pairs is None:
        pairs = tree_match(into, tree)[1]
        if shape:
            seen[shape] = pairs
    taken = {j: i for i, j in pairs}
    fresh = []
    for j, kid in enumerate(tree[3]):
        if j in taken:
            merge(into[3][taken[j]], kid, seen)
        else:
            fresh.append(kid)
    into[3].extend(fresh)


def _shape(tree: list) -> tuple:
    return (tree[0], *(_shape(k) for k in tree[3]))


_WRAPPER = T.StructType().add("host", T.StringType()).add("part", T.IntegerType()).add("wrapper", T.StringType())
#: Rows of two kinds: wrappers, and the pages that a leaf stands on in a node.
_FOLDED = T.StructType([*_WRAPPER, T.StructField("node", T.LongType()), T.StructField("leaf", T.StringType()), T.StructField("n", T.LongType())])
_NODES = T.StructType().add("host", T.StringType()).add("node", T.LongType()).add("path", T.StringType()).add("of", T.LongType())
#: Wrappers of one host that one task merges at a time.
_FANS = 16


def _drain(host: str, node: list, ids: Iterator[int], out: list[tuple]) -> None:
    """Moves the counters of a wrapper to `out`, giving an id to nodes that have none."""
    if not node[4]:
        node[4].append(next(ids))
    out.extend((host, None, None, node[4][0], leaf, n) for leaf, n in node[2].items())
    node[2].clear()
    for kid in node[3]:
        _drain(host, kid, ids, out)


def _fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    wrappers: dict[str, list] = {}
    seen: dict[str, dict] = {}
    ids = itertools.count(TaskContext.get().partitionId() << 32)
    for df in parts:
        for host, dom in zip(df["host"], df["dom"]):
            tree = _tree(from_json(json.loads(dom)))
            if host in wrappers:
                merge(wrappers[host], tree, seen.setdefault(host, {}))
            else:
                wrappers[host] = tree
        out: list[tuple] = []
        for host in df["host"].unique():
            _drain(host, wrappers[host], ids, out)
        yield _folded(out)
    yield _folded([(h, xxhash.xxh32_intdigest(w) % _FANS, w, None, None, None) for h, w in ((h, json.dumps(w)) for h, w in wrappers.items())])


def _folded(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_FOLDED.names).astype({"part": "Int32", "node": "Int64", "n": "Int64"})


def _merged(wrappers: list[str]) -> list:
    out, seen = None, {}
    for w in sorted(wrappers):
        if out is None:
            out = json.loads(w)
        else:
            merge(out, json.loads(w), seen)
    return out


def _nodes(host: str, wrapper: list) -> list[tuple]:
    """(host, id, path of tags, pages) of each id that a node of the wrapper had.

    Siblings that cross between pages stand in the wrapper several times; as a page has one node of a path, they are one node here.
    """
    pages: dict[str, int] = {}
    ids: list[tuple[int, str]] = []

    def walk(node: list, path: str) -> None:
        pages[path] = pages.get(path, 0) + node[1]
        ids.extend((i, path) for i in node[4])
        for kid in node[3]:
            walk(kid, f"{path}/{kid[0]}")

    walk(wrapper, wrapper[0])
    return [(host, i, path, pages[path]) for i, path in ids]


def induce(doms: DataFrame, share: float, pages: int) -> DataFrame:
    """(host, path, leaf) of the template, from rows (host, dom): leaves that stand on at least `pages` pages and at least `share` of those
    with their node. Wrappers are folded within partitions and merged across them in two steps; the leaves of a node are counted in full."""

    def some(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [key[0]], "part": [0], "wrapper": [json.dumps(_merged(list(part["wrapper"])))]})

    def last(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_nodes(key[0], _merged(list(part["wrapper"]))), columns=_NODES.names)

    folded = cut(doms.mapInPandas(_fold, _FOLDED))
    wrappers = folded.filter("wrapper is not null").select(*_WRAPPER.names)
    nodes = wrappers.groupBy("host", "part").applyInPandas(some, _WRAPPER).groupBy("host").applyInPandas(last, _NODES)
    counted = folded.filter("leaf is not null").select("host", "node", "leaf", "n").join(nodes, ["host", "node"]).groupBy("host", "path", "of", "leaf").agg(F.sum("n").alias("n"))
    return counted.filter((F.col("n") >= pages) & (F.col("n") >= share * F.col("of"))).select("host", "path", "leaf")


_CLEAN = T.StructType().add("text", T.StringType()).add("marks", T.IntegerType())
_DOM = T.StructType().add("dom", T.StringType()).add("marks", T.IntegerType())


@F.pandas_udf(_DOM)
def _parse(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in parts:
        out = []
        for t in texts:
            dom, marks = parse(t)
            out.append((json.dumps(to_json(dom), ensure_ascii=False) if marks else None, marks))
        yield pd.DataFrame(out, columns=_DOM.names)


def parsed(df: DataFrame, text: str, whole: bool = True) -> DataFrame:
    """The rows of `df` that may hold markup with the struct `__dom` (dom, marks), written once; without `whole` only those that do, and without their text."""
    out = df.filter(F.col(text).rlike(HINT)).withColumn("__dom", _parse(F.col(text)))
    return cut(out if whole else out.filter("__dom.marks > 0").drop(text))


def rendered(marked: DataFrame, host: str, share: float, pages: int):
    """A column: the DOM of `__dom` as clean text without the template of its host, which is induced over all rows of `marked`."""
    name = F.coalesce(F.col(host).cast("string"), F.lit(""))
    template: dict[str, dict[str, set[str]]] = {}
    for r in induce(marked.filter("__dom.marks > 0").select(name.alias("host"), "__dom.dom"), share, pages).collect():
        template.setdefault(r["host"], {}).setdefault(r["path"], set()).add(r["leaf"])

    @F.pandas_udf(T.StringType())
    def render_all(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for doms, hosts in parts:
            yield pd.Series([None if d is None else render(from_json(json.loads(d)), template.get(h, _NONE)) for d, h in zip(doms, hosts)], dtype=object)

    return render_all(F.col("__dom.dom"), name)


#: A leaf is template from this share of the pages with its node, and this number of pages, on.
SHARE, PAGES = 0.005, 30


def clean_markup(df: DataFrame, text: str, host: str, into: str = "clean", share: float = SHARE, pages: int = PAGES) -> DataFrame:
    """Adds the struct `into` (text, marks): clean text and the number of marks found; nulls for null, text unchanged where none.

    Every text is parsed once, and wrappers are induced over all rows with marks. What comes back to the driver are the template
    leaves of the hosts: at most 1 / `share` times the leaves that a page has in a node, whatever the number of rows. Empty and very long texts, unclosed marks,
    deeply nested ones and marks encoded several times are legal.
    """
    marked = parsed(df, text)
    new = rendered(marked, host, share, pages)
    done = marked.withColumn(into, F.struct(F.coalesce(new, F.col(text)).alias("text"), F.col("__dom.marks").alias("marks"))).drop("__dom")
    plain = df.filter(~F.coalesce(F.col(text).rlike(HINT), F.lit(False)))
    return done.unionByName(plain.withColumn(into, F.struct(F.col(text).alias("text"), F.when(F.col(text).isNotNull(), F.lit(0)).alias("marks"))))


def found(papers: DataFrame) -> DataFrame:
    """Papers rows whose abstract contains markup: paper_row. The text that remains of it is made as well, so that a row whose clean
    text could not be built would not be reported."""
    marked = parsed(papers.select("paper_row", "source", "abstract"), "abstract", whole=False)
    return marked.filter(rendered(marked, "source", SHARE, PAGES).isNotNull()).select("paper_row")


def cleaned(papers: DataFrame) -> DataFrame:
    """Every abstract as clean text: paper_row, clean_text, marks."""
    return clean_markup(papers.select("paper_row", "source", "abstract"), "abstract", "source").select("paper_row", F.col("clean.text").alias("clean_text"), "clean.marks")
