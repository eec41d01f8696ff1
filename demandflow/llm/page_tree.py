"""Pages as trees of blocks, and the alignment of such trees."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:\"[^\"]*\"|'[^']*'|(?=[^\"'])))*+>|[^>]*(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in "script style textarea title xmp iframe noembed noframes".split()}
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr picture q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
# Elements whose repetitions are one slot of a template, whatever is in them.
FLOW = set("p li dt dd tr td th h1 h2 h3 h4 h5 h6 blockquote pre figcaption option".split())
# A start tag ends an open element of the first set, up to the nearest one of the second.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}), "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}), "option": ({"option"}, {"select"}),
    **{f"h{k}": ({f"h{j}" for j in range(1, 7)}, {"td", "th", "li"}) for k in range(1, 7)},
}
KEEPS_P = set("table td th caption button object".split())
DEPTH = 100
REPEATS = 8

# Parts of a page by tag, role, and words of class and id. WEAK words do not count beside a CONTENT word
# ("post-header"), BESIDE words not where the name says that they stand next to it ("with-sidebar").
DROPPED_TAGS = set(
    "nav footer aside form script style noscript template iframe svg canvas audio video object select option button textarea "
    "head title dialog menu".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
STRONG = set(
    "nav navigation masthead copyright ad ads adsense consent gdpr subscribe subscription disqus reply replies respond share sharing "
    "social related recommended breadcrumb breadcrumbs pagination pager popup modal login signup notice notices notification alert "
    "promo promotion widget widgets".split()
)
STRONG_STARTS = ("advert", "comment", "cookie", "footer", "menu", "navbar", "newsletter", "sponsor")
STRONG_ENDS = ("nav", "menu", "footer")
NOT_STRONG = {"commentary"}
BESIDE, NEXT_TO = {"sidebar", "sidebars", "aside", "rail"}, {"with", "has", "no", "without", "layout"}
WEAK = set("header head topbar banner side search form hidden".split())
CONTENT = set("article post entry story content body text".split())


def names_a_part(words: set[str], tag: str) -> bool:
    """Whether words of class and id tell that an element is not of the article."""
    for word in words - NOT_STRONG:
        if word in STRONG or word.startswith(STRONG_STARTS) or word.endswith(STRONG_ENDS):
            return True
    if words & BESIDE and not words & NEXT_TO:
        return True
    return bool(words & WEAK) and not words & CONTENT and tag != "article"


class Node:
    __slots__ = ("tag", "label", "children", "outline", "number", "dropped")

    def __init__(self, tag: str, label: str, dropped: bool):
        self.tag, self.label, self.dropped, self.children, self.outline, self.number = tag, label, dropped, [], None, 0


MATTERS = re.compile(r"\b(?:class|id|role|hidden|aria-hidden|style)\b", re.I)


def label_of(tag: str, attributes: str) -> tuple[str, bool]:
    return _label_of(tag, attributes if MATTERS.search(attributes) else "")


@lru_cache(maxsize=4096)
def _label_of(tag: str, attributes: str) -> tuple[str, bool]:
    """Tag with the letters of class and id, and whether these name a part that is not the article."""
    dropped, names = tag in DROPPED_TAGS, []
    if len(attributes) > 2:
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id"):
                names += re.sub(r"[^a-zA-Z\s_-]+", "", value).split()
            elif name == "role":
                dropped |= value.lower() in DROPPED_ROLES
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                dropped = True
            elif name == "style":
                dropped |= "display:none" in value.replace(" ", "").lower()
    label = ".".join([tag, *sorted(set(names))])
    if names and tag != "main":
        words = {w.lower() for n in names for w in re.findall(r"[A-Z]?[a-z]+|[A-Z]+", n)}
        dropped |= names_a_part(words, tag)
    return label + "!" * dropped, dropped


class Page:
    """Blocks of a page in order, each with its node; nodes are numbered by their place in ``shape``,
    the page's outline in which repeated elements count once."""

    def __init__(self, source: str):
        self.root, self.blocks = Node("", "page", False), []
        self.stack, self.unnested, self.pieces, self.links, self.in_link = [self.root], Counter(), [], 0, False
        self._read(source)
        self.shape, self.size, _ = self.root.outline = _outline([self.root])
        _number([self.root], self.root.outline, 0)

    def _read(self, source: str) -> None:
        at, end = 0, len(source)
        while at < end:
            found = TOKEN.search(source, at)
            if found is None:
                break
            if found.start() > at:
                self._text(source[at : found.start()])
            at = found.end()
            tag = (found[2] or "").lower()
            if not tag:
                continue
            if found[1]:
                self._end(tag)
                continue
            if tag in RAW:
                self._start(tag, found[3])
                close = RAW[tag].search(source, at)
                at = close.end() if close else end
                self._end(tag)
            else:
                self._start(tag, found[3])
        if at < end:
            self._text(source[at:])
        self._flush()

    def _text(self, text: str) -> None:
        text = html.unescape(text) if "&" in text else text
        self.pieces.append(text)
        if self.in_link:
            self.links += len(text)

    def _flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append((self.stack[-1], text, min(self.links, len(text))))
            self.pieces, self.links = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.in_link = True
        if tag in ("html", "body") or tag in VOID:
            if tag in ("br", "hr"):
                self._text(" ")
            return
        label, dropped = label_of(tag, attributes)
        if tag in INLINE and not dropped:
            self.unnested[tag] += any(n.tag == tag for n in self.stack)
            return
        self._flush()
        if tag not in INLINE:
            self._close({"p"}, KEEPS_P)
        if tag in ENDS:
            self._close(*ENDS[tag])
        if len(self.stack) >= DEPTH:
            self.unnested[tag] += 1
            return
        node = Node(tag, label, dropped)
        self.stack[-1].children.append(node)
        self.stack.append(node)

    def _close(self, tags: set, stop: set) -> None:
        for k in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[k].tag
            if tag in tags:
                del self.stack[k:]
                return
            if tag in stop:
                return

    def _end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        if tag in VOID or tag in ("html", "body"):
            return
        if tag in INLINE and not any(n.tag == tag for n in self.stack):
            return
        if self.unnested[tag]:
            self.unnested[tag] -= 1
            if tag not in INLINE:
                self._flush()
            return
        self._flush()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return


def _outline(nodes: list[Node]) -> tuple[str, int, list]:
    """(written outline, number of slots, groups of children that share a slot)."""
    slots: dict[str, list[Node]] = {}
    same = Counter()
    for child in (c for n in nodes for c in n.children):
        if child.tag in FLOW:
            slots.setdefault(child.label, []).append(child)
        else:
            child.outline = _outline([child])
            same[child.outline[0]] += 1
            slots.setdefault(f"{child.outline[0]} {same[child.outline[0]]}", []).append(child)
    often = {text for text, n in same.items() if n > REPEATS}
    groups, met = [], {}
    for members in slots.values():
        text = members[0].outline[0] if members[0].outline else None
        if text in often:
            if text in met:
                met[text] += members
                continue
            met[text] = members
        groups.append(members)
    shown, size, parts = [], 1, []
    for members in groups:
        inner = members[0].outline or _outline(members)
        shown.append(inner[0])
        parts.append((members, inner, size))
        size += inner[1]
    text = nodes[0].label + (f"({' '.join(shown)})" if shown else "")
    return text, size, parts


def _number(nodes: list[Node], outline: tuple, first: int) -> None:
    for node in nodes:
        node.number = first
    for members, inner, at in outline[2]:
        if members[0].outline:
            for member in members:
                _number([member], member.outline, first + at)
        else:
            _number(members, inner, first + at)


class Tree:
    """An outline read back: labels and children by number, in the order of ``shape``."""

    def __init__(self, shape: str):
        self.labels, self.kids, self.parents = [], [], []
        path: list[int] = []
        for token in re.findall(r"[^() ]+|[()]", shape):
            if token == "(":
                path.append(len(self.labels) - 1)
            elif token == ")":
                path.pop()
            else:
                self.parents.append(path[-1] if path else -1)
                if path:
                    self.kids[path[-1]].append(len(self.labels))
                self.labels.append(token)
                self.kids.append([])


def tree_matching(a: Tree, b: Tree) -> dict[int, int]:
    """Simple tree matching: the largest set of node pairs with equal labels, matched parents and the
    order of siblings kept; number in ``a`` -> number in ``b``."""
    sizes: dict[tuple[int, int], tuple[int, list]] = {}

    def match(i: int, j: int) -> tuple[int, list]:
        if a.labels[i] != b.labels[j]:
            return 0, []
        if (i, j) not in sizes:
            x, y = a.kids[i], b.kids[j]
            if [a.labels[k] for k in x] == [b.labels[k] for k in y] and len({a.labels[k] for k in x}) == len(x):
                pairs = list(zip(x, y))
            else:
                pairs = _sequence(x, y, match)
            sizes[i, j] = 1 + sum(match(*p)[0] for p in pairs), pairs
        return sizes[i, j]

    found, open_pairs = {}, [(0, 0)] if match(0, 0)[0] else []
    while open_pairs:
        i, j = open_pairs.pop()
        found[i] = j
        open_pairs += match(i, j)[1]
    return found


def _sequence(x: list[int], y: list[int], match) -> list[tuple[int, int]]:
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(len(y) - 1, -1, -1):
            row[j] = max(below[j], row[j + 1], below[j + 1] + match(x[i], y[j])[0])
    i, j, pairs = 0, 0, []
    while i < len(x) and j < len(y):
        size = match(x[i], y[j])[0]
        if size and best[i][j] == best[i + 1][j + 1] + size:
            pairs.append((x[i], y[j]))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return pairs
