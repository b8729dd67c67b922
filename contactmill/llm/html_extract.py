"""HTML extraction: a tree-structured graphical model over the DOM decides what is main text.

Every element of a page is a binary variable, content or not. Its own potential is a log-linear
function of tag, class and id words, link density and text length; a potential for each edge
between parent and child depends on the kind of the child. Sum-product message passing, once from
the leaves upward and once downward, gives every element's exact content marginal. Text of an
element with a marginal above one half is main text.

Both potentials are trained from labelled pages. The tables have none, so a seeded generator makes
pages of many layouts whose labels are known from their making (`labelled_pages`); others can be
given to `train`.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactmill.session import bounded_batches

# Names of HTML elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Up to their end tag these hold no elements, and nothing of them is shown as text of the page.
RAW = frozenset("script style textarea title template noscript iframe xmp noembed noframes".split())
#: Everything else stands within a line.
BLOCK = frozenset(
    "html head body address article aside blockquote caption center col colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr legend li listing main menu nav ol p "
    "plaintext pre search section summary table tbody td tfoot th thead tr ul".split()
)
SECTION = frozenset("html body div section article main nav aside header footer form table center fieldset".split())
#: An opening tag of the key closes these, if open within the nearest section; any other block closes a paragraph.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
#: One attribute: a name and, after an equals sign, a value in quotes or up to white space.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"'][^\s>]*+)|(["'])|))?)?""")
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    hints: tuple[str, ...] = ()
    own: int = 0  # characters of text directly inside
    text: int = 0  # characters of text in the subtree
    linked: int = 0  # of them within links
    stops: int = 0  # sentence ends directly inside
    children: int = 0
    share: int = 0  # fifths of the page's text that the subtree has


@dataclass
class Page:
    """nodes, parents before children; pieces: (node, text) in page order, node -1 for a block's end."""

    nodes: list[Node] = field(default_factory=list)
    pieces: list[tuple[int, str]] = field(default_factory=list)


class _Tokens:
    """Tags and texts of a page by the tokenizer states of the HTML standard, in one pass.

    Where the standard drops the rest of a page (an end that never comes: of a quote, a raw element
    other than script and style, or a tag), what is unfinished is passed over instead."""

    def __init__(self, source: str):
        self.source, self.size = source, len(source)
        self.last = {c: source.rfind(c) for c in "\"'>"}
        self.unended: set[str] = set()  # raw elements without an end tag from here on

    def attributes(self, pos: int) -> tuple[int, str, bool]:
        """(where the tag ends, the words of class, id and role, whether it closes itself)."""
        source, hints = self.source, []
        while True:
            m = _ATTRIBUTE.match(source, pos)
            if m.group(5):  # an open quote: the value ends where the tag seems to
                end = source.find(">", m.end())
                return (self.size if end < 0 else end + 1), " ".join(hints), False
            if m.group(1) and m.group(1).lower() in ("class", "id", "role"):
                hints.append(next(filter(None, m.group(2, 3, 4)), ""))
            pos = m.end()
            if pos >= self.size:
                return self.size, " ".join(hints), False
            if source[pos] == ">":
                return pos + 1, " ".join(hints), source[pos - 1] == "/" and not m.group(1)

    def raw_end(self, tag: str, pos: int) -> int | None:
        """The place after the end tag of a raw element; None if it has none."""
        if tag not in self.unended:
            m = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(self.source, pos)
            if m:
                return m.end()
            self.unended.add(tag)
        return None

    def __iter__(self):
        """(text, "", "", False) or ("", name or /name, hints, closes itself)."""
        source, size, pos, begin = self.source, self.size, 0, 0
        foreign = 0  # svg and math: elements may close themselves, and no content is raw
        while True:
            pos = source.find("<", pos)
            if pos < 0:
                break
            after = source[pos + 1 : pos + 2]
            ending = after == "/"
            name = _NAME.match(source, pos + 1 + ending)
            if not name and not (after in ("!", "?") or ending and pos + 2 < size) or not after:
                pos += 1  # a lone < is text
                continue
            if begin < pos:
                yield source[begin:pos], "", "", False
            if not name:
                if source.startswith("<!--", pos):
                    # <!--> and <!---> are whole comments
                    m = re.compile(r"-?>|.*?(?:--!?>|\Z)", re.S).match(source, pos + 4)
                    pos = begin = m.end()
                else:
                    end = source.find(">", pos) if pos < self.last[">"] else -1
                    pos = begin = size if end < 0 else end + 1
                continue
            tag = name.group().lower()
            end, hints, closed = self.attributes(name.end())
            pos = begin = end
            if ending:
                foreign = max(0, foreign - (tag in ("svg", "math")))
                yield "", "/" + tag, "", False
                continue
            if tag in ("svg", "math") and not closed:
                foreign += 1
            elif tag in RAW and (not foreign or tag in ("script", "style")):
                stop = None if closed and foreign else self.raw_end(tag, pos)
                if stop is not None or tag in ("script", "style") and not (closed and foreign):
                    pos = begin = size if stop is None else stop
                continue
            yield "", tag, hints, closed and (foreign > 0 or tag in ("svg", "math"))
        if begin < size:
            yield source[begin:], "", "", False


def parse(source: str) -> Page:
    """The element tree of tag soup, with end tags implied as browsers do for the common cases."""
    page = Page([Node("#root", -1)])
    nodes, pieces = page.nodes, page.pieces
    stack = [0]
    opened: Counter = Counter()
    drawing = 0  # open svg elements: their text is no text of the page

    def text(piece: str) -> None:
        piece = html.unescape(piece) if "&" in piece else piece
        if not piece.isspace():
            at = stack[-1]
            nodes[at].own += len(piece)
            nodes[at].stops += piece.count(". ") + piece.count("! ") + piece.count("? ") + (piece.rstrip()[-1:] in ".!?")
            pieces.append((at, piece))
        else:
            pieces.append((stack[-1], " "))

    def close(depth: int) -> None:
        nonlocal drawing
        while len(stack) > depth:
            tag = nodes[stack.pop()].tag
            opened[tag] -= 1
            drawing -= tag == "svg"
            if tag in BLOCK:
                pieces.append((-1, ""))

    for piece, tag, given, closed in _Tokens(source):
        if not tag:
            if not drawing:
                text(piece)
            continue
        if tag[0] == "/":
            tag = tag[1:]
            if opened[tag] and tag not in ("html", "body"):
                depth = len(stack) - 1
                while nodes[stack[depth]].tag != tag:
                    depth -= 1
                close(depth)
            continue
        if tag == "br":
            pieces.append((stack[-1], " "))
            continue
        closes = CLOSES.get(tag, ("p",) if tag in BLOCK else ())
        if any(opened[c] for c in closes):
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag in closes:
                    close(depth)
                    break
                if open_tag in SECTION or open_tag in ("ul", "ol", "dl", "td", "th") and open_tag not in closes:
                    break
        if tag in ("html", "body") and opened[tag]:
            continue
        if tag in BLOCK:
            pieces.append((-1, ""))
        if tag in VOID or closed:
            continue
        hints: tuple[str, ...] = ()
        if given:
            hints = tuple(dict.fromkeys(_WORD.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", given).lower())))
        nodes[stack[-1]].children += 1
        nodes.append(Node(tag, stack[-1], hints))
        stack.append(len(nodes) - 1)
        opened[tag] += 1
        drawing += tag == "svg"
    for i in range(len(nodes) - 1, -1, -1):
        node = nodes[i]
        node.text += node.own
        if node.tag == "a":
            node.linked = node.text
        if node.parent >= 0:
            above = nodes[node.parent]
            above.text += node.text
            above.linked += node.linked
    for node in nodes:
        node.share = min(4, node.text * 5 // max(1, nodes[0].text))
    return page


def kind(tag: str) -> int:
    """The kind of a child that its edge potential depends on."""
    return 2 if tag in SECTION else 1 if tag in BLOCK else 0


def features(node: Node) -> list[str]:
    """Names of an element's features; each has the value 1."""
    out = ["bias", f"tag:{node.tag}"]
    out += [f"hint:{w}" for w in node.hints]
    if node.text:
        out.append(f"links:{min(4, node.linked * 5 // node.text)}")
        out.append(f"size:{min(12, node.text.bit_length())}")
    else:
        out.append("size:0")
    # what has most of the page's text, and little of it in links, is seldom beside the article
    out.append(f"share:{node.share}" if node.linked * 2 < node.text else "share:links")
    out.append(f"own:{min(10, node.own.bit_length())}")
    out.append(f"stops:{min(4, node.stops)}")
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    #: edge[kind of child][label of parent][label of child], as logarithms
    edge: tuple

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Log-odds of the content marginals, by sum-product upward and downward."""
        weights, n = self.weights, len(nodes)
        up = [sum(weights.get(f, 0.0) for f in features(node)) for node in nodes]
        sent = [0.0] * n
        kinds = [kind(node.tag) for node in nodes]
        factors = [[[math.exp(x) for x in row] for row in table] for table in self.edge]
        for i in range(n - 1, 0, -1):
            e = math.exp(min(50.0, max(-50.0, up[i])))
            t = factors[kinds[i]]
            sent[i] = math.log((t[1][0] + t[1][1] * e) / (t[0][0] + t[0][1] * e))
            up[nodes[i].parent] += sent[i]
        belief = up
        for i in range(1, n):
            rest = belief[nodes[i].parent] - sent[i]
            e = math.exp(min(50.0, max(-50.0, rest)))
            t = factors[kinds[i]]
            belief[i] += math.log((t[0][1] + t[1][1] * e) / (t[0][0] + t[1][0] * e))
        return belief

    def extract(self, source: str | None) -> str:
        """The main text of a page: blocks in page order, one on each line."""
        if not source:
            return ""
        page = parse(source)
        belief = self.marginals(page.nodes)
        blocks, now = [], []
        for at, piece in [*page.pieces, (-1, "")]:
            if at < 0:
                if now:
                    block = " ".join("".join(now).split())
                    if block:
                        blocks.append(block)
                    now = []
            elif belief[at] > 0:
                now.append(piece)
        return "\n".join(blocks)


# ----------------------------------------------------------------- training


def train(pages: Iterable[tuple[str, list[int]]], rounds: int = 160, decay: float = 1e-4) -> Model:
    """A model from (html, label of each element in page order) pairs.

    Gradient ascent on the likelihood of the labels under the whole model. The gradient is what the
    labels have of each feature, and of each pair of labels on the edges of a kind, less what the
    marginals expect; those come from the same sum-product passes, over all pages as one forest,
    level by level.
    """
    names: dict[str, int] = {}
    rows, columns, known, parent, depth, kinds = [], [], [], [], [], []
    for source, labels in pages:
        nodes, base = parse(source).nodes, len(known)
        assert len(nodes) == len(labels), (len(nodes), len(labels))
        for i, node in enumerate(nodes):
            for f in features(node):
                rows.append(base + i)
                columns.append(names.setdefault(f, len(names)))
            known.append(labels[i])
            kinds.append(kind(node.tag))
            parent.append(base + node.parent if i else -1)
            depth.append(depth[base + node.parent] + 1 if i else 0)
    rows, columns, y = np.array(rows), np.array(columns), np.array(known)
    parent, depth, kinds = np.array(parent), np.array(depth), np.array(kinds)
    child = np.flatnonzero(depth)
    levels = [np.flatnonzero(depth == d) for d in range(1, depth.max() + 1)]
    pair = kinds[child] * 4 + y[parent[child]] * 2 + y[child]
    seen = np.bincount(pair, minlength=12).reshape(3, 2, 2).astype(float)
    share = (seen + 1) / (seen + 1).sum((1, 2), keepdims=True)
    edge = np.log(share / (share.sum(2, keepdims=True) * share.sum(1, keepdims=True)))
    w, speed, edge_speed = np.zeros(len(names)), np.full(len(names), 1e-8), np.full((3, 2, 2), 1e-8)

    def through(x, given_0, given_1):
        """log-odds message of a log-odds x over an edge; given_k: potentials (other 0, other 1) for k."""
        return np.logaddexp(given_1[0], given_1[1] + x) - np.logaddexp(given_0[0], given_0[1] + x)

    for _ in range(rounds):
        up = np.bincount(rows, w[columns], len(y))
        sent = np.zeros(len(y))
        for at in reversed(levels):
            t = edge[kinds[at]].transpose(1, 2, 0)  # [label of parent, label of child, element]
            sent[at] = through(up[at], t[0], t[1])
            np.add.at(up, parent[at], sent[at])
        belief = up.copy()
        for at in levels:
            t = edge[kinds[at]].transpose(2, 1, 0)  # [label of child, label of parent, element]
            belief[at] += through(belief[parent[at]] - sent[at], t[0], t[1])
        marginal = 1 / (1 + np.exp(-np.clip(belief, -50, 50)))
        slope = np.bincount(columns, (marginal - y)[rows], len(w)) / len(y) + decay * w
        rest = belief[parent[child]] - sent[child]
        logits = edge[kinds[child]].copy()
        logits[:, 1, :] += rest[:, None]
        logits[:, :, 1] += up[child][:, None]
        logits -= logits.max((1, 2), keepdims=True)
        expected = np.exp(logits)
        expected /= expected.sum((1, 2), keepdims=True)
        total = np.stack([expected[kinds[child] == k].sum(0) for k in range(3)])
        edge_slope = (total - seen) / len(y) + decay * edge
        speed += slope**2
        w -= 0.4 * slope / np.sqrt(speed)
        edge_speed += edge_slope**2
        edge = edge - 0.2 * edge_slope / np.sqrt(edge_speed)
    return Model({f: float(w[i]) for f, i in names.items()}, tuple(tuple(map(tuple, t)) for t in edge.tolist()))


# Class and id words of the generated pages, by what the element is for.
_NAMES = {
    "menu": "nav menu navbar navigation topnav breadcrumb breadcrumbs pagination pager tabs toc links sitemap",
    "header": "header masthead top topbar banner branding logo site-header page-header",
    "footer": "footer bottom colophon site-footer copyright legal imprint credits",
    "sidebar": "sidebar aside side rail widget widgets related recommended popular trending archive tags sticky",
    "notice": "cookie cookies consent notice alert gdpr banner popup modal overlay disclaimer warning message paywall",
    "advert": "ad ads advert adverts advertisement sponsor sponsored promo promotion teaser banner adbox commercial",
    "form": "form search login signup subscribe newsletter contact register poll feedback",
    "comments": "comments comment comment-list reply replies discussion respond reader-comments feedback thread disqus",
    "share": "share social sharing follow buttons tools meta byline print",
    "main": "article content main post entry story body text page-content post-body article-body entry-content",
}
_TAGS = {
    "menu": ["nav", "div", "ul"],
    "header": ["header", "div"],
    "footer": ["footer", "div"],
    "sidebar": ["aside", "div", "section"],
    "notice": ["div", "section", "aside"],
    "advert": ["div", "aside", "section"],
    "form": ["form"],
    "comments": ["section", "div"],
    "share": ["div"],
}


class _Maker:
    """Writes one page and the labels of its elements."""

    def __init__(self, rng: random.Random):
        self.rng, self.out, self.labels = rng, [], [1]

    def words(self, lo: int, hi: int) -> str:
        letters = "etaoinshrdlucmfwypvbg"
        made = ["".join(self.rng.choices(letters, k=self.rng.randint(2, 9))) for _ in range(self.rng.randint(lo, hi))]
        for i in range(self.rng.randint(6, 12), len(made), 11):
            made[i] += self.rng.choice([".", ".", ",", "!"])
        return " ".join(made).capitalize()

    def open(self, tag: str, label: int, attributes: str = "") -> None:
        self.out.append(f"<{tag}{attributes}>")
        self.labels.append(label)

    def element(self, tag: str, label: int, text: str, attributes: str = "") -> None:
        self.open(tag, label, attributes)
        self.out.append(text + f"</{tag}>")

    def named(self, role: str) -> str:
        if self.rng.random() < 0.2:
            return ""
        key = self.rng.choice(["class", "id", "class"])
        return f' {key}="{self.rng.choice(_NAMES[role].split())}"'

    def prose(self, label: int, lo: int, hi: int) -> None:
        rng = self.rng
        for _ in range(rng.randint(lo, hi)):
            pick = rng.random()
            if pick < 0.7:
                self.open("p", label)
                self.out.append(self.words(2, rng.choice([8, 30, 120, 200])))
                if rng.random() < 0.2:
                    self.element(rng.choice(["a", "b", "em", "span"]), label, self.words(1, 4))
                    self.out.append(self.words(2, 20))
                self.out.append(rng.choice(["</p>", "</p>", "</p>", "\n"]))
            elif pick < 0.76:
                self.open("p", label)
                self.open("b", label)
                self.out.append(self.words(2, 40) + "<br>")
            elif pick < 0.84:
                self.element(rng.choice(["h2", "h3"]), label, self.words(1, 7))
            elif pick < 0.92:
                self.open(rng.choice(["ul", "ol"]), label)
                list_tag = self.out[-1][1:-1]
                for _ in range(rng.randint(1, 5)):
                    self.element("li", label, self.words(1, 14))
                self.out.append(f"</{list_tag}>")
            elif pick < 0.96:
                self.element(rng.choice(["blockquote", "pre", "div"]), label, self.words(4, 40))
            else:
                for tag in ("table", "tr"):
                    self.open(tag, label)
                for _ in range(3):
                    self.element("td", label, self.words(1, 6))
                self.out.append("</tr></table>")

    def links(self) -> None:
        lists = self.rng.random() < 0.6
        if lists:
            self.open("ul", 0)
        for _ in range(self.rng.randint(2, 8)):
            if lists:
                self.open("li", 0)
            self.element("a", 0, self.words(1, 3), ' href="/x"')
            self.out.append("</li>" if lists else " ")
        if lists:
            self.out.append("</ul>")

    def beside(self, role: str) -> None:
        rng, tag = self.rng, self.rng.choice(_TAGS[role])
        self.open(tag, 0, self.named(role) if tag in ("div", "section", "ul") or rng.random() < 0.4 else "")
        if tag in ("div", "section", "ul") and "=" not in self.out[-1]:
            self.out[-1] = f'<{tag} class="{rng.choice(_NAMES[role].split())}">'
        if role in ("menu", "share"):
            self.links()
        elif role == "form":
            if rng.random() < 0.5:
                self.element("label", 0, self.words(1, 4))
            if rng.random() < 0.4:
                self.prose(0, 1, 1)
            self.out.append('<input name="q">')
            self.element("button", 0, self.words(1, 2))
        elif role == "comments":
            if rng.random() < 0.6:
                self.element(rng.choice(["h2", "h3"]), 0, self.words(1, 3))
            for _ in range(rng.randint(1, 6)):
                inner = rng.choice(["div", "article", "li", ""])
                if inner:
                    self.open(inner, 0, self.named("comments"))
                self.prose(0, 1, 2)
                if inner:
                    self.out.append(f"</{inner}>")
        else:
            if rng.random() < 0.4:
                self.out.append(self.words(2, 25))
            if rng.random() < 0.5:
                self.prose(0, 1, 3)
            if rng.random() < 0.4:
                self.links()
        self.out.append(f"</{tag}>")

    def frame(self) -> None:
        """The head, and sometimes no head, html or body at all."""
        rng = self.rng
        if rng.random() < 0.85:
            self.open("html", 1)
            if rng.random() < 0.8:
                self.out.append(f"<head><title>{self.words(2, 6)}</title><script>a('<p>')</script></head>")
                self.labels.append(0)
            self.open("body", 1)

    def plain(self) -> tuple[str, list[int]]:
        """A page of few elements: a menu of no to three links, paragraphs, a line below them."""
        rng = self.rng
        self.frame()
        links = rng.randint(0, 3)
        if links:
            tag = rng.choice(["nav", "nav", "div", "header"])
            self.open(tag, 0, self.named("menu") if tag == "nav" else f' class="{rng.choice(_NAMES["menu"].split())}"')
            for _ in range(links):
                self.element("a", 0, self.words(1, 3), ' href="/x"')
            self.out.append(f"</{tag}>")
        tag = rng.choice(["article", "main", "div", "section", ""])
        if tag:
            self.open(tag, 1, self.named("main") if rng.random() < 0.4 else "")
        if rng.random() < 0.5:
            self.element("h1", 1, self.words(1, 9))
        for _ in range(rng.randint(1, 7)):
            self.element("p", 1, self.words(*rng.choice([(1, 10), (6, 30), (30, 80), (80, 220)])))
        self.out.append(f"</{tag}>" if tag else "")
        if rng.random() < 0.5:
            tag = rng.choice(["footer", "footer", "div"])
            self.open(tag, 0, self.named("footer") if tag == "footer" else f' class="{rng.choice(_NAMES["footer"].split())}"')
            self.out.append(self.words(2, 14) + f"</{tag}>")
        return "".join(self.out), self.labels

    def page(self) -> tuple[str, list[int]]:
        rng, some = self.rng, lambda p: self.rng.random() < p
        if some(0.3):
            return self.plain()
        self.frame()
        wrappers = []
        for _ in range(rng.randint(0, 2)):
            self.open("div", 1, rng.choice([' id="page"', ' class="wrapper"', ' class="container"', ""]))
            wrappers.append("</div>")
        for role, p in (("notice", 0.25), ("header", 0.4), ("menu", 0.7), ("advert", 0.4), ("form", 0.15), ("sidebar", 0.25)):
            if some(p):
                self.beside(role)
        bare = some(0.1)
        tags = [] if bare else rng.choice([["article"], ["main"], ["main", "article"], ["div"], ["section"], ["div", "div"]])
        for tag in tags:
            self.open(tag, 1, self.named("main") if tag != "div" else f' class="{rng.choice(_NAMES["main"].split())}"')
        if some(0.6):
            self.element("h1", 1, self.words(2, 12))
        self.prose(1, 1, 4)
        for role, p in (("advert", 0.25), ("share", 0.2), ("notice", 0.1), ("sidebar", 0.1)):
            if some(p):
                self.beside(role)
        self.prose(1, 0, 8)
        if tags and some(0.2):
            self.beside("comments")
        self.out += [f"</{tag}>" for tag in reversed(tags)]
        for role, p in (("share", 0.2), ("comments", 0.35), ("sidebar", 0.35), ("form", 0.25), ("advert", 0.3), ("footer", 0.8), ("notice", 0.25)):
            if some(p):
                self.beside(role)
        return "".join(self.out + wrappers) + rng.choice(["</body></html>", ""]), self.labels


def labelled_pages(n: int, seed: int) -> list[tuple[str, list[int]]]:
    """n generated pages with the label of each element: 1 for main text, 0 for all else."""
    return [_Maker(random.Random(f"{seed}-{i}")).page() for i in range(n)]


#: Pages that the default model is trained from.
TRAINING_PAGES = 900


@lru_cache(maxsize=1)
def default_model() -> Model:
    return train(labelled_pages(TRAINING_PAGES, 11))


def extract(
    pages: DataFrame, html_col: str = "html", text_col: str = "text", model: Model | None = None
) -> DataFrame:
    """All columns of pages but html_col, and the main text in text_col ("" where there is none).

    Character references are decoded, white space inside a block becomes one space, blocks are
    trimmed and joined by a line feed in page order; empty blocks are left out. A null or empty page
    has no text. A page without any tags is one block of text. Repeated rows are kept. A column of
    pages called text_col is replaced. An empty table gives an empty result.
    """
    bounded_batches(pages.sparkSession)
    model = model or default_model()
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in pages.columns if c not in (html_col, text_col)]
    source = pages.select(*kept, F.col(html_col).alias(html_col))
    schema = source.select(*kept, F.lit("").alias(text_col)).schema

    def run(batches):
        for batch in batches:
            texts = [shared.value.extract(x) for x in batch.column(len(kept)).to_pylist()]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], [*kept, text_col])

    return source.mapInArrow(run, schema)
