r"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded so that choices on a path agree.

A page becomes a tree of its block elements (inline markup joins its block; scripts, styles, form controls and the head are
left out while parsing, all other text is left to the trees). Each node has features of itself and its subtree: tag, attribute tokens, text and link density, punctuation, depth,
siblings, ancestors, position. Trees boosted on logistic loss give the probability that the node holds main text. Decoding maximises the sum of
log-probabilities over all nodes under the rule that nothing under a dropped node is kept: a bottom-up pass compares, for
each node, dropping its whole subtree with keeping it and deciding each child for itself.

The model is trained on pages that `synthetic_pages` generates from a seed (TRAINING_PAGES of them), since no table labels the nodes of pages; it depends on
no input table. The text of kept nodes is cut into blocks at block elements; character references are decoded,
white space inside a block becomes one space, and blocks are joined by an empty line in page order.

Defined results: a null or empty html, or a page without main text, gives the empty string; rows may repeat; other columns are ignored; markup may be
unclosed, unbalanced or cut off anywhere; text that isn't inside any tag is a block of the body; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import html as _html
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_stage

# Fixed sets of element names.
BLOCKS = frozenset("html body div p h1 h2 h3 h4 h5 h6 article section main nav aside header footer ul ol li dl dt dd table caption thead tbody tfoot tr td th form fieldset legend blockquote pre figure figcaption address details summary center dialog menu hgroup search".split())
RAW = frozenset("script style title textarea xmp noembed noframes iframe".split())
HIDDEN = frozenset("head noscript template select button datalist".split())
#: What may stand in a head; anything else, and text, ends it. Elements that an unclosed form control doesn't reach into.
HEAD = frozenset("head html base basefont bgsound link meta noscript script style template title noframes".split())
BEYOND = BLOCKS - {"div", "p", "ul", "ol", "li"}
PARAGRAPH_ENDS = BLOCKS - {"html", "body"}
#: Of each name: what an open element of which names ends when it begins, and the containers beyond which it doesn't look.
IMPLIED = {"li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table"))}
TAGS = {name: k for k, names in enumerate(("p", "h1 h2 h3 h4 h5 h6", "div section center", "li dt dd", "ul ol dl", "article", "main", "nav menu", "aside", "header hgroup", "footer", "form fieldset search dialog", "table thead tbody tfoot tr td th caption", "blockquote pre figure figcaption", "html body")) for name in names.split()}
KINDS = 16
BOILERPLATE = frozenset("nav menu aside header footer form fieldset search dialog".split())

# Fixed word lists for class, id and role tokens.
AGAINST = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs "
    "header masthead topbar toolbar footer foot bottom copyright legal sidebar side aside rail widget widgets related recommended recommendations more popular trending teaser teasers "
    "comment comments commentlist reply replies respond discussion disqus cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup "
    "login signin register form search share sharing social follow tags tag taglist category categories pagination pager paging prev next byline author meta date time breadcrumbs skip hidden "
    "contentinfo complementary tools links print rating vote poll cart shop buy archive calendar feed rss".split()
)
FOR = frozenset("article post entry content main story body text page maincontent articlebody postbody blogpost news copy prose reader document lead paragraph hentry".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>|<[a-zA-Z!?/][^>]*+\Z", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PUNCTUATION = re.compile(r"[.!?;:,](?=\s|$)")


@functools.lru_cache(maxsize=50_000)
def _tokens(attributes: str) -> tuple[int, int]:
    """Numbers of tokens of class, id and role that speak against and for main text."""
    found: set[str] = set()
    for values in _ATTRIBUTE.findall(attributes):
        found.update(_SPLIT.split(_CAMEL.sub(r"\1 \2", "".join(values)).lower()))
    return sum(t in AGAINST for t in found), sum(t in FOR for t in found)


class Node:
    __slots__ = ("against", "anchor", "children", "depth", "index", "links", "name", "own", "pages_before", "paragraphs", "parent", "parts", "points", "pro", "tags", "text", "words")

    def __init__(self, name: str, parent: Node | None, attributes: str, before: int) -> None:
        self.name, self.parent, self.depth = name, parent, 0 if parent is None else parent.depth + 1
        self.against, self.pro = _tokens(attributes) if attributes else (0, 0)
        self.children: list[Node] = []
        self.parts: list[str | Node] = []
        self.text = self.links = self.words = self.points = self.own = self.paragraphs = 0
        self.tags = 1
        self.pages_before = before
        if parent is not None:
            parent.children.append(self)
            parent.parts.append(self)


def parse(page: str) -> Node:
    """The tree of block elements. parts of a node: its text pieces (references decoded)  and child nodes, in order."""
    root = Node("html", None, "", 0)
    stack = [root]
    at, anchors, hidden, seen, n, drawings = 0, 0, [], 0, len(page), 0
    open_: dict[str, list[int]] = defaultdict(list)  # of each name, where its open elements (but the root) stand in the stack
    inside: list[str] = []  # open blocks inside hidden elements, and how many there are of each name
    within: Counter[str] = Counter()

    def text(piece: str, coded: bool = True) -> None:
        nonlocal seen
        if hidden == ["head"] and piece.strip():
            hidden.clear()
        if hidden or not piece:
            return
        piece = _html.unescape(piece) if coded and "&" in piece else piece
        node = stack[-1]
        node.parts.append(piece)
        size = len(piece.strip())
        if size:
            node.own += size
            node.text += size
            node.words += len(piece.split())
            node.points += len(_PUNCTUATION.findall(piece))
            if anchors:
                node.links += size
            seen += size

    def close(depth: int) -> None:
        while len(stack) > depth:
            node = stack.pop()
            open_[node.name].pop()
            up = node.parent
            up.text += node.text
            up.links += node.links
            up.words += node.words
            up.points += node.points
            up.tags += node.tags
            up.paragraphs += node.paragraphs + (node.name == "p" and node.text > 0)

    def last(names: tuple[str, ...]) -> int:
        """Where the innermost open element of these names stands; 0 if none is open."""
        return max((open_[x][-1] for x in names if open_[x]), default=0)

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        slash, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if hidden == ["head"] and not slash and name not in HEAD:
            hidden.clear()
        if name == "svg" and not attributes.endswith("/"):
            drawings = max(drawings + (-1 if slash else 1), 0)
        if not slash and name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
            inner = page[at : n if end is None else end.start()]
            at = n if end is None else page.find(">", end.start()) + 1 or n
            if name == "xmp":  # shown as it stands, as a block of its own
                if not hidden:
                    stack.append(Node("pre", stack[-1], attributes, seen))
                    text(inner, False)
                    open_["pre"].append(len(stack) - 1)
                    close(len(stack) - 1)
            elif name == "title" and drawings:
                text(inner)
        elif name in HIDDEN and (name != "noscript" or hidden):
            if slash:
                if name in hidden:
                    del hidden[hidden.index(name) :]
                    inside.clear()
                    within.clear()
            elif not attributes.endswith("/"):
                hidden.append(name)
        elif name in BLOCKS:
            # A hidden element ends with an enclosing block; an unclosed form control also where a block begins that it can't hold.
            if name == "body":
                hidden.clear()
            elif hidden and slash and within[name]:
                gone = ""
                while gone != name:
                    gone = inside.pop()
                    within[gone] -= 1
            elif hidden and slash and open_[name]:
                hidden.clear()
            elif hidden and not slash and (hidden[-1] in ("select", "datalist") or hidden[-1] == "button" and name in BEYOND):
                while hidden and hidden[-1] in ("select", "datalist", "button"):
                    hidden.pop()
            if hidden:
                if not slash:
                    inside.append(name)
                    within[name] += 1
                continue
            inside.clear()
            within.clear()
            if slash:
                if open_[name]:
                    close(open_[name][-1])
                    anchors = 0
                continue
            if name == "html" or name == "body" and open_[name]:
                continue
            if name in PARAGRAPH_ENDS and open_["p"] and open_["p"][-1] > last(("td", "th", "table")):
                close(open_["p"][-1])
            if name in IMPLIED:
                ends, limits = IMPLIED[name]
                limit = last(limits)
                if name == "tr":  # a row ends all cells and rows of its table
                    found = [open_[x][k] for x in ends for k in [bisect.bisect(open_[x], limit)] if k < len(open_[x])]
                    if found:
                        close(min(found))
                elif last(ends) > limit:
                    close(last(ends))
            open_[name].append(len(stack))
            stack.append(Node(name, stack[-1], attributes, seen))
            anchors = 0
        elif name == "a":
            anchors = 0 if slash else 1
            stack[-1].tags += not slash
        elif name in ("br", "hr", "wbr", "input", "img"):
            if name != "wbr":
                text(" ")
            stack[-1].tags += 1
        else:
            stack[-1].tags += not slash
    close(1)
    return root


def _walk(root: Node) -> list[Node]:
    out, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        node.index = len(out)
        out.append(node)
        waiting.extend(reversed(node.children))
    return out


FEATURES = KINDS + 21


def node_features(nodes: list[Node]) -> list[list[float]]:
    """A row for each node, ancestors before descendants."""
    root = nodes[0]
    whole = max(root.text, 1)
    inherited: list[tuple[int, int, int, int]] = []
    alike: dict[int, tuple[Counter, dict[int, int]]] = {}
    for node in nodes:
        if node.children:
            alike[node.index] = Counter(x.name for x in node.children), {x.index: k for k, x in enumerate(node.children)}
    rows = []
    for node in nodes:
        up = node.parent
        against, pro, good, bad = (0, 0, 0, 0) if up is None else inherited[up.index]
        same = before = 0
        if up is not None:
            names, places = alike[up.index]
            same, before = names[node.name], places[node.index]
        siblings = len(up.children) if up is not None else 1
        kind = [0.0] * KINDS
        kind[TAGS.get(node.name, KINDS - 1)] = 1.0
        size, words = node.text, node.words
        rows.append([
            *kind, node.depth, math.log1p(size), node.links / max(size, 1), math.log1p(words), size / node.tags, node.points / max(words, 1), math.log1p(node.paragraphs), size / whole,
            size / max(up.text, 1) if up is not None else 1.0, before / siblings, math.log1p(siblings), same / siblings, node.against, node.pro, against, pro, good, bad, node.pages_before / whole,
            node.own / max(size, 1), up.links / max(up.text, 1) if up is not None else 0.0,
        ])
        inherited.append((against + node.against, pro + node.pro, good or node.name in ("article", "main"), bad or node.name in BOILERPLATE))
    return rows


@dataclass
class Boosted:
    """Trees of a fixed depth as arrays: feature and threshold of each inner node, value of each leaf."""

    start: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += v[at - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.25, bins: int = 32, ridge: float = 2.0) -> Boosted:
    """Newton boosting on the logistic loss with histograms of quantile bins."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(c, col, "left") for c, col in zip(cuts, x.T, strict=True)])
    n, m = binned.shape
    inner = 2**depth - 1
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, start)
    feature, threshold, value = np.zeros((trees, inner), dtype=np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for tree in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            base, width = 2**level - 1, 2**level
            local = at - base
            best = np.full(width, 1e-3)
            for f in range(m):
                size = len(cuts[f]) + 1
                if size < 2:
                    continue
                key = local * size + binned[:, f]
                gs = np.bincount(key, g, width * size).reshape(width, size)
                hs = np.bincount(key, h, width * size).reshape(width, size)
                gl, hl = gs.cumsum(axis=1)[:, :-1], hs.cumsum(axis=1)[:, :-1]
                gt, ht = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < 1) | (ht - hl < 1)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best[better] = top[better]
                feature[tree, base : base + width][better] = f
                threshold[tree, base : base + width][better] = cuts[f][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[tree, at]] > threshold[tree, at])
        leaf = at - inner
        value[tree] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        margin += value[tree][leaf]
    return Boosted(start, feature, threshold, value)


def decode(nodes: list[Node], margin: np.ndarray) -> list[bool]:
    """For each node whether it is kept: the best labelling in which a dropped node has no kept descendant."""
    keep_cost = np.logaddexp(0, -margin).tolist()
    drop_cost = np.logaddexp(0, margin).tolist()
    keep, drop = list(keep_cost), list(drop_cost)
    for node in reversed(nodes[1:]):
        up = node.parent.index
        drop[up] += drop[node.index]
        keep[up] += min(keep[node.index], drop[node.index])
    kept = [False] * len(nodes)
    for node in nodes:
        kept[node.index] = node.parent is None or kept[node.parent.index] and keep[node.index] < drop[node.index]
    return kept


def blocks(root: Node, kept: list[bool]) -> list[str]:
    """The text blocks of kept nodes in page order."""
    out: list[str] = []
    waiting: list[str] = []

    def end() -> None:
        if waiting:
            block = " ".join("".join(waiting).split())
            if block:
                out.append(block)
            waiting.clear()

    todo: list[Node | str | None] = [root]
    while todo:
        x = todo.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            waiting.append(x)
        elif kept[x.index]:
            end()
            todo.append(None)
            todo.extend(reversed(x.parts))
        else:
            end()
    return out


def extract_batch(pages: list[str | None], model: Boosted) -> list[str]:
    trees = [_walk(parse(p or "")) for p in pages]
    rows = [r for nodes in trees for r in node_features(nodes)]
    margin = model.margins(np.array(rows, dtype=np.float64).reshape(-1, FEATURES))
    out, at = [], 0
    for nodes in trees:
        kept = decode(nodes, margin[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n\n".join(blocks(nodes[0], kept)))
    return out


TRAINING_PAGES = 700
LONG_EVERY = 35


def synthetic_pages(count: int = TRAINING_PAGES, seed: int = 0) -> Iterator[tuple[str, list[str]]]:
    """Pages of many layouts with their main text's blocks."""
    rng = random.Random(seed)
    syllables = "an be co da el fi ga ho in ka lo me no or pa re si tu un ver wa zo é ü ñ".split()
    chance = lambda p: rng.random() < p

    def sentence(low: int, high: int) -> str:
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        if len(words) > 6 and chance(0.5):
            words[len(words) // 2] += ","
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", "?", "!"])

    def prose(low: int, high: int) -> str:
        return " ".join(sentence(1, 24) for _ in range(rng.randint(low, high)))

    def attrs(*names: str, p: float = 0.8) -> str:
        if not chance(p):
            return ""
        return f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}{rng.choice(["", "", " clearfix", "-1", " box wide"])}"'

    def link_list(n: int, tag: str = "ul") -> str:
        return f"<{tag}>" + "".join(f'<li><a href="/{k}">{sentence(1, 3).rstrip(".?!")}</a></li>' for k in range(n)) + f"</{tag}>"

    def nav() -> str:
        if chance(0.6):
            return f"<nav{attrs('main-nav', 'menu', p=0.4)}>{link_list(rng.randint(2, 9))}</nav>"
        return f"<div{attrs('nav', 'menu', 'navbar', 'navigation')}>{link_list(rng.randint(2, 9))}</div>"

    def ad() -> str:
        return f"<{(t := rng.choice(['div', 'div', 'aside', 'p', 'section']))}{attrs('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-slot', 'banner', p=0.97)}>{rng.choice([prose(1, 2), '<p>' + prose(1, 3) + '</p>', '<a href=x>' + sentence(2, 8) + '</a>'])}</{t}>"

    def header() -> str:
        inner = rng.choice([f"<a href='/'>{sentence(1, 3)}</a>", f"<h2>{sentence(1, 4)}</h2>", f"<p>{sentence(2, 9)}</p>", f"<div>{sentence(1, 4)}</div><div>{sentence(2, 9)}</div>", f"<h1>{sentence(1, 3)}</h1>"])
        return f"<header{attrs('site-header', 'top', p=0.4)}>{inner}{nav() if chance(0.3) else ''}</header>" if chance(0.6) else f"<div{attrs('header', 'masthead', 'site-header', 'topbar', p=0.95)}>{inner}</div>"

    def footer() -> str:
        inner = rng.choice([f"&copy; site.example &middot; {prose(1, 2)}", f"<p>&copy; {sentence(2, 6)}</p>{link_list(3)}", f"<div>{prose(1, 3)}</div><a href=z>{sentence(1, 2)}</a>"])
        return f"<footer>{inner}</footer>" if chance(0.65) else f"<div{attrs('footer', 'site-footer', 'copyright', p=0.95)}>{inner}</div>"

    def sidebar() -> str:
        inner = "".join(rng.choice([f"<h3>{sentence(1, 3)}</h3>{link_list(rng.randint(2, 6))}", f"<div class='widget'><h4>{sentence(1, 3)}</h4><p>{prose(1, 2)}</p></div>", f"<p>{prose(1, 3)}</p>"]) for _ in range(rng.randint(1, 3)))
        return f"<aside{attrs('sidebar', p=0.5)}>{inner}</aside>" if chance(0.5) else f"<div{attrs('sidebar', 'side', 'widgets', 'rail', 'right-sidebar', p=0.97)}>{inner}</div>"

    def comments() -> str:
        item = lambda: rng.choice([f"<div class='comment'><p>{prose(1, 4)}</p></div>", f"<li class='comment'><b>{sentence(1, 2)}</b><p>{prose(1, 3)}</p></li>", f"<p>{prose(1, 3)}</p>", f"<article class='comment'><p>{prose(1, 3)}</p></article>"])
        head = f"<h3>{sentence(1, 3)}</h3>" if chance(0.6) else ""
        return f"<{(t := rng.choice(['div', 'section', 'ol', 'ul']))}{attrs('comments', 'comment-list', 'replies', 'discussion', 'respond', 'reader-comments', p=0.98)}>{head}{''.join(item() for _ in range(rng.randint(1, 6)))}</{t}>"

    def notice() -> str:
        inner = rng.choice([prose(1, 3), f"<p>{prose(1, 2)}</p><button>OK</button>", f"<p>{sentence(3, 9)}</p><a href=y>{sentence(1, 2)}</a>"])
        return f"<{(t := rng.choice(['div', 'div', 'section', 'aside', 'p']))}{attrs('cookie-notice', 'consent', 'gdpr', 'notice', 'alert', 'popup', 'newsletter', 'subscribe', 'cookie-banner', p=0.97)}>{inner}</{t}>"

    def form() -> str:
        return f"<form action='/s'>{rng.choice(['<p>' + sentence(2, 8) + '</p>', sentence(1, 4), '<div>' + sentence(2, 6) + '</div>'])}<input name=q><button>{sentence(1, 1)}</button></form>"

    def related() -> str:
        return f"<{(t := rng.choice(['div', 'section', 'aside']))}{attrs('related', 'recommended', 'more-links', 'popular', 'teasers', p=0.95)}><h3>{sentence(1, 3)}</h3>{link_list(rng.randint(2, 5))}</{t}>"

    def share() -> str:
        return f"<div{attrs('share', 'social', 'tools', 'tags', p=0.95)}>{rng.choice([link_list(3), sentence(1, 4), '<a href=f>' + sentence(1, 1) + '</a> <a href=t>' + sentence(1, 1) + '</a>'])}</div>"

    def byline() -> str:
        return f"<{(t := rng.choice(['p', 'div']))}{attrs('byline', 'meta', 'author', 'date', p=1)}>{sentence(2, 5)}</{t}>"

    def body_block() -> tuple[str, list[str]]:
        kind = rng.random()
        text = prose(1, rng.choice([1, 1, 2, 4, 9]))
        if kind < 0.72:
            return f"<p>{text}{'</p>' if chance(0.9) else ''}", [text]
        if kind < 0.8:
            return f"<p><b>{text}<br>", [text]
        if kind < 0.86:
            return f"<{(t := rng.choice(['h2', 'h3']))}>{(s := sentence(1, 8))}</{t}>", [s]
        if kind < 0.9:
            return f"<blockquote>{'<p>' if chance(0.5) else ''}{text}</blockquote>", [text]
        if kind < 0.95:
            items = [prose(1, 1) for _ in range(rng.randint(2, 5))]
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", items
        a, b, c = sentence(1, 6), sentence(1, 3), sentence(1, 9)
        return f'<p>{a} <a href="/l">{b}</a> <em>{c}</em></p>', [f"{a} {b} {c}"]

    for number in range(count):
        p_boiler = rng.choice([0.3, 0.6, 0.9])
        some = lambda make, p=1.0: make() if chance(p_boiler * p) else ""
        parts, main = [], []
        if chance(0.85):
            title = prose(1, 2)
            parts.append(f"<h1>{title}</h1>")
            main.append(title)
        if chance(0.2 * p_boiler):
            parts.append(byline())
        # A few pages have hundreds of blocks.
        long_page = number % LONG_EVERY == LONG_EVERY - 1
        for _ in range(rng.randint(70, 400) if long_page else rng.choice([1, 2, 4, 8, 15])):
            markup, found = body_block()
            parts.append(markup)
            main += found
            if chance((0.004 if long_page else 0.04) * p_boiler):
                parts.append(rng.choice([ad, share, related, form, notice])())
        inside = "".join(parts) + some(share, 0.3) + some(comments, 0.1)
        style = rng.random()
        if style < 0.45:
            content = f"<article{attrs('post', 'entry', p=0.3)}>{inside}</article>"
        elif style < 0.6:
            content = f"<main>{inside}</main>"
        elif style < 0.9:
            t = rng.choice(["div", "section"])
            content = f"<{t}{attrs('content', 'post', 'entry-content', 'article-body', 'story', 'main', 'text', p=0.85)}>{inside}</{t}>"
        else:
            content = inside
        for _ in range(rng.choice([0, 0, 1, 2])):
            extra = some(sidebar, 0.5)
            content = f"<div{attrs('wrapper', 'container', 'page', 'row', 'layout', p=0.6)}>{extra if chance(0.3) else ''}{content}{some(related, 0.2)}</div>"
        before = some(notice, 0.3) + some(header, 0.5) + some(nav) + some(ad, 0.6) + some(form, 0.2)
        after = some(comments, 0.4) + some(sidebar, 0.4) + some(related, 0.3) + some(ad, 0.2) + some(notice, 0.2) + some(footer)
        yield f"<!DOCTYPE html><html><head><title>{sentence(1, 5)}</title><script>var a = '<p>';</script></head><body>{before}{content}{after}</body></html>", main


@functools.lru_cache(maxsize=1)
def default_model() -> Boosted:
    """Boosted trees fitted to the nodes of the synthetic pages: a node is positive if its subtree holds main text."""
    rows, label = [], []
    for page, main in synthetic_pages():
        nodes = _walk(parse(page))
        whole = set(main)
        positive = [False] * len(nodes)
        for node in reversed(nodes):
            own = [" ".join(b.split()) for b in "".join(x if isinstance(x, str) else "\0" for x in node.parts).split("\0")]
            if any(b in whole for b in own if b) or positive[node.index]:
                positive[node.index] = True
                if node.parent is not None:
                    positive[node.parent.index] = True
        rows += node_features(nodes)
        label += positive
    return boost(np.array(rows, dtype=np.float64), np.array(label, dtype=np.float64))


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", model: Boosted | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    shared = pages.sparkSession.sparkContext.broadcast(model or default_model())

    def make():
        def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, len(whole), 200):
                    batch = whole.slice(at, 200)
                    text = extract_batch(batch.column(2).to_pylist(), shared.value)
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

        return stage

    rows = pages.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return arrow_stage(rows, make, "page_id long, url string, text string, n_chars long")
