"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the hierarchy.

A lenient parser makes a tree of a page. Every node gets features of its subtree (words, links, tags and
text density), its attributes' tokens, its depth and its siblings. Boosted trees, trained here on pages
that a generator invents (so every node's part is known), give the chance that a node belongs to the main
text. A dynamic program over the tree then decides: a dropped node drops all below it, and a node is kept
only where none above it was dropped, so no descendant contradicts an ancestor.

The text of the kept blocks comes in page order, a line each; white space inside a block becomes one
space, character references are decoded. A null or empty page, and one without a main text, gives an empty
string. Repeated rows are extracted alike; other columns are passed through.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "html body head address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul button select option label caption".split()
)
#: Open elements that an opening tag may end, by group: the elements, and what shields them when it lies between.
GROUPS = {
    "p": ({"p"}, BLOCK - {"p"}), "foreign": ({"svg", "math"}, BLOCK | {"foreignobject", "desc"}), "li": ({"li"}, {"ul", "ol", "menu"}), "d": ({"dt", "dd"}, {"dl"}),
    "row": ({"tr", "td", "th"}, {"table"}), "cell": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
#: The groups whose highest open element a tag ends.
ENDS = {t: ("foreign", "p") for t in BLOCK - {"button", "select", "option", "label", "html", "body", "head"}}
ENDS |= {t: (*ENDS.get(t, ()), g) for t, g in {"li": "li", "dt": "d", "dd": "d", "tr": "row", "td": "cell", "th": "cell", "option": "option"}.items()}
#: The groups that a tag shields, and those that it is one of.
_SHIELDS = {t: tuple(g for g, (_, stop) in GROUPS.items() if t in stop) for _, stops in GROUPS.values() for t in stops}
_MEMBER = {t: tuple(g for g, (own, _) in GROUPS.items() if t in own) for owns, _ in GROUPS.values() for t in owns}
#: Never main text, whatever the trees say: what isn't shown, and what takes input.
NEVER = frozenset("script style noscript template textarea title iframe svg math object head select option button input label".split())

_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_END_OR_QUOTE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_WORD = re.compile(r"\w+")

#: What attributes call the main text and what surrounds it (roots of tokens).
GOOD = ("article", "content", "entry", "main", "post", "story", "text", "body", "prose", "page")
BAD = (
    "nav menu header foot side aside widget ad ads advert banner sponsor promo cookie consent notice gdpr popup modal comment reply disqus share social related recommend breadcrumb crumb form login search subscribe newsletter tag pager pagin toolbar copyright legal skip hidden meta author-box"
).split()


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "depth", "index", "block", "scope")

    def __init__(self, tag: str, attrs: str, parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        #: Nodes and strings, in page order.
        self.children: list[Node | str] = []
        self.depth = parent.depth + 1 if parent else 0
        self.index = 0
        #: The nearest block from here up, and of each group the highest open element that nothing shields.
        self.block: Node = self if parent is None or tag in BLOCK else parent.block
        self.scope: dict[str, Node] = parent.scope if parent else {}
        shields, member = _SHIELDS.get(tag, ()), _MEMBER.get(tag, ())
        if member or any(g in self.scope for g in shields):
            self.scope = {g: x for g, x in self.scope.items() if g not in shields}
            for g in member:
                self.scope.setdefault(g, self)


class _Scanner:
    """Finds where tags end. Each kind of thing that turns out not to close is remembered, so a page is read once, whatever it holds."""

    def __init__(self, page: str):
        self.page, self.quotes, self.cdata = page, True, True

    def tag_end(self, at: int) -> int:
        """Of the tag that starts at: the place of its `>`, one within a quoted value not counting; -1 if there is none. After a quote that is never closed quotes mean nothing."""
        page, here = self.page, at
        while self.quotes and (m := _END_OR_QUOTE.search(page, here)):
            if m.group() == ">":
                return m.start()
            here = page.find(m.group(), m.end()) + 1
            self.quotes = here > 0
        self.quotes = False
        return page.find(">", at)

    def markup(self, at: int) -> tuple[int, str]:
        """Of a comment, declaration or CDATA section that starts at: its end, and the text that it gives."""
        page = self.page
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            return (end + 3 if end >= 0 else len(page)), ""
        if self.cdata and page.startswith("<![CDATA[", at):
            end = page.find("]]>", at)
            if end >= 0:
                return end + 3, page[at + 9 : end].replace("&", "&amp;")
            self.cdata = False
        end = page.find(">", at)
        return (end + 1 if end >= 0 else len(page)), ""


def parse(page: str) -> Node:
    """A tree of any string, in time that its length bounds: unclosed and misplaced tags are closed where HTML implies it, an end tag that closes nothing is dropped."""
    root = here = Node("#root", "", None)
    scan, at, end = _Scanner(page), 0, len(page)
    opened: dict[tuple[int, str], int] = {}  # by block and tag (blocks: by tag alone): how many are open

    def counted(x: Node) -> tuple[int, str]:
        return (0 if x.tag in BLOCK else id(x.block)), x.tag

    def up_to(x: Node) -> None:
        """Closes all below x."""
        nonlocal here
        while here is not x:
            opened[counted(here)] -= 1
            here = here.parent

    while at < end:
        start = page.find("<", at)
        if start < 0:
            here.children.append(page[at:])
            break
        if start > at:
            here.children.append(page[at:start])
        if page[start + 1 : start + 2] in ("!", "?"):
            at, text = scan.markup(start)
            if text:
                here.children.append(text)
            continue
        m = _NAME.match(page, start)
        stop = scan.tag_end(m.end()) if m else -1
        if m is None or stop < 0:
            # no tag: the sign is text; where no tag can end any more, so is the rest
            at = start + 1 if m is None else end
            here.children.append(page[start:at])
            continue
        tag, attrs, at = m.group(1).lower(), page[m.end() : stop], stop + 1
        if page[start + 1] == "/":
            if opened.get((0 if tag in BLOCK else id(here.block), tag)):
                x = here
                while x.tag != tag:
                    x = x.parent
                up_to(x.parent)
            continue
        for group in ENDS.get(tag, ()):
            if (x := here.scope.get(group)) is not None:
                up_to(x.parent)
        node = Node(tag, attrs, here)
        here.children.append(node)
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.children.append(page[at : close.start() if close else end])
            at = close.end() if close else end
        elif tag not in VOID and not attrs.rstrip().endswith("/"):
            here = node
            opened[counted(node)] = opened.get(counted(node), 0) + 1
    return root


TAGS = {t: i for i, t in enumerate("article main section div p h1 h2 h3 h4 li ul ol nav header footer aside form table td tr pre blockquote figure figcaption a span body b".split())}
_KINDS = {"nav": 0, "menu": 0, "header": 1, "footer": 1, "aside": 2, "form": 2, "dialog": 2, "article": 3, "main": 3}
_HEADINGS, _LISTS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6")), frozenset(("li", "ul", "ol"))
_STOP = re.compile(r"[.!?,;]")


def _tokens(attrs: str) -> list[str]:
    out: list[str] = []
    for name, value in _ATTRIBUTE.findall(attrs):
        if name.lower() in ("class", "id", "role", "itemprop", "aria-label", "data-role", "data-component"):
            out += re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower())
    return out


def _token_score(tokens: list[str]) -> tuple[int, int]:
    good = sum(any(t.startswith(g) for g in GOOD) for t in tokens)
    bad = sum(any(t == b or (len(b) > 3 and t.startswith(b)) for b in BAD) for t in tokens)
    return good, bad


def featurise(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes in page order, and a row of features for each."""
    nodes: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        node.index = len(nodes)
        nodes.append(node)
        if node.tag not in NEVER:
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    n = len(nodes)
    # of each subtree: words, words in links, sentence marks, elements, paragraphs, links, inputs, items
    words, linked, marks, elements, paragraphs, links, inputs, items = ([0] * n for _ in range(8))
    own = [0] * n  # words of own text
    for i in range(n - 1, -1, -1):
        node, tag = nodes[i], nodes[i].tag
        up = node.parent.index if node.parent else 0
        if tag in NEVER:
            if i:
                elements[up] += 1
                inputs[up] += tag in ("button", "select", "textarea", "input", "label")
            continue
        text = " ".join([c for c in node.children if isinstance(c, str)])
        if text and not text.isspace():
            own[i] = len(_WORD.findall(text))
            words[i] += own[i]
            marks[i] += len(_STOP.findall(text))
        if tag == "a":
            linked[i] = words[i]
            links[i] += 1
        elif tag == "p":
            paragraphs[i] += 1
        elif tag == "li":
            items[i] += 1
        elif tag == "input":
            inputs[i] += 1
        if i:
            words[up] += words[i]
            linked[up] += linked[i]
            marks[up] += marks[i]
            elements[up] += elements[i] + 1
            paragraphs[up] += paragraphs[i]
            links[up] += links[i]
            inputs[up] += inputs[i]
            items[up] += items[i]
    # of the children of each node: how many, and by tag how many with how many words
    count, place = [0] * n, [0] * n
    by_tag: list[dict[str, list[int]]] = [{} for _ in range(n)]
    for i in range(1, n):
        up = nodes[i].parent.index
        place[i] = count[up]
        count[up] += 1
        row = by_tag[up].setdefault(nodes[i].tag, [0, 0])
        row[0] += 1
        row[1] += words[i]
    whole, rows, log = max(1, words[0]), [], math.log1p
    above: list[tuple[int, ...]] = []
    for i, node in enumerate(nodes):
        tag = node.tag
        good, bad = _token_score(_tokens(node.attrs)) if node.attrs else (0, 0)
        up = node.parent.index if i else 0
        g, b, *kinds = above[up] if i else (0, 0, 0, 0, 0, 0)
        if tag in _KINDS:
            kinds[_KINDS[tag]] += 1
        above.append((g + good, b + bad, *kinds))
        same, same_words = by_tag[up].get(tag, (0, 0)) if i else (0, 0)
        w = words[i]
        rows.append(
            (
                TAGS.get(tag, -1), node.depth, log(w), linked[i] / (w or 1), marks[i] / (w or 1), w / (1 + elements[i]), log(paragraphs[i]), log(links[i]), inputs[i],
                log(items[i]), own[i] / (w or 1), w / whole, i / n, good, bad, *above[i], same, log(same_words / (same or 1)), place[i] / (count[up] or 1), count[up],
                tag == "p", tag in _HEADINGS, tag in _LISTS, tag in BLOCK, TAGS.get(node.parent.tag, -1) if i else -1,
                linked[up] / (words[up] or 1) if i else 0, log(words[up]) if i else 0, log(own[i]), node.attrs not in ("", " "), paragraphs[up] if i else 0,
            )
        )
    return nodes, np.array(rows, dtype=float)


@dataclass
class Trees:
    """Boosted regression trees of one depth, stored as arrays: features and cuts by level order, values by leaf."""

    bias: float
    features: np.ndarray
    cuts: np.ndarray
    values: np.ndarray

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        depth = int(np.log2(self.values.shape[1]))
        for f, c, v in zip(self.features, self.cuts, self.values, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (len(v) - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 50, depth: int = 4, rate: float = 0.25, bins: int = 24, least: float = 2.0) -> Trees:
    """Logistic boosting with Newton leaves on binned features."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    out = Trees(bias, np.zeros((trees, 2**depth - 1), dtype=np.int64), np.full((trees, 2**depth - 1), np.inf), np.zeros((trees, 2**depth)))
    z = np.full(len(y), bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (at - first) * (bins + 1) + binned[:, j]
                gs = np.bincount(cell, g, count * (bins + 1)).reshape(count, -1).cumsum(axis=1)
                hs = np.bincount(cell, h, count * (bins + 1)).reshape(count, -1).cumsum(axis=1)
                gl, hl, gt, ht = gs[:, : len(e)], hs[:, : len(e)], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain[(hl < least) | (ht - hl < least)] = 0
                k = gain.argmax(axis=1)
                top = gain[np.arange(count), k]
                better = top > best + 1e-9
                best = np.where(better, top, best)
                out.features[t, first : first + count] = np.where(better, j, out.features[t, first : first + count])
                out.cuts[t, first : first + count] = np.where(better, e[k], out.cuts[t, first : first + count])
            at = 2 * at + 1 + (x[np.arange(len(y)), out.features[t, at]] > out.cuts[t, at])
        leaf = at - (2**depth - 1)
        out.values[t] = rate * np.bincount(leaf, g, 2**depth) / (np.bincount(leaf, h, 2**depth) + 1)
        z += out.values[t, leaf]
    return out


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """Which nodes are kept, so that their likelihoods together are greatest and none lies below a dropped one."""
    n = len(nodes)
    keep = [min(6.0, max(-6.0, z)) * (1.0 if x.tag in BLOCK or x.parent is None else 0.1) for x, z in zip(nodes, logits, strict=True)]
    drop_all, best = [-z for z in keep], [0.0] * n
    for i in range(n - 1, -1, -1):
        never = nodes[i].tag in NEVER
        structure = nodes[i].tag in ("#root", "html", "body")  # always open: they hold the page
        open_ = (0.0 if structure else keep[i]) + best[i]
        gain = open_ if structure else -1e9 if never else open_
        value = max(gain, drop_all[i]) if not structure else gain
        keep[i] = gain >= value and not never
        if nodes[i].parent:
            p = nodes[i].parent.index
            best[p] += value
            drop_all[p] += drop_all[i]
    kept = [False] * n
    for i, node in enumerate(nodes):
        kept[i] = bool(keep[i]) and (node.parent is None or kept[node.parent.index])
    return kept


def blocks(root: Node, nodes: list[Node], kept: list[bool]) -> list[str]:
    """Texts of the kept nodes, a string for each run of inline content."""
    out: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := " ".join("".join(run).split()):  # white space of any kind
            out.append(text)
        run.clear()

    stack: list[tuple[Node, int]] = [(root, 0)]
    while stack:
        node, at = stack.pop()
        if at >= len(node.children):
            if node.tag in BLOCK:
                close()
            continue
        stack.append((node, at + 1))
        child = node.children[at]
        if isinstance(child, str):
            if node.tag not in ("#root", "html", "body") or child.strip():
                run.append(entities.unescape(child))
        elif child.tag in NEVER or not kept[child.index]:
            if child.tag in BLOCK:
                close()
        else:
            if child.tag in BLOCK:
                close()
            elif child.tag == "br":
                run.append(" ")
            stack.append((child, 0))
    close()
    return out


_WORDS = "en la der of tion ment keit ado ing ould ver ein que les por con und the and with from over mar sol tur per lin gas mon".split()


def _invented(rnd: random.Random) -> tuple[str, set[str]]:
    """A page of some layout, and the marks that its main blocks end in."""

    def word() -> str:
        return "".join(rnd.choice(_WORDS) for _ in range(rnd.randint(1, 3)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rnd.randint(a, b)))

    def prose(a: int, b: int) -> str:
        return " ".join(words(2, 14).capitalize() + rnd.choice(".....,!?") for _ in range(rnd.randint(a, b)))

    main: set[str] = set()

    def mark() -> str:
        m = f"qz{len(main)}zq"
        main.add(m)
        return m

    def attr(*names: str) -> str:
        kind = rnd.random()
        name = rnd.choice(names)
        name = rnd.choice([name, f"{name}-{word()}", f"{word()}_{name}", f"site-{name}"])
        return f' class="{name}"' if kind < 0.55 else f' id="{name}"' if kind < 0.75 else f' role="{name}"' if kind < 0.8 else ""

    def links(n: int) -> str:
        return "".join(f'<li><a href="/{word()}">{words(1, 3)}</a></li>' for _ in range(n))

    def menu() -> str:
        inner = f"<ul>{links(rnd.randint(3, 9))}</ul>" if rnd.random() < 0.8 else " | ".join(f'<a href="/{word()}">{word()}</a>' for _ in range(5))
        return rnd.choice([f"<nav>{inner}</nav>", f"<div{attr('nav', 'menu', 'navbar', 'breadcrumb')}>{inner}</div>"])

    def notice() -> str:
        tag = rnd.choice(["div", "div", "aside", "p", "section"])
        return f"<{tag}{attr('ad', 'ads', 'advert', 'cookie-notice', 'banner', 'sponsor', 'promo', 'newsletter', 'consent')}>{prose(1, 2)}</{tag}>"

    def side() -> str:
        body = f"<h3>{words(1, 3)}</h3><ul>{links(4)}</ul>" if rnd.random() < 0.6 else f"<h4>{words(1, 3)}</h4><p>{prose(1, 2)}</p>"
        return rnd.choice([f"<aside>{body}</aside>", f"<div{attr('sidebar', 'widget', 'related', 'aside')}>{body}</div>", f"<aside{attr('sidebar', 'related')}>{body}</aside>"])

    def comments() -> str:
        rows = "".join(f"<{(t := rnd.choice(['div', 'li']))}{attr('comment', 'reply')}><b>{word()}</b> <p>{prose(1, 3)}</p></{t}>" for _ in range(rnd.randint(1, 5)))
        return f'<{(t := rnd.choice(["section", "div"]))} {rnd.choice(["class", "id"])}="{rnd.choice(["comments", "comment-list", "disqus_thread", "replies"])}">{f"<h3>{word()}</h3>" if rnd.random() < 0.5 else ""}{rows}</{t}>'

    def form() -> str:
        return f"<form{attr('search', 'login', 'subscribe', 'form')}><p>{words(2, 6)}</p><label>{word()}</label><input name=q><button>{word()}</button></form>"

    def head() -> str:
        return rnd.choice([f"<header><h2>{words(1, 3)}</h2>{menu() if rnd.random() < 0.4 else f'<p>{words(2, 5)}</p>'}</header>", f"<div{attr('header', 'masthead', 'banner')}><p>{words(1, 4)}</p></div>", ""])

    def foot() -> str:
        return rnd.choice([f"<footer>&copy; {word()}.example &middot; {prose(1, 2)}</footer>", f"<footer><p>{prose(1, 2)}</p>{menu()}</footer>", f"<div{attr('footer', 'copyright', 'legal')}><p>© {words(2, 6)}</p></div>"])

    def body() -> str:
        out = [f"<h1>{words(3, 12)} {mark()}</h1>"] if rnd.random() < 0.85 else []
        for _ in range(rnd.randint(1, 9)):
            kind = rnd.random()
            close = "" if rnd.random() < 0.2 else "</p>"
            bold = rnd.choice(["", "", "<b>", "<b>{}</b> ".format(word()), f'<a href="/{word()}">{words(1, 3)}</a> '])
            if kind < 0.75:
                out.append(f"<p>{bold}{prose(1, 6)}{'<br>' if rnd.random() < 0.2 else ''} {mark()}{close}")
            elif kind < 0.82:
                out.append(f"<h2>{words(2, 6)} {mark()}</h2>")
            elif kind < 0.88:
                out.append("<ul>" + "".join(f"<li>{prose(1, 2)} {mark()}</li>" for _ in range(rnd.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote><p>{prose(1, 3)} {mark()}</p></blockquote>")
            elif kind < 0.95:
                out.append(f"<table><tr><td>{words(1, 5)} {mark()}</td><td>{words(1, 5)} {mark()}</td></tr></table>")
            elif kind < 0.97:
                out.append(f"<pre>{words(3, 20)} {mark()}</pre>")
            else:
                out.append(rnd.choice([notice, side, form])())
        return "\n".join(out)

    shape = rnd.random()
    text = body()
    if rnd.random() < 0.15:
        text += rnd.choice([comments, side])()
    if shape < 0.45:
        middle = f"<article{attr('post', 'entry', 'article') if rnd.random() < 0.5 else ''}>{text}</article>"
    elif shape < 0.6:
        middle = f"<main>{text}</main>"
    elif shape < 0.85:
        middle = f"<div{attr('content', 'post', 'article-body', 'entry-content', 'main', 'story')}>{text}</div>"
    else:
        middle = text
    if rnd.random() < 0.35:
        middle = f"<div{attr('wrapper', 'container', 'page', 'row')}>{middle}{side() if rnd.random() < 0.5 else ''}</div>"
    before = [f() for f in (head, menu, notice, side, form) if rnd.random() < 0.5]
    after = [f() for f in (comments, side, notice, form, menu) if rnd.random() < 0.35]
    rnd.shuffle(before)
    page = f"<!DOCTYPE html><html><head><title>{words(2, 8)}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>{''.join(before)}{middle}{''.join(after)}{foot() if rnd.random() < 0.85 else ''}</body></html>"
    return page, main


_MARK = re.compile(r" ?qz\d+zq")
_trees: dict[tuple[int, int], Trees] = {}


def trained(pages: int = 500, seed: int = 3) -> Trees:
    """Trees fitted to invented pages; a node's class is whether half of its text or more is main text."""
    if (pages, seed) in _trees:
        return _trees[pages, seed]
    rnd, xs, ys = random.Random(seed), [], []
    for _ in range(pages):
        page, _main = _invented(rnd)
        # classes are read off the marked page, features off the page without marks: both have the same nodes
        marked, _x = featurise(parse(page))
        nodes, x = featurise(parse(_MARK.sub("", page)))
        inside, total = np.zeros(len(marked)), np.zeros(len(marked))
        for i in range(len(marked) - 1, -1, -1):
            node = marked[i]
            if node.tag not in NEVER:
                own = "".join(c for c in node.children if isinstance(c, str))
                words = len(_WORD.findall(own))
                total[i] += words
                inside[i] += words if _MARK.search(own) else 0
                if not own.strip() and not total[i]:
                    continue
                # inline children of a marked block are main text too
                if _MARK.search(own):
                    inside[i] = total[i]
            if node.parent:
                total[node.parent.index] += total[i]
                inside[node.parent.index] += inside[i]
        y = 2 * inside >= np.maximum(total, 1)
        for i, node in enumerate(marked):  # and so are what they hold
            if node.parent and node.tag not in BLOCK and _MARK.search("".join(c for c in node.parent.children if isinstance(c, str))):
                y[i] = True
        if len(nodes) == len(y):
            use = [i for i, m in enumerate(marked) if total[i] and m.tag not in ("#root", "html", "body")]
            xs.append(x[use])
            ys.append(y[use])
    _trees[pages, seed] = out = boost(np.concatenate(xs), np.concatenate(ys).astype(float))
    return out


#: Nodes that the trees judge at once.
NODES = 20_000


def extract_all(pages: Iterable[str | None], trees: Trees) -> list[str]:
    """The main text of each page; the trees see the nodes of many pages at once."""
    out: list[str] = []
    held: list[tuple[int, Node, list[Node], np.ndarray]] = []

    def judge() -> None:
        logits = trees.logits(np.concatenate([x for *_, x in held])) if held else []
        at = 0
        for i, root, nodes, _ in held:
            out[i] = "\n".join(blocks(root, nodes, decode(nodes, logits[at : at + len(nodes)])))
            at += len(nodes)
        held.clear()

    waiting = 0
    for page in pages:
        out.append("")
        if page and not page.isspace():
            root = parse(page)
            held.append((len(out) - 1, root, *featurise(root)))
            waiting += len(held[-1][2])
        if waiting > NODES:
            judge()
            waiting = 0
    judge()
    return out


def extract(page: str | None, trees: Trees) -> str:
    return extract_all([page], trees)[0]


def extract_main_text(pages: DataFrame, html: str = "html", trees: Trees | None = None) -> DataFrame:
    """pages with text (the main text) and n_chars (its code points) in place of html. Columns of pages with these names are replaced."""
    small_batches(pages.sparkSession)
    sent = pages.sparkSession.sparkContext.broadcast(trees or trained())

    @F.pandas_udf("string")
    def extracted(texts: pd.Series) -> pd.Series:
        return pd.Series(extract_all(texts, sent.value), dtype=object)

    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("text", "n_chars", html)]
    return pages.select(*kept, extracted(F.col(html)).alias("text")).withColumn("n_chars", F.length("text").cast("long"))
