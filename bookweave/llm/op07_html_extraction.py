"""HTML extraction: boosted trees over DOM nodes, decoded so that choices never contradict along a path.

A tolerant parser turns a page into a tree of elements that carry structure (block elements, and others that have a
class, id or role); plain inline markup belongs to the element around it. Each node gets features: its tag, attribute
tokens of itself and of its ancestors, subtree text and link density, depth, and statistics of its siblings. Boosted
trees, fitted on generated pages of many layouts, give each node's odds of being main content. Decoding picks the most
likely labelling in which everything below a dropped node is dropped too: per node the better of dropping its whole
subtree and keeping it with the best choices of its children.

Text: character references decoded, white space in a block is one space, blocks are joined by one line feed.

Defined results: null or empty html has an empty text; scripts, styles, titles, the head, hidden templates and text fields
never count; formulas, drawings and the fallback text of media, frames and scripts are judged with the element around them;
unclosed or stray tags are tolerated; repeated rows give equal texts; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import unescape

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, parallel, table
from .trees import BoostedTrees

BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("head script style template textarea title".split())
RAW = set("script style textarea title".split())
#: A start tag of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

GOOD = set("article content main post entry body story text page blog paragraph prose".split())
BAD = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs tabs toolbar skip pagination pager toc",
    "head": "header masthead topbar banner logo branding hero",
    "foot": "footer foot copyright legal imprint colophon contentinfo bottom",
    "side": "sidebar side aside complementary rail widget related recommended recommendations more trending popular tags",
    "notice": "notice cookie cookies consent gdpr alert warning modal popup overlay dialog message disclaimer privacy banner",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp adsense teaser",
    "form": "form search login signup subscribe newsletter input contact field register",
    "comment": "comment comments reply replies discussion disqus respond feedback reader readers",
    "social": "share sharing social follow author byline meta rating",
}
KINDS = {t: k for k, name in enumerate(BAD) for t in BAD[name].split()}
TAGS = {"p": 0, "h1": 1, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "div": 3, "section": 4, "article": 5, "main": 6, "ul": 7, "ol": 7, "li": 8, "blockquote": 9, "pre": 9, "figure": 9, "figcaption": 9, "table": 10, "tr": 10, "td": 10, "th": 10, "nav": 11, "menu": 11, "header": 12, "footer": 13, "aside": 14, "form": 15, "fieldset": 15, "select": 15, "button": 15, "label": 15, "dialog": 16, "body": 17, "html": 17}
OWN = {"nav": 0, "menu": 0, "header": 1, "footer": 2, "aside": 3, "dialog": 4, "form": 6}  # what a tag says as a token would


MARK = " data-k"


class Node:
    __slots__ = ("tag", "parent", "parts", "kinds", "good", "depth", "chars", "links", "count", "index", "at", "commas", "children", "marked")

    def __init__(self, tag: str, parent: Node | None, attributes: str):
        self.tag, self.parent = tag, parent
        self.parts: list = []  # strings, child nodes, and None where a block ends
        self.children: list[Node] = []
        found = {t.lower() for m in ATTRIBUTE.finditer(attributes) for t in TOKEN.findall(m[2] or m[3] or m[4] or "")} if attributes else ()
        self.kinds = {KINDS[t] for t in found if t in KINDS}
        if tag in OWN:
            self.kinds.add(OWN[tag])
        self.good = tag in ("article", "main") or any(t in GOOD for t in found)
        self.depth = parent.depth + 1 if parent else 0
        self.chars = self.links = self.commas = 0
        self.count = 1
        self.marked = MARK in attributes  # only in training pages


def parse(html: str) -> Node:
    root = Node("html", None, "")
    stack = [("html", root)]  # open elements with the node that takes their text
    unseen = links = at = 0
    n = len(html)
    while at < n:
        m = TAG.search(html, at)
        end = m.start() if m else n
        if end > at and not unseen:
            _text(stack[-1][1], unescape(html[at:end]), links)
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if not depth or tag not in BLOCK and any(t in BLOCK for t, _ in stack[depth + 1 :]):
                continue
            for t, node in stack[depth:]:
                unseen -= t in UNSEEN
                links -= t == "a"
                if t in BLOCK:
                    node.parts.append(None)
            del stack[depth:]
            continue
        if tag == "br":
            if not unseen:
                _text(stack[-1][1], " ", 0)
            continue
        if tag == "html":
            continue
        if tag in BLOCK and not unseen:
            gone = CLOSES.get(tag, set())
            # a block ends an open paragraph, with the inline elements in it
            for i in range(len(stack) - 1, 0, -1):
                t = stack[i][0]
                if t == "p" or t in gone:
                    for u, node in stack[i:]:
                        links -= u == "a"
                        if u in BLOCK:
                            node.parts.append(None)
                    del stack[i:]
                    if t in gone:
                        continue
                    break
                if t in BLOCK and t not in gone:
                    break
        closed = m[3].rstrip().endswith("/") and tag not in BLOCK
        if tag in VOID or closed:
            if tag == "hr" and not unseen:
                stack[-1][1].parts.append(None)
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = stop.end() if stop else n
            continue
        node = stack[-1][1]
        if tag in UNSEEN:
            unseen += 1
        elif not unseen and (tag in BLOCK or ATTRIBUTE.search(m[3]) and tag != "a"):
            child = Node(tag, node, m[3])
            if tag in BLOCK:
                node.parts.append(None)
            node.parts.append(child)
            node.children.append(child)
            node = child
        links += tag == "a"
        stack.append((tag, node))
    return root


def _text(node: Node, text: str, linked: int) -> None:
    node.parts.append(text)
    n = len(text.strip())
    node.chars += n
    node.commas += text.count(",") + text.count(".")
    if linked:
        node.links += n


WIDTH = 30


def features(root: Node) -> tuple[list[Node], np.ndarray]:
    """Nodes in page order and their features. Subtree sums go up, ancestors' tokens go down."""
    nodes: list[Node] = []
    stack = [root]
    while stack:
        node = stack.pop()
        node.index = len(nodes)
        nodes.append(node)
        stack.extend(reversed(node.children))
    own = np.array([(n.chars, n.links, n.commas, 1) for n in nodes], "f8")
    total = own.copy()
    for n in reversed(nodes[1:]):
        total[n.parent.index] += total[n.index]
    x = np.zeros((len(nodes), WIDTH))
    under = [0] * len(nodes)  # bit sets of the kinds of node and ancestors
    good = [False] * len(nodes)
    everything = max(total[0, 0], 1)
    for i, n in enumerate(nodes):
        mine = sum(1 << k for k in n.kinds)
        up, fine = (under[n.parent.index], good[n.parent.index]) if n.parent else (0, False)
        # an article inside says more than a header around it, and the other way round
        under[i], good[i] = (up | mine), fine or n.good
        siblings = n.parent.children if n.parent else [n]
        like = sum(s.tag == n.tag for s in siblings)
        around = total[n.parent.index] if n.parent else total[0]
        chars, links, commas, count = total[i]
        x[i] = (
            TAGS.get(n.tag, 18), n.good, fine, bool(mine), bool(up), *(under[i] >> k & 1 for k in range(len(BAD))),
            chars, own[i, 0], links / max(chars, 1), chars / count, commas / max(chars, 1), count, n.depth, len(siblings), like / len(siblings),
            chars / max(around[0], 1), (around[0] - chars) / max(len(siblings) - 1, 1), around[1] / max(around[0], 1), chars / everything, TAGS.get(n.parent.tag, 18) if n.parent else 19, own[i, 1] / max(own[i, 0], 1), len(n.children),
        )
    return nodes, x


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """The most likely labels with everything below a dropped node dropped. A node counts by the text of its own."""
    keep = -np.logaddexp(0, -odds)
    drop = -np.logaddexp(0, odds)
    weight = np.array([1 + n.chars / 20 for n in nodes])
    gone, best = weight * drop, weight * keep
    enter = [False] * len(nodes)
    for n in reversed(nodes):
        enter[n.index] = best[n.index] > gone[n.index]
        if n.parent:
            gone[n.parent.index] += gone[n.index]
            best[n.parent.index] += max(best[n.index], gone[n.index])
    kept = [False] * len(nodes)
    for n in nodes:
        kept[n.index] = enter[n.index] and (n.parent is None or kept[n.parent.index])
    return kept


def blocks(root: Node, kept: list[bool]) -> Iterator[str]:
    """Texts of the kept nodes, block by block."""
    parts: list[str] = []
    stack: list = [iter(root.parts)]
    nodes = [root]
    while stack:
        part = next(stack[-1], stack)
        if part is stack:
            stack.pop()
            if nodes.pop().tag in BLOCK:
                part = None
            else:
                continue
        if part is None:
            if text := " ".join("".join(parts).split()):
                yield text
            parts = []
        elif isinstance(part, str):
            if kept[nodes[-1].index]:
                parts.append(part)
        else:
            nodes.append(part)
            stack.append(iter(part.parts))
    if text := " ".join("".join(parts).split()):
        yield text


def extract(pages: list[str | None], model: BoostedTrees) -> list[str]:
    roots = [parse(p or "") for p in pages]
    found = [features(r) for r in roots]
    odds = np.split(model.log_odds(np.concatenate([x for _, x in found])), np.cumsum([len(n) for n, _ in found])[:-1]) if found else []
    return ["\n".join(blocks(r, decode(n, o))) for r, (n, _), o in zip(roots, found, odds, strict=True)]


# --- training pages -------------------------------------------------------------------------------------------------


class Layouts:
    """Generates pages whose elements are labelled: data-k marks main content. Seeded, so the model is always the same."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.r
        n = max(1, int(low * (high / low) ** r.random()))
        out = ["".join(r.choice(("ka", "lo", "mi", "ter", "an", "so", "ve", "il", "ru", "den")) for _ in range(r.randint(1, 4))) for _ in range(n)]
        for i in range(0, n, r.randint(5, 14)):
            out[i] = out[i].capitalize()
            if i:
                out[i - 1] += r.choice((".", ".", ",", "!", "&amp;"))
        return " ".join(out) + ("." if r.random() < 0.8 and n > 2 else "")

    def some(self, make, low: int, high: int) -> str:
        return "".join(make() for _ in range(self.r.randint(low, high)))

    def named(self, semantic: str, tokens: str, inner: str, chance: float = 0.5) -> str:
        """An element that says what it is by its tag, by its attributes, or by both."""
        r = self.r
        token = r.choice(tokens.split())
        token = r.choice((token, f"{token}-{r.choice(('1', 'box', 'wrap', 'x', 'area'))}", f"site-{token}", f"{token} c{r.randint(1, 9)}"))
        name = r.choice(("class", "class", "id"))
        if semantic and r.random() < chance:
            return f"<{semantic}{r.choice(('', f' {name}="{token}"'))}>{inner}</{semantic}>"
        tag = r.choice(("div", "div", "section", "ul" if inner.startswith("<li") else "div"))
        return f'<{tag} {name}="{token}">{inner}</{tag}>'

    def link(self) -> str:
        return f'<a href="/{self.r.randint(1, 99)}">{self.words(1, 4)}</a>'

    def items(self) -> str:
        return self.some(lambda: f"<li>{self.link()}</li>", 2, 8)

    def sentence(self) -> str:
        return f"<p>{self.words(3, 30)}</p>" if self.r.random() < 0.5 else self.words(3, 30)

    def menu(self) -> str:
        return self.named("nav", BAD["nav"], f"<ul>{self.items()}</ul>" if self.r.random() < 0.8 else self.some(self.link, 2, 8))

    def header(self) -> str:
        return self.named("header", "header masthead topbar branding", self.r.choice((self.words(1, 6), f"<h1>{self.words(1, 6)}</h1>", f"<p>{self.words(2, 20)}</p>", self.menu(), f"<h2>{self.words(1, 4)}</h2><p>{self.words(2, 15)}</p>")))

    def footer(self) -> str:
        return self.named("footer", "footer legal copyright imprint", self.r.choice((f"&copy; {self.words(4, 25)}", f"<p>{self.words(3, 40)}</p>", f"<ul>{self.items()}</ul><p>{self.words(3, 20)}</p>")), 0.7)

    def side(self) -> str:
        return self.named("aside", BAD["side"], self.r.choice((f"<h3>{self.words(1, 4)}</h3><ul>{self.items()}</ul>", f"<p>{self.words(5, 60)}</p>", self.sentence(), f"<h2>{self.words(1, 4)}</h2>" + self.some(lambda: f"<p>{self.words(4, 40)}</p>", 1, 4))))

    def advert(self) -> str:
        return self.named("", BAD["ad"], self.r.choice((self.words(3, 30), f"<p>{self.words(3, 30)}</p>", f"<h4>{self.words(2, 6)}</h4>{self.link()}")))

    def notice(self) -> str:
        return self.named("dialog", BAD["notice"], self.r.choice((self.words(6, 50), f"<p>{self.words(6, 50)}</p><button>{self.words(1, 2)}</button>")), 0.2)

    def form(self) -> str:
        return self.named("form", BAD["form"], f"<label>{self.words(1, 4)}</label><input><button>{self.words(1, 2)}</button>" + self.r.choice(("", f"<p>{self.words(3, 25)}</p>")), 0.8)

    def comments(self) -> str:
        one = lambda: self.r.choice((f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.words(3, 60)}</p></div>', f"<li><p>{self.words(3, 60)}</p></li>", f"<p>{self.words(3, 60)}</p>", f"<article><p>{self.words(3, 60)}</p></article>"))
        return self.named("section", BAD["comment"], f"<h3>{self.words(1, 3)}</h3>" + self.some(one, 1, 6), 0.0)

    def social(self) -> str:
        return self.named("", "share sharing social follow", self.r.choice((self.some(self.link, 2, 5), f"<ul>{self.items()}</ul>")))

    def junk(self, inside: bool) -> str:
        return self.r.choice((self.advert, self.side, self.form, self.social, self.notice, self.comments) if inside else (self.menu, self.header, self.footer, self.side, self.advert, self.notice, self.form, self.comments, self.social))()

    def prose(self) -> str:
        r, k = self.r, " data-k"
        inline = lambda t: r.choice((t, t, f"<b>{t}</b>", f"<em>{t}</em>", f"{t} {self.link()} {self.words(1, 9)}"))
        return r.choice((
            lambda: f"<p{k}>{inline(self.words(1, 120))}</p>", lambda: f"<p{k}>{inline(self.words(1, 120))}</p>", lambda: f"<p{k}>{inline(self.words(5, 200))}",
            lambda: f"<p{k}>{self.words(1, 6)}</p>", lambda: f"<h{r.randint(2, 4)}{k}>{self.words(1, 8)}</h3>".replace("</h3>", ""), lambda: f"<ul{k}>" + self.some(lambda: f"<li{k}>{self.words(1, 30)}</li>", 1, 6) + "</ul>",
            lambda: f"<blockquote{k}><p{k}>{self.words(3, 60)}</p></blockquote>", lambda: f"<div{k}>{self.words(3, 100)}</div>", lambda: f"<pre{k}>{self.words(3, 40)}</pre>", lambda: f"<table{k}><tr{k}>" + self.some(lambda: f"<td{k}>{self.words(1, 6)}</td>", 1, 4) + "</tr></table>",
        ))()

    def article(self) -> str:
        r = self.r
        plain = r.random() < 0.4
        text = self.some(lambda: f"<p data-k>{self.words(1, 150)}</p>", 1, 12) if plain else self.some(self.prose, 1, 14)
        inner = (f"<h1 data-k>{self.words(2, 14)}</h1>" if r.random() < 0.8 else "") + text
        if r.random() < 0.4:
            inner = self.junk(True) + inner if r.random() < 0.3 else inner + self.junk(True)
        token = r.choice("article content main-content post entry-content story article-body post-body text".split())
        name = r.choice(("class", "id"))
        shape = r.random()
        if shape < 0.5:
            out = f"<article data-k>{inner}</article>"
        elif shape < 0.6:
            out = f"<main data-k>{inner}</main>"
        elif shape < 0.9:
            out = f'<div {name}="{token}" data-k>{inner}</div>'
        else:
            out = f"<div data-k>{inner}</div>"
        if r.random() < 0.4:
            out = f"<{r.choice(('main', 'div', 'section'))} data-k>{out}"
        return out

    def page(self) -> str:
        r = self.r
        before = "".join(self.junk(False) for _ in range(r.choice((0, 1, 1, 2, 3))))
        after = "".join(self.junk(False) for _ in range(r.choice((0, 1, 1, 2, 4))))
        if r.random() < 0.6:
            before = self.menu() + before
        if r.random() < 0.6:
            after += self.footer()
        return f"<html><body data-k>{before}{self.article() if r.random() < 0.97 else ''}{after}</body></html>"


def train(pages: int = 1200, seed: int = 7) -> BoostedTrees:
    layouts = Layouts(seed)
    xs, ys, ws = [], [], []
    for _ in range(pages):
        nodes, x = features(parse(layouts.page()))
        xs.append(x)
        ys.append([n.parent is None or n.marked for n in nodes])
        ws.append([1 + min(n.chars, 200) / 40 for n in nodes])
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys).astype("f8"), np.concatenate(ws))


_models: dict[int, BoostedTrees] = {}


def model(seed: int = 7) -> BoostedTrees:
    if seed not in _models:
        _models[seed] = train(seed=seed)
    return _models[seed]


def texts(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text."""
    trees = model()
    cut = lambda part: {"text": extract(part.column("html").to_pylist(), trees)}
    return map_rows(parallel(spark, pages.select("page_id", "url", "html")), cut, "text string", drop=("html",), step=128)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
