"""Main text of web pages: gradient-boosted trees over DOM nodes, then hierarchical decoding.

A tolerant parser makes block-level nodes; inline elements are text of their block.  Trees score each node by its
tag, attribute tokens, depth, subtree density (text, links, punctuation, paragraphs), ancestors and siblings.  The
decoder picks the set of nodes with the largest sum of score x own text under one rule: a node below a dropped one is
dropped.  So no kept paragraph hangs in a dropped menu, and a comment thread inside an article can go as a whole.

The model is trained here, on `TRAIN_PAGES` labelled pages that `labelled_page` makes up from a seed: layouts, class
names and prose vary, each node is known to be article or not.  It is as large on any corpus.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from foliant.llm.common import portions

TRAIN_PAGES, TREES, DEPTH, RATE, BINS = 1_000, 100, 4, 0.2, 32
BATCH_BYTES = 2 << 20  # of html whose nodes are held in arrays at a time

# HTML element kinds and common words of class names.
HEAD = frozenset("base basefont bgsound link meta noembed noframes noscript script style template title head html".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label map mark math menclose mfrac mi mn mo mover mrow ms msqrt msub msubsup msup mtext munder meter noscript output q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
HIDDEN = frozenset("head button select option datalist input object canvas audio video area embed svg template".split())
RAW = frozenset("script style iframe noembed noframes textarea title xmp plaintext".split())
BREAKS = frozenset("""b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup
    table tt u ul var""".split())  # end an open svg
CLOSES = {
    "p": frozenset(["p"]), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]),
}
SCOPE = {"li": frozenset(["ul", "ol"]), "tr": frozenset(["table"]), "td": frozenset(["tr"]), "th": frozenset(["tr"]),
    "dt": frozenset(["dl"]), "dd": frozenset(["dl"])}
NO_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
GOOD = frozenset("article articlebody body content entry main post story text page prose copy maincontent".split())
BAD = frozenset("""ad ads alert announcement adv advert advertisement banner bottom breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer discuss disqus
    foot footer form gdpr head header hidden legal links login masthead menu meta modal nav navbar navigation newsletter notice notification pager pagination popup popular privacy
    promo promotion recommended related replies reply respond search share sharing sidebar side signup skip social sponsor sponsored subscribe tag tags teaser toolbar top topbar trending warning widget widgets""".split())
TAGS = ("p", "h1", "h2", "h3", "li", "ul", "ol", "div", "section", "article", "main", "nav", "header", "footer",
    "aside", "form", "blockquote", "pre", "td", "figure", "body")

# Attributes as browsers read them: a quote delimits a value only behind "=".  Every part is possessive, so a tag is
# read once; only the end of the page can make it fail.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|["'][^\s>]*+)?+"""
_TAG = re.compile(rf"""</?+([a-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+)>""", re.I)
_PLAIN_TAG = re.compile(r"</?+([a-z][^\s/>]*+)([^>]*+)>", re.I)
_ATTR = re.compile(r"""([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""")
_COMMENT_END = re.compile(r"--!?>")
_NAMED = frozenset("class id role itemprop aria-label hidden style".split())
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_LONG_NUMBER = re.compile(r"&#\d{8,}+;?")
_BARE_COMMENT = re.compile(r"<!--(?:-?+>)")
_TAG_NO = {t: i for i, t in enumerate(TAGS)}
_NONE, _P = frozenset(), frozenset(["p"])
_WALLS = frozenset("table td article section div blockquote figure body".split())
TITLES, CHOICES = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset(["button", "select", "datalist"])
LOOSE = -2  # stands for the node of a button or list without an end tag: the next block ends it
MAX_OPEN = 512  # open elements; browsers have the same bound


@dataclass
class Page:
    """Block nodes in page order, and text segments (node, words)."""

    tag: list[int] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    good: list[int] = field(default_factory=list)
    bad: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    stops: list[int] = field(default_factory=list)
    segments: list[tuple[int, str]] = field(default_factory=list)
    mark: list[str] = field(default_factory=list)  # data-y of training pages


def _tokens(attrs: str) -> tuple[int, int]:
    good = bad = 0
    for name, value in _ATTR.findall(attrs):
        name = name.lower()
        if name not in _NAMED:
            continue
        if name == "style":
            bad += bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        elif name == "hidden":
            bad += 1
        else:
            for w in _WORDS.findall(value):
                w = w.lower()
                good += w in GOOD
                bad += w in BAD
    return good, bad


def _decoded(part: str) -> str:
    """Text with its character references decoded."""
    if "&" not in part:
        return part
    try:
        return unescape(part)
    except ValueError:  # a number of thousands of digits, which is no character
        return unescape(_LONG_NUMBER.sub("�", part))


def _empty(attrs: str) -> bool:
    """Whether a tag with these attributes closes itself: a slash at its end that is no part of a value."""
    if not attrs.endswith("/"):
        return False
    value = attrs.rsplit(None, 1)[-1].partition("=")[2]
    return not value or value == "/" or value[0] in "\"'"


class Tags:
    """The page cut into text, comments, tags and raw text by one walk from `<` to `<`, in time linear in its length."""

    def __init__(self, html: str) -> None:
        self.html, self.last, self.plain = html, html.rfind(">"), False
        self.ends: dict[str, int] = {}

    def closes(self, name: str, at: int) -> bool:
        """Whether an end tag of this name comes behind at; each name's last end tag is looked up once."""
        if name not in self.ends:
            self.ends[name] = max((m.start() for m in _closing(name).finditer(self.html)), default=-1)
        return self.ends[name] >= at

    def pairs(self, name: str, at: int) -> bool:
        """Whether the next tag of this name is an end tag."""
        return self.closes(name, at) and (m := _either(name).search(self.html, at)) is not None and m[1] == "/"

    def after(self, name: str, at: int) -> tuple[int, int]:
        """Raw text of an element from at on: where it ends, and where its end tag does."""
        m = _closing(name).search(self.html, at) if self.closes(name, at) else None
        if m is None:
            return len(self.html), len(self.html)
        return m.start(), (self.html.find(">", m.end()) + 1) or len(self.html)

    def next(self, at: int) -> tuple[int, int, str, str] | None:
        """(start, end, name, attributes) of the next markup from at on: name is empty for comments, starts with / for
        end tags.  A `<` that starts no markup, or that no `>` follows, is text."""
        html = self.html
        while True:
            lt = html.find("<", at)
            if lt < 0:
                return None
            if html.startswith("<!--", lt):
                m = _BARE_COMMENT.match(html, lt) or _COMMENT_END.search(html, lt + 4)
                return lt, m.end() if m else len(html), "", ""
            at = lt + 1
            if lt > self.last:
                continue
            c = html[lt + 1]
            if c.isascii() and c.isalpha() or c == "/" and html[lt + 2].isascii() and html[lt + 2].isalpha():
                m = None if self.plain else _TAG.match(html, lt)
                if m is None:  # a quote is open to the end of the page: from here on quotes count for nothing
                    self.plain = True
                    m = _PLAIN_TAG.match(html, lt)
                return lt, m.end(), ("/" if c == "/" else "") + m[1].lower(), m[2]
            if c in "!?/":
                return lt, html.index(">", lt) + 1, "", ""


@lru_cache(maxsize=64)
def _closing(name: str) -> re.Pattern:
    return re.compile(rf"</{name}(?=[\s/>])", re.I)


@lru_cache(maxsize=64)
def _either(name: str) -> re.Pattern:
    return re.compile(rf"<(/?+){name}(?=[\s/>])", re.I)


def parse(html: str | None, marks: bool = False) -> Page:
    """Nodes and segments of a page; any input gives a result, in time linear in its length.

    Tags that may be left out are implied: content closes an open head, a block closes an open button.  An element
    whose content is hidden and whose end tag never comes is taken as empty, so that it hides nothing of the page.
    """
    page, html = Page(), html or ""
    stack: list[tuple[str, int]] = []  # open elements; node -1: inline
    blocks: list[int] = []  # nodes of the open blocks
    count: dict[str, int] = {}  # open elements by name
    text: list[tuple[str, bool]] = []
    links = hidden = 0

    def node(tag: str, attrs: str) -> int:
        good, bad = _tokens(attrs) if attrs else (0, 0)
        up = blocks[-1] if blocks else -1
        for c, v in ((page.tag, _TAG_NO.get(tag, len(TAGS))), (page.parent, up),
            (page.depth, page.depth[up] + 1 if up >= 0 else 0), (page.good, good), (page.bad, bad),
                     (page.chars, 0), (page.linked, 0), (page.words, 0), (page.stops, 0)):
            c.append(v)
        if marks:
            page.mark.append(m[1] if (m := re.search(r'data-y="(\w)"', attrs)) else "")
        return len(page.tag) - 1

    def push(name: str, at: int) -> None:
        stack.append((name, at))
        count[name] = count.get(name, 0) + 1
        if at >= 0:
            blocks.append(at)

    def flush() -> None:
        if not text:
            return
        joined = " ".join("".join(t for t, _ in text).split())
        if joined:
            if not blocks:  # text outside of any block: the page itself
                at = node("body", "")
                stack.insert(0, ("body", at))
                count["body"] = count.get("body", 0) + 1
                blocks.append(at)
            at = blocks[-1]
            page.segments.append((at, joined))
            page.chars[at] += len(joined)
            page.words[at] += joined.count(" ") + 1
            page.stops[at] += sum(map(joined.count, ".,;:!?"))
            page.linked[at] += min(len(joined), sum(len(t.strip()) for t, l in text if l))
        text.clear()

    def close(to: int) -> None:
        """Close the open elements from place to on."""
        nonlocal links, hidden
        if any(n >= 0 for _, n in stack[to:]):
            flush()
        for name, n in stack[to:]:
            links -= name == "a"
            hidden -= name in HIDDEN
            count[name] -= 1
            if n >= 0:
                blocks.pop()
        del stack[to:]

    def last_open(names) -> int:
        return next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in names), -1)

    def add(part: str, raw: bool = False) -> None:
        if count.get("head") and stack[-1][0] == "head" and part.strip():
            close(last_open(("head",)))  # text is no content of a head
        if not hidden:
            text.append((part if raw else _decoded(part), links > 0))

    def end(name: str) -> None:
        if name == "br" and not hidden:
            text.append((" ", False))
        if name in TITLES and not count.get(name):  # the end of one heading ends another
            name = next((x for x, _ in reversed(stack) if x in TITLES), name)
        if not count.get(name):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == name:
                close(k)
                return
            if name in INLINE and stack[k][1] >= 0:
                return

    def start(name: str, attrs: str, to: int) -> int:
        """Take a start tag that ends at to; gives where reading goes on."""
        nonlocal links, hidden
        if name not in HEAD and count.get("head"):
            close(last_open(("head",)))
        if name in RAW:
            if name == "plaintext":
                flush()
                add(html[to:], raw=True)
                return len(html)
            if name in ("title", "textarea") and not tags.closes(name, to):
                return to
            if count.get("svg") and _empty(attrs):
                return to
            begin, (stop, to) = to, tags.after(name, to)
            if name == "xmp":
                flush()
                push(name, node("pre", attrs))
                add(html[begin:stop], raw=True)
                close(len(stack) - 1)
            return to
        if name in BREAKS and count.get("svg") and not count.get("foreignobject"):
            close(last_open(("svg",)))
        if name in NO_P and any(map(count.get, CHOICES)) and stack[k := last_open(CHOICES)][1] == LOOSE:
            close(k)
        if name in HIDDEN:
            if name == "head":
                push(name, -1)
                hidden += 1
            elif name in VOID or name == "option" or name == "svg" and _empty(attrs):
                pass
            elif name in CHOICES:
                if count.get(name):
                    close(last_open((name,)))
                push(name, -1 if tags.pairs(name, to) else LOOSE)
                hidden += 1
            elif tags.closes(name, to) and len(stack) < MAX_OPEN:
                push(name, -1)
                hidden += 1
            return to
        if name in INLINE:
            if name == "br" or name == "img":
                if not hidden:
                    text.append((" ", False))
            elif name not in VOID and len(stack) < MAX_OPEN and not _empty(attrs):
                push(name, -1)
                links += name == "a"
            return to
        flush()
        shut = CLOSES.get(name, _NONE) | (_P if name in NO_P else _NONE)
        if any(map(count.get, shut)):
            stop = SCOPE.get(name, _NONE)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    close(k)
                    if name == "p" or name not in NO_P or not any(map(count.get, shut)):
                        break
                elif stack[k][0] in stop or stack[k][0] in _WALLS:
                    break
        if name in VOID:
            return to
        if len(stack) >= MAX_OPEN:  # as browsers do: beyond a depth, elements stand side by side
            close(len(stack) - 1)
        push(name, node(name, attrs))
        return to

    tags, at = Tags(html), 0
    while (found := tags.next(at)) is not None:
        begin, stop, name, attrs = found
        if begin > at:
            add(html[at:begin])
        at = stop
        if name[:1] == "/":
            end(name[1:])
        elif name:
            at = start(name, attrs, stop)
    if at < len(html):
        add(html[at:])
    flush()
    return page


class Batch:
    """Nodes of many pages in arrays; parents point within the batch, -1 at roots."""

    def __init__(self, pages: list[Page]) -> None:
        sizes = [len(p.tag) for p in pages]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.page = np.repeat(np.arange(len(pages)), sizes)
        cat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
        self.tag, self.depth, self.good, self.bad, self.chars, self.linked, self.words, self.stops = map(cat,
            ("tag", "depth", "good", "bad", "chars", "linked", "words", "stops"))
        up = cat("parent")
        self.parent = np.where(up >= 0, up + self.starts[self.page], -1)
        self.levels = [np.flatnonzero(self.depth == d) for d in range(int(self.depth.max(initial=-1)) + 1)]

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.astype(float)
        for at in reversed(self.levels[1:]):
            np.add.at(out, self.parent[at], out[at])
        return out

    def down(self, values: np.ndarray) -> np.ndarray:
        """Sums over proper ancestors."""
        out = np.zeros(len(values))
        for at in self.levels[1:]:
            out[at] = out[self.parent[at]] + values[self.parent[at]]
        return out

    def features(self) -> np.ndarray:
        """A row for each node."""
        return self._stacked(self.columns(), 0, len(self.tag))

    def scores(self, trees: Trees, rows: int = 1 << 15) -> np.ndarray:
        """Scores of the nodes; the matrix is made for so many at a time."""
        cols, n = self.columns(), len(self.tag)
        return np.concatenate([trees.score(self._stacked(cols, a, min(a + rows, n))) for a in range(0, n, rows)]
            or [np.zeros(0)])

    @staticmethod
    def _stacked(cols: list[np.ndarray], a: int, b: int) -> np.ndarray:
        return np.stack([c[a:b].astype(float) for c in cols], axis=1) if cols else np.zeros((0, 1))

    def columns(self) -> list[np.ndarray]:
        """The features one by one, kinds and ancestors as Booleans."""
        n = len(self.tag)
        if not n:
            return []
        up = np.maximum(self.parent, 0)
        has = self.parent >= 0
        total = np.bincount(self.page, self.chars, minlength=len(self.starts))[self.page]
        before = np.cumsum(self.chars) - self.chars
        before = before - before[np.minimum(self.starts[self.page], n - 1)]
        sub = {k: self.up(getattr(self, k)) for k in ("chars", "linked", "words", "stops")}
        nodes, paras, links = self.up(np.ones(n)), self.up(self.tag == _TAG_NO["p"]), self.up(self.linked > 0)
        sub_bad = self.up(self.bad > 0)
        kids = np.bincount(up[has], minlength=n)[:n].astype(float)
        group = np.where(has, up, n + self.page)
        of = lambda v: np.bincount(group, v, minlength=n + len(self.starts))[group]
        size = of(np.ones(n))
        order = np.arange(n)
        firsts = np.full(n + len(self.starts), n)
        np.minimum.at(firsts, group, order)
        rank = (order - firsts[group]) / np.where(has, nodes[up], np.bincount(self.page)[self.page])
        cols = [
            self.depth, self.good > 0, self.bad > 0, self.down(self.good > 0) > 0,
            np.minimum(self.down(self.bad > 0), 3),
            self.chars, self.words, self.stops / np.maximum(self.words, 1), self.linked / np.maximum(self.chars, 1),
            self.chars / np.maximum(self.words, 1),
            sub["chars"], sub["words"] / nodes, sub["stops"] / np.maximum(sub["words"], 1),
            sub["linked"] / np.maximum(sub["chars"], 1), paras, links / nodes, sub_bad / nodes,
            sub["chars"] / np.maximum(total, 1), before / np.maximum(total, 1), kids, size, rank,
            of(self.bad > 0) / size, of(self.chars) / size, of(self.linked) / np.maximum(of(self.chars), 1),
            np.where(has, sub["chars"][up], total), np.where(has, sub["linked"][up] / np.maximum(sub["chars"][up], 1),
            0), np.where(has, paras[up], 0), np.where(has, sub["stops"][up] / np.maximum(sub["words"][up], 1), 0),
        ]
        cols += [self.tag == i for i in range(len(TAGS))]
        for t in ("article", "main", "nav", "header", "footer", "aside", "form", "ul", "p", "section"):
            cols.append(self.down(self.tag == _TAG_NO[t]) > 0)
        return cols


@dataclass
class Trees:
    """Boosted trees: per tree, split features, thresholds (right if greater) and leaf values in heap order."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
    """Second-order boosting of the log-loss on histograms of quantile bins, all nodes of a level at once."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)
    p = float((y * weight).sum() / weight.sum())
    base = float(np.log(p / (1 - p)))
    margin = np.full(len(y), base)
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    fs, cs, vs = [], [], []
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        g, h = weight * (prob - y), weight * prob * (1 - prob)
        at = np.zeros(len(y), np.int64)
        f, c = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(DEPTH):
            first, width = 2**level - 1, 2**level
            local = at - first
            best = np.full(width, 1e-6)
            for j in range(x.shape[1]):
                if not len(edges[j]):
                    continue
                key = local * (BINS + 1) + binned[:, j]
                gl, hl = (np.bincount(key, w, minlength=width * (BINS + 1)).reshape(width, -1).cumsum(axis=1)
                    for w in (g, h))
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                gain = np.where((hl > 1e-3) & (ht - hl > 1e-3), gain, 0)[:, : len(edges[j])]
                b = gain.argmax(axis=1)
                v = gain[np.arange(width), b]
                up = v > best + 1e-12
                best[up] = v[up]
                f[first : first + width][up] = j
                c[first : first + width][up] = edges[j][b[up]]
            at = 2 * at + 1 + (x[np.arange(len(y)), f[at]] > c[at])
        leaf = at - inner
        v = -RATE * np.bincount(leaf, g, minlength=leaves) / (np.bincount(leaf, h, minlength=leaves) + 1)
        margin += v[leaf]
        fs.append(f), cs.append(c), vs.append(v)
    return Trees(base, np.array(fs), np.array(cs), np.array(vs))


def decode(batch: Batch, score: np.ndarray) -> np.ndarray:
    """Kept nodes: the best sum of score x (own characters + 1) such that nothing below a dropped node is kept."""
    value = score * (batch.chars + 1)
    for at in reversed(batch.levels[1:]):
        np.add.at(value, batch.parent[at], np.maximum(value[at], 0))
    keep = value > 0
    for at in batch.levels[1:]:
        keep[at] &= keep[batch.parent[at]]
    return keep


def labelled_page(rng: random.Random) -> str:
    """A made-up page; data-y of a block is y (article) or n (not); blocks that hold both have none."""
    parts = ["th", "er", "on", "an", "ing", "es", "ver", "lich", "que", "ment", "ción", "os", "eau", "en", "de", "la",
        "st", "ble"]
    word = lambda: "".join(rng.choices(parts, k=rng.randint(1, 4)))

    def prose(lo: int, hi: int) -> str:
        ws = [word() for _ in range(rng.randint(lo, hi))]
        for k in range(len(ws)):
            if rng.random() < 0.12:
                ws[k] += rng.choice([".", ".", ",", ";", "!!", "***"])
        return " ".join(ws).capitalize() + rng.choice([".", ".", ".", ""])

    def link(lo: int = 1, hi: int = 4) -> str:
        return f'<a href="/{word()}">{" ".join(word() for _ in range(rng.randint(lo, hi)))}</a>'

    def named(*names: str) -> str:
        """A telling class or id most of the time, else none or a meaningless one."""
        r = rng.random()
        if r < 0.75:
            return f' {rng.choice(["class", "class", "id"])}="{rng.choice(names)}"'
        return "" if r < 0.9 else f' class="{word()}"'

    def box(tag: str, attrs: str, y: str, inner: str) -> str:
        return f'<{tag}{attrs} data-y="{y}">{inner}</{tag}>'

    def items(y: str, n: int, make) -> str:
        return box("ul", "", y, "".join(box("li", "", y, make()) for _ in range(n)))

    def nav() -> str:
        return rng.choice([
            lambda: box("nav", named("main-nav", "menu") if rng.random() < 0.5 else "", "n",
            items("n", rng.randint(3, 9), link)),
            lambda: box("div", ' class="' + rng.choice(["menu", "navbar", "nav top", "breadcrumb"]) + '"', "n",
            " ".join(link() for _ in range(rng.randint(3, 8)))),
            lambda: box("nav", "", "n", rng.choice([" | ", " ", ""]).join(link(1, 1)
            for _ in range(rng.randint(2, 8))))])()

    def header() -> str:
        inner = rng.choice([lambda: box("h1", "", "n", prose(1, 4)), lambda: box("div", ' class="logo"', "n", link()),
            lambda: box("p", "", "n", prose(3, 10))])()
        return rng.choice([lambda: box("header", named("site-header", "masthead"), "n",
            inner + (nav() if rng.random() < 0.5 else "")),
            lambda: box("div", f' class="{rng.choice(["header", "site-header", "masthead", "topbar"])}"', "n",
            inner)])()

    def footer() -> str:
        says = rng.choice(["&copy; ", "Copyright ", "&copy; 2024 ",
            ""]) + word() + ".example.com" + rng.choice([" &middot; ", " ", ". "]) + (prose(2, 25) if rng.random() < 0.8
            else "")
        inner = rng.choice([lambda: says, lambda: box("p", "", "n", says),
            lambda: box("div", "", "n", says) + items("n", 3, link)])()
        return rng.choice([lambda: box("footer", named("footer", "site-footer") if rng.random() < 0.4 else "", "n",
            inner), lambda: box("div", f' class="{rng.choice(["footer", "bottom", "site-footer", "copyright"])}"', "n",
            inner)])()

    def ad() -> str:
        inner = rng.choice([lambda: prose(2, 40), lambda: box("p", "", "n", prose(4, 40)), lambda: link(2, 9)])()
        return box(rng.choice(["div", "div", "aside", "section"]),
            f' {rng.choice(["class", "id"])}="{rng.choice(["ad", "ads", "advert", "banner", "promo", "sponsored", "ad-box", "advertisement", "sponsor"])}"',
            "n", inner)

    def notice() -> str:
        inner = rng.choice([lambda: prose(5, 40), lambda: box("p", "", "n", prose(8, 50)) + "<button>OK</button>"])()
        if rng.random() < 0.2:
            return box(rng.choice(["div", "p"]), f' role="{rng.choice(["alert", "dialog"])}"', "n", inner
                if "<p" not in inner else prose(4, 30))
        return box("div",
            f' class="{rng.choice(["cookie", "cookie-notice", "notice", "consent", "gdpr-banner", "popup", "notification", "warning", "alert", "announcement"])}"',
            "n", inner)

    def aside() -> str:
        inner = rng.choice([
            lambda: box("h3", "", "n", prose(1, 3)) + items("n", rng.randint(2, 7), link),
            lambda: box("h2", "", "n", prose(1, 3)) + box("p", "", "n", prose(8, 60)),
            lambda: "".join(box("p", "", "n", prose(5, 40)) for _ in range(rng.randint(1, 4))), lambda: prose(4, 30),
            lambda: items("n", rng.randint(2, 6), lambda: prose(2, 12))])()
        return rng.choice([lambda: box("aside", named("sidebar", "widget", "related") if rng.random() < 0.5 else "",
            "n", inner),
            lambda: box("div",
            f' class="{rng.choice(["sidebar", "widget", "related", "side", "recommended", "popular", "related-posts"])}"',
            "n", inner)])()

    def form() -> str:
        inner = rng.choice([lambda: f"<label>{prose(1, 4)}</label><input name=q><button>{word()}</button>",
            lambda: box("p", "", "n", prose(4, 25)) + "<input type=text>",
            lambda: prose(3, 20) + "<input><select><option>a<option>b</select>"])()
        return rng.choice([lambda: box("form", named("newsletter", "search", "subscribe", "login") if rng.random() < 0.6
            else "", "n", inner), lambda: box("div", ' class="newsletter signup"', "n", box("form", "", "n", inner))])()

    def comments() -> str:
        one = lambda: rng.choice([lambda: box("p", "", "n", prose(4, 90)),
            lambda: box("b", "", "n", word()) + box("p", "", "n", prose(4, 90)) + link(1, 1)])()
        each = [lambda: box("div", ' class="' + rng.choice(["comment", "reply", "comment-body", "comment"]) + '"', "n",
            one()), lambda: box("li", "", "n", one()), lambda: box("article", ' class="comment"', "n", one())]
        kind = rng.choice(each)
        inner = (box("h2", "", "n", prose(1, 3)) if rng.random() < 0.6 else "") + "".join(kind()
            for _ in range(rng.randint(1, 7)))
        return box(rng.choice(["section", "div", "ol", "ul"]),
            f' {rng.choice(["id", "class"])}="{rng.choice(["comments", "comment-list", "discussion comments", "replies", "respond", "disqus"])}"',
            "n", inner)

    def share() -> str:
        return box("div",
            f' class="{rng.choice(["share", "social", "tags", "meta share", "sharing", "pagination", "pager"])}"', "n",
            " ".join(link(1, 2) for _ in range(rng.randint(2, 5))))

    def body() -> str:
        kinds = [
            (12, lambda: box("p", "", "y", prose(1, 120))),
            (2, lambda: box("p", "", "y", "<b>" + prose(3, 30) + "</b> " + link() + prose(3, 40))),
            (1, lambda: f'<p data-y="y"><b>{prose(2, 50)}<br>'),
            (1, lambda: box(rng.choice(["h2", "h3"]), "", "y", prose(1, 8))),
            (1, lambda: items("y", rng.randint(2, 7), lambda: prose(2, 25))),
            (1, lambda: box("blockquote", "", "y", box("p", "", "y", prose(8, 60)))),
            (0.5, lambda: box("pre", "", "y", prose(3, 40))),
            (0.5, lambda: box("table", "", "y", "".join(box("tr", "", "y",
            "".join(box("td", "", "y", prose(1, 6)) for _ in range(3))) for _ in range(rng.randint(1, 4))))),
            (0.5, lambda: box("figure", "", "y", "<img src=x>" + box("figcaption", "", "y", prose(3, 15)))),
            (0.6, lambda: box("div", "", "y", prose(4, 80)))]
        inside = [(0.25, ad), (0.25, share), (0.15, aside), (0.1, form), (0.1, notice)]
        n = rng.choice([1, 2, 3, 5, 8, 12, 20])
        weights = [w for w, _ in kinds]
        out = [rng.choices([k for _, k in kinds], weights)[0]() for _ in range(n)]
        for chance, make in inside:
            if rng.random() < chance * 0.6:
                out.insert(rng.randint(0, len(out)), make())
        title = box("h1", "", "y", prose(2, 12)) if rng.random() < 0.9 else ""
        if title and rng.random() < 0.15:
            title = box("header", "", "y", title + (box("p", "", "y", prose(3, 20)) if rng.random() < 0.5 else ""))
        return title + "".join(out)

    talk = comments() if rng.random() < 0.35 else ""
    within = talk if rng.random() < 0.4 else ""
    inner = body() + within
    r = rng.random()
    if r < 0.08:  # straight in the page
        core = inner
    elif r < 0.48:
        core = box("article", named("post", "article", "story") if rng.random() < 0.3 else "", "y", inner)
    elif r < 0.6:
        core = box("main", "", "y", inner if rng.random() < 0.5 else box("article", "", "y", inner))
    elif r < 0.85:
        core = box("div",
            f' {rng.choice(["class", "id"])}="{rng.choice(["content", "main-content", "post", "entry", "article-body", "story", "text", "page-content"])}"',
            "y", inner)
    else:
        core = box(rng.choice(["div", "section"]), "", "y", inner)
    if within != talk:
        core += talk
    around = [(0.8, nav), (0.5, header), (0.5, ad), (0.3, notice), (0.3, aside), (0.2, form), (0.15, share)]
    above = [f() for p, f in around if rng.random() < p]
    below = [f() for p, f in ((0.4, aside), (0.3, share), (0.3, ad), (0.25, form), (0.15, nav), (0.1, notice))
        if rng.random() < p]
    rng.shuffle(above), rng.shuffle(below)
    bare = rng.random() < 0.06  # nothing but the article
    if bare:
        above, below = [], []
    whole = "".join(above) + core + "".join(below)
    if rng.random() < 0.25:
        whole = f'<div class="{rng.choice(["wrapper", "container", "page", word()])}">{whole}</div>'
    return f'<!DOCTYPE html><html><head><title>{prose(1, 9)}</title><style>p{{margin:0}}</style></head><body>{whole}{footer() if rng.random() < 0.85 and not bare else ""}</body></html>'


@lru_cache(maxsize=2)
def model(pages: int = TRAIN_PAGES, seed: int = 5) -> Trees:
    """Trees trained on made-up labelled pages; the same for the same arguments."""
    rng = random.Random(seed)
    made = [parse(labelled_page(rng), marks=True) for _ in range(pages)]
    batch = Batch(made)
    mark = np.array([m for p in made for m in p.mark])
    known = mark != ""
    # a node counts by its text: a paragraph that is missed costs what it holds
    weight = np.log1p(batch.chars) + 0.3
    return boost(batch.features()[known], (mark[known] == "y").astype(float), weight[known])


def texts(htmls: list[str | None], trees: Trees) -> list[str]:
    """Main texts of pages: kept blocks in page order, joined by a line break."""
    pages = [parse(h) for h in htmls]
    batch = Batch(pages)
    if not len(batch.tag):
        return [""] * len(htmls)
    keep = decode(batch, batch.scores(trees))
    return ["\n".join(t for n, t in p.segments if keep[s + n]) for p, s in zip(pages, batch.starts)]


def extract(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """page_id, url, text, n_chars (code points) of every row; null, empty and markup-free input give what text there is kept."""
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(trees or model())  # TREES trees of fixed depth

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, n in portions(pc.coalesce(pc.binary_length(b.column(2)), 0).to_pylist(), BATCH_BYTES):
                part = b.slice(at, n)
                found = texts(part.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()),
                    pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
