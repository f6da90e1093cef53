"""Main text of HTML pages: flat blocks, classified by a decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values. Elements that end the text of a block.
BREAKS = frozenset("address article aside blockquote body button canvas center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                   "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav noscript ol option p pre section select summary "
                   "table tbody td template textarea tfoot th thead title tr ul".split())
#: Elements whose content is no text of the page.
SILENT = frozenset("canvas iframe math noembed noframes noscript object script select style svg template textarea title".split())
#: Of these, those whose content holds no markup.
RAW = frozenset("iframe noembed noframes script style textarea title".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements and words in class, id or role that stand around what is no article. Where such a
#: mark holds for a whole layout and not a part of it (void()), it says nothing.
AROUND = frozenset("nav footer aside menu dialog button".split())
HINTS = frozenset("ad ads advert advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer gdpr legal "
                  "login menu modal nav navbar navigation newsletter notice notices pagination popup promo promotion related share sharing "
                  "sidebar signup skip social sponsor sponsored subscribe toolbar widget copyright disclaimer overlay paywall recommended sitemap "
                  "subnav topbar".split())
READERS = frozenset("comment comments disqus replies reply respond".split())
#: These only where no article has begun.
HEADERS = frozenset("header logo masthead brand".split())
ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
#: A name after one of these tells what a layout has or lacks, not what it is.
TELLING = frozenset("has no with without is not hide show".split())
INLINE = frozenset("b i em strong span a u small font".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TEXTS = frozenset("p li td th dd dt blockquote pre figcaption caption".split())
MOST, LARGE = 0.5, 50
"""A weak mark around a larger share of the words, and as many words, is one of a layout."""
#: An element that one of these starts closes an open one of those.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}} | {
    t: {"p"} for t in BREAKS - {"li", "dt", "dd", "tr", "td", "th", "option", "button", "canvas", "iframe", "noscript", "select", "template", "textarea"}}

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I | re.S)
_NAME = re.compile(r"[A-Za-z]+")

FEATURES = ["words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after", "words_near", "heading", "running", "marked", "inside", "outside"]
WEAK, READER, STRONG = 1, 2, 3


def _marks(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """What an element's name and attributes say: the kind of its mark, 0 for none; whether it is hidden."""
    mark, hidden = STRONG if tag in AROUND or tag == "header" and not inside else WEAK if tag == "form" else 0, False
    if attributes and not attributes.isspace():
        for m in _ATTRIBUTE.finditer(attributes):
            key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if key in ("class", "id"):
                for name in value.split():
                    parts = _NAME.findall(name)
                    for before, w in zip(["", *parts], parts):
                        if before not in TELLING and tag not in ("html", "body", "article", "main"):
                            mark = max(mark, READER if w in READERS else WEAK if w in HINTS or w in HEADERS and not inside else 0)
            elif key == "role":
                mark = max(mark, WEAK * (value.strip() in ROLES and tag not in ("html", "body", "article", "main")))
            elif key == "style":
                hidden |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
            else:
                hidden |= key == "hidden" or value == "true"
    return mark, hidden


@dataclass
class Nodes:
    """The elements of a page, parents first; the page itself is the first."""

    tag: list[str] = field(default_factory=lambda: [""])
    parent: list[int] = field(default_factory=lambda: [0])
    mark: list[int] = field(default_factory=lambda: [0])
    inside: list[bool] = field(default_factory=lambda: [False])

    def add(self, tag: str, parent: int, mark: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.mark.append(mark)
        self.inside.append(self.inside[parent] or tag in ("article", "main"))
        return len(self.tag) - 1

    def marked(self, words: list[int]) -> list[bool]:
        """By element, whether it or one around it has a mark that isn't void; words: those in each."""
        n, words, holds = len(self.tag), words.copy(), [False] * len(self.tag)
        for i in range(n - 1, 0, -1):
            p = self.parent[i]
            words[p] += words[i]
            holds[p] |= holds[i] or self.tag[i] in ("article", "main")
        out, scope = [False] * n, [0] * n
        for i in range(1, n):
            p = self.parent[i]
            scope[i] = p if self.tag[p] in ("article", "main") else scope[p]
            out[i] = out[p] or self.mark[i] > 0 and not holds[i] and not (self.mark[i] == WEAK and self.void(words[i], words[scope[i]]))
        return out

    @staticmethod
    def void(own: int, scope: int) -> bool:
        """Whether an element with a weak mark holds all words of the article or page, or most of many."""
        return own >= scope or own > MOST * scope and own >= LARGE


def blocks(page: str) -> tuple[list[tuple[str, int, int, int]], Nodes]:
    """(text, words, words in links, element) of each block of text, in page order; the elements.

    A block ends where a block element begins or ends. Work is linear: an end is looked for
    only where its element is open.
    """
    out: list = []
    text: list[str] = []
    linked: list[str] = []
    nodes = Nodes()
    stack: list[tuple[str, int, bool]] = []  # tag, element, silent
    solid: list[int] = []  # places in the stack of what is no inline element
    opened: Counter = Counter()
    node, silent = 0, False
    links, at, n = 0, 0, len(page)

    def close() -> None:
        if text:
            found = " ".join("".join(text).split())
            if found:
                out.append((found, found.count(" ") + 1, len("".join(linked).split()), node))
            text.clear()
            linked.clear()

    def drop(to: int) -> None:
        nonlocal node, silent
        for tag, _, _ in stack[to:]:
            opened[tag] -= 1
        del stack[to:]
        while solid and solid[-1] >= to:
            solid.pop()
        _, node, silent = stack[-1] if stack else ("", 0, False)

    while at < n:
        m = _TOKEN.search(page, at)
        until = m.start() if m else n
        if until > at and not silent:
            piece = html.unescape(page[at:until]) if "&" in page[at:until] else page[at:until]
            text.append(piece)
            if links:
                linked.append(piece + " ")
        if not m:
            break
        at, tag = m.end(), m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            text.append("\n")
        elif m[1]:
            if tag in BREAKS:
                close()
            if tag == "a":
                links = 0
            if opened[tag]:
                drop(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
        else:
            if tag in BREAKS:
                close()
                ends = CLOSES.get(tag, ())
                for i in reversed(solid) if any(opened[t] for t in ends) else ():
                    if stack[i][0] in ends:
                        drop(i)
                        break
                    if stack[i][0] != "p":
                        break
            if tag == "a":
                links = 1
            if tag in EMPTY or m[3].endswith("/") and tag not in BREAKS | SILENT and tag not in ("a", "b", "i", "em", "span"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
                continue
            if tag in BREAKS or tag in SILENT or m[3]:
                mark, hidden = _marks(tag, m[3], nodes.inside[node])
                if tag not in INLINE:
                    solid.append(len(stack))
                node, silent = nodes.add(tag, node, mark), silent or hidden or tag in SILENT
                stack.append((tag, node, silent))
                opened[tag] += 1
    close()
    return out, nodes


def features(found: list[tuple], nodes: Nodes) -> np.ndarray:
    """A row of FEATURES for each block; those of neighbours are zero where there is none."""
    n = len(found)
    if not n:
        return np.zeros((0, len(FEATURES)))
    inner = [0] * len(nodes.tag)
    for b in found:
        inner[b[3]] += b[1]
    marked = nodes.marked(inner)
    words = np.array([b[1] for b in found], float)
    density = np.array([b[2] for b in found], float) / words
    inside = np.array([nodes.inside[b[3]] for b in found], float)
    pad = lambda x, k: np.r_[np.zeros(max(k, 0)), x, np.zeros(max(-k, 0))][max(-k, 0) :][:n]  # noqa: E731  the k-th block before, after if negative
    plain = np.where(density < 0.5, words, 0)
    near = np.max([pad(plain, k) for k in (-2, -1, 1, 2)], axis=0)
    tags = [nodes.tag[b[3]] for b in found]
    return np.column_stack([
        words, density, pad(words, 1), pad(density, 1), pad(words, -1), pad(density, -1), near, [t in HEADINGS for t in tags], [t in TEXTS for t in tags],
        [marked[b[3]] for b in found], inside, inside.max() - inside])  # the last: the page marks its article, and this isn't in it


#: The labelled table: pages in small, + before what belongs to the article, - before what doesn't; ~n stands for n words.
LABELLED = [
    # nothing tells but words, links and neighbours
    "<div><a href=#>-~1</a> <a href=#>~1</a> <a href=#>~2</a></div><h1>+~6</h1><p>+~55</p><p>+~30</p><p>+~4</p><p>+~80</p><div>-~7</div>",
    "<div>-~2</div><div><h2>+~4</h2><p>+~40</p><p>+~3</p><p>+~64</p></div><div>-~9</div>",
    "<div>-~3</div><div>+~45</div><div>+~60</div><div>+~25</div><div>+~38</div><div>-~6</div>",
    "<div>-~4</div><div>-~2</div><div>+~70</div><div>+~32</div><div>-~3</div><div>-~5</div>",
    "<ul><li><a href=#>-~1</a></li><li><a href=#>-~2</a></li><li><a href=#>-~1</a></li></ul><p>+~48</p><p>+~8</p><p>+~50</p><ul><li><a href=#>-~3</a></li><li><a href=#>-~4</a></li></ul>",
    "<h1>+~5</h1><p>+~36</p><ul><li>+~4</li><li>+~9</li><li>+~2</li></ul><p>+~41</p><p>+~20</p><div>-~4</div>",
    "<h1>+~7</h1><p>+~28 <a href=#>~3</a> ~20</p><p>+<a href=#>~4</a></p><p>+~60</p><p>+~9</p><div><a href=#>-~6</a></div><div><a href=#>-~5</a></div>",
    "<div><a href=#>-~2</a></div><h1>+~3</h1><p>+~24</p><h2>+~2</h2><p>+~33</p><h2>+~4</h2><p>+~27</p><p>+~2</p><div>-~8</div><div>-~3</div>",
    "<h1>+~8</h1><p>+~90</p><p>+~75</p><p>+~6</p><div><p><a href=#>-~3</a></p><p><a href=#>-~7</a></p><p><a href=#>-~4</a></p></div>",
    "<table><tr><td>+~2</td><td>+~3</td></tr><tr><td>+~2</td><td>+~5</td></tr></table><p>+~40</p><p>+~26</p><div>-~5</div>",
    "<div>-~1</div><p>+~22</p><blockquote>+~14</blockquote><p>+~31</p><pre>+~12</pre><p>+~5</p>",
    "<div><div>-~3</div><div><a href=#>-~2</a></div></div><div><div>+~52</div><div>+~18</div><div>+~47</div></div><div><div>-~2</div><div><a href=#>-~1</a></div></div>",
    "<p><a href=#>-~2</a> <a href=#>~3</a></p><h1>+~6</h1><p>+~44</p><p>+~16</p><p>+~39</p><p><a href=#>-~2</a> <a href=#>~2</a> <a href=#>~2</a></p>",
    "<div>+~45</div><div>+~60</div>", "<h1>+~5</h1><div>+~33</div><div>+~70</div>", "<div><a href=#>-~2</a></div><div>+~41</div><div>+~29</div>", "<div>-~3</div><div>+~24</div><div>+~66</div>",
    "<h1>+~4</h1><p>+~28</p><p>+<a href=#>~35</a></p><p>+~33</p><p>+~6</p><p>+<a href=#>~12</a></p><p>+~41</p><ul><li><a href=#>-~2</a></li><li><a href=#>-~5</a></li></ul>",
    "+~2", "<div>+~6</div>", "<p>+~4</p>", "<p>+~30</p><p>+~3</p>", "<div>+~26</div>", "<h1>+~4</h1><p>+~12</p><p>+~9</p>", "<p>+~3</p><p>+~2</p><div><a href=#>-~6</a></div><p><a href=#>-~5</a></p>",
    "<div>-~2 <a href=#>~2</a></div><p>+~58</p><p>+~17</p><p>+~21 <a href=#>~5</a></p><div>-~3 <a href=#>~4</a></div>",
    # the page marks its article, or what stands around it
    "<nav><ul><li><a href=#>-~1</a></li><li><a href=#>-~2</a></li></ul></nav><div class=ad>-~8</div><article><h1>+~5</h1><p>+~26</p><p>+~1</p><p>+~90</p><p>+~2 <a href=#>~2</a> ~2</p></article><footer>-~12</footer>",
    "<div class=menu><a href=#>-~1</a> <a href=#>~1</a></div><div><h1>+~2</h1><p>+~50</p><p>+~1</p><p>+~26</p></div><div id=sidebar><p>-~11</p></div><div class=comments><p>-~40</p></div>",
    "<header><p>-~5</p><a href=#>-~2</a></header><main><h2>+~1</h2><p>+~26</p><ul><li>+~1</li><li>+~2</li></ul><div class='cookie notice'>-~11</div><p>+~78</p></main><aside><p>-~26</p></aside><form><p>-~3</p></form>",
    "<article><header><h1>+~4</h1></header><p>+~26</p><p>+<a href=#>~3</a></p><div class=share>-~5</div><section class=comments><p>-~52</p><p>-~1</p></section><p>+~2</p></article><p>-~8</p>",
    "<div class='newsletter'><p>-~26</p></div><article><p>+~1</p></article><div>-~52</div><footer><p>-~26</p></footer>",
    "<p>+~78</p><p>+~1</p><footer><a href=#>-~1</a></footer><div class=related><a href=#>-~4</a></div>",
    "<nav><a href=#>-~1</a></nav><article><h1>+~1</h1><p>+~52</p><p>+~78</p></article><p>-~78</p><p>-~1</p>",
    "<article><div>+~3</div><div>+~40</div><div>+~2</div><ul><li><a href=#>+~3</a></li><li><a href=#>+~2</a></li></ul></article><div>-~40</div>",
    "<article><div>+~30</div><div>+~4</div></article>", "<article><div>+~50</div><h2>+~3</h2></article>", "<article><div>+~2</div><div><a href=#>+~4</a></div></article>",
    "<div>-~3</div><article><div>+~20</div><div>+~4</div><div>+~60</div></article>", "<article><div><a href=#>+~2</a> ~1</div><div>+~1</div></article><div>-~6</div>",
    "<article><div><a href=#>+~3</a></div><p>+~40</p><div><a href=#>+~5</a></div><div>+~40</div></article><div>-~35</div><p>-~4</p>",
    "<table><tr><td>+~2</td><td>+~2</td></tr></table><p>+~26</p><div class=banner>-~26</div><p>+~31</p><nav><p>-~7</p></nav>",
    "<p>+~60</p><div class=comments><p>-~70</p><p>-~45</p><p>-~30</p></div><aside><p>-~35</p><p>-~41</p></aside>",
]
SCALES = (0.6, 1.0, 1.7)
"""Each page of the table stands for three, with shorter and longer blocks."""
_PROSE = "the committee met on the first day of the month and agreed to publish the whole of the report that its members had written over the year".split()


def labelled() -> tuple[np.ndarray, np.ndarray]:
    x, y = [], []
    for page in LABELLED:
        for scale in SCALES:
            def some(m: re.Match) -> str:
                return " ".join(_PROSE[i % len(_PROSE)] for i in range(max(1, round(int(m[1]) * scale))))
            found, nodes = blocks(re.sub(r"~(\d+)", some, page))
            y += [b[0][0] == "+" for b in found]
            x.append(features(found, nodes))
    return np.concatenate(x), np.array(y, float)


class Tree:
    """A binary decision tree (Gini), grown until its leaves are pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 8):
        self.feature, self.value, self.share = -1, 0.0, float(y.mean())
        best = 1e-12
        whole = self.share * (1 - self.share)
        for f in range(x.shape[1]) if depth and whole else ():
            order = np.argsort(x[:, f], kind="stable")
            v, hits = x[order, f], np.cumsum(y[order])
            k = np.flatnonzero(np.diff(v)) + 1
            left, right = hits[k - 1] / k, (hits[-1] - hits[k - 1]) / (len(v) - k)
            gain = whole - (k * left * (1 - left) + (len(v) - k) * right * (1 - right)) / len(v)
            if len(k) and gain.max() > best:
                i = int(gain.argmax())
                best, self.feature, self.value = gain[i], f, (v[k[i] - 1] + v[k[i]]) / 2
        if self.feature >= 0:
            low = x[:, self.feature] <= self.value
            self.low, self.high = Tree(x[low], y[low], depth - 1), Tree(x[~low], y[~low], depth - 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.share)
        if self.feature >= 0 and len(x):
            low = x[:, self.feature] <= self.value
            out[low], out[~low] = self.low(x[low]), self.high(x[~low])
        return out


@cache
def classifier() -> Tree:
    return Tree(*labelled())


def main_text(page: str | None) -> str:
    """Blocks of the article, joined by an empty line."""
    found, nodes = blocks(page or "")
    if not found:
        return ""
    keep = classifier()(features(found, nodes)) > 0.5
    return "\n\n".join(b[0] for b, k in zip(found, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text.

    Null or empty html gives empty text; null ids and urls stay null; equal rows give
    equal rows; a block whose leaf is divided evenly is left out; an empty table gives an
    empty one; other columns are ignored. One pass, no shuffle; work and memory grow with
    the longest page, of whatever markup.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.slice(at, 200)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([main_text(p) for p in part.column(2).to_pylist()], pa.string())], ["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string")
