"""Main text of web pages from flat text blocks and a decision tree.

A page is cut at block-level tags into flat text blocks. A block has a word count, a link density (share of
its words inside links), those of the block before and after it, and a place told by its open elements: inside
an article or main element, inside boilerplate (navigation, footer, aside, form and the like, or a class, id or
role that says so), or neither. A decision tree (Gini, fitted when the operator is built) trained on the small
labelled table below tells text from boilerplate.

Scripts, styles, titles, comments and other raw elements never make text. Character references are decoded,
white space inside a block becomes one space, text blocks are joined in page order by one space. The tokeniser
is tolerant: unclosed elements end with their parent, stray end tags are ignored, a tag cut off at the end of
the page is dropped. Null html gives "". Map-only; repeated rows stay repeated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "place")
# words, links, before: words, links, after: words, links, place (2 article, 1 neither, 0 boilerplate) -> text
LABELLED = np.array(
    [
        # articles: long, short and one-word paragraphs, headings, a link or two
        (80, 0.00, 60, 0.00, 70, 0.00, 2, 1), (45, 0.05, 12, 0.00, 90, 0.00, 2, 1), (120, 0.02, 0, 0.00, 40, 0.10, 2, 1),
        (1, 0.00, 40, 0.00, 80, 0.00, 2, 1), (2, 0.00, 30, 0.00, 25, 0.00, 2, 1), (9, 0.00, 0, 0.00, 55, 0.00, 2, 1),
        (6, 0.00, 20, 1.00, 70, 0.00, 2, 1), (14, 0.00, 8, 0.00, 3, 0.00, 2, 1), (3, 0.00, 2, 0.00, 6, 0.00, 2, 1),
        (30, 0.30, 40, 0.00, 25, 0.00, 2, 1), (12, 0.25, 30, 0.00, 9, 0.00, 2, 1), (200, 0.00, 1, 1.00, 12, 0.00, 2, 1),
        (25, 0.00, 1, 0.00, 10, 0.10, 2, 1), (5, 0.40, 50, 0.00, 60, 0.00, 2, 1), (60, 0.00, 12, 0.00, 15, 0.00, 2, 1),
        (70, 0.00, 9, 0.00, 1, 0.00, 2, 1), (18, 0.00, 60, 0.00, 0, 0.00, 2, 1), (7, 0.00, 1, 0.00, 2, 0.00, 2, 1),
        (1, 0.00, 1, 0.00, 1, 0.00, 2, 1), (2, 0.00, 9, 0.00, 0, 0.00, 2, 1), (400, 0.10, 9, 0.00, 20, 0.00, 2, 1),
        (10, 0.00, 20, 0.00, 1, 1.00, 2, 1), (16, 0.45, 35, 0.00, 14, 0.00, 2, 1), (4, 0.00, 5, 1.00, 2, 0.00, 2, 1),
        (4, 0.50, 1, 0.00, 0, 0.00, 2, 1), (12, 0.60, 30, 0.00, 20, 0.00, 2, 1), (6, 0.67, 9, 0.00, 40, 0.00, 2, 1), (30, 0.55, 12, 0.00, 3, 0.00, 2, 1),
        (3, 0.00, 2, 0.00, 3, 0.00, 2, 1), (5, 0.00, 3, 0.00, 2, 0.00, 2, 1), (6, 0.00, 1, 0.00, 4, 0.00, 2, 1),
        (2, 0.00, 3, 0.00, 9, 0.00, 2, 1), (4, 0.00, 2, 0.00, 2, 0.00, 2, 1), (8, 0.00, 4, 1.00, 3, 1.00, 2, 1),
        (7, 0.00, 2, 1.00, 12, 0.00, 2, 1), (5, 0.00, 1, 1.00, 1, 1.00, 2, 1), (9, 0.00, 2, 1.00, 2, 1.00, 2, 1),
        (3, 0.00, 3, 1.00, 8, 0.50, 2, 1), (6, 0.30, 2, 0.00, 3, 0.00, 2, 1), (2, 0.00, 4, 0.00, 1, 1.00, 2, 1),
        (1, 0.00, 2, 1.00, 2, 1.00, 2, 1), (9, 0.00, 3, 0.00, 4, 0.00, 2, 1), (12, 0.00, 3, 1.00, 2, 1.00, 2, 1),
        (1, 0.00, 0, 0.00, 2, 1.00, 2, 1),
        # lists of links inside articles
        (6, 1.00, 50, 0.00, 7, 1.00, 2, 0), (8, 1.00, 6, 1.00, 5, 1.00, 2, 0), (3, 1.00, 4, 1.00, 12, 0.10, 2, 0),
        (12, 0.95, 30, 0.00, 9, 1.00, 2, 0), (20, 0.90, 8, 1.00, 10, 1.00, 2, 0), (2, 1.00, 70, 0.00, 2, 1.00, 2, 0),
        # anything in boilerplate elements
        (1, 1.00, 0, 0.00, 1, 1.00, 0, 0), (2, 1.00, 1, 1.00, 1, 1.00, 0, 0), (1, 1.00, 1, 1.00, 14, 0.00, 0, 0),
        (14, 0.00, 1, 1.00, 10, 0.00, 0, 0), (25, 0.00, 2, 1.00, 60, 0.00, 0, 0), (12, 0.10, 80, 0.00, 0, 0.00, 0, 0),
        (18, 0.00, 90, 0.00, 0, 0.00, 0, 0), (60, 0.00, 12, 0.00, 40, 0.00, 0, 0), (35, 0.20, 50, 0.00, 5, 1.00, 0, 0),
        (4, 0.00, 30, 0.00, 12, 0.00, 0, 0), (90, 0.00, 70, 0.00, 80, 0.00, 0, 0), (40, 0.00, 60, 0.00, 50, 0.00, 0, 0),
        (8, 0.00, 70, 0.00, 90, 0.00, 0, 0), (15, 0.20, 45, 0.00, 30, 0.00, 0, 0), (100, 0.00, 40, 0.00, 60, 0.00, 0, 0),
        (3, 0.00, 0, 0.00, 9, 0.00, 0, 0), (1, 0.00, 90, 0.00, 100, 0.00, 0, 0), (22, 0.50, 14, 0.00, 20, 0.40, 0, 0),
        # pages without article elements: text
        (60, 0.00, 50, 0.00, 70, 0.00, 1, 1), (35, 0.05, 8, 0.00, 45, 0.00, 1, 1), (110, 0.02, 3, 1.00, 60, 0.00, 1, 1),
        (25, 0.00, 60, 0.00, 12, 0.00, 1, 1), (20, 0.10, 90, 0.05, 30, 0.00, 1, 1), (5, 0.00, 60, 0.00, 70, 0.00, 1, 1),
        (1, 0.00, 45, 0.00, 30, 0.00, 1, 1), (8, 0.00, 2, 1.00, 80, 0.00, 1, 1), (12, 0.00, 40, 0.00, 3, 0.00, 1, 1),
        (18, 0.00, 25, 0.00, 20, 0.00, 1, 1), (3, 0.00, 30, 0.00, 50, 0.00, 1, 1), (40, 0.20, 35, 0.00, 2, 1.00, 1, 1),
        (75, 0.00, 4, 0.00, 1, 0.00, 1, 1), (40, 0.00, 3, 0.00, 1, 0.00, 1, 1), (50, 0.10, 1, 1.00, 2, 1.00, 1, 1),
        (28, 0.00, 2, 1.00, 0, 0.00, 1, 1), (90, 0.05, 5, 0.60, 2, 0.00, 1, 1), (300, 0.00, 0, 0.00, 0, 0.00, 1, 1),
        (22, 0.00, 6, 0.00, 6, 0.00, 1, 1), (65, 0.15, 9, 0.80, 1, 1.00, 1, 1), (33, 0.00, 1, 0.00, 2, 0.00, 1, 1),
        (2, 0.00, 40, 0.00, 22, 0.00, 1, 1), (4, 0.00, 1, 0.00, 35, 0.00, 1, 1), (6, 0.20, 55, 0.00, 40, 0.00, 1, 1),
        # pages without article elements: menus, notes
        (3, 0.00, 2, 0.00, 4, 0.00, 1, 0), (5, 0.00, 6, 1.00, 1, 1.00, 1, 0), (8, 0.00, 2, 0.50, 3, 1.00, 1, 0),
        (25, 0.90, 3, 1.00, 2, 1.00, 1, 0), (70, 0.85, 40, 0.00, 30, 0.00, 1, 0), (12, 1.00, 20, 0.00, 8, 0.00, 1, 0),
        (2, 1.00, 1, 1.00, 3, 1.00, 1, 0), (4, 0.80, 2, 1.00, 40, 0.00, 1, 0), (1, 1.00, 60, 0.00, 2, 1.00, 1, 0),
        (6, 0.00, 2, 1.00, 3, 1.00, 1, 0), (3, 0.00, 1, 1.00, 2, 1.00, 1, 0), (9, 0.60, 3, 1.00, 5, 0.80, 1, 0),
        (15, 0.70, 30, 0.00, 4, 1.00, 1, 0), (5, 0.00, 3, 0.00, 1, 1.00, 1, 0), (30, 0.80, 50, 0.00, 20, 0.60, 1, 0),
        (2, 0.00, 0, 0.00, 1, 1.00, 1, 0), (7, 0.00, 4, 1.00, 2, 0.00, 1, 0), (10, 1.00, 80, 0.00, 60, 0.00, 1, 0),
    ]
)

RAW = {"script", "style", "title", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "textarea", "select", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header "
    "hr html label legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
BOILER_TAGS = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "label", "fieldset"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu", "menubar", "form"}
BOILER_WORDS = set(
    "ad ads advert adverts advertisement advertising adslot sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert "
    "sidebar aside widget comment comments disqus reply replies respond menu nav navbar navigation breadcrumb breadcrumbs topbar masthead footer pagination pager "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay toolbar toc skip copyright legal".split()
)
MAIN_TAGS = {"article", "main"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(>|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>]*)(>|\Z)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.IGNORECASE)
_NAMES = re.compile(r"[a-z]+")


def _is_boiler(tag: str, attributes: str, in_main: bool) -> bool:
    if tag in BOILER_TAGS or tag == "header" and not in_main:
        return True
    if tag in ("html", "body", "article", "main") or not attributes:
        return False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = value.strip("\"'").lower()
        name = name.lower()
        if name == "role" and value in BOILER_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id") and not BOILER_WORDS.isdisjoint(_NAMES.findall(value)):
            return True
    return False


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    main: bool
    boiler: bool


def blocks(html: str) -> list[Block]:
    """The flat text blocks of a page, empty ones left out."""
    out: list[Block] = []
    open_: list[tuple[str, bool, bool]] = []  # tag, in main, in boilerplate
    parts: list[str] = []
    links = link_words = 0

    def flush() -> None:
        nonlocal link_words
        text = " ".join("".join(parts).split())
        if text:
            top = open_[-1] if open_ else ("", False, False)
            out.append(Block(text, text.count(" ") + 1, link_words, top[1], top[2]))
        parts.clear()
        link_words = 0

    def add(raw: str) -> None:
        nonlocal link_words
        if raw:
            text = unescape(raw)
            parts.append(text)
            if links:
                link_words += len(text.split())

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        close, tag, attributes, end = m.group(1, 2, 3, 4) if m[2] else m.group(5, 6, 7, 8)
        if tag is None:  # comment or declaration
            if m[0].startswith("<![CDATA["):
                add(m[0][9:].removesuffix("]]>"))
            continue
        if not end:  # a tag cut off by the end of the page
            break
        tag = tag.lower()
        if not close and tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = stop.end() if stop else size
            continue
        if tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            flush()
        if close:
            if any(tag == t for t, _, _ in open_):
                while True:
                    gone = open_.pop()[0]
                    links -= gone == "a"
                    if gone == tag:
                        break
        elif tag not in VOID and not attributes.endswith("/"):
            _, in_main, in_boiler = open_[-1] if open_ else ("", False, False)
            if tag == "a" and links:  # links don't nest
                continue
            links += tag == "a"
            open_.append((tag, in_main or tag in MAIN_TAGS, in_boiler or _is_boiler(tag, attributes, in_main)))
    flush()
    return out


class Tree:
    """A small classification tree (Gini impurity, midpoints between neighbouring values)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 3):
        self.root = self._grow(x, y, depth, least)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int, least: int):
        share = y.mean()
        if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
            return bool(share > 0.5)
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, f] <= cut
                n = left.sum()
                if n < least or len(y) - n < least:
                    continue
                p, q = y[left].mean(), y[~left].mean()
                loss = n * p * (1 - p) + (len(y) - n) * q * (1 - q)
                if best is None or loss < best[0] - 1e-12:
                    best = (loss, f, float(cut), left)
        if best is None or best[0] >= len(y) * share * (1 - share) - 1e-12:
            return bool(share > 0.5)
        _, f, cut, left = best
        return f, cut, self._grow(x[left], y[left], depth - 1, least), self._grow(x[~left], y[~left], depth - 1, least)

    def __call__(self, row: tuple) -> bool:
        node = self.root
        while not isinstance(node, bool):
            f, cut, low, high = node
            node = low if row[f] <= cut else high
        return node


def train(labelled: np.ndarray = LABELLED) -> Tree:
    return Tree(labelled[:, :-1], labelled[:, -1])


def main_text(html: str | None, tree: Tree) -> str:
    if not html:
        return ""
    own = blocks(html)
    sizes = [(b.words, b.link_words / b.words) for b in own]
    edge = (0, 0.0)
    kept = []
    for i, b in enumerate(own):
        before, after = sizes[i - 1] if i else edge, sizes[i + 1] if i + 1 < len(own) else edge
        if tree((*sizes[i], *before, *after, 0 if b.boiler else 1 + b.main)):
            kept.append(b.text)
    return " ".join(kept)


def extract(pages: DataFrame, labelled: np.ndarray = LABELLED) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    tree = train(labelled)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h, tree) for h in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return own.mapInArrow(batches(run), "page_id long, url string, text string, n_chars long")
