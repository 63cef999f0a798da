"""Main text of web pages: the one place where Python parses, on Arrow batches inside the tasks."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from trendlens.relational import pieces

# Elements whose content is never article text, and containers tried in this order
# (tag name, class name or attribute value).
DROPPED = ("script", "style", "nav", "header", "footer", "aside")
CONTAINERS = (
    ("tag", "article"), ("class", "article-content"), ("class", "post-content"), ("class", "entry-content"),
    ("class", "content"), ("tag", "main"), ("class", "story-body"), ("itemprop", "articleBody"),
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
MIN_WORDS = 50


class _Paragraphs(HTMLParser):
    """Collects every <p> with the first containers of each kind that enclose it."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int | None]] = []  # (tag, paragraph opened here)
        self.skipped = 0
        self.texts: list[list[str]] = []
        self.open: list[int] = []
        self.live: dict[int, int] = {}  # container kind -> depth of its first match while open
        self.found: set[int] = set()
        self.inside: dict[int, list[int]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            return
        if tag in DROPPED:
            self.skipped += 1
        names = dict(attrs)
        classes = (names.get("class") or "").split()
        paragraph = None
        if not self.skipped:
            for kind, (how, value) in enumerate(CONTAINERS):
                hit = tag == value if how == "tag" else (value in classes if how == "class" else names.get("itemprop") == value)
                if hit and kind not in self.found:
                    self.found.add(kind)
                    self.live[kind] = len(self.stack)
            if tag == "p":
                paragraph = len(self.texts)
                self.texts.append([])
                self.open.append(paragraph)
                for kind in self.live:
                    self.inside.setdefault(kind, []).append(paragraph)
        self.stack.append((tag, paragraph))

    def handle_endtag(self, tag: str) -> None:
        depth = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if depth is None:
            return
        for closed, paragraph in self.stack[depth:]:
            self.skipped -= closed in DROPPED
            if paragraph is not None:
                self.open.remove(paragraph)
        del self.stack[depth:]
        self.live = {k: d for k, d in self.live.items() if d < depth}

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            for paragraph in self.open:
                self.texts[paragraph].append(data)


def main_text(html: str | None) -> str:
    """Paragraphs of the first container with more than 50 words, else of the whole page.

    A container with exactly 50 words neither ends the search nor triggers the fallback.
    """
    parser = _Paragraphs()
    parser.feed(html or "")
    parser.close()
    texts = ["".join(t).strip() for t in parser.texts]

    def joined(indices) -> str:
        return " ".join(texts[i] for i in indices if texts[i])

    text = ""
    for kind in range(len(CONTAINERS)):
        if kind in parser.found:
            text = joined(parser.inside.get(kind, []))
            if len(text.split()) > MIN_WORDS:
                break
    return joined(range(len(texts))) if len(text.split()) < MIN_WORDS else text


def extract_main_text(df: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """Add the main text of each page."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches):
            yield part.append_column(out, pa.array([main_text(h) for h in part.column(html).to_pylist()], pa.string()))

    return df.mapInArrow(run, f"{fields}, `{out}` string")
