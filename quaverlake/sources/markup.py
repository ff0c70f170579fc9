"""Wikitext and HTML as rows."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

_HEADING = re.compile(r"^(={2,6})\s*(.*?)\s*\1\s*$")
#: Names of templates that hold a file, as regular expressions.
TEMPLATES = ("file", r"#fte:\w*file")


def _template_end(text: str, at: int) -> int:
    """The position after the template that begins at ``at``; braces are balanced."""
    depth = 0
    for m in re.compile(r"\{\{|\}\}").finditer(text, at):
        depth += 1 if m[0] == "{{" else -1
        if not depth:
            return m.end()
    raise ValueError("template without an end")


def file_chunks(wikitext: str, templates: tuple[str, ...] = TEMPLATES) -> Iterator[tuple[list[str], str]]:
    """(headings above, template body) of each template whose whole name fits one of ``templates``, case aside.

    Comments count as nothing. A name ends at a bar, a line end or the template's end.
    """
    text = re.sub(r"(?s)<!--.*?(?:-->|$)", "", wikitext)
    names = "|".join(templates)
    spot = re.compile(rf"(?im)^(?:={{2,6}}).*$|\{{\{{\s*(?:{names})\s*(?=\||\n|\}}\}})")
    stack: list[tuple[int, str]] = []
    at = 0
    while m := spot.search(text, at):
        if m[0].startswith("{{"):
            at = _template_end(text, m.start())
            yield [h for _, h in stack], text[m.start() + 2 : at - 2]
        else:
            if h := _HEADING.match(m[0]):
                level = len(h[1])
                stack = [s for s in stack if s[0] < level] + [(level, h[2])]
            at = m.end() + 1


def read_wikitext(pages: DataFrame, templates: tuple[str, ...] = TEMPLATES) -> DataFrame:
    """File chunks of pages (page_id, wikitext) with their headings; a page that can't be read gives one row with its issue."""

    def rows_of(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows = []
            for p, w in zip(pdf.page_id, pdf.wikitext):
                try:
                    rows += [(p, k, h, b, None) for k, (h, b) in enumerate(list(file_chunks(w or "", templates)))]
                except ValueError as e:
                    rows.append((p, None, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["page_id", "place", "headings", "chunk", "issue"], dtype=object)

    return pages.select("page_id", "wikitext").mapInPandas(rows_of, "page_id long, place int, headings array<string>, chunk string, issue string")


class _Sections(HTMLParser):
    SKIP = {"script", "style", "nav"}

    def __init__(self):
        super().__init__()
        self.rows, self.heading, self.words, self.stack = [], "", [], []

    def handle_starttag(self, tag, attrs):
        self.stack.append(tag)
        if re.fullmatch("h[1-6]", tag):
            self.cut()
            self.heading = ""

    def handle_endtag(self, tag):
        while self.stack and self.stack.pop() != tag:
            pass

    def handle_data(self, data):
        if not self.SKIP & set(self.stack):
            if any(re.fullmatch("h[1-6]", t) for t in self.stack):
                self.heading += data
            else:
                self.words.append(data)

    def cut(self):
        text = " ".join(" ".join(self.words).split())
        if text:
            self.rows.append((self.heading.strip(), text))
        self.words = []


def sections(html: str) -> list[tuple[str, str]]:
    """(heading above, text) of the parts of a page."""
    parser = _Sections()
    parser.feed(html)
    parser.close()
    parser.cut()
    return parser.rows


def read_sections(pages: DataFrame) -> DataFrame:
    """Sections of pages (page_id, html)."""

    def rows_of(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            rows = [(p, k, h, t) for p, html in zip(pdf.page_id, pdf.html) for k, (h, t) in enumerate(sections(html or ""))]
            yield pd.DataFrame(rows, columns=["page_id", "place", "heading", "text"])

    return pages.select("page_id", "html").mapInPandas(rows_of, "page_id long, place int, heading string, text string")
