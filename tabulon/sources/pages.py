"""Links, titles and main text of HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LINKS = "url string, text string, discovery string, is_attachment boolean, is_statistics_hint boolean, is_catalog_frame boolean"
_FILE = re.compile(r"\.(pdf|xlsx?|zip|docx?)$", re.I)
_HINT = re.compile("统计|年鉴|公报")
_OPENED = re.compile(r"(?:open|location(?:\.href)?\s*=?)\s*\(?\s*['\"]([^'\"]+)['\"]")


class _Links(HTMLParser):
    def __init__(self, base: str):
        super().__init__(convert_charrefs=True)
        self.base, self.found, self.open, self.mute = base, [], None, 0

    def add(self, href: str | None, text: str, how: str, frame: bool = False) -> None:
        if not href or href.strip().lower().startswith(("javascript:", "mailto:", "#")):
            return
        try:
            url = urljoin(self.base, href.strip())
            path = urlsplit(url).path
        except ValueError:
            return
        text = " ".join(text.split())
        self.found.append((url, text, how, bool(_FILE.search(path)), bool(_HINT.search(text)), frame))

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style"):
            self.mute += 1
        if tag == "a":
            self.flush()
            self.open = [a.get("href"), [], "anchor"]
        elif tag in ("frame", "iframe"):
            self.add(a.get("src"), a.get("title") or a.get("name") or "", "frame", True)
        if (m := _OPENED.search(a.get("onclick") or "")) is not None:
            if self.open is not None and tag == "a":
                self.open[0], self.open[2] = m[1], "onclick"
            else:
                self.add(m[1], a.get("title") or "", "onclick")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.mute = max(0, self.mute - 1)
        elif tag == "a":
            self.flush()

    def handle_data(self, data):
        if self.open is not None and not self.mute:
            self.open[1].append(data)

    def unknown_decl(self, data):
        if data.startswith("CDATA["):
            inner = _Links(self.base)
            inner.feed(data[6:].rstrip("]"))
            inner.flush()
            self.found += [(u, t, "cdata", *rest) for u, t, _, *rest in inner.found]

    def flush(self):
        if self.open is not None:
            href, parts, how = self.open
            self.open = None
            self.add(href, "".join(parts), how)


def links_of(page: str, base: str) -> list[tuple]:
    """Links of a page in the order of ``LINKS``; of equal (url, text) the last one stays."""
    p = _Links(base)
    p.feed(page)
    p.flush()
    return list({(x[0], x[1]): x for x in p.found}.values())


class _Article(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title = self.published = ""
        self.heading, self.text, self.mute, self.in_head = [], [], 0, False

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in ("script", "style", "nav", "title"):
            self.mute += 1
        elif tag == "meta":
            name = (a.get("name") or "").lower()
            if name == "articletitle":
                self.title = a.get("content") or ""
            elif name == "pubdate":
                self.published = a.get("content") or ""
        elif tag in ("h1", "h2", "h3"):
            self.in_head = True
            self.heading.append("")
        if tag in ("p", "br", "div", "li", "h1", "h2", "h3", "tr"):
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "nav", "title"):
            self.mute = max(0, self.mute - 1)
        elif tag in ("h1", "h2", "h3"):
            self.in_head = False

    def handle_data(self, data):
        if self.mute:
            return
        if self.in_head:
            self.heading[-1] += data
        self.text.append(data)


def article_of(page: str) -> tuple[str, str, str]:
    """(title, publication date, text): the title of the meta tag, else the first heading that speaks of a bulletin or yearbook."""
    p = _Article()
    p.feed(page)
    p.close()
    title = p.title or next((h.strip() for h in p.heading if re.search("公报|年鉴", h)), "")
    lines = (" ".join(x.split()) for x in "".join(p.text).split("\n"))
    return title, p.published, "\n".join(x for x in lines if x)


def page_links(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src and the columns of ``LINKS``) of every page; null pages have no links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["src", *(c.split()[0] for c in LINKS.split(", "))]
        kinds = [pa.string()] * 4 + [pa.bool_()] * 3
        for b in batches:
            rows = [(u, *x) for u, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if page for x in links_of(page, u or "")]
            cols = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return pages.select(url, html).mapInArrow(run, f"src string, {LINKS}")


def page_articles(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(url, title, published, text) of every page; a null page has nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(u, *(article_of(page) if page is not None else (None,) * 3)) for u, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in (zip(*rows) if rows else [()] * 4)], names=["url", "title", "published", "text"])

    return pages.select(url, html).mapInArrow(run, "url string, title string, published string, text string")


def followed(links: DataFrame, registry: DataFrame) -> DataFrame:
    """Links that hint at statistics, are attachments or frames, on a registered host."""
    host = F.lower(F.regexp_extract("url", "^https?://([^/:?#@]+)", 1))
    some = links.where("is_statistics_hint or is_attachment or is_catalog_frame").withColumn("host", host)
    return some.join(registry.select("host").distinct(), "host", "left_semi")
