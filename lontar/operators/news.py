"""List pages and article pages of news sites: by selectors, with fall-through, in one Arrow pass over the pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urljoin

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.operators.html import Node, tree
from lontar.operators.selectors import first, select

#: Selectors of titles and bodies of article pages, in order (fixed values).
TITLES = ("h1.detail__title", 'h1[class*="title"]', "h1", ".detail__title", '[class*="title"]')
BODIES = (".detail__body-text.itp_bodycontent", ".detail__body-text", ".itp_bodycontent", ".detail__body", '[class*="body"]', ".article-content", ".content")
#: Parts of class names of what is no content (fixed values).
ADS = ("ad", "ads", "advertisement", "banner", "promo")
_SCRIPTS, _AROUND = ("script", "style", "noscript"), ("script", "style", "aside", "nav", "header", "footer", "ad")
_SPACES = re.compile(r"\s+")


@dataclass(frozen=True)
class Site:
    """How a site's pages are read; each field holds selectors in order of preference."""

    items: tuple[str, ...] = ("article", "li")
    titles: tuple[str, ...] = ("h2 a", "h3 a", "a")
    links: tuple[str, ...] = ("h2 a", "h3 a", "a")
    bodies: tuple[str, ...] = (".content", ".article-content")
    names: tuple[str, ...] = ()


def listed(html: str, url: str, site: Site) -> list[tuple[str, str]]:
    """``(title, address)`` of the items of a list page; the first selector that has any decides which elements are items."""
    root = tree(html)
    items: list[Node] = next((found for s in site.items if (found := list(select(root, s)))), [])
    out = []
    for item in items:
        title, link = first(item, *site.titles), first(item, *site.links)
        href = link.attrs.get("href", "") if link is not None else ""
        name = title.text() if title is not None else ""
        if name and href:
            out.append((name, href if href.startswith("http") else urljoin(url, href)))
    return out


def list_pages(pages: DataFrame, html: str, url: str, site: Site, known: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """``source_url, title, page, place`` of the articles that list pages name, each address once (where it comes first, by page and place).

    Addresses of ``known`` (a column ``source_url``) are left out; ``most`` is
    the number of articles wanted. Null and unreadable pages have none.
    """
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows: list[tuple[str, str, str, int]] = []
            for page, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if page and at:
                    rows += [(link, title, at, k) for k, (title, link) in enumerate(_safe(listed, page, at, site) or [])]
            cols = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cols[:3]), pa.array(cols[3], pa.int64())], ["source_url", "title", "page", "place"])

    found = pages.select(html, url).mapInArrow(run, "source_url string, title string, page string, place bigint")
    once = found.groupBy("source_url").agg(F.min(F.struct("page", "place", "title")).alias("f")).select("source_url", "f.title", "f.page", "f.place")
    if known is not None:
        once = once.join(known.select("source_url").where("source_url IS NOT NULL").distinct(), "source_url", "left_anti")
    return once if most is None else once.orderBy("page", "place").limit(most)


def article(html: str, titles: tuple[str, ...] = TITLES, bodies: tuple[str, ...] = BODIES) -> tuple[str, str]:
    """Title and text of an article page; '' for what isn't there."""
    root = tree(html)
    head, body = first(root, *titles), first(root, *bodies)
    title = head.text() if head is not None else ""
    if body is None:
        return title, ""
    body.drop(lambda n: n.tag in _SCRIPTS or any(w in c.lower() for c in n.attrs.get("class", "").split() for w in ADS))
    return title, _SPACES.sub(" ", body.text(" ")).strip()


def body(html: str, site: Site) -> str | None:
    """Text of an article page of a site: elements of the first selector with more than 100 characters; else the article or content element, else paragraphs of more than 50, else the first division of more than 200 that doesn't name the site."""
    root = tree(html)
    for s in site.bodies:
        parts = []
        for n in select(root, s):
            n.drop(lambda x: x.tag in _AROUND)
            if len(t := n.text(" ")) > 100:
                parts.append(t)
        if parts:
            return " ".join(parts)
    whole = first(root, "article", "div.content")
    if whole is not None:
        whole.drop(lambda x: x.tag in _AROUND)
        if len(t := whole.text(" ")) > 100:
            return t
    parts = [t for n in select(root, "p") if len(t := n.text()) > 50]
    if parts:
        return " ".join(parts)
    return next((t for n in select(root, "div") if len(t := n.text()) > 200 and not any(name in t.lower() for name in site.names)), None)


def articles(pages: DataFrame, html: str, site: Site | None = None) -> DataFrame:
    """``pages`` (without ``html``) with ``title, text``: by the fixed selectors, or by those of a ``site``; a page that can't be read keeps its row, with ''."""
    import pyarrow as pa

    keep = [c for c in pages.columns if c not in (html, "title", "text")]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows = []
            for page in b.column(len(keep)).to_pylist():
                title, text = (_safe(article, page) if page else None) or ("", "")
                if site is not None:
                    text = (_safe(body, page, site) if page else None) or ""
                rows.append((title, text))
            cols = list(zip(*rows)) or [(), ()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string())], [*keep, "title", "text"])

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    return pages.select(*keep, html).mapInArrow(run, f"{schema}title string, text string")


def _safe(f, *args):
    try:
        return f(*args)
    except (ValueError, RecursionError, AssertionError):  # a page that can't be read
        return None
