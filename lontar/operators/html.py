"""Content extraction from pages, on the standard library's parser: one vectorised pass, whatever else is needed in Columns.

The extraction builds a small tree, drops what surrounds the article, takes the
best-scored content element, and reads title, author, date, description,
keywords and images by cascades of selectors. Three further methods are built
in (``METHODS``), others plug in as ``method(html) -> dict``; the best quality
wins, the earlier one on a tie.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import page_text, words
from lontar.operators.quality import extraction_score, reading_minutes
from lontar.operators.selectors import one, select

#: Parts of class and id values of what surrounds an article (fixed values).
UNWANTED = ("ad", "advertisement", "sidebar", "nav", "menu", "footer", "header", "comment", "social", "share", "related", "popup", "modal")
#: Classes that speak for content (fixed values).
CONTENT_WORDS = ("content", "article", "post", "entry", "story")
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SENTENCE, _WORD = re.compile(r"[.!?]+\s+[A-Z]"), re.compile(r"\w+")
SCHEMA = "title string, content string, author string, publish_date string, description string, keywords array<string>, images array<string>, links array<string>, extraction_method string"


class Node:
    """An element of the tree; texts are children too."""

    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def text(self, gap: str = "") -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if n.strip():
                    out.append(n.strip())
            else:
                stack.extend(reversed(n.children))
        return gap.join(out)

    def drop(self, gone: Callable[[Node], bool]) -> None:
        stack = [self]
        while stack:
            n = stack.pop()
            n.children = [c for c in n.children if isinstance(c, str) or not gone(c)]
            stack.extend(c for c in n.children if isinstance(c, Node))


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def tree(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _named(n: Node) -> tuple[str, str]:
    return n.attrs.get("class", ""), n.attrs.get("id", "")


def _unwanted(n: Node) -> bool:
    if n.tag in ("script", "style", "noscript"):
        return True
    c, i = _named(n)
    return any(w in c or w in i for w in UNWANTED)


def element_score(n: Node) -> float:
    """Length, paragraphs, sentences and words speak for an element, many links per paragraph against it."""
    text = n.text()
    if not text:
        return 0.0
    inner = list(n.walk())[1:]
    p, a = sum(x.tag == "p" for x in inner), sum(x.tag == "a" for x in inner)
    score = min(len(text) / 1000, 10) + min(0.5 * p, 5) + min(0.1 * len(_SENTENCE.findall(text)), 3) + min(len(_WORD.findall(text)) / 100, 5)
    if a / max(p, 1) > 0.3:
        score -= 2 * a / max(p, 1)
    if n.tag in ("article", "section", "main"):
        score += 2
    if any(w in n.attrs.get("class", "").lower() for w in CONTENT_WORDS):
        score += 1
    return max(score, 0.0)


def _classes(n: Node) -> set[str]:
    return set(n.attrs.get("class", "").split())


#: Where the content may be, in order of preference.
_PLACES: tuple[Callable[[Node], bool], ...] = (
    lambda n: n.tag == "article", lambda n: n.attrs.get("role") == "main", lambda n: n.tag == "main", lambda n: "article-content" in _classes(n), lambda n: "entry-content" in _classes(n), lambda n: "post-content" in _classes(n),
    lambda n: "content" in _classes(n), lambda n: n.attrs.get("id") == "content", lambda n: "article-body" in _classes(n), lambda n: "story-body" in _classes(n),
    lambda n: "article" in _named(n)[0] and "body" in _named(n)[0], lambda n: "post" in _named(n)[0] and "body" in _named(n)[0],
)
_TITLES: tuple[Callable[[Node], bool], ...] = (
    lambda n: n.tag == "h1" and "title" in _named(n)[0], lambda n: n.tag == "h1" and "headline" in _named(n)[0], lambda n: "article-title" in _classes(n), lambda n: "entry-title" in _classes(n), lambda n: "post-title" in _classes(n),
    lambda n: n.tag == "h1", lambda n: n.tag == "title",
)


def _best(nodes: list[Node], places: tuple) -> Node | None:
    best, score = None, 0.0
    for fits in places:
        for n in nodes:
            if fits(n) and (s := element_score(n)) > score:
                best, score = n, s
    return best


#: Selectors of author, date, description and keywords, in order (fixed values).
AUTHORS = ('[rel="author"]', ".author", ".byline", '[class*="author"]', '[itemprop="author"]', 'meta[name="author"]')
DATES = ("[datetime]", "time", ".date", ".published", '[class*="date"]', '[itemprop="datePublished"]', 'meta[property="article:published_time"]', 'meta[name="date"]')
DESCRIPTIONS = ('meta[name="description"]', 'meta[property="og:description"]', 'meta[name="twitter:description"]', ".description", ".summary", ".excerpt")
TAGS = (".tags", ".keywords", '[class*="tag"]', '[class*="category"]')


def _cascade(nodes: list[Node], selectors: tuple[str, ...], least: int, most: int, meta_too: bool = False) -> str | None:
    """The first selector whose first element has a text of fitting length; what a meta element or ``datetime`` says holds as it is, unless ``meta_too``."""
    for s in selectors:
        n = next(filter(one(s), nodes), None)
        if n is None:
            continue
        said = n.attrs.get("content") if n.tag == "meta" else n.attrs.get("datetime") if s in DATES else None
        if not meta_too and (n.tag == "meta" or said):
            return said
        t = said if n.tag == "meta" else n.text()
        if t and least <= len(t) <= most:
            return t
    return None


def metadata(root: Node) -> dict:
    """Title, author, date, description, keywords, images and links of a page, before anything is dropped from it."""
    every = list(root.walk())
    title = None
    for fits in _TITLES:
        found = next((n for n in every if fits(n)), None)
        if found is not None and len(t := found.text()) > 10:
            title = t
            break
    # All of these selectors look at attributes of one element.
    marked = [n for n in every if n.attrs or n.tag == "time"]
    classed = [n for n in marked if "class" in n.attrs]
    named = next(filter(one('meta[name="keywords"]'), marked), None)
    words = {k.strip() for k in (named.attrs.get("content", "") if named is not None else "").split(",") if k.strip()}
    words |= {t for n in classed if any(one(s)(n) for s in TAGS) and (t := n.text()) and len(t) < 50}
    return {
        "title": title, "author": _cascade(marked, AUTHORS, 1, 99), "publish_date": _cascade(marked, DATES, 1, 49), "description": _cascade(marked, DESCRIPTIONS, 50, 300, True), "keywords": sorted(words)[:10],
        "images": [x for n in every if n.tag == "img" and (x := n.attrs.get("src") or n.attrs.get("data-src"))], "links": [n.attrs["href"] for n in every if n.tag == "a" and n.attrs.get("href")],
    }


def custom(html: str) -> dict | None:
    """The method by selectors; None if nothing is found."""
    root = tree(html)
    out = metadata(root)
    root.drop(_unwanted)
    nodes = list(root.walk())
    best = _best(nodes, _PLACES) or _best(nodes, (lambda n: n.tag in ("div", "section", "article"),))
    if best is None:
        return None
    best.drop(lambda n: n.tag in ("script", "style", "aside", "nav", "footer"))
    return out | {"content": best.text(" "), "extraction_method": "custom"}


#: Characters of a content below which the three methods that follow have found nothing.
LEAST = 200
_GONE = ("script", "style", "noscript", "template", "svg", "form", "iframe")


def _linked(n: Node) -> int:
    return sum(len(a.text(" ")) for a in n.walk() if a.tag == "a")


def dense(html: str) -> dict | None:
    """The method by text density: the run of text blocks with the most characters outside links, less a price for each block that is short or linked."""
    root = tree(html)
    out = metadata(root)
    root.drop(lambda n: n.tag in (*_GONE, "nav", "aside", "footer", "header"))
    blocks = []
    for n in root.walk():
        if n.tag in ("p", "li", "h2", "h3", "h4", "blockquote", "pre", "td", "dd") and not any(c.tag in ("p", "li", "blockquote", "table", "ul") for c in list(n.walk())[1:]):
            t = n.text(" ")
            if t:
                blocks.append((t, len(t) - 2 * _linked(n) - 60))
    best, here, at, span = 0, 0, 0, (0, 0)
    for k, (_, worth) in enumerate(blocks):
        if here <= 0:
            here, at = 0, k
        here += worth
        if here > best:
            best, span = here, (at, k + 1)
    content = " ".join(t for t, _ in blocks[span[0] : span[1]])
    return out | {"content": content} if len(content) >= LEAST else None


def readable(html: str) -> dict | None:
    """The method by paragraphs' votes: each of some length speaks for its parent, and half as much for the one above; links speak against."""
    root = tree(html)
    title = metadata(root)["title"]
    root.drop(lambda n: n.tag in _GONE)
    votes: dict[int, float] = {}
    nodes: dict[int, Node] = {}
    stack: list[tuple[Node, Node | None, Node | None]] = [(root, None, None)]
    while stack:
        n, parent, above = stack.pop()
        if n.tag in ("p", "pre", "td", "blockquote") and len(t := n.text(" ")) >= 25:
            worth = 1 + t.count(",") + min(3.0, len(t) / 100)
            for holder, share in ((parent, 1.0), (above, 0.5)):
                if holder is not None:
                    votes[id(holder)] = votes.get(id(holder), 0.0) + share * worth
                    nodes[id(holder)] = holder
        stack.extend((c, n, parent) for c in reversed(n.children) if isinstance(c, Node))
    if not votes:
        return None
    best = nodes[max(votes, key=lambda k: votes[k] * (1 - min(1.0, _linked(nodes[k]) / max(1, len(nodes[k].text(" "))))))]
    best.drop(lambda n: n.tag in ("nav", "aside", "footer", "ul") and _linked(n) > 0.5 * max(1, len(n.text(" "))))
    content = best.text(" ")
    return {"title": title, "content": content} if len(content) >= LEAST else None


def described(html: str) -> dict | None:
    """The method by what the page says of itself: the article element, or the elements marked as its body, with all metadata."""
    root = tree(html)
    out = metadata(root)
    for s in ('[itemprop="articleBody"]', "article", 'meta[property="og:title"]'):
        n = next(select(root, s), None)
        if n is None:
            continue
        if n.tag == "meta":
            n = next((x for x in root.walk() if x.tag == "body"), root)
            out["title"] = out["title"] or None
        n.drop(lambda x: x.tag in (*_GONE, "nav", "aside", "footer"))
        content = " ".join(t for p in n.walk() if p.tag in ("p", "li", "h2", "h3") and (t := p.text(" ")))
        if len(content) >= LEAST:
            return out | {"content": content}
    return None


def paragraphs(html: str, least: int = 50, whole: int = 200) -> dict | None:
    """A plainer method for news pages: paragraphs of ``least`` characters in the article (or content element), else the first element of ``whole``."""
    root = tree(html)
    root.drop(lambda n: n.tag in ("script", "style", "noscript", "nav", "footer", "aside"))
    every = list(root.walk())
    place = next((n for n in every if n.tag == "article" or "content" in _classes(n)), root)
    parts = [t for n in place.walk() if n.tag == "p" and len(t := n.text(" ")) > least]
    if not parts:
        parts = [t for n in every if n.tag == "div" and len(t := n.text(" ")) > whole][:1]
    title = next((n.text() for n in every if n.tag == "h1"), None)
    return {"title": title, "content": " ".join(parts), "keywords": [], "images": [], "links": []} if parts else None


#: All built-in methods, in order of preference among equally good ones.
METHODS: dict[str, Callable[[str], dict | None]] = {"dense": dense, "readable": readable, "described": described, "custom": custom}


def extract(pages: DataFrame, html: str, methods: dict[str, Callable[[str], dict | None]] | None = None, least: int = 100, url: str = "url") -> DataFrame:
    """``pages`` (without its ``html``) with the extracted fields, ``word_count, reading_time, quality_score``.

    The result of the best score is taken, of equal ones that of the earlier
    method; it is chosen within the row. Images are made absolute by the column
    ``url``, where there is one. Pages under ``least`` characters, null ones, and
    ones in which no method finds content have the method ``failed`` and null
    contents.
    """
    import pyarrow as pa

    fields = [tuple(f.split()) for f in SCHEMA.split(", ")]
    keep = [c for c in pages.columns if c not in (html, *(f[0] for f in fields), "word_count", "reading_time", "quality_score")]
    chosen = methods or {"custom": custom}
    types = [(n, pa.list_(pa.string()) if t.startswith("array") else pa.string()) for n, t in fields]
    based = url in keep

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            bases = b.column(keep.index(url)).to_pylist() if based else [None] * b.num_rows
            out = []
            for page, base in zip(b.column(len(keep)).to_pylist(), bases):
                found = [r | {"extraction_method": name} for name, m in chosen.items() if page and len(page.strip()) >= least and (r := _safe(m, page))]
                for r in found:
                    r["images"] = sorted({x for src in r.get("images") or [] if (x := _absolute(base, src))})[:10]
                out.append([{n: r.get(n) for n, _ in types} for r in found or [{"extraction_method": "failed"}]])
            yield pa.RecordBatch.from_arrays([*(b.column(j) for j in range(len(keep))), pa.array(out, pa.list_(pa.struct(types)))], [*keep, "_found"])

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in keep)
    found = pages.select(*keep, html).mapInArrow(run, f"{schema}_found array<struct<{', '.join(f'{n}:{t}' for n, t in fields)}>>")

    def plain(r: Column) -> Column:
        return F.struct(*((page_text(r[n]) if n in ("content", "title") else r[n]).alias(n) for n, _ in fields))

    def scored(r: Column, place: Column) -> Column:
        score = extraction_score(*(r[c] for c in ("content", "title", "author", "publish_date", "description", "keywords")))
        return F.struct(F.when(r["extraction_method"] == "failed", 0.0).otherwise(score).alias("quality_score"), (-place).alias("place"), *(r[n].alias(n) for n, _ in fields))

    # Two steps: within one, each use of a cleaned text would clean it again.
    best = found.withColumn("_best", F.array_max(F.transform(F.transform("_found", plain), scored)))
    body = F.coalesce("content", F.lit(""))
    return best.select(*keep, *(F.col("_best")[n].alias(n) for n, _ in fields), F.col("_best.quality_score").alias("quality_score")).withColumns({"word_count": words(body), "reading_time": reading_minutes(body)})


def _absolute(base: str | None, src: str) -> str | None:
    try:
        full = urljoin(base, src) if base else src
    except ValueError:
        return None
    return full if full.startswith("http") else None


def _safe(method: Callable, page: str) -> dict | None:
    try:
        return method(page)
    except (ValueError, RecursionError, AssertionError):  # a page that can't be read is a failed one
        return None


def title_of(html: Column) -> Column:
    """The page's title element, in the JVM."""
    return F.nullif(F.trim(F.regexp_extract(html, r"(?s)<title>([^<]*)</title>", 1)), F.lit(""))
