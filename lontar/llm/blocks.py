"""Problem 4: page boilerplate mixed with main content.

Method: a page's HTML is read as a flat list of text blocks. Each block has its
number of words and its link density, those of its neighbours, and those of the
element that holds it; a decision tree, trained on a small table of labelled
blocks (``blocks_labelled.csv``, rows of features and a label, no texts), tells
main body from the rest. The blocks' labels are then handed on to the lines of
the page's extracted text, in order.

Defined results: pages without extracted content have no lines; pages without
HTML are judged by their lines alone (each a block without links); a line that
is no block of the page is judged as such a block too; an empty line is not
main body; of several fetches of a page the last one with content counts.
"""

from __future__ import annotations

import csv
import html as entities
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELLED = os.path.join(os.path.dirname(__file__), "blocks_labelled.csv")
_SPLIT = re.compile(r"(<[^>]*>)")
_GONE = re.compile(r"<!--.*?-->|<(script|style|noscript|template|svg)\b.*?</\1\s*>", re.S | re.I)
_NAME = re.compile(r"</?\s*([A-Za-z][A-Za-z0-9]*)")
_INLINE = frozenset("a abbr b bdi cite code em font i img kbd label mark q s small span strike strong sub sup time tt u var wbr input button picture source".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_KIND = {"h1": 1, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "p": 3, "li": 4, "blockquote": 3, "dd": 4, "dt": 4}
_END = re.compile(r"[.!?…。！？][\"'”’)\]]*$")
_MANY = re.compile(r"[|›/·»•>] ")
#: Words that go with what surrounds an article: one hit is evidence for the tree, no verdict (fixed values).
CUES = re.compile(
    r"\b(?:cookies?|kuki|privacy|privasi|terms|syarat|imprint|accessibility|careers?|karier|redaksi|pedoman|kebijakan|subscribe|berlangganan|newsletter|mailing list|sign up|daftar surat|log in|masuk|share (?=tweet|this|on)|tweet|pin mail|save share|bagikan|teruskan"
    r"|pass it on|salin tautan|print|save|advertisement|iklan|sponsored|most read|terpopuler|you may also like|read also|related|baca juga|lihat juga|comments?|komentar|min read|waktu baca|updated|diperbarui|written by|ditulis oleh|by a small team"
    r"|oleh tim|desk|commission|komisi|small fee|nasihat|does not replace|general in nature|partners|copyright (?=\(c\)|©|\d)|all rights)\b|©",
    re.I,
)
_STARTS = re.compile(r"^\W*(?:" + CUES.pattern + ")", re.I)
_HEADING = re.compile(r"^(?:you may also like|baca juga|most read|terpopuler|related|read also|lihat juga|recommended)\W*$", re.I)
FEATURES = (
    "words", "word_length", "link_density", "kind", "ends", "previous_words", "previous_link_density", "previous_kind", "next_words", "next_link_density", "next_kind", "cues", "title", "holder_words",
    "holder_link_density", "holder_sentences", "holder_share", "holder_titled", "place", "separators", "numbered", "sentences", "holder_paragraphs", "after_heading", "from_title", "holder_cues", "holder_mean", "page_titled", "cue_share", "starts_with_cue",
)


def parse(html: str) -> tuple[list[tuple[str, str, int, int]], str]:
    """Text blocks ``(text, tag, holder, characters in links)`` in order, and the page's title."""
    html = _GONE.sub(" ", html)
    blocks: list[tuple[str, str, int, int]] = []
    stack: list[tuple[str, int]] = [("body", 0)]
    made, parts, linked, in_link, title, in_title = 0, [], 0, 0, "", False

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                # Text straight in a holder beside other blocks belongs to that holder.
                blocks.append((text, stack[-1][0], stack[-2][1] if len(stack) > 1 else 0, min(linked, len(text))))
            parts.clear()
        linked = 0

    for token in _SPLIT.split(html):
        if not token:
            continue
        if token[0] != "<" or len(token) < 3:
            if in_title:
                title += token
            elif token.strip():
                parts.append(token)
                if in_link:
                    linked += len(token.strip())
            elif parts:
                parts.append(" ")
            continue
        m = _NAME.match(token)
        if not m:
            continue
        tag = m[1].lower()
        closing = token[1] == "/"
        if tag == "title":
            in_title = not closing
        elif tag == "a":
            in_link = max(0, in_link + (-1 if closing else 1))
        elif tag == "br":
            flush()
        elif tag in _INLINE:
            continue
        elif closing:
            flush()
            if any(t == tag for t, _ in stack[1:]):
                while stack[-1][0] != tag:
                    stack.pop()
                stack.pop()
        elif tag not in _VOID:
            flush()
            if tag in ("p", "li") and stack[-1][0] == tag:
                stack.pop()
            made += 1
            if tag not in ("html", "head", "body"):
                stack.append((tag, made))
    flush()
    return blocks, " ".join(entities.unescape(title).split())


def features(blocks: list[tuple[str, str, int, int]], title: str) -> np.ndarray:
    """``[block, feature]`` of a page."""
    n = len(blocks)
    words = np.array([b[0].count(" ") + 1 for b in blocks], float)
    chars = np.array([max(1, len(b[0])) for b in blocks], float)
    links = np.array([b[3] for b in blocks], float)
    density = links / chars
    kind = np.array([_KIND.get(b[1], 0) for b in blocks], float)
    ends = np.array([bool(_END.search(b[0])) for b in blocks], float)
    cues = np.array([len(CUES.findall(b[0])) for b in blocks], float)
    stem = title.lower()
    titled = np.array([len(b[0]) > 5 and (stem == (t := b[0].lower()) or stem.startswith(t + " - ") or stem.startswith(t + " | ")) for b in blocks], float)
    sentence = ((words >= 8) & (ends > 0) & (density < 0.5) & (cues == 0)).astype(float)
    _, holder = np.unique([b[2] for b in blocks], return_inverse=True)
    total = lambda x: np.bincount(holder, x)
    h_words, h_chars, h_count = total(words), total(chars), total(np.ones(n))
    h_sentences = total(sentence)
    body = total(sentence * words)
    paragraphs = total((kind == 3).astype(float))
    heading = np.array([bool(_HEADING.match(b[0])) for b in blocks], float)
    headed, after = {}, np.zeros(n)
    for i, h in enumerate(holder):
        after[i] = headed.get(h, 0)
        if heading[i]:
            headed[h] = 1
        elif titled[i]:
            headed[h] = 0
    previous = lambda x, none: np.concatenate(([none], x[:-1]))
    following = lambda x, none: np.concatenate((x[1:], [none]))
    at = np.flatnonzero(titled)
    from_title = np.arange(n) - at[0] if len(at) else np.full(n, -99)
    with np.errstate(invalid="ignore"):
        return np.stack([
            words, chars / words, density, kind, ends, previous(words, 0), previous(density, 0), previous(kind, -1), following(words, 0), following(density, 0), following(kind, -1), cues, titled,
            h_words[holder], (total(links) / h_chars)[holder], h_sentences[holder], (body / max(1.0, body.max()))[holder], total(titled)[holder] > 0, np.arange(n) / max(1, n - 1),
            [len(_MANY.findall(b[0])) for b in blocks], [b[0][:1].isdigit() for b in blocks], [b[0].count(". ") + b[0].count("? ") + b[0].count("! ") + e for b, e in zip(blocks, ends)],
            paragraphs[holder], after, from_title, (total(np.minimum(cues, 1)) / h_count)[holder], (h_words / h_count)[holder], np.full(n, float(len(at) > 0)), cues / words,
            [bool(_STARTS.match(b[0])) for b in blocks],
        ], 1).astype(float)


def grow(x: np.ndarray, y: np.ndarray, depth: int = 9, least: int = 3) -> list[tuple[int, float, int, int, float]]:
    """A decision tree by Gini impurity: nodes ``(feature or -1, threshold, left, right, share of main body)``."""
    nodes: list[tuple[int, float, int, int, float]] = []

    def build(rows: np.ndarray, level: int) -> int:
        me, p = len(nodes), y[rows].mean()
        nodes.append((-1, 0.0, 0, 0, p))
        if level == depth or p in (0.0, 1.0) or len(rows) < 2 * least:
            return me
        best = (1e-9, -1, 0.0)
        n, all_ones = len(rows), y[rows].sum()
        impurity = n * 2 * p * (1 - p)
        for f in range(x.shape[1]):
            v = x[rows, f]
            o = np.argsort(v, kind="stable")
            v, ones = v[o], np.cumsum(y[rows][o])
            k = np.flatnonzero(v[1:] > v[:-1]) + 1
            k = k[(k >= least) & (n - k >= least)]
            if not len(k):
                continue
            a, b = ones[k - 1] / k, (all_ones - ones[k - 1]) / (n - k)
            gain = impurity - k * 2 * a * (1 - a) - (n - k) * 2 * b * (1 - b)
            j = int(np.argmax(gain))
            if gain[j] > best[0]:
                best = (gain[j], f, (v[k[j] - 1] + v[k[j]]) / 2)
        if best[1] < 0:
            return me
        left = x[rows, best[1]] <= best[2]
        a, b = build(rows[left], level + 1), build(rows[~left], level + 1)
        nodes[me] = (best[1], best[2], a, b, p)
        return me

    build(np.arange(len(y)), 0)
    return nodes


def judge(tree: list[tuple[int, float, int, int, float]], x: np.ndarray) -> np.ndarray:
    """Share of main body in the leaf of each row."""
    f, t, a, b, p = (np.array(c) for c in zip(*tree))
    at = np.zeros(len(x), np.int64)
    for _ in range(64):
        inner = f[at] >= 0
        if not inner.any():
            break
        go = x[np.arange(len(x)), np.maximum(f[at], 0)] <= t[at]
        at = np.where(inner, np.where(go, a[at], b[at]), at)
    return p[at]


@lru_cache(maxsize=2)
def trained(path: str = LABELLED) -> tuple:
    """The tree of the labelled table: columns of ``FEATURES``, then ``main`` (0 or 1)."""
    with open(path, newline="") as f:
        rows = list(csv.reader(f))
    if tuple(rows[0]) != (*FEATURES, "main"):
        raise ValueError(f"{path}: its columns aren't the features")
    data = np.array(rows[1:], float)
    return tuple(grow(data[:, :-1], data[:, -1]))


def line_labels(content: str, html: str | None, tree: tuple) -> list[bool]:
    """Whether each line of the extracted text is main body."""
    lines = [" ".join(s.split()) for s in content.split("\n")]
    blocks, title = parse(html) if html else ([], "")
    known: dict[str, list[int]] = {}
    for i, b in enumerate(blocks):
        known.setdefault(b[0], []).append(i)
    alone = [i for i, s in enumerate(lines) if s and s not in known]
    if alone:
        extra = {i: len(blocks) + k for k, i in enumerate(alone)}
        blocks = blocks + [(lines[i], "p", -1, 0) for i in alone]
    if not blocks:
        return [False] * len(lines)
    main = judge(list(tree), features(blocks, title)) >= 0.5
    out, used = [], dict.fromkeys(known, 0)
    for i, s in enumerate(lines):
        if not s:
            out.append(False)
        elif s in known:  # lines that are repeated take the page's blocks in order
            k = min(used[s], len(known[s]) - 1)
            used[s] += 1
            out.append(bool(main[known[s][k]]))
        else:
            out.append(bool(main[extra[i]]))
    return out


def _met(fetched: DataFrame, extracted: DataFrame) -> DataFrame:
    """``page_id, content, html``: the pages are met by id, each HTML once; repeated fetches and repeated extractions are reduced to one before anything is joined."""
    good = fetched.where("content IS NOT NULL").groupBy("page_id").agg(F.max(F.struct("fetched_at", "content")).alias("f")).select("page_id", F.col("f.content").alias("html"))
    texts = extracted.where("content IS NOT NULL").select("page_id", "content").groupBy("page_id").agg(F.max("content").alias("content"))
    return texts.join(good.hint("merge"), "page_id", "left").select("page_id", "content", "html")


def labelled_lines(fetched: DataFrame, extracted: DataFrame) -> DataFrame:
    """``page_id, line_no, main`` of all lines of extracted contents."""
    import pyarrow as pa

    kind = extracted.schema["page_id"].dataType.simpleString()
    tree = trained()

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows, numbers, labels = [], [], []
            for k, (content, page) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                main = line_labels(content, page, tree)
                rows += [k] * len(main)
                numbers += range(1, len(main) + 1)
                labels += main
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int64()), pa.array(labels, pa.bool_())], ["page_id", "line_no", "main"])

    return _met(fetched, extracted).mapInArrow(run, f"page_id {kind}, line_no bigint, main boolean")


def main_text(fetched: DataFrame, extracted: DataFrame) -> DataFrame:
    """``page_id, main_text``: the lines of the main body, cut out where the page is judged; '' if there is none."""
    import pyarrow as pa

    kind = extracted.schema["page_id"].dataType.simpleString()
    tree = trained()

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            out = ["\n".join(line for line, main in zip(content.split("\n"), line_labels(content, page, tree)) if main) for content, page in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], ["page_id", "main_text"])

    return _met(fetched, extracted).mapInArrow(run, f"page_id {kind}, main_text string")
