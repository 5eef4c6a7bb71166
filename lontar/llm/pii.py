"""Problem 6: personal information inside free text.

Method: a semi-Markov conditional random field. Candidate segments of at most
``MAX_LENGTH`` characters (runs of capitalised words, of digits and separators,
of words that make up an address or an e-mail address) get scores from features
of the whole span and of the words beside it; where candidates overlap, dynamic
programming over all of them chooses boundaries and types jointly, text outside
segments scoring 0. The weights are learnt by maximum likelihood (forward and
backward sums over the same lattices) from the labelled sentences of
``pii_examples``. Which capitalised words are ordinary ones is told by a
vocabulary of words met in lower case, counted over all texts.

Types: ``email``, ``phone``, ``id_number``, ``address``, ``person_name``.
Defined results: null and empty texts have none; start positions are from 1, in
code points; repeated rows give repeated spans in ``spans``.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import cut

PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "id_number": "[ID_NUMBER]", "address": "[ADDRESS]", "person_name": "[PERSON_NAME]"}
MAX_LENGTH = 120
#: Share of all ordinary uses from which a word is an ordinary one; so there are at most 500,000.
SHARE = 2e-6

_AT, _DOT = r"(?:@|\s?[(\[{]\s?(?:at|AT|@)\s?[)\]}]\s?)", r"(?:\.|\s?[(\[{]\s?(?:dot|DOT|\.)\s?[)\]}]\s?)"
_EMAIL = re.compile(rf"[\w.+%'-]*\w(?:{_AT})[A-Za-z0-9](?:[\w-]*\w)?(?:{_DOT}[A-Za-z0-9][\w-]*)+|[\w.+%-]*\w\s(?:at|AT)\s[A-Za-z0-9][\w-]*(?:\s(?:dot|DOT)\s[A-Za-z]\w*)+")
_EMAIL_CUE = re.compile(r"@|[(\[{]\s?at\s?[)\]}]|\sdot\s", re.I)
_NUMBER = re.compile(r"(?<![\w@.])(?:\+|\()?\d(?:[\d().]|[ -](?=[\d(])|(?<=\))\s){4,26}\d(?![\w@])|(?<![\w@])[A-Z]{1,2}\d{6,9}(?!\w)")
_WAY = r"(?:Street|St\.|Road|Rd\.?|Avenue|Ave\.?|Lane|Ln\.?|Court|Ct\.?|Close|Drive|Dr\.|Way|Square|Terrace|Place|Boulevard|Blvd\.?)"
_CITY = r"(?:, [A-Z][\w'-]+(?: [A-Z][\w'-]+)?(?: \d{5})?)?"
_ADDRESS = re.compile(
    rf"(?:(?:Flat|Apt\.?|Apartment|Unit|Suite|Block) \w{{1,5}}, )?\d{{1,5}}[A-Za-z]?,? (?:[A-Z][\w'-]+ ){{1,3}}{_WAY}(?!\w){_CITY}"
    rf"|(?:Jalan|Jln\.?|Jl\.?) (?:[A-Z][\w'-]+,? ){{1,4}}?(?:(?:Gang|Gg\.?) \w{{1,6}},? )?(?:(?:No\.?|Nomor)? ?\d{{1,5}}\w?)(?:,? RT\.? ?\d+ ?/ ?RW\.? ?\d+)?{_CITY}"
    rf"|(?:Komplek|Kompleks|Perumahan|Perum|Apartemen) (?:[A-Z][\w'-]+,? ){{1,3}}?(?:Blok \w{{1,5}},? ?)(?:(?:No\.?|Nomor) ?\d{{1,5}})?{_CITY}"
    rf"|(?:P\.?O\.? Box|Kotak Pos|PO BOX) \d{{1,6}}(?:, [A-Z][\w'-]+(?: [A-Z][\w'-]+)?)?(?: \d{{5}})?"
)
_ADDRESS_CUE = re.compile(rf"\b(?:{_WAY}|Jalan|Jln|Jl|Komplek|Kompleks|Perumahan|Perum|Apartemen|Box|BOX|Kotak Pos)(?!\w)")
#: Capital and small letters of the Latin, Greek and Cyrillic scripts.
_U, _L = ("".join(c for c in map(chr, (*range(0x41, 0x250), *range(0x370, 0x530))) if c.isalpha() and is_(c)) for is_ in (str.isupper, str.islower))
_PART = rf"(?:[{_U}][{_L}'’]+(?:-[{_U}][{_L}]+)?|[{_U}]\.|[{_U}]{{2,}}(?:-[{_U}]{{2,}})?)(?!\w)"
_RUN = re.compile(rf"(?<![\w@.+-]){_PART}(?:(?:,? | ){_PART})+")
_PIECE = re.compile(_PART)
_LOWER = re.compile(rf"(?<![\w@.+'’-])[{_L}]{{3,}}(?![\w@+'’-]|\.\w)")
_INITIAL, _LEAD = re.compile(rf" [{_L}]\. "), re.compile(rf"(?<![\w@.+-])([{_L}]\.) $")
_TITLES = frozenset("pak bu bapak ibu mr mrs ms miss dr prof sir mbak mas".split())
_WORD = rf"(?<![\w@.])%s[{_L}]{{2,}}(?![\w@])"
_WORDS = re.compile(_WORD % f"[{_U}]?")
_NAMED = re.compile(f"(?:(?<=[{_L}] )|(?<=[{_L}], )|(?<=-- )|(?<=Pak )|(?<=Bu ))" + _WORD % f"[{_U}]")


def _around(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The two words before (``^`` at a line's start) and the word after, in lower case and without marks."""
    head = text[max(0, start - 40) : start]
    head = head.rpartition("\n")[2]
    words = head.split()[-2:]
    clean = lambda w: w.strip(".,:;!?()[]\"'’").lower() or w[-1:]
    first = clean(words[-1]) if words else "^"
    second = clean(words[-2]) if len(words) > 1 else "^"
    if words and words[-1][-1] in ".!?":
        first, second = "^", "^"
    tail = text[end : end + 24].partition("\n")[0]
    after = tail.split(None, 1)
    return first, second, (clean(after[0]) if after else "$")


def _runs(text: str, vocabulary: frozenset) -> Iterator[list[tuple[int, int, str]]]:
    """Runs of words that may be names: capitalised words and initials, and lower-case words that are no ordinary ones."""
    for m in _RUN.finditer(text):
        yield [(p.start() + m.start(), p.end() + m.start(), p[0]) for p in _PIECE.finditer(m[0])]
    odd = [m for m in _LOWER.finditer(text) if m[0] not in vocabulary]
    run: list[tuple[int, int, str]] = []
    for m in odd:
        gap = text[run[-1][1] : m.start()] if run else ""
        if run and (gap in (" ", ", ") or _INITIAL.fullmatch(gap)):
            if len(gap) > 2:
                run.append((run[-1][1] + 1, run[-1][1] + 3, gap.strip()))
        else:
            if len(run) > 1:
                yield run
            lead = _LEAD.search(text, max(0, m.start() - 4), m.start())
            run = [(lead.start(1), lead.end(1), lead[1])] if lead else []
        run.append((m.start(), m.end(), m[0]))
    if len(run) > 1:
        yield run


def _candidates(text: str, vocabulary: frozenset) -> list[tuple[int, int, str, list[str]]]:
    """Candidate segments ``(start, end, type, features)``."""
    out: list[tuple[int, int, str, list[str]]] = []

    def add(start: int, end: int, kind: str, own: list[str]) -> None:
        b1, b2, a1 = _around(text, start, end)
        out.append((start, end, kind, [f"{kind}|{f}" for f in [*own, f"b1={b1}", f"b2={b2} {b1}", f"a1={a1}"]]))

    if _EMAIL_CUE.search(text):
        for m in _EMAIL.finditer(text):
            if m.end() - m.start() <= MAX_LENGTH:
                add(m.start(), m.end(), "email", ["bias", "plain" if "@" in m[0] else "words"])
    for m in _NUMBER.finditer(text):
        s = m[0].rstrip(" .-(")
        digits = sum(map(str.isdigit, s))
        if digits < 6 or s.count("(") != s.count(")"):
            continue
        shape = re.sub(r"\d", "0", s)
        own = ["bias", f"shape={re.sub('[A-Z]', 'A', shape)}", f"digits={digits}", f"marks={''.join(sorted(set(re.sub(r'[0A-Z]', '', shape))))}", f"first={s[0] if not s[0].isdigit() else s[:2] if s[:2] in ('08', '62', '02') else 'd'}", f"groups={len(re.findall('0+', shape))}"]
        add(m.start(), m.start() + len(s), "phone", own)
        add(m.start(), m.start() + len(s), "id_number", own)
    if _ADDRESS_CUE.search(text):
        for m in _ADDRESS.finditer(text):
            s = m[0].rstrip(" ,")
            numbered = any(c.isdigit() for c in s)
            add(m.start(), m.start() + len(s), "address", ["bias", f"numbered={numbered}", f"head={re.sub(r'[0-9]+', '0', s.split()[0])}", f"parts={min(6, s.count(' '))}"])
    for parts in _runs(text, vocabulary):
        known = [p[2].lower() in vocabulary for p in parts]
        for i in range(len(parts)):
            if parts[i][2].lower().rstrip(".") in _TITLES:
                continue
            for j in range(i + 1, len(parts)):
                span = parts[i : j + 1]
                # Names of any number of parts, as long as a segment may be; one of five or more has at most one ordinary word.
                if span[-1][1] - span[0][0] > MAX_LENGTH or len(span) > 4 and sum(known[i : j + 1]) > 1:
                    break
                if any(p[2].lower().rstrip(".") in _TITLES for p in span[1:]):
                    break
                between = [text[a[1] : b[0]] for a, b in zip(span, span[1:])]
                commas = sum("," in g for g in between)
                if commas > 1 or commas and not (len(span) == 2 or "," in between[0]) or all(len(p[2]) == 2 and p[2][1] == "." for p in span):
                    continue
                form = "".join("I" if p[2].endswith(".") else "U" if p[2].isupper() else "L" if p[2].islower() else "C" for p in span)
                common = sum(known[i : j + 1])
                left = i > 0 and not (parts[i - 1][2].lower().rstrip(".") in _TITLES)
                right = j + 1 < len(parts)
                own = [
                    "bias", f"form={form}{',' * commas}", f"parts={min(4, len(span))}", f"common={min(2, common)}", f"first_common={known[i]}", f"last_common={known[j]}",
                    f"left={'title' if i and not left else 'common' if left and known[i - 1] else 'odd' if left else 'none'}", f"right={'common' if right and known[j + 1] else 'odd' if right else 'none'}",
                    f"left_comma={left and ',' in text[parts[i - 1][1] : parts[i][0]]}", f"right_comma={right and ',' in text[parts[j][1] : parts[j + 1][0]]}", f"end_mark={text[parts[j][1] : parts[j][1] + 1] in '.!?' and text[parts[j][1] : parts[j][1] + 1] != ''}",
                ]
                add(parts[i][0], parts[j][1], "person_name", own)
    out.sort(key=lambda c: (c[1], c[0]))
    return out


def _score(weights: dict[str, float], features: list[str]) -> float:
    return sum(weights.get(f, 0.0) for f in features)


def _clusters(candidates: list) -> Iterator[list]:
    """Candidates that overlap directly or through others, sorted by end."""
    group, reach = [], -1
    for c in sorted(candidates, key=lambda c: (c[0], c[1])):
        if group and c[0] >= reach:
            yield sorted(group, key=lambda x: (x[1], x[0]))
            group = []
        group.append(c)
        reach = max(reach, c[1]) if len(group) > 1 else c[1]
    if group:
        yield sorted(group, key=lambda x: (x[1], x[0]))


def decode(candidates: list, weights: dict[str, float]) -> list[tuple[int, int, str]]:
    """The best set of segments that don't overlap."""
    out = []
    for group in _clusters(candidates):
        places = sorted({p for c in group for p in (c[0], c[1])})
        at = {p: k for k, p in enumerate(places)}
        ending = defaultdict(list)
        for c in group:
            ending[at[c[1]]].append(c)
        best, back = [0.0] * len(places), [None] * len(places)
        for k in range(1, len(places)):
            best[k], back[k] = best[k - 1], (k - 1, None)
            for c in ending[k]:
                s = best[at[c[0]]] + _score(weights, c[3])
                if s > best[k]:
                    best[k], back[k] = s, (at[c[0]], c)
        k = len(places) - 1
        while k:
            k, c = back[k]
            if c:
                out.append((c[0], c[1], c[2]))
    return sorted(out)


def _log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a))


def train(labelled: list[tuple[str, list[tuple[int, int, str]]]], vocabulary: frozenset, rounds: int = 6, rate: float = 0.5, decay: float = 2e-4) -> dict[str, float]:
    """Weights of most likelihood, by adaptive gradient steps on each lattice."""
    weights: dict[str, float] = defaultdict(float)
    scale: dict[str, float] = defaultdict(lambda: 1e-6)
    lattices = []
    for text, spans in labelled:
        gold = set(spans)
        for group in _clusters(_candidates(text, vocabulary)):
            places = sorted({p for c in group for p in (c[0], c[1])})
            at = {p: k for k, p in enumerate(places)}
            lattices.append(([(at[a], at[b], f, (a, b, kind) in gold) for a, b, kind, f in group], len(places)))
    for _ in range(rounds):
        for arcs, n in lattices:
            scores = [_score(weights, f) for _, _, f, _ in arcs]
            ahead, back = [0.0] + [-math.inf] * (n - 1), [-math.inf] * (n - 1) + [0.0]
            into, out = defaultdict(list), defaultdict(list)
            for k, (a, b, _, _) in enumerate(arcs):
                into[b].append(k), out[a].append(k)
            for k in range(1, n):
                ahead[k] = ahead[k - 1]
                for e in into[k]:
                    ahead[k] = _log_add(ahead[k], ahead[arcs[e][0]] + scores[e])
            for k in range(n - 2, -1, -1):
                back[k] = back[k + 1]
                for e in out[k]:
                    back[k] = _log_add(back[k], back[arcs[e][1]] + scores[e])
            for (a, b, f, right), s in zip(arcs, scores):
                g = (1.0 if right else 0.0) - math.exp(min(0.0, ahead[a] + s + back[b] - ahead[n - 1]))
                if abs(g) < 1e-4:
                    continue
                for x in f:
                    step = g - decay * weights[x]
                    scale[x] += step * step
                    weights[x] += rate * step / math.sqrt(scale[x])
    return {k: round(v, 4) for k, v in weights.items() if abs(v) > 1e-3}


@lru_cache(maxsize=2)
def _trained(vocabulary: frozenset) -> dict[str, float]:
    from lontar.llm.pii_examples import examples

    return train(examples(), vocabulary)


def word_uses(texts: Iterator[str]) -> tuple[Counter, Counter]:
    """Ordinary uses, and uses as a name, of the words of ``texts`` in lower case: ordinary is in lower case or at the start of a sentence, as a name is capitalised after a word in lower case."""
    every: Counter = Counter()
    capital: Counter = Counter()
    for t in texts:
        if _EMAIL_CUE.search(t):
            t = _EMAIL.sub(" ", t)
        every.update(_WORDS.findall(t))
        capital.update(_NAMED.findall(t))
    plain: Counter = Counter()
    named: Counter = Counter()
    for w, n in every.items():
        plain[w.lower()] += n - capital[w]
        named[w.lower()] += capital[w]
    return plain, named


def fit_vocabulary(texts: DataFrame) -> frozenset:
    """Ordinary words of all ``texts``: far more often ordinary than used as names, and at least ``SHARE`` of all ordinary uses."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        plain, named = word_uses(t for b in batches for t in b.column(0).to_pylist() if t)
        words = list(plain)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([plain[w] for w in words], pa.int64()), pa.array([named[w] for w in words], pa.int64())], ["word", "plain", "named"])

    words = cut(texts.select("text").where("text IS NOT NULL").mapInArrow(run, "word string, plain bigint, named bigint").groupBy("word").agg(F.sum("plain").alias("plain"), F.sum("named").alias("named")))
    uses = words.agg(F.sum("plain")).first()[0] or 0
    return frozenset(r["word"] for r in words.where((F.col("plain") > 2) & (F.col("plain") >= SHARE * uses) & (F.col("named") < 0.2 * F.col("plain"))).select("word").collect())


def _model(texts: DataFrame, vocabulary: frozenset | None) -> tuple[frozenset, dict[str, float]]:
    from lontar.llm.pii_examples import ordinary

    words = (fit_vocabulary(texts) if vocabulary is None else vocabulary) | ordinary()
    return words, _trained(words)


def spans(texts: DataFrame, vocabulary: frozenset | None = None) -> DataFrame:
    """The columns of ``texts`` besides ``text``, and ``pii_type, start_pos, length`` of each segment."""
    import pyarrow as pa

    keep = [c for c in texts.columns if c not in ("text", "pii_type", "start_pos", "length")]  # columns of those names are replaced
    shared = texts.sparkSession.sparkContext.broadcast(_model(texts, vocabulary))

    def run(batches: Iterator) -> Iterator:
        known, weights = shared.value
        for b in batches:
            rows, kinds, starts, lengths = [], [], [], []
            for k, text in enumerate(b.column(len(keep)).to_pylist()):
                if not text:
                    continue
                for a, e, kind in decode(_candidates(text, known), weights):
                    rows.append(k), kinds.append(kind), starts.append(a + 1), lengths.append(e - a)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(j).take(at) for j in range(len(keep))), pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64())], [*keep, "pii_type", "start_pos", "length"])

    schema = ", ".join([f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep] + ["pii_type string, start_pos bigint, length bigint"])
    return texts.select(*keep, "text").mapInArrow(run, schema)


def masked(texts: DataFrame, vocabulary: frozenset | None = None) -> DataFrame:
    """``texts`` with ``masked_text``: every segment replaced by the placeholder of its type, the rest unchanged."""
    import pyarrow as pa

    texts = texts.drop("masked_text")  # a column of that name is replaced
    keep = texts.columns
    at_text = keep.index("text")
    shared = texts.sparkSession.sparkContext.broadcast(_model(texts, vocabulary))

    def run(batches: Iterator) -> Iterator:
        known, weights = shared.value
        for b in batches:
            out = []
            for text in b.column(at_text).to_pylist():
                if text:
                    for a, e, kind in reversed(decode(_candidates(text, known), weights)):
                        text = text[:a] + PLACEHOLDER[kind] + text[e:]
                out.append(text)
            yield pa.RecordBatch.from_arrays([*(b.column(j) for j in range(len(keep))), pa.array(out, pa.string())], [*keep, "masked_text"])

    schema = ", ".join([f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep] + ["masked_text string"])
    return texts.mapInArrow(run, schema)
