"""Problem 2: per-document statistics of text quality, and the texts that are no natural prose.

Method: thresholds on the statistics are noisy labelling functions, each of
which votes for a text type (``prose``, ``list`` for lists, tables, names and
keywords in a row, ``junk`` for code and debris) or abstains. Their accuracies
are learnt without labels by expectation-maximization on how often which votes
meet (a Dawid-Skene model on the table of vote patterns, which has a bounded
number of rows whatever the corpus), and each text gets the posterior of each
type. Statistics are taken of every whole text.

Defined results: null, empty and blank texts have 0 for every figure, the type
``empty`` and no posterior, and are no cases; repeated rows are rows of their
own in ``statistics`` and one case in ``found``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lontar.llm.common import cut

TYPES = ("prose", "list", "junk")
#: Common words of English and Indonesian (fixed values).
COMMON = frozenset(
    """the a an and or but if of to in on at by for with from as into is are was were be been has have had do does did will would can could should may might must
    not no nor so than then that this these those there here it its he she his her him they them their we us our you your i my me who what which when where how why
    all any both each few more most some such only own same too very just about after before between over under again once until while because
    yang dan di ke dari untuk pada dengan ini itu adalah akan tidak juga sudah telah oleh saat dalam bisa ada lebih karena agar bila jika apalagi sebelum setelah
    sedangkan sementara maka namun tetap masih menjadi terlalu antara tanpa secara bagi sebab lalu mulai para saya kami kita mereka dia ia satu lain atas sebuah
    seperti hingga sampai tetapi atau hanya harus dapat bahwa sangat semua setiap banyak paling cukup makin ikut lewat selama menurut akibat sejak serta pun saja
    lagi belum pernah terakhir sebanyak padahal tampak disimpan dinilai cara pihak""".split()
)
_LETTERS = re.compile(r"[^\W\d_]+")
_SYMBOL = re.compile(r"[^\w\s]")
#: For plain ASCII: letters in lower case and all else a space; what is a symbol; digits.
_PLAIN = "".join(chr(c).lower() if chr(c).isalpha() else " " for c in range(128))
_SYMBOLS = bytes(c for c in range(128) if _SYMBOL.match(chr(c)))
_DIGIT = re.compile(r"\d")
_MARK = re.compile(r"^(?:[-*•·–—+>#]|\(?\d{1,3}[.):]|\(?[a-z][.)])\s+")
_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
_SENTENCE = re.compile(r"(?<=[.!?…])[\"'”’»)]*\s+|(?<=[。！？])")
_CODE = re.compile(r"[{}<>=|\\^~;]{1}.*[{}<>=|\\^~;]")
_CJK = re.compile(r"[぀-ヿ㐀-鿿]")
STATISTICS = ("n_chars", "n_words", "n_lines", "mean_word_length", "symbol_ratio", "digit_ratio", "end_punctuation_share", "common_word_share", "short_line_share", "running_share", "running_word_share")


def _words(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    return text.translate(_PLAIN).split() if text.isascii() else _LETTERS.findall(text.lower())


def _symbols_and_digits(text: str) -> tuple[int, int]:
    if not text.isascii():
        return len(_SYMBOL.findall(text)), len(_DIGIT.findall(text))
    raw = text.encode()
    return len(raw) - len(raw.translate(None, _SYMBOLS)), len(raw) - len(raw.translate(None, b"0123456789"))


def _running(piece: str) -> bool:
    """Whether a piece of text is a running sentence: it ends as one, is made of letters and has the small words of a language."""
    if not _END.search(piece):
        return False
    words = _words(piece)
    if len(words) < 4:
        return len(_CJK.findall(piece)) >= 6
    letters = sum(map(len, words))
    if letters < 0.66 * (len(piece) - piece.count(" ")) or _CODE.search(piece):
        return False
    if sum(map(COMMON.__contains__, words)) >= max(1, 0.12 * len(words)):
        return True
    return not piece.isascii() and len(_CJK.findall(piece)) >= 6


def _all_running(line: str) -> bool:
    """Whether a line is running sentences throughout, beyond doubt: it has far more small words than a sentence needs."""
    if line[-1] not in ".!?":
        return False
    words = _words(line)
    return sum(map(len, words)) > 0.75 * (len(line) - line.count(" ")) and sum(map(COMMON.__contains__, words)) >= 0.24 * len(words) > 2


def statistics_of(text: str | None) -> tuple | None:
    """The figures of one text, or None if it is blank."""
    if not text or not text.strip():
        return None
    lines = [s for s in map(str.strip, text.splitlines()) if s]
    words = _words(text)
    n, solid = len(words), max(1, len(text) - sum(map(text.count, " \n\t\r")))
    ended = short = run = run_words = total = 0
    for line in lines:
        total += len(line)
        bare = _MARK.sub("", line)
        k = line.count(" ") + 1
        short += k < 6
        if _END.search(line):
            ended += 1
        elif len(line) < 60:
            continue
        if len(bare) > 100 and _all_running(bare):
            run += len(bare)
            run_words += bare.count(" ") + 1
            continue
        pieces = _SENTENCE.split(bare) if len(bare) > 60 else (bare,)
        for p in pieces:
            if p and _running(p):
                run += len(p) + 1
                run_words += p.count(" ") + 1
    spread = sum(line.count(" ") + 1 for line in lines)
    symbols, digits = _symbols_and_digits(text)
    return (
        len(text), n, len(lines), sum(map(len, words)) / n if n else 0.0, symbols / solid, digits / solid, ended / len(lines),
        sum(map(COMMON.__contains__, words)) / n if n else 0.0, short / len(lines), min(1.0, run / total), min(1.0, run_words / spread),
    )


def statistics(texts: DataFrame) -> DataFrame:
    """The columns of ``texts`` besides ``text``, and the figures of each text."""
    import pyarrow as pa

    keep = [c for c in texts.columns if c != "text" and c not in STATISTICS]  # a column of that name is replaced
    whole = {"n_chars", "n_words", "n_lines"}

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows = [statistics_of(t) or (0,) * 3 + (0.0,) * 8 for t in b.column(len(keep)).to_pylist()]
            cols = [pa.array(c, pa.int64() if name in whole else pa.float64()) for name, c in zip(STATISTICS, zip(*rows) if rows else [()] * len(STATISTICS))]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), *cols], [*keep, *STATISTICS])

    schema = ", ".join([f"`{c}` {texts.schema[c].dataType.simpleString()}" for c in keep] + [f"{c} {'bigint' if c in whole else 'double'}" for c in STATISTICS])
    return texts.select(*keep, "text").mapInArrow(run, schema)


def votes() -> dict[str, F.Column]:
    """Labelling functions: 0 prose, 1 list, 2 junk, -1 no vote.

    Each looks at a figure of its own and is wrong at times: many lists have
    ends like sentences, code has common words, news has numbers. None is the
    share of characters in running sentences, by which cases are defined.
    """
    c = F.col
    pick = lambda *cases: F.coalesce(*(F.when(cond, F.lit(label)) for cond, label in cases), F.lit(-1))
    return {
        "v_running_words": pick((c("running_word_share") >= 0.5, 0), (c("running_word_share") < 0.25, 1)),
        "v_common": pick((c("common_word_share") >= 0.25, 0), (c("common_word_share") < 0.1, 1)),
        "v_symbols": pick((c("symbol_ratio") > 0.15, 2), (c("symbol_ratio") < 0.05, 0)),
        "v_length": pick(((c("mean_word_length") > 8) | (c("mean_word_length") < 2.5), 2)),
        "v_ends": pick((c("end_punctuation_share") >= 0.6, 0), (c("end_punctuation_share") < 0.2, 1)),
        "v_digits": pick((c("digit_ratio") > 0.12, 1)),
        "v_short_lines": pick((c("short_line_share") >= 0.7, 1), (c("short_line_share") < 0.3, 0)),
    }


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximization on vote patterns: priors of the types, and ``[function, type, vote + 1]`` probabilities."""
    k, m = len(TYPES), patterns.shape[1]
    posterior = np.full((len(patterns), k), 0.05)
    for t in range(k):  # to begin with, the majority of the votes
        posterior[:, t] += (patterns == t).sum(1)
    posterior /= posterior.sum(1, keepdims=True)
    for _ in range(rounds):
        weight = posterior * counts[:, None]
        prior = (weight.sum(0) + 1.0) / (weight.sum() + k)
        table = np.full((m, k, k + 1), 0.5)
        for j in range(m):
            for v in range(-1, k):
                table[j, :, v + 1] += weight[patterns[:, j] == v].sum(0)
        table /= table.sum(2, keepdims=True)
        for t in range(k):  # a vote for a type is never held to speak against it: else two types could change places
            table[:, t, t + 1] = table[:, :, t + 1].max(1)
        posterior = posteriors(patterns, prior, table)
    return prior, table


def posteriors(patterns: np.ndarray, prior: np.ndarray, table: np.ndarray) -> np.ndarray:
    log = np.log(prior)[None, :] + sum(np.log(table[j][:, patterns[:, j] + 1]).T for j in range(patterns.shape[1]))
    log -= log.max(1, keepdims=True)
    p = np.exp(log)
    return p / p.sum(1, keepdims=True)


def typed(stats: DataFrame) -> DataFrame:
    """``stats`` with ``p_prose, p_list, p_junk`` and ``text_type``. ``stats`` is read twice: cut it before."""
    functions = votes()
    names = list(functions)
    voted = stats.withColumns(functions).withColumn("pattern", F.when(F.col("n_chars") > 0, F.concat_ws(",", *names))).drop(*names)
    seen = voted.where("pattern IS NOT NULL").groupBy("pattern").count().collect()  # at most 4 ** 7 patterns, some dozens in practice
    spark = stats.sparkSession
    rows = []
    if seen:
        patterns = np.array([[int(v) for v in r["pattern"].split(",")] for r in seen])
        prior, table = fit(patterns, np.array([r["count"] for r in seen], float))
        rows = [(r["pattern"], *map(float, p)) for r, p in zip(seen, posteriors(patterns, prior, table))]
    known = spark.createDataFrame(rows, "pattern string, p_prose double, p_list double, p_junk double")
    best = F.when(F.col("pattern").isNull(), "empty").when(F.col("p_prose") >= F.greatest("p_list", "p_junk"), "prose").when(F.col("p_list") >= F.col("p_junk"), "list").otherwise("junk")
    return voted.join(F.broadcast(known), "pattern", "left").withColumn("text_type", best).drop("pattern")


def no_prose(texts: DataFrame) -> DataFrame:
    """Distinct keys (the columns besides ``text``) of texts that are no natural prose."""
    keep = [c for c in texts.columns if c != "text"]
    return typed(cut(statistics(texts))).where((F.col("text_type") != "empty") & (F.col("p_prose") < 0.5)).select(*keep).distinct()
