"""Quality predicates, validation and scores of texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lontar.functions.text import LETTER, pieces, sentence_ends, strip, words

#: Phrases of spam (fixed values).
SPAM = ("click here", "subscribe now", "advertisement")


def clean_status(title: Column, text: Column) -> Column:
    """First of ``short_content``, ``poor_title``, ``contains_spam`` that holds, else ``clean``."""
    low = F.lower(text)
    spam = F.lit(False)
    for s in SPAM:
        spam = spam | low.contains(s)
    return F.when(F.length(F.coalesce(text, F.lit(""))) < 100, "short_content").when(F.length(F.coalesce(title, F.lit(""))) < 10, "poor_title").when(spam, "contains_spam").otherwise("clean")


def filled(*columns: Column) -> Column:
    """Whether all are neither null nor empty."""
    out = F.lit(True)
    for c in columns:
        out = out & (F.coalesce(c, F.lit("")) != "")
    return out


def garbled(text: Column) -> Column:
    """Whether a text of 50 or more characters is unprintable, wordless, shredded, or of sentences under three words."""
    size = F.length(text)
    unprintable = F.regexp_count(text, F.lit(r"[\p{C}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]"))
    n = words(text)
    single = F.regexp_count(text, F.lit(rf"(?<!{LETTER}){LETTER}(?!{LETTER})"))
    parts = F.regexp_count(text, F.lit("[.!?]+")) + 1  # blank pieces count too, as after the last mark
    per_part = pieces(F.regexp_replace(text, "[.!?]+", " ")) / parts
    return F.coalesce((size >= 50) & (((size - unprintable) / size < 0.9) | (n == 0) | (single / F.greatest(n, F.lit(1)) > 0.3) | ((parts >= 2) & (per_part < 3))), F.lit(False))


def issues(text: Column, least: int = 200) -> Column:
    """Array of ``too_short``, ``empty_after_cleaning``, ``garbled_content``."""
    t = F.coalesce(text, F.lit(""))
    return F.array_compact(F.array(F.when(F.length(t) < least, "too_short"), F.when(strip(t) == "", "empty_after_cleaning"), F.when(garbled(t), "garbled_content")))


def clean_score(original: Column, cleaned: Column, problems: Column, pii_kinds: Column, emoji: Column, changes: Column) -> Column:
    """0 to 100: less for problems, for much changed length, for more than three kinds of personal data, for many emoji; a little more for changes made."""
    ratio = F.abs(F.length(original) - F.length(cleaned)) / F.greatest(F.length(original), F.lit(1))
    score = (
        F.lit(100.0) - F.when(F.array_contains(problems, "too_short"), 30).otherwise(0) - F.when(F.array_contains(problems, "empty_after_cleaning"), 50).otherwise(0) - F.when(F.array_contains(problems, "garbled_content"), 40).otherwise(0)
        - F.when(ratio > 0.5, 20 * ratio).otherwise(0.0) - F.when(F.size(pii_kinds) > 3, 5 * F.size(pii_kinds)).otherwise(0) - F.when(emoji > 10, F.least(emoji, F.lit(20))).otherwise(0)
        + F.when(changes > 0, F.least(0.1 * changes, F.lit(5.0))).otherwise(0.0)
    )
    return F.when(F.coalesce(original, F.lit("")) == "", 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)))


def extraction_score(content: Column, title: Column, author: Column, date: Column, description: Column, keywords: Column, least: int = 200) -> Column:
    """0 to 100 (at most 80 in fact): length, title, sentences, variety of words, and what else was found."""
    t = F.coalesce(content, F.lit(""))
    tokens = F.regexp_extract_all(F.lower(t), F.lit(f"({LETTER}+)"), 1)
    sentences = sentence_ends(t)
    full = lambda c: F.coalesce(c, F.lit("")) != ""
    score = (
        F.when(F.length(t) >= least, F.least(F.length(t) / 100, F.lit(30.0))).otherwise(0.0) + F.when(F.length(F.coalesce(title, F.lit(""))) > 10, 10).otherwise(0) + F.when(sentences > 5, F.least(sentences, F.lit(20))).otherwise(0)
        + F.when(F.size(tokens) > 0, 10 * F.size(F.array_distinct(tokens)) / F.size(tokens)).otherwise(0.0)
        + F.when(full(author), 2).otherwise(0) + F.when(full(date), 2).otherwise(0) + F.when(full(description), 3).otherwise(0) + F.when(F.size(F.coalesce(keywords, F.array())) > 0, 3).otherwise(0)
    )
    return F.least(score, F.lit(100.0))


def reading_minutes(text: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(words(text) / 200)).cast("long")


def gate(valid: Column, least: float = 0.9) -> list[Column]:
    """Aggregates ``records, valid, share, passed``: whether at least ``least`` of all records are valid; none pass."""
    n = F.count(F.lit(1))
    share = F.coalesce(F.try_divide(F.count_if(valid).cast("double"), n.cast("double")), F.lit(0.0))
    return [n.alias("records"), F.count_if(valid).alias("valid"), F.round(share, 6).alias("share"), ((share >= least) | (n == 0)).alias("passed")]


def field_errors(present: dict[str, Column], banned: dict[str, Column]) -> Column:
    """Array of ``missing_x`` for required fields that are empty and ``banned_x`` for fields that must not be there."""
    lacks = [F.when(F.coalesce(c.cast("string"), F.lit("")) == "", F.lit(f"missing_{n}")) for n, c in present.items()]
    has = [F.when(c.isNotNull(), F.lit(f"banned_{n}")) for n, c in banned.items()]
    return F.array_compact(F.array(*lacks, *has))


def entry_errors(entry: dict[str, Column], least: int = 200) -> Column:
    """Array of what an exported entry lacks: missing fields, a short text."""
    missing = [F.when(F.coalesce(c.cast("string"), F.lit("")) == "", F.lit(f"missing_{name}")) for name, c in entry.items()]
    return F.array_compact(F.array(*missing, F.when(F.length(F.coalesce(entry["text"], F.lit(""))) < least, "text_too_short")))
