"""Rule cascade that masks personal information: each step sees what the one before has left.

``masked`` is the expression, ``found`` the kinds in order of first hit. The
patterns and replacements are the format of the corpus (fixed values), with the
Unicode classes of digits, spaces and word ends. Accounts and names are matched
first and then replaced wherever they stand, names but for a few placeholders.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (kind, pattern, replacement) in order (fixed values).
STEPS = (
    ("email", r"(?i)\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", "xxxx@xxxx.xxx"),
    ("phone", r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b", "xxx-xxx-xxxx"),
    ("phone", r"\b\(\d{3}\)\s?\d{3}[-.]?\d{4}\b", "xxx-xxx-xxxx"),
    ("phone", r"\b\+\d{1,3}[-.\s]?\d{1,4}[-.\s]?\d{1,4}[-.\s]?\d{1,9}\b", "xxx-xxx-xxxx"),
    ("phone", r"\b\d{3}\s\d{3}\s\d{4}\b", "xxx-xxx-xxxx"),
    ("ssn", r"\b\d{3}-\d{2}-\d{4}\b", "xxx-xx-xxxx"),
    ("credit_card", r"\b\d{4}[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b", "xxxx-xxxx-xxxx-xxxx"),
    ("license", r"\b[A-Z]\d{7,8}\b", "xxxxxxxx"),
    ("license", r"\b\d{8,9}\b", "xxxxxxxx"),
    ("account", r"\b\d{8,17}\b", None),
    ("passport", r"\b[A-Z]\d{8}\b", "xxxxxxxxx"),
    ("date", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{4}\b", "xx/xx/xxxx"),
    ("date", r"\b\d{4}[/-]\d{1,2}[/-]\d{1,2}\b", "xx/xx/xxxx"),
    ("date", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2}\b", "xx/xx/xxxx"),
    ("ip", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "xxx.xxx.xxx.xxx"),
    ("name", r"\b[A-Z][a-z]+ [A-Z][a-z]+\b", "xxxx xxxx"),
    ("name", r"\b[A-Z]\. [A-Z][a-z]+\b", "xxxx xxxx"),
    ("name", r"\b[A-Z][a-z]+ [A-Z]\. [A-Z][a-z]+\b", "xxxx xxxx"),
    ("address", r"(?i)\b\d+\s+[A-Za-z\s]+(?:Street|St|Avenue|Ave|Road|Rd|Drive|Dr|Lane|Ln|Boulevard|Blvd)\b", "xxxx xxxx Street"),
    ("address", r"\b\d+\s+[A-Za-z\s]+\s+\d{5}(?:-\d{4})?\b", "xxxx xxxx Street"),
)

#: Placeholders of names that stay (fixed values).
PLACEHOLDERS = ("John Doe", "Jane Doe", "John Smith", "Jane Smith", "First Last", "Your Name", "Full Name", "Test User", "Sample User", "Example User")


def unicode(pattern: str) -> str:
    """The pattern with the Unicode classes of the JVM's engine."""
    return "(?iU)" + pattern[4:] if pattern.startswith("(?i)") else "(?U)" + pattern


def cascade(c: Column, kinds: tuple[str, ...] | None = None) -> list[tuple[str, Column, Column]]:
    """``(kind, hit, text after the step)`` of each step of the ``kinds``."""
    out = []
    for kind, pattern, by in STEPS:
        if kinds and kind not in kinds:
            continue
        before, c = c, _step(c, kind, pattern, by)
        out.append((kind, _hit(before, c, kind, pattern, by), c))
    return out


def _matches(c: Column, kind: str, pattern: str) -> Column:
    """Different matches in order, without placeholders."""
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(unicode(pattern)), 0))
    return F.filter(found, lambda m: ~m.isin(*PLACEHOLDERS)) if kind == "name" else found


def _step(c: Column, kind: str, pattern: str, by: str | None) -> Column:
    if kind not in ("account", "name"):
        return F.regexp_replace(c, unicode(pattern), by)
    return F.aggregate(_matches(c, kind, pattern), c, lambda s, m: F.replace(s, m, F.repeat(F.lit("x"), F.length(m)) if by is None else F.lit(by)))


def _hit(before: Column, after: Column, kind: str, pattern: str, by: str | None) -> Column:
    """Whether the step has found something; a text that it leaves as it was may still hold a value that looks like its own replacement."""
    if by is None or kind == "name":
        return before != after
    return (before != after) | (before.contains(by) & before.rlike(unicode(pattern)))


def masked(c: Column, kinds: tuple[str, ...] | None = None) -> Column:
    return cascade(c, kinds)[-1][2]


def found(c: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """Kinds that some step of the cascade has hit, in order."""
    hits = [F.when(hit, F.lit(kind)) for kind, hit, _ in cascade(c, kinds)]
    return F.array_distinct(F.array_compact(F.array(*hits)))


def mask(df, column: str, kinds: tuple[str, ...] | None = None, into: str = "masked_text", found_into: str = "pii_found"):
    """``df`` with both results; each step is a column of its own, so no step is computed twice."""
    work = df.withColumn("_s0", F.col(column))
    names, chosen = [], [s for s in STEPS if not kinds or s[0] in kinds]
    for k, (kind, pattern, by) in enumerate(chosen):
        c, after = F.col(f"_s{k}"), F.col(f"_s{k + 1}")
        work = work.withColumn(f"_s{k + 1}", _step(c, kind, pattern, by))
        names.append(F.when(_hit(c, after, kind, pattern, by), F.lit(kind)))
    out = work.withColumn(into, F.col(f"_s{len(chosen)}")).withColumn(found_into, F.array_distinct(F.array_compact(F.array(*names))))
    return out.drop(*(f"_s{k}" for k in range(len(chosen) + 1)))
