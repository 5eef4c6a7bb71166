"""Text functions as Columns, in built-in expressions throughout.

Patterns spell out their character classes, since the regex engines of Java,
Python and SQL databases disagree about ``\\s``, ``\\w`` and ``\\b``. Null in,
null out, unless a function says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of Unicode, as a class for Java and RE2 alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Characters of words.
LETTER = r"[\p{L}\p{N}_]"
NO_LETTER_NO_SPACE = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Emoji blocks removed from threads and pages (fixed values).
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{2600}-\x{26FF}\x{2B00}-\x{2BFF}]"
#: Words and patterns that thread cleaning removes (fixed values).
USER_V1, USER_V2 = r"u/[a-zA-Z0-9_-]+", r"(?i)\bu/[A-Za-z0-9_-]+"
URL_HTTP, URL_WWW = r"https?://[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", r"www\.[^\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
MAIL_V1, MAIL_V2 = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b", r"\b[\p{L}\p{N}_.-]+@[\p{L}\p{N}_.-]+\.[\p{L}\p{N}_]+\b"
PHONE_V1 = r"(\+?1[-. \t\n\r]?)?\(?[0-9]{3}\)?[-. \t\n\r]?[0-9]{3}[-. \t\n\r]?[0-9]{4}"
PHONE_V2 = r"\b(?:\+?\d{1,3}[ -]?)?(?:\(?\d{2,4}\)?[ -]?)?\d{3,4}[ -]?\d{3,4}\b"
ODD_V1 = r"[^\p{L}\p{N}_\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}.,!?;:()\-\[\]{}\"']"
#: Literals that corpus cleaning takes out of news texts (fixed values).
NEWS_LITERALS = ("SCROLL TO CONTINUE WITH CONTENT", "ADVERTISEMENT", "Baca juga:", "Simak juga Video:", "[Gambas:Video 20detik]", "Halaman 2 dari 2", "detikcom", "(", ")")
NEWS_CODES = ("akd/akd", "haf/haf", "nvc/idh", "rfs/imk", "rdp/tor")
#: Phrases that extraction deletes in place (fixed values).
PAGE_PHRASES = (
    r"\b(advertisement|sponsored|promoted)\b", r"\b(ads?|advert)\b", r"\b(affiliate|partner)\s+(link|content)\b", r"\b(next|previous|prev|continue)\s+(page|article|story)\b", r"\b(home|back|top)\s+(page|link)\b",
    r"\b(breadcrumb|navigation|menu)\b", r"\b(disclaimer|terms|privacy|policy|legal)\b", r"\b(copyright|all rights reserved)\b", r"\b(medical|health)\s+disclaimer\b",
)
CONTROL = r"[\x00-\x1f\x7f-\x{9f}]"
CONTROL_BUT_LINES = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]"


_SPACES = SPACE[1:-1]


def fast(pattern: str) -> str:
    """A pattern with the class of spaces spelled out, as Java matches it several times faster: by the Unicode class of the engine."""
    return "(?U)" + pattern.replace(_SPACES, r"\s\x1c-\x1f") if _SPACES in pattern else pattern


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, fast(rf"^{SPACE}+|{SPACE}+$"), "")


def squeeze(c: Column) -> Column:
    """White space runs made one space, ends stripped."""
    return F.trim(F.regexp_replace(c, fast(f"{SPACE}+"), " "))


def replaced(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, by in steps:
        c = F.regexp_replace(c, fast(pattern), by)
    return c


def without(c: Column, *literals: str) -> Column:
    for x in literals:
        c = F.replace(c, F.lit(x), F.lit(""))
    return c


def thread_text_v1(c: Column) -> Column:
    """First form of thread cleaning: user names, addresses, mails, phones and odd characters go; one line. Null gives ''."""
    return F.coalesce(squeeze(replaced(c, (USER_V1, ""), (URL_HTTP, ""), (URL_WWW, ""), (MAIL_V1, ""), (PHONE_V1, ""), (ODD_V1, " "))), F.lit(""))


def thread_text_v2(c: Column) -> Column:
    """Second form: also quote marks of lines and emoji; three entities are unescaped; lines are kept. Null gives ''."""
    c = replaced(c, (rf"(?m)^{SPACE}*>{SPACE}*", ""), (USER_V2, ""), (URL_HTTP, ""), (MAIL_V2, ""), (PHONE_V2, ""), (f"{EMOJI}+", ""))
    for entity, mark in (("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(mark))
    c = replaced(c, (r"[\t\x0b\x0c\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+", " "), (r"[ \t\r\f\x0b]+", " "), (r"\n{3,}", "\n\n"))
    return F.coalesce(strip(c), F.lit(""))


def news_text(c: Column) -> Column:
    """News cleaning: one line, no control characters. Null gives ''."""
    return F.coalesce(F.regexp_replace(squeeze(c), r"[\x00-\x08\x0b-\x1f]", ""), F.lit(""))


def news_without_residue(c: Column) -> Column:
    """Corpus cleaning: fixed literals, leading dash and reporter codes go, and a closing run of at most five lower-case words. Null gives ''."""
    c = squeeze(without(c, *NEWS_LITERALS))
    c = F.regexp_replace(c, r"^ *- *", "")
    for code in NEWS_CODES:
        c = F.regexp_replace(c, f" *{code} *", "")
    tail = F.regexp_extract(c, r" +[a-z ]+$", 0)
    short = (F.trim(tail) != "") & (F.size(F.split(F.trim(tail), " +")) <= 5)
    return F.coalesce(strip(F.when(short, F.substring(c, F.lit(1), F.length(c) - F.length(tail))).otherwise(c)), F.lit(""))


def page_text(c: Column) -> Column:
    """Extraction cleaning: phrases of advertisement, navigation and disclaimers are deleted in place, marks in a row made one."""
    for p in PAGE_PHRASES:
        c = F.regexp_replace(c, "(?i)" + p, "")
    return strip(F.regexp_replace(F.regexp_replace(c, fast(f"{SPACE}+"), " "), r"([.!?]) *([.!?])+", "$1"))


def emojis(c: Column) -> Column:
    """Number of emoji code points."""
    return F.regexp_count(c, F.lit(EMOJI)).cast("long")


def normalised(c: Column, keep_lines: bool = False) -> Column:
    """Normalisation of pages' text: control characters, spaces, marks, quotes, bullets and dashes.

    ``keep_lines`` keeps tabs and line ends, which the default deletes with the
    other control characters. Compatibility forms are made plain by
    ``lontar.functions.unicode.nfkc`` beforehand, where needed.
    """
    c = F.regexp_replace(c, CONTROL_BUT_LINES if keep_lines else CONTROL, "")
    c = replaced(c, (r"\r\n?", "\n"), (r"\n{3,}", "\n\n"), (" {2,}", " "), (r"\t{2,}", "\t"), (r"[ \t]+", " "), (r"(?m)[ \t]+$", ""))
    c = replaced(c, (r"\.{2,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?"), (rf"{SPACE}+([.!?,:;])", "$1"), ("[\"'`]", '"'), ('"{2,}', '"'))
    c = replaced(c, ("[•·▪▫‣⁃]", "•"), ("[—–]", "—"), ("…", "..."))
    return strip(units_joined(c))


def units_joined(c: Column) -> Column:
    """``5 kg`` becomes ``5kg``."""
    return F.regexp_replace(c, r"(\d+) +(cm|mm|km|m|ft|in|lb|kg|oz|g)\b", "$1$2")


def units_replaced(c: Column) -> Column:
    """The literal form of the same: each ``5 kg`` found is joined wherever its characters stand, within longer words too."""
    unit = r"(\d+)\s*(cm|mm|km|m|ft|in|lb|kg|oz|g)\b"
    found = F.arrays_zip(F.regexp_extract_all(c, F.lit(unit), 1).alias("n"), F.regexp_extract_all(c, F.lit(unit), 2).alias("u"))
    return F.aggregate(found, c, lambda t, m: F.replace(t, F.concat(m["n"], F.lit(" "), m["u"]), F.concat(m["n"], m["u"])))


def change_counts(c: Column, keep_lines: bool = False) -> Column:
    """Map of what ``normalised`` changes, by kind; marks may count below zero, as ``..`` grows. Line ends are only there to be counted with ``keep_lines``."""
    control = CONTROL_BUT_LINES if keep_lines else CONTROL
    ended = replaced(F.regexp_replace(c, control, ""), (r"\r\n?", "\n"))
    plain = F.regexp_replace(ended, r"\n{3,}", "\n\n")
    spaced = replaced(plain, (r"[ \t]+", " "), (r"(?m)[ \t]+$", ""))
    marks = replaced(spaced, (r"\.{2,}", "..."), ("!{2,}", "!"), (r"\?{2,}", "?"))
    count = lambda x, p: F.regexp_count(x, F.lit(p))
    fixed = F.regexp_replace(marks, fast(rf"{SPACE}+([.!?,:;])"), "$1")
    return F.create_map(
        F.lit("spaces_normalized"), count(plain, " ") - count(spaced, " "), F.lit("linebreaks_normalized"), count(ended, "\n") - count(plain, "\n"), F.lit("punctuation_normalized"), count(spaced, r"[.!?]") - count(marks, r"[.!?]"),
        F.lit("quotes_normalized"), count(fixed, "[\"'`]"), F.lit("special_chars_normalized"), count(fixed, "[•·▪▫‣⁃]") + count(fixed, "[—–]") + count(fixed, "…"),
        F.lit("control_chars_removed"), count(c, control), F.lit("units_normalized"), count(fixed, r"\d+ *° *[CF]") + count(fixed, r"\d+ *(?:cm|mm|km|m|ft|in|lb|kg|oz|g)\b"),
    )


def words(c: Column) -> Column:
    """Number of words: runs of letters, digits and ``_``."""
    return F.regexp_count(c, F.lit(LETTER + "+")).cast("long")


def pieces(c: Column) -> Column:
    """Number of white-space separated pieces."""
    return F.regexp_count(c, F.lit(fast(f"[^{_SPACES}]+"))).cast("long")


def sentence_ends(c: Column) -> Column:
    """Sentence marks followed by white space and a capital."""
    return F.regexp_count(c, F.lit(fast(rf"[.!?]+{SPACE}+[A-Z]"))).cast("long")


def language(c: Column) -> Column:
    """``en`` if there is a Latin letter, else ``und``: the rule where no language model is installed."""
    return F.when(c.rlike("[A-Za-z]"), "en").otherwise("und")
