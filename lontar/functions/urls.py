"""Address functions as Columns."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def url_hash(url: Column) -> Column:
    return F.sha2(url, 256)


def host(url: Column) -> Column:
    """Host with port, as written; '' if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def domain(url: Column) -> Column:
    """Host in lower case without a leading ``www.``; ``unknown`` if there is none."""
    d = F.regexp_replace(F.lower(host(url)), r"^www\.", "")
    return F.when(d == "", "unknown").otherwise(d)


def normal(url: Column) -> Column:
    """Without fragment and with sorted query parameters that have a value; doing it twice changes nothing."""
    plain = F.regexp_replace(url, r"#.*$", "")
    base = F.regexp_extract(plain, r"^([^?]*)", 1)
    kept = F.array_sort(F.filter(F.split(F.regexp_extract(plain, r"\?(.*)$", 1), "&"), lambda p: p.rlike("^[^=]+=.+")))
    return F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def valid(url: Column) -> Column:
    """http or https, and a host."""
    return F.coalesce(url.rlike(r"^https?://[^/?#]+"), F.lit(False))


def article(url: Column, site: str, sections: tuple[str, ...], number: str = r"/d-\d+/") -> Column:
    """Whether an address is an article's: its site, one of the sections, and a numbered part."""
    held = F.lit(False)
    for s in sections:
        held = held | url.contains(s)
    return F.coalesce(url.contains(site) & held & url.rlike(number), F.lit(False))


def absolute_v1(url: Column, base: str) -> Column:
    """Relative paths joined to ``base`` as they are; '' for none."""
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(url.startswith("http"), url).otherwise(F.concat(F.lit(base), url))


def absolute_v2(url: Column, base: str) -> Column:
    """As v1, with the slash added where it lacks."""
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(url.startswith("http"), url).when(url.startswith("/"), F.concat(F.lit(base), url)).otherwise(F.concat(F.lit(base + "/"), url))


def group_v1(url: Column, default: str = "Cooking") -> Column:
    """Discussion group: third part of a relative path, or ``/r/x/`` of an absolute one."""
    relative = F.when(url.startswith("/r/"), F.try_element_at(F.split(url, "/"), F.lit(3)))
    far = F.when(url.contains(".com/r/") | url.contains(".example/r/"), F.nullif(F.regexp_extract(url, r"/r/([^/]+)/", 1), F.lit("")))
    return F.coalesce(relative, far, F.lit(default))


def group_v2(url: Column, default: str = "Cooking") -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(url, r"/r/([^/]+)/", 1), F.lit("")), F.lit(default))


def links(html: Column) -> Column:
    """All ``href`` values of a page, in order, repeated ones kept."""
    return F.regexp_extract_all(html, F.lit(r'<a\s[^>]*href="([^"]*)"'), 1)


def article_links(pages: DataFrame, html: str, base: str, rule: Callable[[Column], Column], keys: list[str]) -> DataFrame:
    """``keys, place, link``: the links of each page that the rule takes, absolute, each once per ``keys``, numbered from 0 as they first come."""
    found = F.transform(links(F.col(html)), lambda x: F.trim(x))
    each = pages.select(*keys, base, F.posexplode(found).alias("place", "_link")).select(*keys, "place", resolved(F.col(base), F.col("_link")).alias("link"))
    return each.where(valid(F.col("link")) & F.coalesce(rule(F.col("link")), F.lit(False))).groupBy(*keys, "link").agg(F.min("place").alias("place")).select(*keys, "place", "link")


@F.pandas_udf(StringType())
def _joined(base: pd.Series, link: pd.Series) -> pd.Series:
    from urllib.parse import urljoin

    return link.combine(base, lambda x, b: None if x is None or b is None else urljoin(b, x))


def resolved(base: Column, link: Column) -> Column:
    """A link as seen from its page. Absolute and root-relative links stay in the JVM."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    simple = F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link).when(link.rlike("^/[^/]|^/$"), F.concat(root, link))
    return F.coalesce(simple, _joined(base, F.when(simple.isNull(), link)))
