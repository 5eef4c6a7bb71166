"""Fetching as a table operation: addresses in, fetch results out, by any transport.

The transport is a function ``url -> (status, headers, body)``; none is built
in, so that tests and offline runs need no network. Retries, back-off, content
types and rules of robots files are handled around it.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Types of content that are taken (fixed values).
CONTENT_TYPES = ("text/html", "application/xhtml", "text/plain", "application/xml", "text/xml")
SCHEMA = "url string, success boolean, status_code int, content string, headers map<string,string>, error string, response_time double, final_url string, content_type string, content_length int"


class FetchError(Exception):
    """A failed attempt; ``retry`` says whether another one may help, ``wait`` after how many seconds."""

    def __init__(self, message: str, status: int | None = None, retry: bool = True, wait: float | None = None):
        super().__init__(message)
        self.status, self.retry, self.wait = status, retry, wait


def attempt(transport: Callable, url: str) -> dict:
    began = time.monotonic()
    status, headers, body = transport(url)
    headers = {k.lower(): v for k, v in (headers or {}).items()}
    if status == 429 or status >= 500:
        wait = headers.get("retry-after", "")
        raise FetchError(f"HTTP {status}", status, True, float(wait) if wait.isdigit() else None)
    if status >= 400:
        raise FetchError(f"HTTP {status}", status, False)
    kind = headers.get("content-type", "")
    if not kind.startswith(CONTENT_TYPES):
        raise FetchError(f"content type {kind or 'missing'}", status, False)
    return {"success": True, "status_code": status, "content": body, "headers": headers, "error": None, "response_time": time.monotonic() - began, "final_url": headers.get("location", url), "content_type": kind, "content_length": len(body or "")}


def fetch_one(transport: Callable, url: str, retries: int = 3, base: float = 1.0, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> dict:
    """One result, whatever happens; the wait doubles with each attempt, and up to a second more, or is what the server asks for."""
    for n in range(retries + 1):
        try:
            return attempt(transport, url)
        except FetchError as e:
            last = e
            if not e.retry:
                break
        except (OSError, ValueError) as e:
            last = FetchError(f"{type(e).__name__}: {e}")
        if n < retries:
            sleep(last.wait if last.wait is not None else base * 2**n + jitter())
    return {"success": False, "status_code": last.status, "error": str(last)}


def fetch(urls: DataFrame, transport: Callable, workers: int = 64, retries: int = 3, base: float = 1.0) -> DataFrame:
    """Fetch results of the distinct addresses of ``urls`` (a column ``url``), spread over ``workers`` tasks."""
    import pyarrow as pa

    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rows = [fetch_one(transport, u, retries, base) | {"url": u} for u in b.column(0).to_pylist()]
            types = (pa.string(), pa.bool_(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string(), pa.float64(), pa.string(), pa.string(), pa.int32())
            cols = [pa.array([list(r[n].items()) if n == "headers" and r.get(n) else r.get(n) for r in rows], t) for n, t in zip(names, types)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return urls.select("url").where("url IS NOT NULL").distinct().repartition(workers, "url").mapInArrow(run, SCHEMA)


def allowed(path: Column, disallow: Column, allow: Column) -> Column:
    """Robots rule: the longest matching prefix decides, allowing on a tie; no rule allows."""
    longest = lambda rules: F.coalesce(F.array_max(F.transform(F.filter(rules, lambda r: (r != "") & path.startswith(r)), F.length)), F.lit(-1))
    return longest(allow) >= longest(disallow)


def page_plan(spark, base: str, first: int, last: int) -> DataFrame:
    """``url, page`` of numbered listing pages; ``{page}`` in ``base`` is the number."""
    return spark.range(first, last + 1).select(F.replace(F.lit(base), F.lit("{page}"), F.col("id").cast("string")).alias("url"), F.col("id").alias("page"))


def robots_rules(text: str | None, agent: str = "*") -> tuple[list[str], list[str], float | None]:
    """``disallow, allow, delay`` of a robots file for an agent: those of the groups that name it, else of ``*``; nothing is forbidden without a file."""
    groups: list[tuple[list[str], list[tuple[str, str]]]] = []
    open_ = False
    for line in (text or "").splitlines():
        name, _, value = line.partition("#")[0].partition(":")
        name, value = name.strip().lower(), value.strip()
        if name == "user-agent":
            if not open_:
                groups.append(([], []))
            groups[-1][0].append(value.lower())
            open_ = True
        elif groups and name in ("disallow", "allow", "crawl-delay"):
            groups[-1][1].append((name, value))
            open_ = False
    own = [r for names, rules in groups for r in rules if any(n != "*" and n and n in agent.lower() for n in names)] or [r for names, rules in groups for r in rules if "*" in names]
    delay = next((float(v) for n, v in own if n == "crawl-delay" and v.replace(".", "", 1).isdigit()), None)
    return [v for n, v in own if n == "disallow" and v], [v for n, v in own if n == "allow" and v], delay


def robots_table(files: DataFrame, agent: str = "*") -> DataFrame:
    """``domain, disallow, allow, delay, fetched_at`` of robots files (``domain, content, fetched_at``), the last one of each domain; a null content forbids nothing."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            rules = [robots_rules(t, agent) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r[0] for r in rules], pa.list_(pa.string())), pa.array([r[1] for r in rules], pa.list_(pa.string())), pa.array([r[2] for r in rules], pa.float64()), b.column(1)], ["domain", "disallow", "allow", "delay", "fetched_at"])

    last = files.groupBy("domain").agg(F.max(F.struct(F.col("fetched_at").cast("timestamp").alias("fetched_at"), "content")).alias("f")).select("domain", "f.fetched_at", "f.content")
    return last.mapInArrow(run, "domain string, disallow array<string>, allow array<string>, delay double, fetched_at timestamp")


def permitted(urls: DataFrame, robots: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """``urls`` (a column ``url``) with ``permitted`` and ``stale``: whether the rules of its domain are missing or older than ``hours``, so that the file has to be read again; a domain without rules permits all."""
    from lontar.functions.urls import domain
    from lontar.plans.stage import sized

    rules = sized(robots.select(F.col("domain").alias("_domain"), "disallow", "allow", F.col("fetched_at").alias("_at")))
    path = F.when(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1) == "", "/").otherwise(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(.*)$", 1))
    none = F.array().cast("array<string>")
    joined = urls.join(rules, domain(F.col("url")) == F.col("_domain"), "left")
    ok = allowed(path, F.coalesce("disallow", none), F.coalesce("allow", none))
    return joined.select(*(F.col(c) for c in urls.columns), ok.alias("permitted"), F.coalesce(F.col("_at") < now - F.make_dt_interval(F.lit(0), F.lit(hours)), F.lit(True)).alias("stale"))


def files(spark, path: str, pattern: str = "*") -> DataFrame:
    """``path, name, bytes, checksum, content`` of binary files such as images."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return found.select("path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("checksum"), "content")


def domains(spark, path: str) -> DataFrame:
    """``domain`` of a list of one per line; blank lines and repeated ones are left out."""
    return spark.read.text(path).select(F.trim("value").alias("domain")).where("domain <> ''").distinct()


#: Agents a transport may name in turn (a plain list; bring your own).
AGENTS = ("lontar/1.0", "lontar/1.0 (corpus)", "Mozilla/5.0 (compatible; lontar/1.0)")


def agent_of(url: Column, agents: tuple[str, ...] = AGENTS) -> Column:
    """An agent's name per address: the same one each time."""
    return F.element_at(F.array(*(F.lit(a) for a in agents)), (F.pmod(F.xxhash64(url), F.lit(len(agents))) + 1).cast("int"))
