"""Content hashes, document ids, SimHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lontar.functions.text import NO_LETTER_NO_SPACE, SPACE, fast, strip


def hash_form(text: Column) -> Column:
    """Lower case, white space runs made one space, all but word characters and spaces dropped, ends stripped."""
    return strip(F.regexp_replace(F.regexp_replace(F.lower(text), fast(f"{SPACE}+"), " "), fast(NO_LETTER_NO_SPACE), ""))


def content_hash(text: Column) -> Column:
    """SHA-256 of the hash form; '' for an empty text."""
    return F.when(text == "", "").otherwise(F.sha2(hash_form(text), 256))


def document_id(url: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(url, F.lit("#"), F.substring(F.sha2(text, 256), 1, 16)), 256), 1, 16)


def export_id(url: Column, text: Column) -> Column:
    return F.substring(F.sha2(F.concat(url, F.lit("#"), F.sha2(text, 256)), 256), 1, 16)


def article_signature(title: Column, text: Column, url: Column) -> Column:
    """One value for equal stripped title, text and address."""
    s = lambda c: F.coalesce(strip(c), F.lit(""))
    return F.md5(F.to_json(F.struct(s(text).alias("text"), s(title).alias("title"), s(url).alias("url"))))


def simhashes(df: DataFrame, column: str, into: str = "simhash", grams: int = 3) -> DataFrame:
    """``df`` with the 64-bit SimHash of word 1- to ``grams``-grams, as 16 hex digits; '' for texts without words.

    Features are low halves of MD5, repeated ones count; a bit is set if more
    than half of the weight has it. Vectorised per Arrow batch.
    """
    import pyarrow as pa

    keep = df.columns
    place = keep.index(column)

    def run(batches: Iterator) -> Iterator:
        import re
        from hashlib import md5

        import numpy as np

        word, memory = re.compile(r"\w+"), {}

        def feature(x: str) -> int:
            h = memory.get(x)
            if h is None:
                if len(memory) > 500_000:
                    memory.clear()
                h = memory[x] = int.from_bytes(md5(x.encode()).digest()[8:], "big")
            return h

        for b in batches:
            out = []
            for text in b.column(place).to_pylist():
                w = word.findall(text.lower()) if text else []
                f = [feature(" ".join(w[i : i + k])) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]
                if not f:
                    out.append("")
                    continue
                bits = np.unpackbits(np.array(f, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64) * 2 > len(f)
                out.append(np.packbits(bits).tobytes().hex())
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(len(keep))), pa.array(out, pa.string())], [*keep, into])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields) + f", `{into}` string"
    return df.mapInArrow(run, schema)


def simhash_number(hexadecimal: Column) -> Column:
    """16 hex digits as a signed 64-bit number; null for anything else."""
    return F.when(hexadecimal.rlike("^[0-9a-fA-F]{16}$"), F.conv(hexadecimal, 16, -10).cast("long"))
