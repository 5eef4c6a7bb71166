"""Books: ids of search pages, plain texts, DOCX files with metadata beside them."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def book_ids(html: Column) -> Column:
    """Ids of ``/ebooks/n`` links, in order, repeated ones kept."""
    return F.regexp_extract_all(html, F.lit(r"/ebooks/(\d+)"), 1)


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``stem, text`` of whole text files."""
    return spark.read.text(path, wholetext=True).select(stem(F.col("_metadata.file_path")).alias("stem"), F.col("value").alias("text"))


def docx_text(content: bytes) -> str | None:
    """Paragraphs of a DOCX file, one per line; None if it is none."""
    from xml.etree import ElementTree

    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    ns = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    lines = ["".join(t.text or "" for t in p.iter(f"{ns}t")) for p in root.iter(f"{ns}p")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def read_docx(spark: SparkSession, path: str) -> DataFrame:
    """``stem, text`` of DOCX files; files that can't be read have a null text."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([docx_text(c) for c in b.column(1).to_pylist()], pa.string())], ["path", "text"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(path).select("path", "content")
    return files.mapInArrow(run, "path string, text string").select(stem(F.col("path")).alias("stem"), "text")


def with_metadata(books: DataFrame, metadata: DataFrame) -> DataFrame:
    """Books with the metadata of their stem, where there is some; each stem's metadata once."""
    return books.join(metadata.dropDuplicates(["stem"]), "stem", "left")


def missing(ids: DataFrame, existing: DataFrame, key: str = "book_id") -> DataFrame:
    """Ids that have not been downloaded yet."""
    return ids.select(key).distinct().join(existing.select(key).distinct(), key, "left_anti")


def pages(read: Callable[[int], str | None], step: int = 25, most: int | None = None) -> Iterator[tuple[int, str]]:
    """``(start, html)`` of search pages from 1 on, ``step`` further each, until one names no book."""
    start = 1
    while most is None or start <= most:
        html = read(start)
        if not html or not re.search(r"/ebooks/\d+", html):
            return
        yield start, html
        start += step


def download(ids: DataFrame, read: Callable[[str], str | None], folder: str, key: str = "book_id") -> DataFrame:
    """Texts of the ids whose folder (``key=id``) isn't there yet are read and written; returns ``key, text`` of all that are there."""
    import pyarrow as pa

    spark = ids.sparkSession
    schema = f"`{key}` string, text string"

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            own = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([read(i) for i in own], pa.string())], [key, "text"])

    there = spark.read.schema(schema).option("ignoreMissingFiles", True).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], schema)
    wanted = missing(ids.select(F.col(key).cast("string").alias(key)).where(F.col(key).isNotNull()), there, key)
    wanted.mapInArrow(run, schema).where("text IS NOT NULL").write.mode("append").partitionBy(key).parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
