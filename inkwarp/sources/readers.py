"""Sources: paper lists, progress, labels, cached and fetched documents, their pages."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.state import queue_id

MAGIC = b"%PDF"


def read_paper_list(spark: SparkSession, path: str) -> DataFrame:
    """(pos, paper): one id per line, blank lines skipped, order kept. A missing file is an error of the engine's own."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("pos"), queue_id(F.col("value")).alias("paper"))
    return lines.filter(F.col("paper").isNotNull())


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """(paper, fig_count, row): a progress file with header; rows of fewer than two fields skipped, a blank count NULL.

    A count that is no number is an error. row keeps the order of the file, as the last row of
    a paper holds.
    """
    raw = spark.read.option("columnPruning", "false").csv(path, header=True, schema="paper string, c string, _bad string", mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True)
    rows = raw.withColumn("row", F.monotonically_increasing_id())
    ok = rows.filter(F.col("paper").isNotNull() & (F.col("_bad").isNull() | F.contains("_bad", F.lit(","))))
    return ok.select("paper", F.when(F.trim(F.coalesce("c", F.lit(""))) != "", F.trim("c").cast("int")).alias("fig_count"), "row")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(text, label) of a labelled file; rows with either missing are dropped."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return raw.select("text", F.col("label").cast("double").cast("int").alias("label")).dropna()


def read_dataset(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The records of a written data set, one JSON object a line."""
    return spark.read.schema(schema).json(path)


def cached_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, content) of the cached files that are not empty and begin like a document."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).filter((F.col("length") > 0) & (F.substring("content", 1, 4) == F.lit(MAGIC))).select("path", "length", "content")


def fetch(url: str, attempts: int = 3, timeout: float = 30.0, delay: float = 2.0, factor: float = 2.0, get: Callable | None = None, sleep: Callable[[float], None] = time.sleep) -> bytes | None:
    """The document at the URL; None if there is none.

    A missing page and an answer that is no document are final; other failures are tried
    again, each time after a longer wait. After a success it waits politely.
    """

    def plain(u: str) -> tuple[int, bytes]:
        with urllib.request.urlopen(u, timeout=timeout) as r:
            return r.status, r.read()

    wait = delay
    for k in range(attempts):
        try:
            status, body = (get or plain)(url)
        except urllib.error.HTTPError as e:
            status, body = e.code, b""
        except OSError:
            status, body = 0, b""
        if status == 200:
            if not body.startswith(MAGIC):
                return None
            sleep(delay)
            return body
        if status == 404:
            return None
        if k + 1 < attempts:
            sleep(wait)
            wait *= factor
    return None


class PaperSource(DataSource):
    """Documents fetched by id: option ids (comma-separated), url with {}, slices; columns paper, content."""

    @classmethod
    def name(cls) -> str:
        return "papers"

    def schema(self) -> str:
        return "paper string, content binary"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PaperReader(self.options)


class _PaperReader(DataSourceReader):
    def __init__(self, options: dict):
        self.ids = [x.strip() for x in options.get("ids", "").split(",") if x.strip()]
        self.url, self.slices = options.get("url", ""), max(1, int(options.get("slices", "1")))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(self.ids[i :: self.slices]) for i in range(self.slices)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for paper in partition.value:
            yield paper, fetch(self.url.format(paper))


PAGE_SCHEMA = (
    "path string, page_num int, page_width double, page_height double, title string, "
    "blocks array<struct<block_id:int,bbox:struct<x0:double,y0:double,x1:double,y1:double>,text:string>>, "
    "paths array<struct<x0:double,y0:double,x1:double,y1:double>>, images array<struct<bbox:struct<x0:double,y0:double,x1:double,y1:double>,image_bytes:binary>>"
)


def parse_pages(documents: DataFrame, parser: Callable[[bytes], Iterator[dict]]) -> DataFrame:
    """The pages of documents (path, content) by a parser that yields a dict of PAGE_SCHEMA's fields for each page.

    The engine ships no parser of its own. A document that the parser can't open gives no page.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in ("path", "page_num", "page_width", "page_height", "title", "blocks", "paths", "images")]
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                try:
                    rows += [{**dict.fromkeys(names), "path": path, **page} for page in parser(bytes(content))]
                except Exception:  # noqa: BLE001 - a broken document must not end the job
                    continue
            yield pd.DataFrame(rows, columns=names)

    return documents.select("path", "content").mapInPandas(run, PAGE_SCHEMA)


def render(figures: DataFrame, renderer: Callable[[str, int, tuple, float], bytes | None], zoom: float = 2.0) -> DataFrame:
    """figures (path, page_num, box, ...) with image_bytes; NULL where rendering failed, to be dropped by enough_bytes."""

    @F.pandas_udf("binary")
    def draw(path: pd.Series, page: pd.Series, box: pd.DataFrame) -> pd.Series:
        def one(p, n, b):
            try:
                return renderer(p, int(n), tuple(b), zoom)
            except Exception:  # noqa: BLE001
                return None

        return pd.Series([one(p, n, b) for p, n, b in zip(path, page, box[["x0", "y0", "x1", "y1"]].to_numpy(), strict=True)])

    return figures.withColumn("image_bytes", draw.asNondeterministic()("path", "page_num", "box"))
