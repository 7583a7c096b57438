"""Paged scan of a web registry as a Spark data source, and scans of saved pages and of JSON files."""

from __future__ import annotations

import datetime
import http.client
import time
from collections.abc import Callable, Iterator
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from gridlode.functions.schemas import PARSED
from gridlode.sources.files import written
from gridlode.sources.html import last_linked, last_page, page_url, table_records

TIMEOUT, RETRIES, PAUSE = 15.0, 2, 0.25


FAILURES = (OSError, http.client.HTTPException)  # a cut transfer is of the second kind alone


class CollectError(RuntimeError):
    """A page that could not be fetched, with the records of the pages before it."""

    def __init__(self, page: int, cause: str, partial: DataFrame | None) -> None:
        super().__init__(f"page {page}: {cause}")
        self.page, self.partial = page, partial


def fetch(url: str, timeout: float = TIMEOUT, retries: int = RETRIES, get: Callable | None = None) -> str:
    """The page's text; any failure of the request, client errors too, is tried again after a growing pause."""

    def read(address: str) -> str:
        with urlopen(address, timeout=timeout) as answer:
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")

    for attempt in range(retries + 1):
        try:
            return (get or read)(url)
        except FAILURES:
            if attempt == retries:
                raise
            time.sleep(PAUSE * (attempt + 1))
    raise AssertionError


class RegistryPages(DataSource):
    """format("registry_pages"): a row for each page from start_page to end_page; a partition for each page.

    As a stream, each micro-batch has the pages after those of the batches before it,
    up to the last one that the start page links to.
    """

    @classmethod
    def name(cls) -> str:
        return "registry_pages"

    def schema(self) -> str:
        return "source_page int, source_url string, fetched_at timestamp, html string, error string"

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PageStreamReader(self.options)


class _Pages:
    """What both readers do with a page."""

    def __init__(self, options) -> None:
        self.base, self.start = options["base_url"], int(options.get("start_page", 1))
        self.timeout, self.retries = float(options.get("timeout", TIMEOUT)), int(options.get("retries", RETRIES))
        self.lenient = options.get("on_error", "fail") == "row"

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        url, error, html = page_url(self.base, partition.value), None, None
        try:
            html = fetch(url, self.timeout, self.retries)
        except FAILURES as e:
            if not self.lenient:
                raise
            error = str(e) or type(e).__name__
        yield partition.value, url, datetime.datetime.now(datetime.timezone.utc), html, error


class PageReader(_Pages, DataSourceReader):
    def __init__(self, options) -> None:
        super().__init__(options)
        self.end = int(options["end_page"])

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in range(self.start, self.end + 1)]


class PageStreamReader(_Pages, DataSourceStreamReader):
    """Offsets are the last page that is done, so a query that starts again goes on with the next one.

    open_pages: as many of the last pages may still get records; they wait until there are pages after them.
    """

    def __init__(self, options) -> None:
        super().__init__(options)
        self.open = int(options.get("open_pages", 0))

    def initialOffset(self) -> dict:
        return {"page": self.start - 1}

    def latestOffset(self) -> dict:
        """The start page is fetched for its links alone; a registry that gives no answer has no new page."""
        try:
            first = fetch(page_url(self.base, self.start), self.timeout, self.retries)
        except FAILURES:
            if not self.lenient:
                raise
            return self.initialOffset()
        return {"page": max(self.start - 1, last_linked(first, self.start) - self.open)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition(p) for p in range(start["page"] + 1, end["page"] + 1)]


def scan(spark: SparkSession, base_url: str, start_page: int = 1, end_page: int | None = None, on_error: str = "fail") -> DataFrame:
    """Pages of a registry. Without an end, the first page tells the last one; it is fetched once."""
    spark.dataSource.register(RegistryPages)
    read = lambda first, last: spark.read.format("registry_pages").options(base_url=base_url, start_page=first, end_page=last, on_error=on_error).load()
    if end_page is not None:
        return read(start_page, end_page)
    first = spark.createDataFrame(list(PageReader({"base_url": base_url, "start_page": start_page, "end_page": start_page, "on_error": on_error}).read(InputPartition(start_page))), RegistryPages({}).schema())
    last = first.select(last_page(F.coalesce("html", F.lit("")), start_page)).first()[0]
    return first.unionByName(read(start_page + 1, last)) if last > start_page else first


def scan_stream(spark: SparkSession, base_url: str, start_page: int = 1, open_pages: int = 0, on_error: str = "fail") -> DataFrame:
    """Pages of a registry as a stream: what a query has read before, by its checkpoint, it doesn't fetch again."""
    spark.dataSource.register(RegistryPages)
    return spark.readStream.format("registry_pages").options(base_url=base_url, start_page=start_page, open_pages=open_pages, on_error=on_error).load()


def collect_pages(spark: SparkSession, base_url: str, source: str, start_page: int = 1, end_page: int | None = None) -> DataFrame:
    """Records of a registry, in the order of its pages. A page that can't be fetched ends the scan with a CollectError that holds the records before it."""
    pages_ = written(scan(spark, base_url, start_page, end_page, on_error="row"))
    failed = pages_.where("error is not null").select("source_page", "error").orderBy("source_page").first()
    if failed is None:
        return table_records(pages_, source)
    raise CollectError(failed["source_page"], failed["error"], table_records(pages_.where(F.col("source_page") < failed["source_page"]), source))


def saved_pages(spark: SparkSession, path: str, base_url: str = "") -> DataFrame:
    """Pages from files, numbered by the last number in their names."""
    text = spark.read.text(path, wholetext=True).withColumn("_file", F.input_file_name())
    page = F.coalesce(F.regexp_extract("_file", r"(\d+)\D*$", 1).try_cast("int"), F.lit(1))
    return text.select(page.alias("source_page"), F.concat(F.lit(base_url), "_file").alias("source_url"), F.current_timestamp().alias("fetched_at"), F.col("value").alias("html"))


def _first_character(spark: SparkSession, path: str) -> str:
    """The first character of a file, or of a folder's first file, that is no white space."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getFileStatus(at).isDirectory():
        at = min((f.getPath() for f in files.listStatus(at) if f.getPath().getName()[0] not in "_."), key=str)
    opened = files.open(at)
    try:
        while (c := opened.read()) >= 0:
            if chr(c) not in " \t\r\n\ufeff":
                return chr(c)
        return ""
    finally:
        opened.close()


def parsed_json(spark: SparkSession, path: str) -> DataFrame:
    """Parsed records from a JSON array of objects; unknown fields are left out.

    A text that is no list is a ValueError at once, an element that is no object an error where it is read.
    """
    if _first_character(spark, path) != "[":
        raise ValueError("the file must hold a list of objects")
    return spark.read.schema(PARSED).option("multiLine", True).option("mode", "FAILFAST").json(path)
