"""A Spark data source for services that answer one request per reporting period.

    spark.dataSource.register(PeriodService)
    spark.read.format("period_service").schema(REGISTRY)
         .option("url", "https://host/list(AnoMes=@AnoMes)?@AnoMes={period}&$format=text/csv&$select={columns}")
         .option("periods", "201903,201906").load()

Options: ``url`` template with ``{period}``, ``{columns}`` and, for paged services, ``{page}``;
``periods`` comma list; ``pages`` pages per period that are asked for in parallel (default 1); ``payload`` ``csv`` or ``json``
(an envelope); ``period_column`` (default ``AnoMes``); ``missing`` ``empty`` takes an absent file or folder for
an empty page (default ``error``); ``timeout`` seconds per request (default 60); ``retries`` (default 3). Each (period,
page) is one partition, so requests run on the executors in parallel. ``pages`` is no limit: the partition of the last
page goes on until a page is empty or absent, and a JSON page's next link is followed. Name only the periods wanted: that is what saves requests. Filters are not taken over
from Spark, because Spark 4.1 keeps a Python source's pushed filters for later uses of the same frame, which would
lose rows there.
"""

from __future__ import annotations

import contextlib
import csv
import io
import itertools
import json
import sys
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import quote, urljoin

from pyspark import cloudpickle
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def _request(uri: str, timeout: float, retries: int):
    """An open answer; a refused or broken request is tried again after a growing pause, a missing page is not."""
    for attempt in range(retries + 1):
        try:
            return urllib.request.urlopen(uri, timeout=timeout)
        except urllib.error.HTTPError as e:
            if e.code < 500 and e.code != 429 or attempt == retries:
                raise
        except OSError:
            if attempt == retries:
                raise
        time.sleep(min(30, 2 ** attempt))


def open_uri(uri: str, missing_is_empty: bool = False, timeout: float = 60, retries: int = 3) -> Iterator:
    """Readable binary streams: one for http(s); for any file system Arrow knows, the file or the folder's files."""
    if uri.startswith(("http://", "https://")):
        try:
            yield _request(uri, timeout, retries)
        except urllib.error.HTTPError as e:
            if e.code != 404 or not missing_is_empty:
                raise
        return
    from pyarrow import fs

    # Arrow knows Spark's s3a scheme as s3
    system, path = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    info = system.get_file_info(path)
    if info.type == fs.FileType.NotFound and missing_is_empty:
        return
    if info.type != fs.FileType.Directory:
        yield system.open_input_stream(path)
        return
    for entry in sorted(system.get_file_info(fs.FileSelector(path)), key=lambda e: e.path):
        if entry.type == fs.FileType.File and not entry.base_name.startswith((".", "_")):
            yield system.open_input_stream(entry.path)


class Request(InputPartition):
    def __init__(self, period: str, page: int):
        self.period = period
        self.page = page


class PeriodService(DataSource):
    @classmethod
    def name(cls) -> str:
        return "period_service"

    def schema(self):
        raise ValueError("declare a schema: .schema(...)")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PeriodReader(schema, dict(self.options))


class PeriodReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.url = options["url"]
        self.periods = [p.strip() for p in options["periods"].split(",") if p.strip()]
        self.pages = int(options.get("pages", 1))
        self.payload = options.get("payload", "csv")
        self.missing_is_empty = options.get("missing", "error") == "empty"
        self.timeout, self.retries = float(options.get("timeout", 60)), int(options.get("retries", 3))
        self.period_column = options.get("period_column", "AnoMes")

    def partitions(self):
        return [Request(p, n) for p in self.periods for n in range(self.pages)]

    def read(self, partition: Request) -> Iterator[tuple]:
        fields = [n for n in self.names if n != self.period_column]
        for page in itertools.count(partition.page):
            uri = self.url.format(period=partition.period, page=page, columns=quote(",".join(fields)))
            told = 0
            # a page beyond the ones asked for may be absent
            for record in self._page(uri, self.missing_is_empty or page >= self.pages):
                # a service that echoes the period keeps its own value
                record.setdefault(self.period_column, partition.period)
                told += 1
                yield tuple(self._text(record.get(n)) for n in self.names)
            if page + 1 < self.pages or not told or "{page}" not in self.url:
                return

    def _page(self, uri: str, missing_is_empty: bool):
        links: list[str] = []
        for stream in open_uri(uri, missing_is_empty, self.timeout, self.retries):
            with contextlib.closing(stream) as raw:
                yield from self._records(raw, links)
        for link in links:
            yield from self._page(urljoin(uri, link), missing_is_empty)

    def _records(self, raw, links: list[str]):
        if self.payload == "json":
            document = json.loads(raw.read())
            yield from document["value"]
            if document.get("@odata.nextLink"):
                links.append(document["@odata.nextLink"])
        else:
            yield from csv.DictReader(io.TextIOWrapper(raw, encoding="utf-8", newline=""))

    @staticmethod
    def _text(value):
        return None if value is None or value == "" else str(value)


# Executors need not have this package installed: what runs there travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
