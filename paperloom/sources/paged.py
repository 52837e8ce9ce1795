"""The paged search as a Python data source: ``spark.read`` for whole listings, ``spark.readStream``
for what is new.

``search_source`` makes the source from a transport. A read has one partition per run of pages, and a
filter on ``year`` leaves out the searches of other years before anything is requested. The
stream's offset is how many hits of each search were taken, so a later run asks for the rest
and no hit is requested twice; ask for an order in which new hits come last.

    spark.dataSource.register(search_source(http_transport(base, headers)))
    spark.read.format("paged_search").options(query="x", years="2022,2023").load().filter("year = 2023")

Options: ``query``; ``years``, separated by commas, or none for one search without a year;
``pagesPerTask`` (1), ``attempts`` (3), ``pause`` in seconds between them (1).
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

from paperloom.limits import PAGE_SIZE
from paperloom.sources.search import PAGE_SCHEMA, Transport, attempted, search_request

Page = tuple[int | None, int, str | None, str | None]

# Spark asks Python sources for their filters only if this is set.
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_TESTS = {
    EqualTo: lambda year, value: year == value,
    In: lambda year, values: year in values,
    GreaterThan: lambda year, value: year > value,
    GreaterThanOrEqual: lambda year, value: year >= value,
    LessThan: lambda year, value: year < value,
    LessThanOrEqual: lambda year, value: year <= value,
}


@dataclass
class PageRun(InputPartition):
    """Hits ``start`` to ``stop`` of one search; ``first`` is the page at ``start`` if it is known."""

    year: int | None
    start: int
    stop: int
    first: Page | None = None


class Search:
    """The requests of one search, shared by both readers."""

    def __init__(self, transport: Transport, options: dict[str, str]):
        self.transport = transport
        self.query = options.get("query", "")
        years = options.get("years", "")
        self.years: list[int | None] = [int(y) for y in years.split(",") if y.strip()] or [None]
        self.pages_per_task = int(options.get("pagesPerTask", "1"))
        self.attempts = int(options.get("attempts", "3"))
        self.pause = float(options.get("pause", "1"))

    def request(self, year: int | None, start: int, count: int = PAGE_SIZE) -> Page:
        asked = search_request(self.query, year, start) | {"count": count}
        return year, start, *attempted(lambda: self.transport(asked), self.attempts, self.pause)

    def runs(self, year: int | None, start: int, stop: int) -> Iterator[PageRun]:
        size = PAGE_SIZE * self.pages_per_task
        for first in range(start, stop, size):
            yield PageRun(year, first, min(stop, first + size))

    def pages(self, run: PageRun) -> Iterator[Page]:
        for start in range(run.start, run.stop, PAGE_SIZE):
            if run.first and start == run.start:
                yield run.first
            else:
                yield self.request(run.year, start, min(PAGE_SIZE, run.stop - start))


def total_hits(page: str | None) -> int:
    found = json.loads(page)["search-results"] if page else {}
    return int(found.get("opensearch:totalResults") or 0)


class PageReader(DataSourceReader):
    """All pages of the searches that a filter on the year leaves."""

    def __init__(self, search: Search):
        self.search = search

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for asked in filters:
            if None in self.search.years or getattr(asked, "attribute", None) != ("year",):
                yield asked
            elif type(asked) in _TESTS:
                test = _TESTS[type(asked)]
                self.search.years = [y for y in self.search.years if test(y, asked.value)]
            elif not isinstance(asked, IsNotNull):
                yield asked

    def partitions(self) -> Sequence[InputPartition]:
        """One request per search tells how many hits there are; its page is not requested again."""
        found: list[InputPartition] = []
        for year in self.search.years:
            first = self.search.request(year, 0)
            runs = list(self.search.runs(year, 0, max(1, total_hits(first[2]))))
            runs[0].first = first
            found += runs
        return found

    def read(self, partition: PageRun | None) -> Iterator[Page]:
        """Spark asks for the partition None where there is none."""
        return self.search.pages(partition) if partition else iter(())


class NewHitsReader(DataSourceStreamReader):
    """The hits that came since the last run. An offset has the number of hits of each search."""

    def __init__(self, search: Search):
        self.search = search

    def initialOffset(self) -> dict:
        return {str(year): 0 for year in self.search.years}

    def latestOffset(self) -> dict:
        """A search that does not answer has no new hits this time."""
        return {str(year): total_hits(self.search.request(year, 0, 1)[2]) for year in self.search.years}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [
            run
            for year in self.search.years
            for run in self.search.runs(year, int(start.get(str(year), 0)), int(end.get(str(year), 0)))
        ]

    def read(self, partition: PageRun) -> Iterator[Page]:
        return self.search.pages(partition)


def search_source(transport: Transport, name: str = "paged_search") -> type[DataSource]:
    """A data source called ``name`` whose requests are sent by ``transport``."""

    class PagedSearch(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return PAGE_SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return PageReader(Search(transport, self.options))

        def streamReader(self, schema) -> DataSourceStreamReader:
            return NewHitsReader(Search(transport, self.options))

    return PagedSearch


def register(spark: SparkSession, transport: Transport, name: str = "paged_search") -> None:
    """Make the source known to the session, and let Spark hand it filters."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(search_source(transport, name))


def replay(path: str) -> Transport:
    """A transport that answers from landed pages (``year=N`` folders of ``start``, ``page``) instead of
    sending requests: a search that was landed once can be read again. The folder must not change."""

    def answer(request: dict) -> str:
        year = int(request["query"].rsplit("=", 1)[1])
        start, stop = request["start"], request["start"] + request["count"]
        blocks = range(max(0, start - PAGE_SIZE + 1) // BLOCK, (stop - 1) // BLOCK + 1)
        rows = [row for block in blocks for row in _block(path, year, block) if start - PAGE_SIZE < row["start"] < stop]
        hits, total = [], "0"
        for row in rows:
            found = json.loads(row["page"])["search-results"]
            total = found["opensearch:totalResults"]
            hits += [hit for rank, hit in enumerate(found["entry"], row["start"]) if start <= rank < stop]
        return json.dumps({"search-results": {"opensearch:totalResults": total, "entry": hits}})

    return answer


# Hits whose pages are read at once; requests that follow each other find them in memory.
BLOCK = 64 * PAGE_SIZE


@lru_cache(maxsize=8)
def _block(path: str, year: int, block: int) -> list[dict]:
    """The landed pages (``start``, ``page``) of one search that begin in a block, in order."""
    start = ds.field("start")
    inside = (ds.field("year") == year) & (start >= block * BLOCK) & (start < (block + 1) * BLOCK)
    found = _pages(path).to_table(columns=["start", "page"], filter=inside, use_threads=False)
    return found.sort_by("start").to_pylist()


@lru_cache(maxsize=16)
def _pages(path: str) -> ds.Dataset:
    store, folder = _located(path)
    return ds.dataset(folder, format="parquet", partitioning="hive", filesystem=store)


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder and its path there."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
