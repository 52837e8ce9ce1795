"""The paged search, and the fetch of listed articles.

Requests are made inside tasks: first one page per search tells how many there are, then all
pages are dealt out over the tasks, then the articles. What sends a request is a function
(``Transport``) from its parameters to the page as JSON text. A request that fails is tried
again and in the end leaves its error in the row.
"""

from __future__ import annotations

import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.functions.articles import page_urls, total_results
from paperloom.limits import PAGE_SIZE
from paperloom.session import stage_table
from paperloom.sinks.tables import BucketTable, TablePlace

Transport = Callable[[dict], str]

PAGE_SCHEMA = "year int, start int, page string, error string"
FETCH_SCHEMA = "url string, raw string, error string"


def search_request(query: str, year: int | None, start: int) -> dict:
    """The parameters of one page request. A search within a year asks for the most
    cited first; a search without one takes the order of the service."""
    request = {"start": start, "count": PAGE_SIZE, "query": query}
    if year is not None:
        request["query"] = f"{query} AND PUBYEAR = {year}"
        request["sort"] = "citedby-count"
    return request


def http_transport(base: str, headers: dict[str, str] | None = None) -> Transport:
    """GET ``base`` with the request parameters. Keys are headers of the caller's."""

    def get(request: dict) -> str:
        return get_url(f"{base}?{urllib.parse.urlencode(request)}", headers)

    return get


def get_url(url: str, headers: dict[str, str] | None = None) -> str:
    with urllib.request.urlopen(urllib.request.Request(url, headers=headers or {}), timeout=60) as reply:
        return reply.read().decode("utf-8")


def attempted(call: Callable[[], str], attempts: int, pause: float) -> tuple[str | None, str | None]:
    """(result, None), or (None, error) after the last of ``attempts``."""
    error = None
    for attempt in range(attempts):
        try:
            return call(), None
        except Exception as failure:  # any transport error is data here
            error = f"{type(failure).__name__}: {failure}"
            if attempt + 1 < attempts:
                time.sleep(pause * 2**attempt)
    return None, error


def _request_pages(wanted: DataFrame, transport: Transport, query: str, attempts: int, pause: float) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for year, start in zip(batch["year"], batch["start"]):
                year = None if pd.isna(year) else int(year)
                request = search_request(query, year, int(start))
                rows.append((year, int(start), *attempted(lambda: transport(request), attempts, pause)))
            yield pd.DataFrame(rows, columns=["year", "start", "page", "error"]).astype({"year": "Int32"})

    return wanted.select("year", "start").mapInPandas(run, PAGE_SCHEMA)


def read_pages(
    spark: SparkSession,
    transport: Transport,
    query: str = "",
    years: list[int] | None = None,
    tasks: int | None = None,
    attempts: int = 3,
    pause: float = 1.0,
) -> DataFrame:
    """Every result page of a search (``year``, ``start``, ``page``, ``error``), the years and
    their pages spread over ``tasks``. Land the result before it is read twice."""
    tasks = tasks or spark.sparkContext.defaultParallelism
    searches = spark.createDataFrame([(y, 0) for y in years or [None]], "year int, start int").repartition(tasks)
    first = _request_pages(searches, transport, query, attempts, pause)
    last = F.greatest(F.lit(0), F.coalesce(total_results(F.col("page")), F.lit(0)) - 1)
    starts = F.sequence(F.lit(0), F.floor(last / PAGE_SIZE).cast("int") * PAGE_SIZE, F.lit(PAGE_SIZE))
    every = first.select("year", F.explode(starts).alias("start")).repartition(tasks, "year", "start")
    return _request_pages(every, transport, query, attempts, pause)


def listing_from_pages(pages: DataFrame) -> DataFrame:
    """The listing of pages (``year``, ``start``, ``page``), one row per hit."""
    page = F.col("page")
    hits = pages.select(
        "year", "start", total_results(page).alias("total_results"), F.posexplode(page_urls(page)).alias("_pos", "url")
    )
    rank = F.col("start") + F.col("_pos") + 1
    number = F.floor((rank - 1) / PAGE_SIZE).cast("int")
    return hits.select("year", rank.alias("rank"), number.alias("page"), "start", "total_results", "url")


def paced(urls: Iterable[str], rate: float | None) -> Iterator[str]:
    """The URLs one by one, at most ``rate`` of them in a second."""
    due = time.monotonic()
    for url in urls:
        if rate:
            time.sleep(max(0.0, due - time.monotonic()))
            due = max(due, time.monotonic()) + 1 / rate
        yield url


def fetch_articles(
    listing: DataFrame,
    get: Callable[[str], str] = get_url,
    tasks: int | None = None,
    attempts: int = 3,
    pause: float = 1.0,
    rate: float | None = None,
) -> DataFrame:
    """Request every listed URL once: (url, raw, error).

    URLs are made distinct first and spread over ``tasks``, each of which sends at most ``rate``
    requests in a second; a request that still fails after ``attempts`` leaves its error in the
    row instead of failing the job.
    """

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            urls = paced(batch["url"], rate)
            rows = [(url, *attempted(lambda: get(url), attempts, pause)) for url in urls]
            yield pd.DataFrame(rows, columns=["url", "raw", "error"])

    tasks = tasks or listing.sparkSession.sparkContext.defaultParallelism
    return listing.select("url").distinct().repartition(tasks, "url").mapInPandas(fetch, FETCH_SCHEMA)


# Requests of one task between two entries into the ledger.
URLS_A_TASK = 200


def fetch_open(
    listing: DataFrame, place: TablePlace, get: Callable[[str], str] = get_url, tasks: int | None = None, **how
) -> DataFrame:
    """Request the listed URLs that the ledger at ``place`` has no article of, and return all it has:
    (url, raw, error), one row per URL.

    The ledger is a table in buckets of the URL. Requests go in rounds of ``URLS_A_TASK`` for each
    task, and each round is entered before the next one begins: whatever stops the job, a later call
    asks again for the URLs of one round at most, and for those that failed. ``how`` is passed on
    to ``fetch_articles``.
    """
    spark = listing.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    ledger = BucketTable(spark, place, spark.createDataFrame([], FETCH_SCHEMA).schema, "url").create()
    done = ledger.read().filter(F.col("raw").isNotNull()).select("url")
    open_ = listing.select("url").distinct().join(done, "url", "left_anti")
    rounds = max(1, -(-open_.count() // (URLS_A_TASK * tasks)))
    dealt = stage_table(open_.withColumn("round", F.pmod(F.xxhash64("url"), F.lit(rounds))), "open-urls", "round")
    for number in range(rounds):
        ledger.insert(fetch_articles(dealt.filter(F.col("round") == number), get, tasks, **how))
    ledger.grow()
    return entered(ledger.read())


def entered(ledger: DataFrame) -> DataFrame:
    """One row per URL of a ledger: the article, else the last error by name."""
    best = F.max(F.struct(F.col("raw").isNotNull().alias("found"), "raw", "error"))
    return ledger.groupBy("url").agg(best.alias("best")).select("url", "best.raw", "best.error")
