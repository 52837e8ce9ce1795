"""The paged search as a data source, the page store and the resumable fetch."""

import json
import os
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from paperloom.limits import PAGE_SIZE
from paperloom.operators import keys
from paperloom.operators.pages import HITS_A_CHUNK, PageStore
from paperloom.session import scratch_path
from paperloom.sinks.tables import TablePlace
from paperloom.sources import paged
from paperloom.sources import search
from paperloom.workload import queries


def service(totals, log):
    """A transport over made listings that writes down what it is asked for."""

    def answer(request):
        year = int(request["query"].rsplit("=", 1)[1])
        start, count = request["start"], request["count"]
        (Path(log) / uuid.uuid4().hex).write_text(json.dumps([year, start, count]))
        hits = [{"prism:url": f"u/{year}/{i}"} for i in range(start, min(start + count, totals[year]))]
        return json.dumps({"search-results": {"opensearch:totalResults": str(totals[year]), "entry": hits}})

    return answer


def asked(log):
    return sorted(tuple(json.loads(f.read_text())) for f in Path(log).iterdir())


def source(spark, transport, **options):
    name = f"search_{uuid.uuid4().hex}"
    paged.register(spark, transport, name)
    return name, {"pause": "0", **options}


def test_every_page_is_requested_once_and_years_are_pruned(spark, tmp_path):
    name, options = source(spark, service({2020: 60, 2021: 25, 2022: 0}, tmp_path), years="2020,2021,2022")
    pages = spark.read.format(name).options(**options).load()
    hits = search.listing_from_pages(pages).collect()
    assert sorted(r["url"] for r in hits) == sorted(f"u/{y}/{i}" for y, n in ((2020, 60), (2021, 25)) for i in range(n))
    assert asked(tmp_path) == [(2020, 0, 25), (2020, 25, 25), (2020, 50, 10), (2021, 0, 25), (2022, 0, 25)]


@pytest.mark.parametrize(
    ("condition", "years"),
    [("year = 2021", [2021]), ("year IN (2020, 2022)", [2020, 2022]), ("year > 2020 AND year <= 2021", [2021]), ("year < 2000", [])],
)
def test_a_filter_on_the_year_is_known_before_anything_is_asked(spark, tmp_path, condition, years):
    name, options = source(spark, service({2020: 3, 2021: 30, 2022: 3}, tmp_path), years="2020,2021,2022")
    pages = spark.read.format(name).options(**options).load().filter(condition)
    assert sorted({r["year"] for r in pages.collect()}) == years
    assert sorted({a[0] for a in asked(tmp_path)}) == years
    assert pages.rdd.getNumPartitions() == max(1, sum({2020: 1, 2021: 2, 2022: 1}[y] for y in years))


def test_a_page_that_fails_is_a_row_with_its_error(spark):
    def broken(request):
        if request["start"]:
            raise OSError("gone")
        return json.dumps({"search-results": {"opensearch:totalResults": "30", "entry": [{"prism:url": "u"}] * 25}})

    name, options = source(spark, broken, attempts="2")
    rows = sorted(map(tuple, spark.read.format(name).options(**options).load().select("year", "start", "error").collect()), key=str)
    assert rows == [(None, 0, None), (None, 25, "OSError: gone")]


def test_a_growing_listing_is_taken_once(spark, tmp_path):
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    logs = []
    for run, totals in enumerate(({2020: 30, 2021: 0}, {2020: 30, 2021: 5}, {2020: 85, 2021: 6})):
        logs.append(tmp_path / str(run))
        logs[-1].mkdir()
        name, options = source(spark, service(totals, logs[-1]), years="2020,2021", pagesPerTask="2")
        stream = spark.readStream.format(name).options(**options).load()
        query = stream.writeStream.option("path", landed).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
    hits = [r["url"] for r in search.listing_from_pages(spark.read.parquet(landed)).collect()]
    assert sorted(hits) == sorted(f"u/{y}/{i}" for y, n in ((2020, 85), (2021, 6)) for i in range(n))
    probes = {(2020, 0, 1), (2021, 0, 1)}
    taken = [[a for a in asked(log) if a not in probes] for log in logs]
    assert taken == [[(2020, 0, 25), (2020, 25, 5)], [(2021, 0, 5)], [(2020, 30, 25), (2020, 55, 25), (2020, 80, 5), (2021, 5, 1)]]


def test_landed_pages_can_be_searched_again(spark):
    listing = spark.range(60).selectExpr("id", "2020 AS year", "CAST(id AS DOUBLE) AS citations")
    answer = paged.replay(queries.land_pages(listing))
    page = json.loads(answer({"query": " AND PUBYEAR = 2020", "start": 20, "count": 25}))["search-results"]
    assert page["opensearch:totalResults"] == "60"
    assert [int(h["prism:url"].rsplit("/", 1)[1]) for h in page["entry"]] == list(range(39, 14, -1))


def test_a_page_lies_in_one_folder(spark):
    n = HITS_A_CHUNK + 60
    listing = spark.range(n).selectExpr("id", "2020 AS year", "CAST(id AS DOUBLE) AS citations")
    store = PageStore(spark, scratch_path(spark, "store")).write(listing, [F.desc("citations")])
    page = store.page(2020, HITS_A_CHUNK + PAGE_SIZE)
    assert sorted(r["rank"] for r in page.collect()) == list(range(HITS_A_CHUNK + 26, HITS_A_CHUNK + 51))
    assert {(r["page"], r["start"], r["total_results"]) for r in page.collect()} == {(401, HITS_A_CHUNK + 25, n)}
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(chunk#" in plan
    with pytest.raises(ValueError):
        store.page(2020, 10)


def urls(spark, n):
    return spark.range(n).selectExpr("concat('u/', id) AS url")


def test_a_fetch_that_died_goes_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "URLS_A_TASK", 10)
    place = TablePlace(f"ledger_{uuid.uuid4().hex}", scratch_path(spark, "ledger"))
    log, dead = str(tmp_path), str(tmp_path / "dead")

    def get(url):
        with open(f"{log}/{url.replace('/', '-')}-{uuid.uuid4().hex}", "w"):
            pass
        if url == "u/57" and not os.path.exists(dead):
            open(dead, "w").close()
            os._exit(1)  # the whole worker
        if url == "u/3":
            raise OSError("gone")
        return f"body of {url}"

    listing = urls(spark, 100).unionByName(urls(spark, 50))
    how = {"get": get, "tasks": 2, "attempts": 1, "pause": 0.0}
    with pytest.raises(Exception):
        search.fetch_open(listing, place, **how)
    rows = {r["url"]: r for r in search.fetch_open(listing, place, **how).collect()}
    assert len(rows) == 100 and rows["u/57"]["raw"] == "body of u/57" and rows["u/3"]["error"] == "OSError: gone"
    times = [len([f for f in os.listdir(log) if f.startswith(f"u-{i}-")]) for i in range(100)]
    assert max(times) <= 2 and times.count(2) <= 2 * 2 * 10 + 1
    before = sum(times)
    search.fetch_open(listing, place, **how).collect()
    assert len(os.listdir(log)) - 1 == before + 1  # the one that failed is asked for again


def test_requests_keep_their_pace():
    import time

    begun = time.monotonic()
    assert list(search.paced("abcde", 50.0)) == list("abcde")
    assert time.monotonic() - begun >= 4 / 50


def test_checked_pair(spark):
    articles = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,), (4,)], "id long")
    keywords = spark.createDataFrame([(10, 1), (11, 3), (12, 9), (13, 8), (13, 1), (None, 1)], "id long, article_id long")
    held = spark.createDataFrame([(3,), (9,)], "id long")
    held_keywords = spark.createDataFrame([(11, 3)], "id long, article_id long")
    good, kept, rejects = keys.checked_pair(articles, keywords, held, held_keywords)
    assert [r["id"] for r in good.collect()] == [1]
    assert sorted(r["id"] for r in kept.collect()) == [10, 12]
    assert sorted(((r["item"], r["id"], r["reason"]) for r in rejects.collect()), key=str) == sorted(
        [
            ("Article", 2, "key more than once"), ("Article", 2, "key more than once"), ("Article", 3, "key already there"),
            ("Article", None, "no key"), ("Article", 4, "no keywords"), ("ArticleKeywords", 11, "key already there"),
            ("ArticleKeywords", 13, "key more than once"), ("ArticleKeywords", 13, "key more than once"),
            ("ArticleKeywords", None, "no key"),
        ], key=str,
    )


def test_landed_pages_are_read_in_blocks(tmp_path, monkeypatch):
    """Requests that follow each other read the folder once, and answer as before over block borders."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    path = f"{tmp_path}/landed"
    hits = 2 * paged.BLOCK + 30
    for first in range(0, hits, paged.PAGE_SIZE):
        entry = [{"n": i} for i in range(first, min(first + paged.PAGE_SIZE, hits))]
        page = json.dumps({"search-results": {"opensearch:totalResults": str(hits), "entry": entry}})
        (tmp_path / "landed" / "year=2020").mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table({"start": pa.array([first], pa.int32()), "page": [page]}), f"{path}/year=2020/{first}.parquet")
    opened, plain = [], paged._pages
    monkeypatch.setattr(paged, "_pages", lambda at: opened.append(at) or plain(at))
    ask, found = paged.replay(path), []
    for start in range(0, hits, 10):
        page = json.loads(ask({"query": " AND PUBYEAR = 2020", "start": start, "count": 10}))["search-results"]
        assert page["opensearch:totalResults"] == str(hits)
        found += [hit["n"] for hit in page["entry"]]
    assert found == list(range(hits))
    assert len(opened) == 3
