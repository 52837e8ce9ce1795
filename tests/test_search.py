"""The paged search source, the fetch stage and the harvest jobs, from local files."""

import json

from pyspark.sql import functions as F

from paperloom.plans import jobs
from paperloom.session import scratch_path, ship_package
from paperloom.sources import search
from test_articles import article
from test_load import target_at



def service(hits_by_year, broken=()):
    """Answers page requests from numbers alone, with one search per year."""

    def answer(request):
        year = int(request["query"].rsplit(" ", 1)[1]) if "PUBYEAR" in request["query"] else 0
        if (year, request["start"]) in broken:
            raise OSError("no reply")
        hits = hits_by_year[year]
        wanted = range(request["start"], min(hits, request["start"] + request["count"]))
        entry = [{"prism:url": f"https://api.example.org/{year}/{i}"} for i in wanted]
        return json.dumps({"search-results": {"opensearch:totalResults": str(hits), "entry": entry}})

    return answer


def test_every_hit_of_every_year(spark):
    hits = {2018: 60, 2019: 0, 2020: 25, 2021: 6026}
    pages = search.read_pages(spark, service(hits), "q", list(hits), tasks=4)
    rows = search.listing_from_pages(pages).orderBy("year", "rank").collect()
    assert [(r.year, r.rank) for r in rows] == [(y, i + 1) for y, n in hits.items() for i in range(n)]
    assert all(r.url.endswith(f"/{r.year}/{r.rank - 1}") for r in rows)
    assert {(r.page, r.start) for r in rows if r.year == 2018} == {(0, 0), (1, 25), (2, 50)}


def test_search_without_years_and_failing_pages(spark):
    pages = search.read_pages(spark, service({0: 80}, broken={(0, 25)}), "q", attempts=2, pause=0.01)
    found = {r.start: (r.page is not None, r.error) for r in pages.collect()}
    assert found == {0: (True, None), 25: (False, "OSError: no reply"), 50: (True, None), 75: (True, None)}


def test_requests():
    assert search.search_request("engineering", None, 25) == {"start": 25, "count": 25, "query": "engineering"}
    by_year = search.search_request("engineering", 2020, 0)
    assert by_year["query"] == "engineering AND PUBYEAR = 2020"
    assert by_year["sort"] == "citedby-count"


def test_fetch_each_url_once_and_keep_errors(spark, tmp_path):
    ship_package(spark)
    good = tmp_path / "85000000001"
    good.write_text(json.dumps(article()))
    urls = [good.as_uri(), good.as_uri(), (tmp_path / "85000000002").as_uri()]
    listing = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = search.fetch_articles(listing, attempts=2, pause=0.01).orderBy("url").collect()
    assert [(r.url, r.raw is not None, r.error is None) for r in rows] == [
        (urls[0], True, True),
        (urls[2], False, False),
    ]
    assert "URLError" in rows[1].error


def harvest_inputs(spark):
    rows = []
    for year in (2018, 2019, 2020):
        for i in range(20):
            raw = article(keywords=None if i % 2 else [{"$": "k"}])
            rows.append((f"https://api.example.org/{year}{i:04}", year, 100 - i, json.dumps(raw)))
    frame = spark.createDataFrame(rows, "url string, year int, citations int, raw string")
    details = frame.select("url", "raw")
    return frame.select("url", "year", "citations"), details.unionByName(details), [F.desc("citations"), F.col("url")]


def test_harvest_by_year(spark, tmp_path):
    listing, details, order = harvest_inputs(spark)
    target = target_at(spark).create()
    args = (listing, details, order, target, str(tmp_path / "runs"))
    expected = [20180000 + i for i in range(0, 20, 2)] + [20190000, 20200000]
    for run in ("a", "b"):
        loaded = jobs.harvest(*args, run, str(tmp_path / "csv"), years=[2018, 2019, 2020], cap=11)
        assert sorted(r.article_id for r in loaded.collect()) == expected
    kept, missing = jobs.harvest_articles(listing, details, order, years=[2019])
    assert sorted(r.article_id for r in kept.collect()) == [20190000 + i for i in range(0, 20, 2)]
    assert missing.count() == 0


def test_recent_harvest(spark):
    listing, details, order = harvest_inputs(spark)
    got, _ = jobs.harvest_articles(listing.drop("year"), details, order, cap=11)
    expected = sorted([(i, y) for y in (2018, 2019, 2020) for i in range(0, 20, 2)])[:11]
    assert sorted(r.article_id for r in got.collect()) == sorted(y * 10000 + i for i, y in expected)


def test_missing_articles_keep_their_rank(spark):
    listing, details, order = harvest_inputs(spark)
    lost = details.filter(~F.col("url").isin("https://api.example.org/20190000", "https://api.example.org/20190001"))
    kept, missing = jobs.harvest_articles(listing, lost, order, years=[2018, 2019, 2020], cap=11)
    # The first visit of 2019 finds nothing, and no other article moves up for it.
    expected = [20180000 + i for i in range(0, 20, 2)] + [20190002, 20200000]
    assert sorted(r.article_id for r in kept.collect()) == expected
    assert sorted((r.url[-8:], r.missing) for r in missing.collect()) == [
        ("20190000", "no article"),
        ("20190001", "no article"),
    ]


def test_harvest_fetches_what_it_lists(spark, tmp_path):
    urls = []
    for n in range(1, 5):
        file = tmp_path / f"8500000000{n}"
        urls.append(file.as_uri())
        if n != 3:
            file.write_text(json.dumps(article()))
    listing = spark.createDataFrame([(u, 10 - i) for i, u in enumerate(urls)], "url string, citations int")
    target = target_at(spark).create()
    loaded = jobs.harvest(
        listing,
        lambda wanted: search.fetch_articles(wanted, attempts=1),
        [F.desc("citations"), F.col("url")],
        target,
        str(tmp_path / "runs"),
        "one",
        rejects_path=str(tmp_path / "rejects"),
    )
    assert sorted(r.article_id for r in loaded.collect()) == [85000000001, 85000000002, 85000000004]
    rejected = spark.read.parquet(str(tmp_path / "rejects")).collect()
    assert [r.url for r in rejected] == [urls[2]] and "URLError" in rejected[0].missing
