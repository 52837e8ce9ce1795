"""Keys, ranking and the harvest against plain Python."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from paperloom.operators import keys, rank, report
from paperloom.plans import jobs
from paperloom.session import scratch_path
from test_load import articles, row


def keyword_lists(spark, lists):
    return spark.createDataFrame(list(lists.items()), "article_id long, keywords array<string>")


def test_explode_and_rebuild(spark):
    lists = {1: ["b", "a", "b"], 2: [f"k{i}" for i in range(25)], 3: [], 4: None}
    exploded = keys.explode_keywords(keyword_lists(spark, lists))
    assert exploded.count() == 28
    rebuilt = {r.article_id: r.keywords for r in keys.rebuild_keywords(exploded, chunk=100).collect()}
    assert rebuilt == {1: lists[1], 2: lists[2]}
    parts = keys.rebuild_keywords(exploded, chunk=10).filter("article_id = 2").orderBy("part").collect()
    assert [len(p.keywords) for p in parts] == [10, 10, 5]
    assert [k for p in parts for k in p.keywords] == lists[2]


def test_dense_ids_with_one_large_article(spark):
    lists = {n: [f"k{i}" for i in range(3000 if n == 5 else n % 4)] for n in range(1, 2000)}
    numbered = keys.keyword_table(keyword_lists(spark, lists).repartition(7)).orderBy("id").collect()
    expected = [(n, k) for n in sorted(lists) for k in lists[n]]
    assert [(r.article_id, r.keyword) for r in numbered] == expected
    assert [r.id for r in numbered] == list(range(1, len(expected) + 1))


def test_orphans_and_key_violations(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (9,), (None,)], "article_id long")
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id long")
    assert [tuple(r) for r in keys.orphan_keys(child, "article_id", parent, "id").collect()] == [(9, 2)]
    found = sorted((tuple(r) for r in keys.key_violations(parent, "id").collect()), key=str)
    assert found == [(2, 2), (None, 1)]


def test_normalise_is_sound(spark):
    pair = jobs.normalise(articles(spark, row(1), row(1, "S"), row(2)), scratch_path(spark, "pair"))
    assert all(v.count() == 0 for v in jobs.check_pair(*pair).values())
    expected = [(1, 1, "k 1"), (2, 1, "k2"), (3, 2, "k 1"), (4, 2, "k2")]
    assert [tuple(r) for r in pair[1].orderBy("id").collect()] == expected


@pytest.mark.parametrize("serial", [False, True])
def test_pair_filled_twice(spark, serial):
    database = f"pair_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'db')}'")
    try:
        jobs.create_pair(spark, database)
        for batch in ([row(70), row(5)], [row(5), row(8, "new"), row(70)], [row(0), row(None)]):
            jobs.extend_pair(articles(spark, *batch), database, scratch_path(spark, "pair"), serial)
        assert all(v.count() == 0 for v in jobs.create_pair(spark, database).values())
        held = sorted(r.id for r in spark.table(f"{database}.Article").collect())
        # The table's own numbers leave nothing but the text to tell articles apart: 5 and 70 come
        # in one batch, later only the new title is unknown.
        assert held == ([1, 2, 3] if serial else [5, 8, 70])
        words = sorted(r.id for r in spark.table(f"{database}.ArticleKeywords").collect())
        assert words == list(range(1, 2 * len(held) + 1))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_normalise_with_serial_ids(spark):
    pair = jobs.normalise(articles(spark, row(70), row(5), row(70, "S")), scratch_path(spark, "pair"), serial=True)
    assert sorted(r.id for r in pair[0].collect()) == [1, 2]
    assert [(r.id, r.article_id) for r in pair[1].orderBy("id").collect()] == [(1, 1), (2, 1), (3, 2), (4, 2)]


def listing(spark, rows):
    return spark.createDataFrame(rows, "id long, year int, citations double, has_keywords boolean").repartition(5)


def order():
    return [F.desc("citations"), F.col("id")]


def python_harvest(rows, cap):
    kept = []
    for year in sorted({r[1] for r in rows}):
        ranked = sorted((r for r in rows if r[1] == year), key=lambda r: (-r[2], r[0]))
        for hit in ranked:
            if hit[3]:
                kept.append(hit)
            if len(kept) >= cap:
                break
    return sorted(kept)


@pytest.mark.parametrize(("seed", "early", "cap"), [(1, 4, 11), (2, 30, 11), (3, 2, 3), (4, 0, 11), (5, 3, 10_000)])
def test_harvest_equals_the_loop(spark, seed, early, cap):
    rng = random.Random(seed)
    rows = []
    for year in range(2018, 2024):
        for _ in range(early if year < 2020 else 30):
            rows.append((len(rows), year, float(rng.randint(0, 9)), rng.random() < 0.5))
    got = rank.harvested(listing(spark, rows), order(), cap)
    assert sorted(tuple(r) for r in got.select("id", "year", "citations", "has_keywords").collect()) == python_harvest(
        rows, cap
    )


def test_harvest_keeps_all_without_a_cap(spark):
    rows = [(i, 2020 + i % 2, float(i), i % 3 == 0) for i in range(9000)]
    assert rank.harvested(listing(spark, rows), order()).count() == 3000


def test_top_n_with_one_dominant_group(spark):
    rows = [(i, 2020 if i % 3 else 2021 + i % 5, float(i % 50), True) for i in range(5000)]
    for n in (1, 40, 6000):
        got = rank.top_n(listing(spark, rows), n, order(), ("year",)).collect()
        expected = []
        for year in {r[1] for r in rows}:
            ranked = sorted((r for r in rows if r[1] == year), key=lambda r: (-r[2], r[0]))
            expected += [(r[0], i + 1) for i, r in enumerate(ranked[:n])]
        assert sorted((r.id, r.rank) for r in got) == sorted(expected)


def test_ranks_use_no_single_task(spark):
    rows = listing(spark, [(i, 2020, float(i % 7), True) for i in range(3000)])
    frame = rank.ranked(rows, order())
    assert sorted(r["rank"] for r in frame.collect()) == list(range(1, 3001))
    plan = frame.select("rank")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange SinglePartition") <= 1  # one row per partition is summed up


def test_pages(spark):
    rows = [(i, 2020, float(i), True) for i in range(6000)]
    pages = rank.result_pages(listing(spark, rows), order()).orderBy("rank").collect()
    assert len(pages) == 6000 and pages[0].id == 5999 and {r.total_results for r in pages} == {6000}
    assert [(r.page, r.start) for r in pages[24:26]] == [(0, 0), (1, 25)]
    assert pages[-1].page == 239


def test_first_harvest(spark):
    rows = [(i, 2020, float(i), i % 2 == 0) for i in range(60)]
    got = [r.id for r in rank.harvested(listing(spark, rows), order(), cap=11, year=None).collect()]
    assert sorted(got, reverse=True) == list(range(58, 36, -2))


def test_ratings(spark):
    rows = [(1, "t", 2.0), (1, None, 4.0), (2, "t", None), (2, "t", 9.0), (3, "t", None)]
    ratings = spark.createDataFrame(rows, "key int, timestamp string, rating double")
    titles = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "key int, title string")
    got = report.most_rated(report.ratings_per_title(ratings, titles, "key")).collect()
    assert [tuple(r) for r in got] == [("x", 3, 5.0), ("y", 1, None)]


def test_keyword_ids_of_repeated_and_missing_articles(spark):
    """The order is that of article and position, whatever rows an article comes in."""
    rows = [(2, ["a", "b"]), (1, ["c"]), (2, ["d"]), (None, ["e", "f"]), (3, []), (4, None), (5, ["g", "h"])]
    found = keys.keyword_table(spark.createDataFrame(rows, "article_id long, keywords array<string>"), 10).collect()
    by_id = {r.id: (r.article_id, r.keyword) for r in found}
    assert sorted(by_id) == list(range(11, 19))
    assert [by_id[i] for i in (11, 12, 13, 16, 17, 18)] == [(None, "e"), (None, "f"), (1, "c"), (2, "b"), (5, "g"), (5, "h")]
    assert {by_id[14], by_id[15]} == {(2, "a"), (2, "d")}


def test_keywords_are_neither_sorted_nor_written_to_be_numbered(spark):
    rows = spark.range(50).selectExpr("id AS article_id", "array('a', 'b') AS keywords")
    plan = keys.keyword_table(rows)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "keyword" in plan
    assert "ShuffledHashJoin" in plan
