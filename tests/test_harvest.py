"""What a harvest of all hits moves and leaves on the disks, and that its rows stay the same."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from paperloom.operators import dedupe
from paperloom.plans import jobs
from paperloom.session import SHUFFLE_CLEANUP, scratch_path, scratch_root, stage_table
from paperloom.sinks import tables
from paperloom.sources import files
from test_articles import article
from test_load import articles, ids, plan_of, row, target_at

BASE = "https://api.example.org/"


def order():
    return [F.desc("citations"), F.col("url")]


def raw_of(number, **how):
    return (f"{BASE}{number}", json.dumps(article(**how)), None)


def tables_of(spark, listed, details):
    listing = spark.createDataFrame(
        [(url, 2018 + i % 3, i) for i, url in enumerate(listed)], "url string, year int, citations int"
    )
    return listing, spark.createDataFrame(details, "url string, raw string, error string")


@pytest.mark.parametrize("sent", [0, 3, 1000])
def test_every_hit_gets_its_article(spark, monkeypatch, sent):
    """Repeated and NULL URLs, copies, errors, unreadable and unlisted articles, on each way of joining."""
    monkeypatch.setattr(jobs, "KEYS_SENT", sent)
    monkeypatch.setattr(dedupe, "KEYS_SENT", sent)
    listed = [f"{BASE}{n}" for n in (1, 2, 2, 2, 3, 3, 4, 5, 6, 8)] + [None, None]
    details = [raw_of(1), raw_of(1), raw_of(2), (f"{BASE}4", None, "TimeoutError"), (f"{BASE}5", "{", None)]
    details += [raw_of(6, keywords=None), raw_of(7), raw_of(8), (None, json.dumps(article()), None)]
    listing, details = tables_of(spark, listed, details)
    kept, missing = jobs.harvest_articles(listing, details, order())
    assert ids(kept) == [1, 2, 2, 2, 8]
    lost = [("3", "no article")] * 2 + [("4", "TimeoutError"), ("5", "no article")] + [("None", "no article")] * 2
    assert sorted((str(r.url).removeprefix(BASE), r.missing) for r in missing.collect()) == lost
    of_year, _ = jobs.harvest_articles(listing, details, order(), years=[2018])
    want = [int(r.url.rsplit("/", 1)[1]) for r in listing.filter("year = 2018 AND url IS NOT NULL").collect()]
    assert ids(of_year) == sorted(n for n in want if n in (1, 2, 8))


@pytest.mark.parametrize("sent", [0, 3, 1000])
def test_a_listing_of_urls_alone_is_joined_like_any_other(spark, monkeypatch, sent):
    monkeypatch.setattr(jobs, "KEYS_SENT", sent)
    monkeypatch.setattr(dedupe, "KEYS_SENT", sent)
    listed = [f"{BASE}{n}" for n in (1, 2, 2, 3, 4, 5, 9)] + [None]
    listing, details = tables_of(spark, listed, [raw_of(n) for n in (1, 2, 4, 4, 5, 6, 7)] + [(f"{BASE}9", None, "E")])
    alone = jobs.visited_articles(listing.select("url"), details, order())
    wide = jobs.visited_articles(listing, details, order()).select(*alone.columns)
    assert sorted(map(str, alone.collect())) == sorted(map(str, wide.collect()))


def test_articles_stay_in_their_tasks(spark, monkeypatch):
    """More URLs than are sent to the tasks, each listed once: nothing wide is shuffled."""
    monkeypatch.setattr(jobs, "KEYS_SENT", 3)
    monkeypatch.setattr(dedupe, "KEYS_SENT", 3)
    listing, details = tables_of(spark, [f"{BASE}{n}" for n in range(1, 9)], [raw_of(n) for n in range(1, 9)])
    kept, _ = jobs.harvest_articles(listing, details, order())
    assert "Exchange hashpartitioning" not in plan_of(kept)
    assert ids(kept) == list(range(1, 9))


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for name in blocks.mkString(" ").split() if name.startswith("shuffle_")}


def test_a_harvest_leaves_little_on_the_disks(spark, tmp_path, monkeypatch):
    """Compressed files, no copy of the landed articles, no shuffle files."""
    inserts, plain = [], tables.BucketTable.insert
    monkeypatch.setattr(tables.BucketTable, "insert", lambda self, df, *how: inserts.append(self) or plain(self, df, *how))
    monkeypatch.setattr(tables, "TURN_BYTES", 0)
    listing, details = tables_of(spark, [f"{BASE}{n}" for n in range(1, 41)], [raw_of(n) for n in range(1, 41)])
    target, before, setting = target_at(spark).create(), shuffle_blocks(spark), spark.conf.get(SHUFFLE_CLEANUP)
    for run in ("a", "b"):
        loaded = jobs.harvest(listing, details, order(), target, str(tmp_path / "runs"), run, str(tmp_path / "csv"))
    for _ in range(100):  # files go a little later
        if shuffle_blocks(spark) <= before:
            break
        time.sleep(0.1)
    assert shuffle_blocks(spark) <= before and spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert len(inserts) == 2 * tables.TURNS and ids(loaded) == list(range(1, 41))
    assert all(name.endswith(".zstd.parquet") for name in loaded.inputFiles())
    assert len(list((tmp_path / "runs").rglob("part-*.zstd.parquet"))) == len(list((tmp_path / "runs").rglob("part-*")))
    assert list((tmp_path / "csv").glob("part-*.csv.gz"))
    assert ids(files.typed_articles(files.read_csv(spark, str(tmp_path / "csv")))) == list(range(1, 41))


def test_the_landed_articles_are_not_copied(spark, sf_dir):
    root = Path(scratch_root(spark).removeprefix("file:"))
    before = set(root.glob("raw-*"))
    assert entry.queries()["harvest_recent"](spark, sf_dir).count() > 0
    assert set(root.glob("raw-*")) == before


def test_a_turn_that_fails_is_made_up_by_the_next_load(spark, monkeypatch):
    monkeypatch.setattr(tables, "TURN_BYTES", 0)
    batch = stage_table(articles(spark, *[row(i) for i in range(1, 101)], row(5), row(None)), "batch")
    target, left, plain = target_at(spark).create(), [2], tables.BucketTable.insert

    def failing(self, df, *how):
        if left[0] == 0:
            raise OSError("disk")
        left[0] -= 1
        plain(self, df, *how)

    monkeypatch.setattr(tables.BucketTable, "insert", failing)
    with pytest.raises(OSError):
        jobs.merge_load(batch, target, landed=True)
    some = ids(target.read())
    assert 0 < len(some) < 100 and len(set(some)) == len(some)
    monkeypatch.setattr(tables.BucketTable, "insert", plain)
    jobs.merge_load(batch, target, scratch_path(spark, "rejects"), landed=True)
    assert ids(target.read()) == list(range(1, 101))
