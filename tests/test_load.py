"""De-duplication, merge, targets, CSV and the load jobs."""

import datetime
import json
import uuid

import pytest
from pyspark.sql import functions as F

from paperloom.functions.articles import ARTICLE_SCHEMA
from paperloom.operators import dedupe, merge
from paperloom.operators.flatten import with_display_names
from paperloom.plans import jobs
from paperloom.plans.schema import create_schema
from paperloom.session import scratch_path
from paperloom.sinks.tables import TablePlace, buckets_for
from paperloom.sinks.targets import JdbcTarget, TableTarget
from paperloom.sinks.writers import land_lines, land_raw, preview, write_csv, write_csv_parts, write_run
from paperloom.sources import files, jdbc
from test_articles import article

DAY = datetime.date(2021, 3, 5)


def row(number, title="T", abstract="x", day=DAY):
    return (number, title, abstract, ["A O'B", "C \"D\""], "fra", day, ["k 1", "k2"])


def articles(spark, *rows):
    return spark.createDataFrame(list(rows), ARTICLE_SCHEMA)


def ids(df):
    return sorted(r.article_id for r in df.select("article_id").collect())


def test_latest_article_survives_any_order(spark):
    rows = [row(1, "old", day=datetime.date(2020, 1, 1)), row(1, "b"), row(1, "a"), row(2), row(1, "none", day=None)]
    for order in (rows, rows[::-1]):
        kept = dedupe.latest_articles(articles(spark, *order)).collect()
        assert sorted((r.article_id, r.title) for r in kept) == [(1, "a"), (2, "T")]


def test_one_row_per_key_is_cut_before_the_shuffle(spark):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = dedupe.first_per_key(frame, ["k"], [F.col("v")])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_rows_with_a_key_of_their_own_stay_where_they_are(spark, monkeypatch):
    """Whether few or many keys are repeated, the rows are those of the plain way."""
    from paperloom.session import stage_table

    batch = articles(spark, row(1, "b"), row(1, "a"), row(2), row(3), row(3), row(None, "x"), row(None, "w"))
    landed = stage_table(batch, "landed")
    found = dedupe.once_per_key(landed, "article_id", dedupe.latest_articles)
    assert plan_of(dedupe.once_per_key(landed.filter("article_id = 2"), "article_id", dedupe.latest_articles)).count("Exchange") == 0
    want = sorted(map(str, dedupe.latest_articles(landed).collect()))
    assert sorted(map(str, found.collect())) == want
    monkeypatch.setattr(dedupe, "KEYS_SENT", 0)
    assert sorted(map(str, dedupe.once_per_key(landed, "article_id", dedupe.latest_articles).collect())) == want


@pytest.mark.parametrize("sent", [0, 1, 100])
def test_fresh_rows_are_the_new_rows(spark, monkeypatch, sent):
    monkeypatch.setattr(dedupe, "KEYS_SENT", sent)
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "d"), (None, "n")], "k int, v string")
    for held in ([], [1], [1, 2], [3, None], [1, 2, 3, 3]):
        target = spark.createDataFrame([(k,) for k in held], "k int")
        want = sorted(r.v for r in merge.new_rows(batch, target, "k").collect())
        assert sorted(r.v for r in merge.fresh_rows(batch, target, "k").collect()) == want


def test_a_load_of_known_size_is_written_once(spark, monkeypatch):
    """Buckets are made before the rows come, for twice what there will be."""
    from paperloom.session import stage_table
    from paperloom.sinks import tables

    landed = stage_table(articles(spark, *[row(i) for i in range(200)]), "landed")
    monkeypatch.setattr(tables, "BUCKET_BYTES", tables.file_bytes(landed) // 4)
    rebuilt, plain = [], tables.BucketTable.rebuild

    def rebuild(self, buckets):
        rebuilt.append(self.read().count())
        plain(self, buckets)

    monkeypatch.setattr(tables.BucketTable, "rebuild", rebuild)
    monkeypatch.setattr(tables.BucketTable, "grow", lambda self: None)
    target = target_at(spark)
    monkeypatch.setattr(tables, "LEAST_BUCKETS", 1)
    target.create(1)
    target.overwrite(landed, tables.file_bytes(landed))
    assert rebuilt == [0] and target.buckets() >= 4
    assert ids(target.read()) == list(range(200))


def test_union_distinct(spark):
    a, b = articles(spark, row(1), row(2)), articles(spark, row(2), row(2, "other"))
    assert ids(merge.union_distinct(a, b)) == [1, 2, 2]


def test_new_rows_with_repeated_and_null_keys(spark):
    batch = spark.createDataFrame([(1, "a"), (3, "b"), (3, "c"), (None, "n")], "k int, v string")
    target = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert sorted(r.v for r in merge.new_rows(batch, target, "k").collect()) == ["b", "c"]
    assert [r.v for r in merge.null_keys(batch, "k").collect()] == ["n"]


def test_new_rows_of_an_empty_batch(spark):
    target = spark.createDataFrame([(1,)], "k int")
    assert merge.new_rows(target.filter("k > 1"), target, "k").count() == 0


def target_at(spark):
    return TableTarget(spark, TablePlace(f"t_{uuid.uuid4().hex}", scratch_path(spark, "t")))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_merge_leaves_the_target_where_it_is(spark):
    target = target_at(spark)
    target.overwrite(articles(spark, *[row(i) for i in range(300)]))
    batch = articles(spark, row(5), row(6), row(900), row(None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = merge.new_rows(batch, target.holding(batch), "article_id")
        assert plan_of(fresh).count("Exchange hashpartitioning") == 1  # the batch
        assert "Bucketed: true" in plan_of(fresh)
        assert ids(fresh) == [900]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_table(spark, monkeypatch):
    from paperloom.sinks import tables

    target = target_at(spark)
    target.overwrite(articles(spark, *[row(i) for i in range(50)]))
    assert target.buckets() == tables.LEAST_BUCKETS
    size = target.size()
    monkeypatch.setattr(tables, "BUCKET_BYTES", size // (2 * tables.LEAST_BUCKETS) + 1)
    target.append(articles(spark, *[row(i) for i in range(50, 60)]))
    assert target.buckets() in (2 * tables.LEAST_BUCKETS, 4 * tables.LEAST_BUCKETS)
    assert ids(target.read()) == list(range(60))
    jobs.merge_load(articles(spark, row(7), row(70)), target)
    assert ids(target.read()) == [*range(60), 70]


def test_number_of_buckets():
    from paperloom.sinks.tables import BUCKET_BYTES, LEAST_BUCKETS

    assert buckets_for(0) == LEAST_BUCKETS
    assert buckets_for(LEAST_BUCKETS * BUCKET_BYTES + 1) == 2 * LEAST_BUCKETS
    assert buckets_for(100 << 40) * BUCKET_BYTES >= 100 << 40


def test_a_rebuild_stopped_between_its_renames_is_finished(spark):
    target = target_at(spark)
    target.overwrite(articles(spark, row(1), row(2)))
    spark.sql(f"ALTER TABLE {target.name} RENAME TO {target.name}_grown")
    assert ids(target.create().read()) == [1, 2]


def test_articles_without_an_id_are_rejected(spark):
    batch = articles(spark, row(1), row(0, "x"), row(0, "y"), row(None, "z"))
    target, rejects = target_at(spark).create(), scratch_path(spark, "rejects")
    for _ in range(2):
        jobs.merge_load(batch, target, rejects)
    assert ids(target.read()) == [1]
    assert sorted(r.title for r in spark.read.parquet(rejects).collect()) == ["x", "x", "y", "y", "z", "z"]


def test_csv_keeps_spaces_and_tells_empty_from_null(spark):
    rows = [row(1, "  T \t", ""), row(2, "", None), row(3, None, " ")]
    path = scratch_path(spark, "csv")
    write_csv(with_display_names(articles(spark, *rows)), path)
    back = files.typed_articles(files.read_csv(spark, path)).orderBy("article_id").collect()
    assert [tuple(r) for r in back] == rows


def test_csv_folder_with_different_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Article Id,Title\n1,a\n")
    (tmp_path / "b.csv").write_text('timestamp_epoch,Article Id,Title\n5,2,"b\nc"\n')
    (tmp_path / "c.csv").write_text("Title,Article Id\nd,3\n")
    rows = files.read_csv(spark, str(tmp_path)).collect()
    assert sorted((r["Article Id"], r["Title"], r["timestamp_epoch"]) for r in rows) == [
        ("1", "a", None), ("2", "b\nc", "5"), ("3", "d", None),
    ]


def test_csv_parts_are_one_file(spark, tmp_path):
    rows = [row(i, f'A "quoted", {i}' if i % 3 else "", "two\nlines" if i % 2 else None) for i in range(60)]
    frame = with_display_names(articles(spark, *rows).repartition(3))
    manifest = [r.asDict() for r in write_csv_parts(frame, str(tmp_path / "out"), rows_per_file=7).collect()]
    manifest.sort(key=lambda r: r["position"])
    assert [r["position"] for r in manifest] == list(range(len(manifest))) and len(manifest) > 6
    whole = b""
    for part in manifest:
        content = open(part["path"].removeprefix("file:"), "rb").read()
        assert (part["offset"], part["bytes"]) == (len(whole), len(content))
        whole += content
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "all.csv").write_bytes(whole)
    for back in (files.read_csv(spark, str(tmp_path / "one")), files.read_csv_parts(spark, str(tmp_path / "out"))):
        assert sorted(tuple(r) for r in files.typed_articles(back).collect()) == rows


def test_append_doubles_and_merge_does_not(spark):
    batch = articles(spark, row(1), row(1, "copy"), row(2))
    appended = target_at(spark).create()
    jobs.append_load(batch, appended)
    jobs.append_load(batch, appended)
    assert ids(appended.read()) == [1, 1, 2, 2]
    merged = target_at(spark).create()
    jobs.merge_load(batch, merged)
    jobs.merge_load(batch, merged)
    assert ids(merged.read()) == [1, 2]


@pytest.mark.parametrize(("merged", "expected"), [(True, [1, 2, 3]), (False, [1, 2, 2, 2, 3, 3])])
def test_repeat_load(spark, merged, expected):
    target = target_at(spark)
    loaded = jobs.repeat_load(
        articles(spark, row(1), row(2)), articles(spark, row(2), row(3)), target, merge=merged
    )
    assert ids(loaded) == expected


def test_csv_with_quotes_commas_and_line_breaks(spark):
    rows = [row(1, 'A "quoted", title', "two\nlines, here"), (2, "t", None, [], "", None, None)]
    path = scratch_path(spark, "csv")
    write_csv(with_display_names(articles(spark, *rows)), path)
    back = files.typed_articles(files.read_csv(spark, path)).orderBy("article_id").collect()
    assert tuple(back[0]) == rows[0]
    assert tuple(back[1]) == rows[1]


def test_csv_written_by_pandas(spark, tmp_path):
    import pandas as pd

    frame = pd.DataFrame(
        [
            {"Article Id": 85000000001, "Title": 'A "quoted", title', "Abstract": "two\nlines",
             "Author name": ["Sean O'Brien", "X Y"], "Country": "", "Publish Date": "2021-03-05",
             "Keywords": ["a\xa0b", "c"], "timestamp_epoch": 5},
        ]
    )
    frame.to_csv(tmp_path / "scrap.csv", index=False, encoding="utf-8")
    read = files.drop_surplus(files.read_csv(spark, str(tmp_path / "scrap.csv")))
    assert "timestamp_epoch" not in read.columns
    assert tuple(files.typed_articles(read).first()) == (
        85000000001, 'A "quoted", title', "two\nlines", ["Sean O'Brien", "X Y"], "", DAY, ["a\xa0b", "c"],
    )
    assert files.unreadable_lists(read).count() == 0


def test_csv_id_that_is_no_number_fails(spark):
    frame = with_display_names(articles(spark, row(1))).withColumn("Article Id", F.lit("x"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        files.typed_articles(frame.withColumn("Keywords", F.lit("[]")).withColumn("Author name", F.lit("[]"))).collect()


def test_csv_files_are_bounded(spark, tmp_path):
    write_csv(spark.range(0, 100, 1, 2), str(tmp_path / "out"), rows_per_file=10)
    assert len(list((tmp_path / "out").glob("*.csv"))) == 10


def test_bulk_init_replaces_and_exports(spark, tmp_path):
    source = scratch_path(spark, "csv")
    write_csv(with_display_names(articles(spark, row(1), row(2))), source)
    target = target_at(spark)
    target.overwrite(articles(spark, row(9)))
    assert ids(jobs.bulk_init(spark, source, target, str(tmp_path / "export"))) == [1, 2]
    assert ids(files.typed_articles(files.read_csv(spark, str(tmp_path / "export")))) == [1, 2]


def test_run_folders_replace_only_themselves(spark, tmp_path):
    path = str(tmp_path / "runs")
    write_run(articles(spark, row(1)), path, "a")
    write_run(articles(spark, row(2)), path, "b")
    write_run(articles(spark, row(3)), path, "a")
    assert ids(spark.read.parquet(path)) == [2, 3]


def test_json_files_one_per_article_and_lines(spark, tmp_path):
    folder = tmp_path / "json" / "sub"
    folder.mkdir(parents=True)
    for n in range(3):
        (folder / f"{n}.json").write_text(json.dumps(article(), indent=1))
    whole = jobs.flatten_json(spark, str(tmp_path / "json"), str(tmp_path / "csv"))
    assert ids(whole) == [85_000_000_007] * 3
    assert ids(files.typed_articles(files.read_csv(spark, str(tmp_path / "csv")))) == [85_000_000_007] * 3
    raw = files.read_article_files(spark, str(tmp_path / "json"))
    land_lines(raw, str(tmp_path / "lines"))
    assert ids(jobs.flatten_json(spark, str(tmp_path / "lines"), one_per_file=False)) == [85_000_000_007] * 3


def test_raw_landing_prunes_years(spark, tmp_path):
    frame = spark.createDataFrame([(2020, "a"), (2021, "b")], "year int, raw string")
    land_raw(frame, str(tmp_path / "bronze"))
    one = spark.read.parquet(str(tmp_path / "bronze")).filter("year = 2021")
    assert [r.raw for r in one.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(year" in one._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x:y", "public.all", {"user": "u"})
    assert options == {"url": "jdbc:x:y", "dbtable": "public.all", "user": "u"}
    assert jdbc.range_options("article_id", 5, 99, 8) == {
        "partitionColumn": "article_id", "lowerBound": "5", "upperBound": "99", "numPartitions": "8",
    }
    target = JdbcTarget(None, "jdbc:x:y", "t", {"user": "u"}, partitions=4, batch_size=10)
    assert target.write_options()["numPartitions"] == "4" and target.write_options()["batchsize"] == "10"


def test_balanced_ranges(spark):
    keys = spark.range(1000).selectExpr("CASE WHEN id < 900 THEN id ELSE id * 1000000 END AS k")
    cuts = jdbc.balanced_cuts(keys, "k", 4)
    predicates = jdbc.range_predicates("k", cuts)
    sizes = [keys.filter(p).count() for p in predicates]
    assert sum(sizes) == 1000 and max(sizes) < 300 and len(sizes) == 4
    assert keys.selectExpr("CAST(NULL AS BIGINT) AS k").filter(predicates[0]).count() == 1000
    assert jdbc.range_predicates("k", jdbc.balanced_cuts(keys.limit(0), "k", 4)) == ["1 = 1"]
    assert jdbc.range_predicates("k", jdbc.balanced_cuts(keys, "k", 1)) == ["1 = 1"]


def pair_of(spark, name):
    article, keywords = (sorted(map(tuple, spark.table(f"{name}.{t}").collect())) for t in ("Article", "ArticleKeywords"))
    return article, keywords


@pytest.mark.parametrize("serial", [False, True])
@pytest.mark.parametrize("stop", ["prepared", "Article", "part of ArticleKeywords", "all but the mark"])
def test_a_load_stopped_anywhere_is_finished(spark, tmp_path, serial, stop):
    older, batch = articles(spark, row(1), row(2, "U")), articles(spark, row(2, "U"), row(3, "V"))
    found = []
    for stopped in (False, True):
        name = f"db_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
        jobs.create_pair(spark, name)
        path = f"{tmp_path}/{name}-loads"
        if stopped:
            _, place = jobs.prepare_load(older, name, path, serial)
            read = {t: spark.read.parquet(f"{place}/{t}") for t in ("Article", "ArticleKeywords")}
            if stop != "prepared":
                jobs.insert_rows(spark, name, "Article", read["Article"])
            if stop == "part of ArticleKeywords":
                jobs.insert_rows(spark, name, "ArticleKeywords", read["ArticleKeywords"].filter("id = 2"))
            if stop == "all but the mark":
                jobs.insert_rows(spark, name, "ArticleKeywords", read["ArticleKeywords"])
            assert len(jobs.unfinished_loads(spark, name)) == 1
        else:
            jobs.extend_pair(older, name, path, serial)
        for _ in range(2):
            jobs.extend_pair(batch, name, path, serial)
        assert jobs.unfinished_loads(spark, name) == []
        found.append(pair_of(spark, name))
        spark.sql(f"DROP DATABASE {name} CASCADE")
    assert found[0] == found[1] and len(found[0][0]) == 3 and len(found[0][1]) == 6


def test_schema_and_constraints(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    try:
        article_name, keyword_name = create_schema(spark, name)
        assert create_schema(spark, name) == [article_name, keyword_name]
        assert dict(spark.table(article_name).dtypes) == {
            "id": "bigint", "title": "string", "abstract": "string", "publishdate": "date",
        }
        spark.sql(f"INSERT INTO {article_name} VALUES (1, 't', 'a', DATE '2021-01-01')")
        spark.sql(f"INSERT INTO {keyword_name} VALUES (1, 1, 'k'), (2, 7, 'k'), (2, NULL, 'k')")
        checks = {k: [tuple(r) for r in v.collect()] for k, v in jobs.create_pair(spark, name).items()}
        assert checks == {"article_key": [], "keyword_key": [(2, 2)], "article_reference": [(7, 1)]}
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_preview(spark, capsys):
    preview(articles(spark, row(1)))
    assert "article_id" in capsys.readouterr().out
