"""One query per operator over the given tables, whole tables and whole texts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions import articles as A, dates as D, stem as S, text as T
from paperloom.operators import dedupe, flatten as X, keys as K, merge as M, rank as R, report
from paperloom.operators.pages import PageStore
from paperloom.limits import PAGE_SIZE
from paperloom.plans import jobs
from paperloom.plans.schema import TABLES
from paperloom.session import scratch_path, stage_table, tune
from paperloom.sinks.tables import TablePlace
from paperloom.sinks.targets import TableTarget
from paperloom.sinks.writers import land_lines, land_raw, write_csv, write_csv_parts
from paperloom.sources.files import drop_surplus, read_csv, read_csv_parts, typed_articles, unreadable_lists
from paperloom.sources import paged
from paperloom.sources.search import listing_from_pages
from paperloom.streaming import dedupe as state, incremental
from paperloom.workload.inputs import (
    ID_BASE,
    article_url,
    by_citations,
    documents,
    keyword_articles,
    land_pages,
    order_listing,
    raw_from_tables,
    table,
    texts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _text_query(step: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: texts(spark, sf_dir).select("doc_id", step(F.col("text")).alias("text"))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_from_tables(spark, sf_dir)
    return raw.select("url", F.explode(F.array(A.parse_article(F.col("raw")))).alias("article"))


def _readable(articles: DataFrame) -> DataFrame:
    """Lists and dates as text, for comparison across engines."""
    return articles.select(
        "article_id",
        "title",
        "abstract",
        F.array_join("author_names", "; ").alias("author_names"),
        "country",
        F.col("publish_date").cast("string").alias("publish_date"),
        F.array_join("keywords", "; ").alias("keywords"),
    )


def stem_words(spark, sf_dir):
    # Rows hold whole texts, of which Spark's own default of 10,000 makes large batches.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    docs = documents(spark, sf_dir, "text")
    return docs.select("doc_id", S.stem_words(T.clean_text(F.col("text"))).alias("stems"))


# --- extraction -----------------------------------------------------------------


def extract_article(spark, sf_dir):
    return _readable(X.flatten(raw_from_tables(spark, sf_dir)))


def display_record(spark, sf_dir):
    return X.with_display_names(_readable(X.flatten(raw_from_tables(spark, sf_dir))))


def four_fields(spark, sf_dir):
    return X.four_fields(_readable(X.flatten(raw_from_tables(spark, sf_dir))))


def keyword_polymorphic(spark, sf_dir):
    article = F.col("article")
    raw = A.raw_keywords(article)
    return _parsed(spark, sf_dir).filter(A.has_keywords(article)).select(
        A.id_from_url(F.col("url")).alias("article_id"),
        F.size(raw).cast("bigint").alias("n_keywords"),
        F.array_join(raw, "; ").alias("keywords"),
        F.array_join(A.clean_keywords(article), "; ").alias("clean"),
    )


def author_names(spark, sf_dir):
    names = A.author_names(F.col("article"))
    return _parsed(spark, sf_dir).select(
        A.id_from_url(F.col("url")).alias("article_id"), F.array_join(names, "; ").alias("author_names")
    )


def scp_id(spark, sf_dir):
    return _parsed(spark, sf_dir).select("url", A.source_id(F.col("article")).alias("scp_id"))


def url_tail_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(article_url(F.col("doc_id")).alias("url"))
    return docs.select("url", A.id_from_url(F.col("url")).alias("article_id"))


def reject_articles(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("url", F.col("html").alias("raw"))
    raw = raw_from_tables(spark, sf_dir, gaps=True).select("url", "raw").unionByName(pages)
    return X.rejects(raw, "url")


def sequence_name(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", A.sequence_name(F.year("o_orderdate"), F.col("o_orderkey")).alias("name")
    )


def drop_epoch(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return drop_surplus(events.withColumn("timestamp_epoch", F.lit(0)))


def list_literal_parse(spark, sf_dir):
    docs = documents(spark, sf_dir, "text")
    escaped = F.replace(F.replace("text", F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    escaped = F.replace(escaped, F.lit("\t"), F.lit("\\t"))
    literal = F.concat(F.lit("['"), F.replace(escaped, F.lit("\n"), F.lit("', '")), F.lit("']"))
    items = A.parse_list_literal(literal)
    count = F.size(items).cast("bigint")
    return docs.select("doc_id", count.alias("n_items"), F.array_join(items, "; ").alias("items"))


def list_round_trip(spark, sf_dir):
    lists = keyword_articles(spark, sf_dir).select("article_id", A.list_to_text(F.col("keywords")).alias("written"))
    return lists.select("article_id", F.array_join(A.parse_list_literal(F.col("written")), "; ").alias("items"))


def _written_dates(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    written = (
        F.when(F.col("o_orderstatus") == "F", F.date_format(day, "d MMMM yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format(day, "MMMM d, yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    return orders.select("o_orderkey", written.alias("written"))


def parse_dates(spark, sf_dir):
    return _written_dates(spark, sf_dir).select("o_orderkey", D.to_iso_date(F.col("written")).alias("iso_date"))


def check_dates(spark, sf_dir):
    return _written_dates(spark, sf_dir).select("o_orderkey", D.is_long_date(F.col("written")).alias("is_date"))


def publish_dates(spark, sf_dir):
    return _parsed(spark, sf_dir).select("url", A.publish_date(F.col("article")).cast("string").alias("publish_date"))


def epoch_and_double(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp_epoch"),
        F.col("value").cast("string").alias("rating"),
    )
    return events.select(
        "event_id",
        D.epoch_to_timestamp(F.col("timestamp_epoch")).cast("timestamp_ntz").cast("string").alias("timestamp"),
        D.to_double(F.col("rating")).alias("rating"),
    )


# --- de-duplication, merge, targets ----------------------------------------------------


def dedupe_by_id(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    order = [F.desc("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    return dedupe.first_per_key(lines, ["l_orderkey"], order)


def dedupe_any(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    return dedupe.any_per_key(lines, "l_orderkey").select("l_orderkey")


def union_distinct(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return M.union_distinct(docs, table(spark, sf_dir, "benchmark").select("text"))


def merge_new_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    loaded = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
    return M.new_rows(orders, loaded, "o_orderkey")


def read_back(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").alias("a")
    return customers.select("a.*")


def _place(spark, name):
    return TablePlace(f"{name}_{uuid.uuid4().hex}", scratch_path(spark, name))


def _articles(spark, sf_dir):
    return X.flatten(raw_from_tables(spark, sf_dir))


def _csv_folder(spark, sf_dir):
    path = scratch_path(spark, "csv")
    write_csv(X.with_display_names(_articles(spark, sf_dir)), path)
    return path


def csv_round_trip(spark, sf_dir):
    return _readable(typed_articles(read_csv(spark, _csv_folder(spark, sf_dir))))


def csv_odd_fields(spark, sf_dir):
    """Titles with outer spaces, and empty next to missing abstracts, written and read back."""
    odd = _articles(spark, sf_dir).withColumns(
        {
            "title": F.concat(F.lit("  "), "title", F.lit("\t ")),
            "abstract": F.when(F.col("country") == "ES", F.lit("")).when(F.col("country") != "DE", F.col("abstract")),
        }
    )
    path = scratch_path(spark, "csv")
    write_csv(X.with_display_names(odd), path)
    back = typed_articles(read_csv(spark, path))
    return back.select("article_id", "title", "abstract")


def csv_mixed_headers(spark, sf_dir):
    """A folder of exports of which some have the surplus column."""
    articles, path = stage_table(X.with_display_names(_articles(spark, sf_dir)), "articles"), scratch_path(spark, "csv")
    surplus = articles.select(F.lit(5).alias("timestamp_epoch"), "*")
    write_csv(surplus.filter(F.col("Country") == ""), f"{path}/a")
    write_csv(articles.filter(F.col("Country") != ""), f"{path}/b")
    return _readable(typed_articles(drop_surplus(read_csv(spark, f"{path}/*"))))


def csv_parts(spark, sf_dir):
    """One CSV file in parts, read back."""
    path = scratch_path(spark, "csv")
    write_csv_parts(X.with_display_names(_articles(spark, sf_dir)), path)
    return _readable(typed_articles(read_csv_parts(spark, path)))


def csv_unreadable_lists(spark, sf_dir):
    """Exports in which only English articles have their keywords written as a list."""
    docs = documents(spark, sf_dir, "text", "lang")
    keywords = F.when(F.col("lang") == "en", A.list_to_text(F.split("text", "\n"))).otherwise(F.col("text"))
    export = docs.select(
        F.col("doc_id").alias("Article Id"), F.lit("['A B']").alias("Author name"), keywords.alias("Keywords")
    )
    return unreadable_lists(export).select("Article Id")


def bulk_init(spark, sf_dir):
    target = TableTarget(spark, _place(spark, "all"))
    loaded = jobs.bulk_init(spark, _csv_folder(spark, sf_dir), target, scratch_path(spark, "export"))
    return _readable(loaded)


def _older_and_all(spark, sf_dir):
    articles = stage_table(_articles(spark, sf_dir), "batch")
    return articles.filter(F.col("country") == ""), articles


def load_twice_append(spark, sf_dir):
    initial, batch = _older_and_all(spark, sf_dir)
    target = TableTarget(spark, _place(spark, "all"))
    loaded = jobs.repeat_load(initial, batch, target, merge=False)
    return loaded.groupBy("article_id").agg(F.count(F.lit(1)).alias("n_rows"))


def load_twice_merge(spark, sf_dir):
    initial, batch = _older_and_all(spark, sf_dir)
    target = TableTarget(spark, _place(spark, "all"))
    return _readable(jobs.repeat_load(initial, batch, target, merge=True))


def merge_load(spark, sf_dir):
    initial, batch = _older_and_all(spark, sf_dir)
    target = TableTarget(spark, _place(spark, "all"))
    target.overwrite(initial)
    jobs.merge_load(batch, target, landed=True)
    return _readable(target.read())


def merge_null_keys(spark, sf_dir):
    """Articles of which the Spanish ones have no id, merged twice: the rows of the target by
    country, and how often the rejects were listed."""
    articles = _articles(spark, sf_dir)
    batch = articles.withColumn("article_id", F.when(F.col("country") != "ES", F.col("article_id")))
    target, rejects = TableTarget(spark, _place(spark, "all")).create(), scratch_path(spark, "rejects")
    for _ in range(2):
        jobs.merge_load(batch, target, rejects)
    loaded = target.read().groupBy("country").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = spark.read.parquet(rejects).groupBy("country").agg(F.count(F.lit(1)).alias("n_rows"))
    return loaded.unionByName(listed.withColumn("country", F.lit("rejected")))


def json_folder(spark, sf_dir):
    path = scratch_path(spark, "json")
    land_lines(raw_from_tables(spark, sf_dir), path)
    return _readable(jobs.flatten_json(spark, path, one_per_file=False))


def raw_landing(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    land_raw(raw_from_tables(spark, sf_dir).select("url", "year", "raw"), path)
    return spark.read.parquet(path).select(
        "url", F.col("year").cast("bigint").alias("year"), A.abstract(A.parse_article(F.col("raw"))).alias("abstract")
    )


# --- the normalised pair ----------------------------------------------------------------


def explode_keywords(spark, sf_dir):
    exploded = K.explode_keywords(keyword_articles(spark, sf_dir))
    return exploded.select("article_id", F.col("pos").cast("bigint").alias("pos"), "keyword")


def keyword_ids(spark, sf_dir):
    return K.keyword_table(keyword_articles(spark, sf_dir))


def article_keywords(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") + F.lit(85_000_000_000)).alias("article_id"), "lang", "source"
    )
    keywords = K.explode_keywords(keyword_articles(spark, sf_dir))
    joined = K.articles_with_keywords(docs, keywords)
    return joined.select("article_id", F.col("pos").cast("bigint").alias("pos"), "keyword", "lang", "source")


def rebuild_keywords(spark, sf_dir):
    rebuilt = K.rebuild_keywords(K.explode_keywords(keyword_articles(spark, sf_dir)), chunk=10_000)
    return rebuilt.select(
        "article_id", F.col("part").cast("bigint").alias("part"), F.array_join("keywords", "; ").alias("keywords")
    )


def fk_violations(spark, sf_dir):
    parents = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return K.orphan_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", parents, "o_orderkey")


def pk_violations(spark, sf_dir):
    return K.key_violations(table(spark, sf_dir, "lineitem"), "l_orderkey")


def checked_load(spark, sf_dir):
    """An increment to tables that have the English articles, in which some articles come twice, some
    without keywords, and some keywords without their article: what is accepted and what is not."""
    docs = documents(spark, sf_dir, "text", "lang").withColumnRenamed("doc_id", "id")
    lines = docs.select(F.col("id").alias("article_id"), "lang", F.posexplode(F.split("text", "\n")).alias("pos", "keyword"))
    lines = lines.withColumn("id", F.col("article_id") * 1_000_000 + F.col("pos"))
    english = F.col("lang") == "en"
    articles = docs.filter(F.col("id") % 17 != 0)
    articles = articles.unionByName(articles.filter(F.col("id") % 11 == 0)).select("id")
    keywords = lines.filter(F.col("article_id") % 13 != 0).select("id", "article_id", "keyword")
    accepted, kept, rejects = K.checked_pair(articles, keywords, docs.filter(english), lines.filter(english))
    every = [
        rows.select("id", F.lit(f"{item} accepted").alias("outcome"))
        for rows, item in ((accepted, "Article"), (kept, "ArticleKeywords"))
    ]
    every.append(rejects.select("id", F.concat_ws(" ", "item", "reason").alias("outcome")))
    return reduce(DataFrame.unionByName, every)


def _normalised(spark, sf_dir, serial):
    article, keywords = jobs.normalise(_articles(spark, sf_dir), scratch_path(spark, "pair"), serial)
    article = article.withColumnRenamed("id", "article_id")
    joined = keywords.withColumnRenamed("id", "keyword_id").join(article, "article_id")
    return joined.select(
        "keyword_id", "article_id", "keyword", "title", F.col("publishdate").cast("string").alias("publishdate")
    )


def normalise(spark, sf_dir):
    return _normalised(spark, sf_dir, serial=False)


def normalise_serial(spark, sf_dir):
    return _normalised(spark, sf_dir, serial=True)


def _filled(spark, sf_dir, serial, stopped=False):
    """Both tables created and filled by two overlapping batches: their rows and constraint
    violations, and the largest ids. With ``stopped`` the first load ends between the two tables."""
    database = f"paperloom_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'db')}'")
    jobs.create_pair(spark, database)
    articles = stage_table(_articles(spark, sf_dir), "articles")
    older = articles.filter(F.col("country") == "")
    if stopped:
        _, place = jobs.prepare_load(older, database, scratch_path(spark, "pair"), serial, landed=True)
        jobs.insert_rows(spark, database, "Article", spark.read.parquet(f"{place}/Article"))
    else:
        jobs.extend_pair(older, database, scratch_path(spark, "pair"), serial, landed=True)
    jobs.extend_pair(articles, database, scratch_path(spark, "pair"), serial, landed=True)
    checks = jobs.create_pair(spark, database)
    tables = {name: spark.table(f"{database}.{name}") for name in TABLES}
    counts = [
        rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(item).alias("item"), "n_rows")
        for item, rows in (tables | checks).items()
    ]
    last = [
        rows.agg(F.max("id").alias("n_rows")).select(F.lit(f"last {item}").alias("item"), "n_rows")
        for item, rows in tables.items()
    ]
    found = stage_table(reduce(DataFrame.unionByName, counts + last), "counts")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return found


def create_and_fill(spark, sf_dir):
    return _filled(spark, sf_dir, serial=False)


def create_and_fill_serial(spark, sf_dir):
    return _filled(spark, sf_dir, serial=True)


def create_and_resume(spark, sf_dir):
    """A load that stopped after the articles, finished by the next one."""
    return _filled(spark, sf_dir, serial=False, stopped=True)


def create_and_resume_serial(spark, sf_dir):
    return _filled(spark, sf_dir, serial=True, stopped=True)


# --- search and harvest -----------------------------------------------------------------


def listing_join(spark, sf_dir):
    url = "https://api.example.org/content/part/"
    listing = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.concat(F.lit(url), F.col("l_partkey").cast("string")).alias("url")
    )
    details = table(spark, sf_dir, "part").select(
        F.concat(F.lit(url), F.col("p_partkey").cast("string")).alias("url"), F.col("p_name").alias("title")
    )
    joined = listing.join(details, "url")
    return joined.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "url", "title")


def _plain(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in columns], "citations")


def top_by_year(spark, sf_dir):
    return _plain(R.ranked(order_listing(spark, sf_dir), by_citations(), ("year",)), "year", "rank", "id")


def paging(spark, sf_dir):
    pages = R.result_pages(order_listing(spark, sf_dir), by_citations())
    return _plain(pages, "rank", "page", "start", "total_results", "id")


def page_requests(spark, sf_dir):
    """The second page of every year, each out of one folder of the stored listing."""
    listing = order_listing(spark, sf_dir)
    store = PageStore(spark, scratch_path(spark, "store")).write(listing, by_citations())
    pages = [store.page(year, PAGE_SIZE) for year in _order_years(listing)]
    return _plain(reduce(DataFrame.unionByName, pages), "year", "rank", "page", "start", "total_results", "id")


def capped_harvest_repeated(spark, sf_dir):
    """A listing in which every hit comes twice: equal hits are visited and kept one by one."""
    listing = order_listing(spark, sf_dir)
    return _plain(R.harvested(listing.unionByName(listing), by_citations(), cap=11), "year", "id")


def capped_harvest(spark, sf_dir):
    """With the count of the visit that a user asks for."""
    return _plain(R.harvested(order_listing(spark, sf_dir), by_citations(), cap=11), "year", "id")


def full_harvest(spark, sf_dir):
    return _plain(R.harvested(order_listing(spark, sf_dir), by_citations()), "year", "id")


def first_n_harvest(spark, sf_dir):
    return _plain(R.harvested(order_listing(spark, sf_dir), by_citations(), cap=11, year=None), "id")


def landed_listing(spark, sf_dir):
    pages = spark.read.parquet(land_pages(order_listing(spark, sf_dir)))
    found = listing_from_pages(pages)
    columns = ["year", "rank", "page", "start", "total_results"]
    return found.select(*[F.col(c).cast("bigint").alias(c) for c in columns], "url")


def search_pages(spark, sf_dir):
    pages = spark.read.parquet(land_pages(order_listing(spark, sf_dir)))
    page = F.col("page")
    return pages.select(
        F.col("year").cast("bigint").alias("year"),
        F.col("start").cast("bigint").alias("start"),
        A.total_results(page).cast("bigint").alias("total_results"),
        F.array_join(A.page_urls(page), " ").alias("urls"),
    )


def _search(spark, pages: str, years: list[int]):
    """The landed pages as a paged search: format name and options."""
    name = f"search_{uuid.uuid4().hex}"
    paged.register(spark, paged.replay(pages), name)
    return name, {"years": ",".join(map(str, years)), "pagesPerTask": "64"}


def _order_years(listing: DataFrame) -> list[int]:
    """The years of the listing; a handful of numbers."""
    return sorted(row[0] for row in listing.select("year").distinct().collect())


def _listed(pages: DataFrame) -> DataFrame:
    columns = ["year", "rank", "page", "start", "total_results"]
    return listing_from_pages(pages).select(*[F.col(c).cast("bigint").alias(c) for c in columns], "url")


def search_read(spark, sf_dir):
    """All pages of all searches through the data source."""
    listing = order_listing(spark, sf_dir)
    name, options = _search(spark, land_pages(listing), _order_years(listing))
    return _listed(spark.read.format(name).options(**options).load())


def search_read_years(spark, sf_dir):
    """The same source, of which a filter leaves the searches of later years."""
    listing = order_listing(spark, sf_dir)
    years = _order_years(listing)
    name, options = _search(spark, land_pages(listing), years)
    pages = spark.read.format(name).options(**options).load()
    return _listed(pages.filter(F.col("year") > years[len(years) // 2]))


def search_stream(spark, sf_dir):
    """A listing that grows between two runs of one stream; each hit is taken once."""
    listing = order_listing(spark, sf_dir)
    years, half = _order_years(listing), listing.agg(F.max("id") / 2).first()[0]
    landed, checkpoint = scratch_path(spark, "landed"), scratch_path(spark, "checkpoint")
    for found in (listing.filter(F.col("id") <= half), listing):
        name, options = _search(spark, land_pages(found, [F.col("id")]), years)
        stream = spark.readStream.format(name).options(**options).load()
        query = stream.writeStream.option("path", landed).option("checkpointLocation", checkpoint)
        query.trigger(availableNow=True).start().awaitTermination()
    return _listed(spark.read.parquet(landed)).select("year", "rank", "url")


def _harvest(spark, sf_dir, years, details=None, rejects_path=None, cap=None):
    raw = raw_from_tables(spark, sf_dir)
    if details:
        raw = stage_table(raw, "raw")
    order = [F.desc("citations"), F.col("url")]
    target = TableTarget(spark, _place(spark, "all")).create()
    return jobs.harvest(
        raw.select("url", "year", "citations"),
        details(raw) if details else raw.select("url", "raw"),
        order,
        target,
        scratch_path(spark, "runs"),
        "first",
        export_path=scratch_path(spark, "export"),
        years=years,
        cap=cap,
        rejects_path=rejects_path,
    )


def _years(spark, sf_dir):
    """The years of the listing; a handful of numbers."""
    raw = raw_from_tables(spark, sf_dir).select("year").distinct()
    return sorted(row[0] for row in raw.collect())


def harvest_by_year(spark, sf_dir):
    return _readable(_harvest(spark, sf_dir, _years(spark, sf_dir)))


def harvest_by_year_capped(spark, sf_dir):
    return _readable(_harvest(spark, sf_dir, _years(spark, sf_dir), cap=11))


def harvest_recent(spark, sf_dir):
    return _readable(_harvest(spark, sf_dir, None))


def harvest_with_gaps(spark, sf_dir):
    """A harvest whose fetch fails for German articles and finds no French ones: what is kept, and
    what is rejected, by URL."""

    def details(raw):
        lost = F.col("raw").contains('"@country":"DE"')
        none = F.col("raw").contains('"@country":"FR"')
        found = raw.filter(~none).select(
            "url", F.when(~lost, F.col("raw")).alias("raw"), F.when(lost, F.lit("TimeoutError")).alias("error")
        )
        return lambda wanted: found.join(wanted, "url", "left_semi")

    rejects = scratch_path(spark, "rejects")
    kept = _harvest(spark, sf_dir, None, details, rejects)
    missing = spark.read.parquet(rejects).select("url", "missing")
    url = article_url(F.col("article_id") - ID_BASE)
    return kept.select(url.alias("url"), F.lit("kept").alias("outcome")).unionByName(
        missing.withColumnRenamed("missing", "outcome")
    )


# --- report ---------------------------------------------------------------------------


def _per_title(spark, sf_dir):
    ratings = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("key"), F.col("l_shipdate").alias("timestamp"), F.col("l_quantity").alias("rating")
    )
    titles = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_name").alias("title"))
    return report.ratings_per_title(ratings, titles, "key", decimals=6)


def ratings_per_title(spark, sf_dir):
    return _per_title(spark, sf_dir)


def topk_group(spark, sf_dir):
    return report.most_rated(_per_title(spark, sf_dir))


# --- streams --------------------------------------------------------------------------


def _event_files(spark, sf_dir):
    """Events as files in no order of time, some of them in two files: one file per batch."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events")
    again = events.filter(F.pmod("event_id", F.lit(3)) == 0)
    events.unionByName(again).repartition(EVENT_FILES, F.xxhash64("event_id", F.rand(1))).write.parquet(path)
    return incremental.file_stream(spark, path, events.schema, files_per_batch=1)


EVENT_FILES = 6


def stream_incremental(spark, sf_dir):
    """First event of each user, loaded by two runs of the same job."""
    target, checkpoint = _place(spark, "stream"), scratch_path(spark, "checkpoint")
    stream = _event_files(spark, sf_dir)
    for _ in range(2):
        loaded = incremental.load_first(stream, "user_id", ["ts", "event_id"], target, checkpoint)
    return loaded.select("user_id", "event_id", "event_type", "value")


def stream_two_sources(spark, sf_dir):
    """Orders of one status, then all orders from another folder with a checkpoint of its own,
    into one target."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    target = _place(spark, "stream")
    for rows in (orders.filter("o_orderstatus = 'F'"), orders):
        path = scratch_path(spark, "orders")
        rows.repartition(3).write.parquet(path)
        stream = incremental.file_stream(spark, path, orders.schema, files_per_batch=2)
        loaded = incremental.load_new(stream, "o_orderkey", target, scratch_path(spark, "checkpoint"))
    return loaded


def stream_articles(spark, sf_dir):
    """Raw articles arriving year by year, loaded as a stream."""
    path = scratch_path(spark, "bronze")
    land_raw(raw_from_tables(spark, sf_dir).select("url", "raw", "year"), path)
    raw = incremental.file_stream(spark, path, "url string, raw string, year int")
    return _readable(jobs.load_article_stream(raw, _place(spark, "stream"), scratch_path(spark, "checkpoint")))


def stream_dedupe(spark, sf_dir):
    """Events in no order of which some come twice: those in time once, and the late ones."""
    path, checkpoint = scratch_path(spark, "events-once"), scratch_path(spark, "checkpoint")
    once, late = state.dedupe_stream(_event_files(spark, sf_dir), "event_id", "ts", "1 day", path, checkpoint)
    # A late event may be a copy of one in time.
    every = once.unionByName(late).distinct()
    return every.select("event_id", "user_id", "event_type", "value", "props")


# Days of events that come in one file.
DAYS_A_FILE = 5


def stream_late_events(spark, sf_dir):
    """Events in the order of their days, of which some come two files later and some twice: how
    many rows of each came in time or late. The state is kept over a second run."""
    events = table(spark, sf_dir, "events")
    day = F.date_diff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date"))
    file = F.floor(day / DAYS_A_FILE) + F.when(F.col("event_id") % 7 == 0, 2).otherwise(0)
    rows = events.unionByName(events.filter(F.col("event_id") % 3 == 0)).withColumn("file", file)
    arrivals = stage_table(rows, "arrivals", "file")
    files = sorted(row[0] for row in arrivals.select("file").distinct().collect())
    path, out, checkpoint = (scratch_path(spark, n) for n in ("events", "events-once", "checkpoint"))
    for number in files:
        one = arrivals.filter(F.col("file") == number).drop("file").coalesce(1)
        one.write.mode("append").parquet(path)
        if number in (files[len(files) // 2], files[-1]):
            stream = incremental.file_stream(spark, path, events.schema, files_per_batch=1)
            once, late = state.dedupe_stream(stream, "event_id", "ts", "1 day", out, checkpoint)
    both = once.withColumn("outcome", F.lit("row")).unionByName(late.withColumn("outcome", F.lit("late")))
    return both.groupBy("event_id", "outcome").agg(F.count(F.lit(1)).alias("n_rows"))


TEXT_QUERIES: dict[str, Callable[[Column], Column]] = {
    "clean_documents": T.clean_text,
    "clean_documents_no_numbers": lambda c: T.clean_text(c, drop_numbers=True),
    "unit_symbols": T.expand_units,
    "lower_text": T.lower_case,
    "expand_contractions": T.expand_contractions,
    "remove_usernames": T.remove_usernames,
    "isolate_punctuation": T.isolate_punctuation,
    "strip_copyright": T.strip_copyright,
    "remove_numbers": T.remove_numbers,
    "remove_special": T.remove_special,
    "collapse_whitespace": T.collapse_whitespace,
    "remove_emojis": T.remove_emojis,
    "repeated_punctuation": T.collapse_repeats,
}

TABLE_QUERIES: list[Query] = [
    stem_words,
    extract_article,
    display_record,
    four_fields,
    keyword_polymorphic,
    author_names,
    scp_id,
    url_tail_id,
    reject_articles,
    sequence_name,
    drop_epoch,
    list_literal_parse,
    list_round_trip,
    parse_dates,
    check_dates,
    publish_dates,
    epoch_and_double,
    dedupe_by_id,
    dedupe_any,
    union_distinct,
    merge_new_rows,
    read_back,
    csv_round_trip,
    csv_odd_fields,
    csv_unreadable_lists,
    csv_mixed_headers,
    csv_parts,
    bulk_init,
    load_twice_append,
    load_twice_merge,
    merge_load,
    merge_null_keys,
    json_folder,
    raw_landing,
    explode_keywords,
    keyword_ids,
    article_keywords,
    rebuild_keywords,
    fk_violations,
    pk_violations,
    checked_load,
    normalise,
    normalise_serial,
    create_and_fill,
    create_and_fill_serial,
    create_and_resume,
    create_and_resume_serial,
    search_read,
    search_read_years,
    search_stream,
    listing_join,
    top_by_year,
    paging,
    page_requests,
    capped_harvest,
    capped_harvest_repeated,
    full_harvest,
    first_n_harvest,
    landed_listing,
    search_pages,
    harvest_by_year,
    harvest_by_year_capped,
    harvest_recent,
    harvest_with_gaps,
    ratings_per_title,
    topk_group,
    stream_incremental,
    stream_two_sources,
    stream_articles,
    stream_dedupe,
    stream_late_events,
]


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(tune(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    named = {name: _text_query(step) for name, step in TEXT_QUERIES.items()}
    named.update({query.__name__: query for query in TABLE_QUERIES})
    return {name: _tuned(query) for name, query in named.items()}
