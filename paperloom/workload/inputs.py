"""The given tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.articles import ROOT
from paperloom.limits import PAGE_SIZE
from paperloom.operators.rank import ranked
from paperloom.session import scratch_path

# A tail for every text, so that each cleaning rule has something to do in each row.
TAIL = (
    " 30 °C 5 km/s x°F 3 m2/g don't, (it's) @user_x a@b.c"
    " © 2021 x 2021. wait?! 5.5 7. «q» 😀 日本 m²; | \t y"
)
URL_BASE = "https://api.example.org/content/abstract/article/"
ID_BASE = 85_000_000_000
FIRST_DAY = "2018-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", *columns)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "text")
    return docs.select("doc_id", F.concat("text", F.lit(TAIL)).alias("text"))


def article_url(number: Column) -> Column:
    return F.concat(F.lit(URL_BASE), (number + F.lit(ID_BASE)).cast("string"))


def article_year(source: Column) -> Column:
    """Sources ``src0`` to ``src19``, four to a year."""
    return (2018 + F.floor(F.substring_index(source, "src", -1).cast("int") / 4)).cast("int")


def raw_articles(docs: DataFrame, gaps: bool = False) -> DataFrame:
    """Each document as article JSON (``url``, ``raw``, ``year``, ``citations``).

    Every line of the text is a keyword: one line gives a lone object, several a list,
    source ``src0`` none at all. ``gaps`` leaves out the title of Spanish articles and
    the date of German ones.
    """
    lang = F.col("lang")
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("$")))
    nodes = F.when(F.size(lines) == 1, F.to_json(lines[0])).otherwise(F.to_json(lines))
    keywords = F.when(F.col("source") == "src0", F.lit("null")).otherwise(
        F.concat(F.lit('{"author-keyword":'), nodes, F.lit("}"))
    )
    count = F.when(lang == "en", 1).when(lang == "fr", 3).otherwise(2)
    authors = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.struct(
            F.when((i > 0) | (lang != "fr"), F.concat(F.lit("G"), F.col("source"))).alias("ce:given-name"),
            F.concat(F.lit("O'S"), i.cast("string")).alias("ce:surname"),
        ),
    )
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), F.col("n_chars").cast("int"))
    stamp = F.concat(day.cast("string"), F.lit("T23:30:00-05:00"))
    title = F.split("text", "\n")[0]
    number = (F.col("doc_id") + F.lit(ID_BASE)).cast("string")
    ids = F.concat(
        F.array(F.struct(F.lit("PUI").alias("@idtype"), F.lit("1").alias("$"))),
        F.when(lang != "es", F.array(F.struct(F.lit("SCP").alias("@idtype"), number.alias("$")))).otherwise(
            F.array()
        ),
    )
    item = F.struct(
        F.struct(
            F.struct((F.when(lang != "de", stamp) if gaps else stamp).alias("@timestamp")).alias("ait:date-delivered")
        ).alias("ait:process-info"),
        F.struct(
            F.struct(
                F.col("text").alias("abstracts"),
                (F.when(lang != "es", title) if gaps else title).alias("citation-title"),
                F.struct(F.when(lang != "en", F.upper(lang)).alias("@country")).alias("source"),
            ).alias("head"),
            F.struct(F.struct(ids.alias("itemid")).alias("itemidlist")).alias("item-info"),
        ).alias("bibrecord"),
    )
    raw = F.concat(
        F.lit(f'{{"{ROOT}":{{"authkeywords":'),
        keywords,
        F.lit(',"coredata":{"dc:creator":{"author":'),
        F.to_json(authors),
        F.lit('}},"item":'),
        F.to_json(item),
        F.lit("}}"),
    )
    return docs.select(
        article_url(F.col("doc_id")).alias("url"),
        raw.alias("raw"),
        article_year(F.col("source")).alias("year"),
        F.col("n_chars").alias("citations"),
    )


def raw_from_tables(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    return raw_articles(documents(spark, sf_dir, "text", "lang", "source", "n_chars"), gaps)


def keyword_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(article_id, keywords): the lines of each document as its keyword list."""
    docs = documents(spark, sf_dir, "text")
    return docs.select((F.col("doc_id") + F.lit(ID_BASE)).alias("article_id"), F.split("text", "\n").alias("keywords"))


def order_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as search hits: the price as citation count, the priority says whether an
    article has keywords."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.year("o_orderdate").alias("year"),
        F.col("o_totalprice").alias("citations"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("has_keywords"),
    )


def by_citations(id_col: str = "id") -> list[Column]:
    return [F.col("citations").desc(), F.col(id_col)]


def land_pages(listing: DataFrame, order_by: list[Column] | None = None) -> str:
    """Write all hits of the searches of each year as result pages (one JSON row per page, 25
    hits at most) and return the folder."""
    hits = ranked(listing, order_by or by_citations(), ("year",))
    hit = F.struct(
        "rank", F.struct(F.concat(F.lit(URL_BASE), F.col("id").cast("string")).alias("prism:url")).alias("entry")
    )
    start = (F.floor((F.col("rank") - 1) / PAGE_SIZE) * PAGE_SIZE).cast("int")
    pages = hits.groupBy("year", start.alias("start")).agg(F.array_sort(F.collect_list(hit)).alias("hits"))
    pages = pages.join(listing.groupBy("year").agg(F.count(F.lit(1)).alias("total")), "year")
    page = F.to_json(
        F.struct(
            F.struct(
                F.col("total").cast("string").alias("opensearch:totalResults"),
                F.transform("hits", lambda h: h["entry"]).alias("entry"),
            ).alias("search-results")
        )
    )
    path = scratch_path(listing.sparkSession, "pages")
    # Small row groups in order, so that one page can be read without its file.
    rows = pages.select("year", "start", page.alias("page")).repartitionByRange("year", "start")
    rows = rows.sortWithinPartitions("year", "start")
    rows.write.option("parquet.block.size", 1 << 20).partitionBy("year").parquet(path)
    return path
