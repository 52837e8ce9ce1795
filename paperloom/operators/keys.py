"""The article/keyword pair: explode, keys, integrity checks and the way back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.operators.dedupe import with_keys
from paperloom.operators.rank import offsets, ranked
from paperloom.session import stage_table


def explode_keywords(articles: DataFrame) -> DataFrame:
    """One row per (article, keyword position); an empty or NULL list gives none."""
    return articles.select("article_id", F.posexplode("keywords").alias("pos", "keyword"))


def dense_ids(df: DataFrame, order_by: list[str], id_col: str = "id", after: int = 0) -> DataFrame:
    """Consecutive numbers from ``after + 1`` in ``order_by``, a unique column list.

    Only these columns are sorted and numbered; the other columns join by them afterwards.
    """
    numbered = ranked(df.select(*order_by), [F.col(c) for c in order_by], rank_col=id_col)
    numbered = numbered.withColumn(id_col, F.col(id_col) + F.lit(after))
    return numbered if len(df.columns) == len(order_by) else df.join(numbered, order_by)


def article_table(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.col("article_id").alias("id"), "title", "abstract", F.col("publish_date").alias("publishdate")
    )


def keyword_table(articles: DataFrame, after: int = 0) -> DataFrame:
    """Keywords with consecutive ids after ``after``, in the order of article and position.

    Only the numbers of keywords per article are sorted and summed; an article's keywords follow from
    where its ids begin. Where an article has several rows, their positions are ranked together.
    """
    n = F.greatest(F.coalesce(F.size("keywords"), F.lit(0)), F.lit(0))
    sizes = articles.groupBy("article_id").agg(F.sum(n).cast("long").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    starts = stage_table(offsets(sizes, "article_id", "_n", "_start"), "keyword-starts")
    several = starts.filter(F.col("_rows") > 1)
    starts = starts.toDF("_article", "_n", "_rows", "_start").hint("shuffle_hash")
    same = F.col("article_id").eqNullSafe(F.col("_article"))

    def placed(rows: DataFrame, rank: Column) -> DataFrame:
        return rows.select((F.col("_start") + rank + F.lit(after)).alias("id"), "article_id", "keyword")

    joined = articles.select("article_id", "keywords").join(starts.filter(F.col("_rows") == 1), same)
    keywords = joined.select("article_id", "_start", F.posexplode("keywords").alias("pos", "keyword"))
    found = placed(keywords, F.col("pos") + 1)
    if several.isEmpty():
        return found
    again = explode_keywords(with_keys(articles, "article_id", several.select("article_id"), "left_semi"))
    again = ranked(again, [F.col("pos")], ("article_id",)).join(starts, same)
    return found.unionByName(placed(again, F.col("rank")))


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent row and how many child rows have them;
    empty if the constraint holds. A NULL foreign key is no violation. Child rows are
    counted per value before the join, so it meets each value once."""
    values = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(key).alias(foreign_key)).distinct()
    return values.join(known, foreign_key, "left_anti")


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once or are NULL, with their row count."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.filter((F.col("n_rows") > 1) | F.col(key).isNull())


def new_keys(rows: DataFrame, key: str, held: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with a key of their own, rejects) of an increment: a reject's key is NULL, comes
    more than once in the increment, or is in ``held``. Rejects have ``reason``. Keys are counted
    before they meet the rows, and ``held`` is read where it lies."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = held.select(F.col(key).alias("_known")).distinct()
    judged = counts.join(known, F.col(key) == F.col("_known"), "left")
    reason = (
        F.when(F.col(key).isNull(), "no key")
        .when(F.col("_n") > 1, "key more than once")
        .when(F.col("_known").isNotNull(), "key already there")
    )
    judged = judged.select(F.col(key).alias("_key"), reason.alias("reason"))
    joined = rows.join(judged, rows[key].eqNullSafe(judged["_key"])).drop("_key")
    return joined.filter(F.col("reason").isNull()).drop("reason"), joined.filter(F.col("reason").isNotNull())


def checked_pair(
    articles: DataFrame, keywords: DataFrame, held_articles: DataFrame, held_keywords: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(articles, keywords, rejects) of an increment of the pair, both staged tables: what may be
    inserted, and (item, id, article_id, reason) of what may not. A keyword must name an article that is
    accepted or there already; an article must have a keyword. Only the increment is judged.
    """
    good_articles, bad_articles = new_keys(articles, "id", held_articles)
    good_keywords, bad_keywords = new_keys(keywords, "id", held_keywords)
    named = good_keywords.select(F.col("article_id").alias("id")).distinct()
    accepted = stage_table(good_articles.join(named, "id", "left_semi"), "accepted-articles")
    bare = good_articles.select("id").join(named, "id", "left_anti")
    there = accepted.select("id").unionByName(held_articles.select("id")).distinct()
    reference = good_keywords["article_id"] == there["id"]
    kept = good_keywords.join(there, reference, "left_semi")
    orphans = good_keywords.join(there, reference, "left_anti")

    def listed(rows: DataFrame, item: str, reason: Column, article: Column) -> DataFrame:
        return rows.select(F.lit(item).alias("item"), "id", article.alias("article_id"), reason.alias("reason"))

    said, own = F.col("reason"), F.col("id")
    rejects = listed(bad_articles, "Article", said, own).unionByName(
        listed(bare, "Article", F.lit("no keywords"), own)
    ).unionByName(listed(bad_keywords, "ArticleKeywords", said, F.col("article_id"))).unionByName(
        listed(orphans, "ArticleKeywords", F.lit("no article"), F.col("article_id"))
    )
    return accepted, kept, rejects


def articles_with_keywords(articles: DataFrame, keywords: DataFrame) -> DataFrame:
    """One row per (article, keyword), the article's columns alongside. ``articles`` is
    unique on ``article_id``; Spark's skew join splits an article with many keywords."""
    return keywords.join(articles, "article_id")


def rebuild_keywords(keywords: DataFrame, chunk: int) -> DataFrame:
    """Keyword lists in position order, the inverse of ``explode_keywords``.

    The key of the result is (``article_id``, ``part``): a row holds at most ``chunk``
    positions, which the caller chooses so that a row fits a task. Lists up to that length
    come back whole as part 0. Copies of a row are merged before the shuffle.
    """
    part: Column = F.floor(F.col("pos") / chunk).cast("int")
    entries = F.array_sort(F.collect_set(F.struct("pos", "keyword")))
    return (
        keywords.groupBy("article_id", part.alias("part"))
        .agg(entries.alias("_entries"))
        .select("article_id", "part", F.transform("_entries", lambda e: e["keyword"]).alias("keywords"))
    )
