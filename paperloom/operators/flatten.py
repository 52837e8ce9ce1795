"""Nested article JSON to the flat seven-column record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions import articles as A


def flatten(
    raw: DataFrame,
    json_col: str = "raw",
    url_col: str | None = "url",
    keep: list[str] | None = None,
    only_with_keywords: bool = True,
) -> DataFrame:
    """One record per article that has keywords; with ``only_with_keywords=False`` every
    readable article, its URL, a flag ``has_keywords`` and the columns in ``keep``.

    The id is the tail of ``url_col``, or the identifier inside the article where
    ``url_col`` is None. The JSON is parsed once per row: the one-element generator
    keeps Catalyst from repeating the parse in the filter and in each field.
    """
    columns = [*([] if url_col is None else [url_col]), *(keep or [])]
    parsed = raw.select(*columns, F.explode(F.array(A.parse_article(F.col(json_col)))).alias("_article"))
    article = F.col("_article")
    fields = [
        (A.source_id(article) if url_col is None else A.id_from_url(F.col(url_col))).alias("article_id"),
        A.title(article).alias("title"),
        A.abstract(article).alias("abstract"),
        A.author_names(article).alias("author_names"),
        A.country(article).alias("country"),
        A.publish_date(article).alias("publish_date"),
        A.clean_keywords(article).alias("keywords"),
    ]
    if only_with_keywords:
        return parsed.filter(A.has_keywords(article)).select(*fields)
    # NULL where there is no readable article.
    flag = F.when(article.isNotNull(), F.coalesce(A.has_keywords(article), F.lit(False)))
    return parsed.select(*columns, *fields, flag.alias("has_keywords"))


def rejects(raw: DataFrame, key: str, json_col: str = "raw") -> DataFrame:
    """The articles with a missing required path, and which one; unreadable JSON
    counts as a missing root. Articles without keywords are skipped, not rejected."""
    parsed = raw.select(key, F.explode(F.array(A.parse_article(F.col(json_col)))).alias("_article"))
    article = F.col("_article")
    missing: Column = F.when(article.isNull(), F.lit("root"))
    for name, value in [
        ("title", A.title(article)),
        ("abstract", A.abstract(article)),
        ("publish_date", A.publish_date(article)),
        ("keywords", A.raw_keywords(article)),
    ]:
        missing = missing.when(A.has_keywords(article) & value.isNull(), F.lit(name))
    return parsed.select(key, missing.alias("missing")).filter(F.col("missing").isNotNull())


def with_display_names(articles: DataFrame) -> DataFrame:
    return articles.select(*[F.col(name).alias(label) for name, label in A.DISPLAY_NAMES.items()])


def four_fields(articles: DataFrame) -> DataFrame:
    return articles.select(
        F.col("title").alias("Title"),
        F.col("abstract").alias("Abstract"),
        F.col("publish_date").alias("Publish Date"),
        F.col("keywords").alias("Keywords"),
    )
