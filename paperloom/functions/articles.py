"""Article JSON, list literals and record shapes as Column functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from paperloom.functions.text import clean_text

# The path names of the article JSON. Nodes that hold either one
# object or a list of objects are read as string, i.e. as their raw JSON.
ROOT = "abstracts-retrieval-response"
ARTICLE_JSON = f"""
`{ROOT}` struct<
  authkeywords: struct<`author-keyword`: string>,
  coredata: struct<`dc:creator`: struct<author: string>>,
  item: struct<
    `ait:process-info`: struct<`ait:date-delivered`: struct<`@timestamp`: string>>,
    bibrecord: struct<
      head: struct<abstracts: string, `citation-title`: string, source: struct<`@country`: string>>,
      `item-info`: struct<itemidlist: struct<itemid: string>>>>>
"""
KEYWORD_JSON = "array<struct<`$`: string>>"
AUTHOR_JSON = "array<struct<`ce:given-name`: string, `ce:surname`: string>>"
ITEM_ID_JSON = "array<struct<`@idtype`: string, `$`: string>>"
SOURCE_ID_TYPE = "SCP"

# A page of search results.
SEARCH_JSON = """
`search-results` struct<
  `opensearch:totalResults`: string,
  entry: array<struct<`prism:url`: string>>>
"""

ARTICLE_SCHEMA = T.StructType(
    [
        T.StructField("article_id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("author_names", T.ArrayType(T.StringType())),
        T.StructField("country", T.StringType()),
        T.StructField("publish_date", T.DateType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
    ]
)

# The column names of exported files.
DISPLAY_NAMES = {
    "article_id": "Article Id",
    "title": "Title",
    "abstract": "Abstract",
    "author_names": "Author name",
    "country": "Country",
    "publish_date": "Publish Date",
    "keywords": "Keywords",
}


def parse_article(raw: Column) -> Column:
    """One parse of the article JSON; every path below is a field of the result."""
    return F.from_json(raw, ARTICLE_JSON)[ROOT]


def has_keywords(article: Column) -> Column:
    return article["authkeywords"].isNotNull()


def raw_keywords(article: Column) -> Column:
    """The keyword list. A root-level array schema also takes a lone object, as a
    list of one."""
    nodes = F.from_json(article["authkeywords"]["author-keyword"], KEYWORD_JSON)
    return F.transform(nodes, lambda node: node["$"])


def clean_keywords(article: Column) -> Column:
    return F.transform(raw_keywords(article), lambda keyword: clean_text(keyword))


def author_names(article: Column) -> Column:
    """"given surname" of the authors that have a given name, in order."""
    authors = F.from_json(article["coredata"]["dc:creator"]["author"], AUTHOR_JSON)
    named = F.filter(authors, lambda a: a["ce:given-name"].isNotNull())
    return F.transform(named, lambda a: F.concat(a["ce:given-name"], F.lit(" "), a["ce:surname"]))


def title(article: Column) -> Column:
    return article["item"]["bibrecord"]["head"]["citation-title"]


def abstract(article: Column) -> Column:
    return article["item"]["bibrecord"]["head"]["abstracts"]


def country(article: Column) -> Column:
    return F.coalesce(article["item"]["bibrecord"]["head"]["source"]["@country"], F.lit(""))


def publish_date(article: Column) -> Column:
    """The calendar date as written, in the offset of the timestamp itself."""
    stamp = article["item"]["ait:process-info"]["ait:date-delivered"]["@timestamp"]
    return stamp.try_cast("date")


def source_id(article: Column) -> Column:
    """The first identifier of the wanted type, 0 without one."""
    ids = F.from_json(article["item"]["bibrecord"]["item-info"]["itemidlist"]["itemid"], ITEM_ID_JSON)
    wanted = F.filter(ids, lambda i: i["@idtype"] == SOURCE_ID_TYPE)
    return F.coalesce(F.try_element_at(wanted, F.lit(1))["$"].cast("bigint"), F.lit(0).cast("bigint"))


def id_from_url(url: Column) -> Column:
    """The last path segment as a number; junk fails the job, as ``int`` would."""
    return F.substring_index(url, "/", -1).cast("bigint")


def total_results(page: Column) -> Column:
    return F.from_json(page, SEARCH_JSON)["search-results"]["opensearch:totalResults"].cast("int")


def page_urls(page: Column) -> Column:
    return F.transform(F.from_json(page, SEARCH_JSON)["search-results"]["entry"], lambda e: e["prism:url"])


def sequence_name(year: Column, position: Column) -> Column:
    """Year and at least four digits; a longer position keeps all its digits."""
    return F.concat(year.cast("string"), F.format_string("%04d", position))


def parse_list_literal(text: Column) -> Column:
    """Read ``['a', "b's"]`` or a JSON array as an array of strings.

    JSON reading accepts single quotes; the two Python escapes JSON lacks
    (``\\xNN`` and ``\\'``) are first rewritten as ``\\u`` escapes. NULL where the
    text still is no list.
    """
    opened = r"(?=\\)(?<!\\)((?:\\\\)*)\\"
    as_json = F.regexp_replace(text, opened + "x([0-9a-fA-F]{2})", r"$1\\u00$2")
    as_json = F.regexp_replace(as_json, opened + "'", r"$1\\u0027")
    return F.from_json(F.when(text.contains("\\"), as_json).otherwise(text), "array<string>")


def list_to_text(items: Column) -> Column:
    return F.to_json(items)
