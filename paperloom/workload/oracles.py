"""The expected result of each query as DuckDB SQL over the same tables.

DuckDB's regular expressions know neither look-around nor Unicode word edges, so a
rule on a whole word is written with its two delimiters and applied twice, because
neighbours share a delimiter. The SQL states the results its own way: from the tables
directly, not through the JSON, files or targets the Spark queries go through.
"""

from __future__ import annotations

from paperloom.workload import expected as S
from paperloom.workload.expected import CONTRACTIONS, DEGREES, EMOJI, UNITS
from paperloom.workload.inputs import FIRST_DAY, ID_BASE, TAIL, URL_BASE

W = r"\p{L}\p{N}_"
S_ = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
D = r"\p{Nd}"


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sub(expr: str, pattern: str, new: str) -> str:
    return f"regexp_replace({expr}, {_quote(pattern)}, {_quote(new)}, 'g')"


def _twice(expr: str, pattern: str, new: str) -> str:
    return _sub(_sub(expr, pattern, new), pattern, new)


def _word(expr: str, word: str, new: str, inside: str = W) -> str:
    return _twice(expr, f"(^|[^{inside}]){word}($|[^{inside}])", rf"\1{new}\2")


def units(expr: str) -> str:
    for scale, words in DEGREES.items():
        expr = _twice(expr, rf"({D})[{S_}]*°[{S_}]*{scale}($|[^{W}])", rf"\1 {words}\2")
    for unit in ("m2/g", "cm3/g"):
        expr = _word(expr, unit, f" {UNITS[unit]} ")
    for scale, words in DEGREES.items():
        expr = _twice(expr, rf"([{W}])°{scale}($|[^{W}])", rf"\1 {words} \2")
    for unit, words in UNITS.items():
        if unit not in ("m2/g", "cm3/g"):
            expr = _word(expr, unit, f" {words} ")
    return expr


def spaces(expr: str) -> str:
    return f"trim({_sub(expr, f'[{S_}]+', ' ')})"


def contractions(expr: str) -> str:
    word = "w"
    for short, full in CONTRACTIONS.items():
        before, after = f"(^|[^{W}'’]|(?:^|[^{W}])['’])", f"($|[^{W}'’]|['’](?:$|[^{W}]))"
        word = _twice(word, before + short.replace("'", "['’]") + after, rf"\1{full}\2")
    return (
        f"array_to_string(list_transform(string_split({spaces(expr)}, ' '), "
        f"lambda w: CASE WHEN contains(w, '''') OR contains(w, '’') THEN {word} ELSE w END), ' ')"
    )


def usernames(expr: str) -> str:
    return _sub(expr, f"@[{W}]+", " ")


def copyright_notice(expr: str) -> str:
    return _sub(expr, rf"©.*?{D}{{4}}\.", " ")


def punctuation(expr: str) -> str:
    apart = _sub(expr, r"""(['".()!?\\/,])""", r" \1 ")
    return copyright_notice(_sub(apart, rf"[^{W}{S_}?%/.\-]", " "))


def emojis(expr: str) -> str:
    return _sub(expr, f"[{EMOJI}]+", "")


def repeats(expr: str) -> str:
    return _sub(expr, r"([!?.]){2,}", r"\1")


def numbers(expr: str) -> str:
    """Every non-word character gets a mark on both sides, so that neighbouring numbers
    do not share a delimiter."""
    mark = "\x01"
    marked = _sub(expr, f"([^{W}])", rf"{mark}\1{mark}")
    number = (
        rf"(^|{mark}){D}+(?:{mark}\.{mark}{D}+({mark}|$)|{mark}\.({mark}[{W}])|({mark}|$))"
    )
    return f"replace({_sub(marked, number, r'\1 \2\3\4')}, {_quote(mark)}, '')"


def special(expr: str) -> str:
    return _sub(expr, r"[;:|•«\n]", " ")


def clean(expr: str, drop_numbers: bool = False) -> str:
    expr = contractions(f"lower({units(expr)})")
    expr = repeats(emojis(punctuation(usernames(expr))))
    if drop_numbers:
        expr = numbers(expr)
    return spaces(special(expr))


TEXT = f"(text || {_quote(TAIL)})"

TEXT_RULES = {
    "clean_documents": clean,
    "clean_documents_no_numbers": lambda e: clean(e, True),
    "unit_symbols": units,
    "lower_text": lambda e: f"lower({e})",
    "expand_contractions": contractions,
    "remove_usernames": usernames,
    "isolate_punctuation": punctuation,
    "strip_copyright": copyright_notice,
    "remove_numbers": numbers,
    "remove_special": special,
    "collapse_whitespace": spaces,
    "remove_emojis": emojis,
    "repeated_punctuation": repeats,
}


# --- stemming ---------------------------------------------------------------------------
# Measure tests as patterns over a stem whose leading "y" is written "Y".

C1 = "[^aeiou][^aeiouy]*"
V1 = "[aeiouy][aeiou]*"
M0 = f"^({C1})?{V1}[^aeiou]"
M1_ONLY = f"^({C1})?{V1}{C1}({V1})?$"
M1 = f"^({C1})?{V1}{C1}{V1}[^aeiou]"
HAS_VOWEL = f"^({C1})?[aeiouy]"
SHORT = "^[aeiou][^aeiou]$|([^aeiouy]|[aeiou]y)[aeiou][^aeiouwxyY]$|[^aeiouy]y[^aeiouwxyY]$"


def _has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {_quote(pattern)})"


def _cut(word: str, ending: str) -> str:
    return f"{word}[:len({word}) - {len(ending)}]"


def _endings(word: str, rules: list[tuple[str, str, str]]) -> str:
    """CASE over (ending, replacement, condition with {} for what precedes)."""
    branches = ""
    for ending, new, condition in rules:
        base = _cut(word, ending)
        test = condition.replace("{}", base) if condition else "TRUE"
        branches += f" WHEN ends_with({word}, '{ending}') THEN CASE WHEN {test} THEN {base} || '{new}' ELSE {word} END"
    return f"CASE{branches} ELSE {word} END"


def _stem_sql() -> str:
    m0, m1 = _has("{}", M0), _has("{}", M1)
    base = "CASE WHEN ends_with(a, 'ed') THEN a[:len(a)-2] ELSE a[:len(a)-3] END"
    plural = (
        "CASE WHEN len(w) = 4 AND ends_with(w, 'ies') THEN w[:3] ELSE "
        + _endings("w", [(e, n, "") for e, n in S.PLURALS])
        + " END"
    )
    # b: what precedes -ed or -ing, where that holds a vowel
    participle = (
        "CASE WHEN ends_with(a, 'ied') THEN CASE WHEN len(a) = 4 THEN a[:3] ELSE a[:len(a)-2] END"
        f" WHEN ends_with(a, 'eed') THEN CASE WHEN {_has('a[:len(a)-3]', M0)} THEN a[:len(a)-1] ELSE a END"
        " WHEN b IS NULL THEN a"
        " WHEN ends_with(b, 'at') OR ends_with(b, 'bl') OR ends_with(b, 'iz') THEN b || 'e'"
        " WHEN len(b) > 1 AND b[-1] = b[-2] AND b[-1] NOT IN ('a','e','i','o','u')"
        " AND b[-1] <> 'y'"
        " THEN CASE WHEN b[-1] IN ('l','s','z') THEN b ELSE b[:len(b)-1] END"
        f" WHEN {_has('b', M1_ONLY)} AND {_has('b', SHORT)} THEN b || 'e' ELSE b END"
    )
    # "logi" is measured with its "l" kept
    long = _endings("d", [(e, n, _has("{} || 'l'", M0) if e == "logi" else m0) for e, n in S.LONG_ENDINGS])
    middle = _endings("e", [(x, n, m0) for x, n in S.MIDDLE_ENDINGS])
    last = _endings(
        "f",
        [(x, "", f"{m1} AND {{}}[-1] IN ('s','t')" if x == "ion" else m1) for x in S.LAST_ENDINGS],
    )
    irregular = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in S.IRREGULAR.items()) + "}"
    return f"""
WITH docs AS (SELECT doc_id, {clean('text')} AS text FROM documents),
tokens AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS token, generate_subscripts(string_split(text, ' '), 1) AS pos
  FROM docs),
words AS (
  SELECT DISTINCT token, CASE WHEN starts_with(token, 'y') THEN 'Y' || token[2:] ELSE token END AS w
  FROM (SELECT lower(token) AS token FROM tokens WHERE token <> '')),
s1a AS (SELECT token, {plural} AS a FROM words),
s1b0 AS (
  SELECT token, a, CASE WHEN (ends_with(a, 'ed') OR ends_with(a, 'ing')) AND {_has(base, HAS_VOWEL)}
    THEN {base} END AS b FROM s1a),
s1b AS (SELECT token, {participle} AS c FROM s1b0),
s1c AS (
  SELECT token, CASE WHEN ends_with(c, 'y') AND len(c) > 2 AND {_has("c[:len(c)-1]", "[^aeiouy]$|[aeiou]y$|^Y$")}
    THEN c[:len(c)-1] || 'i' ELSE c END AS d0 FROM s1b),
s2a AS (
  SELECT token, CASE WHEN ends_with(d0, 'alli') AND {_has("d0[:len(d0)-4]", M0)} THEN d0[:len(d0)-2] ELSE d0 END AS d
  FROM s1c),
s2 AS (SELECT token, {long} AS e FROM s2a),
s3 AS (SELECT token, {middle} AS f FROM s2),
s4 AS (SELECT token, {last} AS g FROM s3),
s5a AS (
  SELECT token, CASE WHEN ends_with(g, 'e') AND ({_has("g[:len(g)-1]", M1)}
    OR ({_has("g[:len(g)-1]", M0)} AND NOT {_has("g[:len(g)-1]", SHORT)})) THEN g[:len(g)-1] ELSE g END AS h FROM s4),
s5 AS (
  SELECT token, CASE WHEN ends_with(h, 'll') AND {_has("h[:len(h)-1]", M1)} THEN h[:len(h)-1] ELSE h END AS i FROM s5a),
stems AS (
  SELECT token, coalesce(({irregular})[token],
    CASE WHEN len(token) <= 2 THEN token ELSE replace(i, 'Y', 'y') END) AS stem FROM s5)
SELECT docs.doc_id, coalesce(string_agg(stem || ' ', '' ORDER BY pos), '') AS stems
FROM docs LEFT JOIN tokens ON docs.doc_id = tokens.doc_id AND tokens.token <> ''
LEFT JOIN stems ON lower(tokens.token) = stems.token GROUP BY docs.doc_id"""


# --- articles -----------------------------------------------------------------------------

URL = f"{_quote(URL_BASE)} || ({ID_BASE} + doc_id)"
LINES = "string_split(text, chr(10))"
CLEAN_LINES = f"array_to_string(list_transform({LINES}, lambda line: {clean('line')}), '; ')"
AUTHORS = (
    "CASE lang WHEN 'en' THEN 'G' || source || ' O''S0'"
    " WHEN 'fr' THEN 'G' || source || ' O''S1; G' || source || ' O''S2'"
    " ELSE 'G' || source || ' O''S0; G' || source || ' O''S1' END"
)
DAY = f"CAST(CAST(DATE '{FIRST_DAY}' + CAST(n_chars AS INTEGER) AS DATE) AS VARCHAR)"
COUNTRY = "CASE WHEN lang = 'en' THEN '' ELSE upper(lang) END"
YEAR = "2018 + CAST(replace(source, 'src', '') AS INTEGER) // 4"


def _articles(where: str = "source <> 'src0'", source: str = "documents") -> str:
    return f"""SELECT {ID_BASE} + doc_id AS article_id, {LINES}[1] AS title, text AS abstract,
  {AUTHORS} AS author_names, {COUNTRY} AS country, {DAY} AS publish_date, {CLEAN_LINES} AS keywords
FROM {source} WHERE {where}"""


FOLDER_ARTICLES = f"""SELECT CASE WHEN lang = 'es' THEN 0 ELSE article_id END AS article_id,
  title, abstract, author_names, country, publish_date, keywords
FROM ({_articles().replace("SELECT ", "SELECT lang, ", 1)})"""

ORDERED = """SELECT o_orderkey AS id, year(o_orderdate) AS year, o_totalprice AS citations,
  o_orderpriority IN ('1-URGENT', '2-HIGH') AS has_keywords,
  row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) AS year_rank,
  row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank,
  count(*) OVER (PARTITION BY year(o_orderdate)) AS year_total, count(*) OVER () AS total
FROM orders"""

BY_YEAR = f"""SELECT year, year_rank AS rank, (year_rank - 1) // 25 AS page,
  (year_rank - 1) // 25 * 25 AS start, year_total AS total_results, {_quote(URL_BASE)} || id AS url
FROM ({ORDERED})"""

WRITTEN = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%-d %B %Y')
  WHEN 'O' THEN strftime(o_orderdate, '%B %-d, %Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END"""
PARSED = "coalesce(try_strptime(written, '%d %B %Y'), try_strptime(written, '%B %d, %Y'))"

PER_TITLE = """SELECT p_name AS title, count(l_shipdate) AS qty_ratings, round(avg(l_quantity), 6) AS avg_rating
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name"""

VISITS = f"""SELECT *, coalesce(sum(CASE WHEN source <> 'src0' THEN 1 ELSE 0 END)
    OVER (ORDER BY y, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kept_before
  FROM (SELECT *, {YEAR} AS y, row_number() OVER (PARTITION BY {YEAR} ORDER BY n_chars DESC, {URL}) AS r
    FROM documents)"""

KEYWORD_ROWS = f"""SELECT {ID_BASE} + doc_id AS article_id, unnest({LINES}) AS keyword,
  generate_subscripts({LINES}, 1) - 1 AS pos, lang, source FROM documents"""


def _pair(article_id: str) -> str:
    return f"""WITH rows AS (
  SELECT article_id, pos, {clean('keyword')} AS keyword FROM ({KEYWORD_ROWS}) WHERE source <> 'src0')
SELECT row_number() OVER (ORDER BY rows.article_id, pos) AS keyword_id, {article_id} AS article_id, keyword,
  {LINES}[1] AS title, {DAY} AS publishdate
FROM rows JOIN documents ON rows.article_id = {ID_BASE} + doc_id"""


def _capped(ordered: str) -> str:
    return f"""SELECT year, id, citations FROM (
  SELECT *, coalesce(sum(CAST(has_keywords AS INTEGER)) OVER (ORDER BY year, year_rank
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS kept_before
  FROM ({ordered}))
WHERE has_keywords AND (kept_before <= 10 OR year_rank = 1)"""


def _filled(last_article: str) -> str:
    return f"""WITH kept AS (SELECT * FROM documents WHERE source <> 'src0'),
sums AS (SELECT count(*) AS articles, CAST(sum(len({LINES})) AS BIGINT) AS keywords, {last_article} AS last FROM kept)
SELECT 'Article' AS item, articles AS n_rows FROM sums
UNION ALL SELECT 'ArticleKeywords', keywords FROM sums
UNION ALL SELECT 'last Article', last FROM sums UNION ALL SELECT 'last ArticleKeywords', keywords FROM sums
UNION ALL SELECT 'article_key', 0 UNION ALL SELECT 'keyword_key', 0 UNION ALL SELECT 'article_reference', 0"""


def all_oracles() -> dict[str, str]:
    oracles = {name: f"SELECT doc_id, {rule(TEXT)} AS text FROM documents" for name, rule in TEXT_RULES.items()}
    articles = _articles()
    oracles |= {
        "stem_words": _stem_sql(),
        "extract_article": articles,
        "display_record": f"""SELECT article_id AS "Article Id", title AS "Title", abstract AS "Abstract",
  author_names AS "Author name", country AS "Country", publish_date AS "Publish Date", keywords AS "Keywords"
FROM ({articles})""",
        "four_fields": f"""SELECT title AS "Title", abstract AS "Abstract", publish_date AS "Publish Date",
  keywords AS "Keywords" FROM ({articles})""",
        "keyword_polymorphic": f"""SELECT {ID_BASE} + doc_id AS article_id, len({LINES}) AS n_keywords,
  array_to_string({LINES}, '; ') AS keywords, {CLEAN_LINES} AS clean FROM documents WHERE source <> 'src0'""",
        "author_names": f"SELECT {ID_BASE} + doc_id AS article_id, {AUTHORS} AS author_names FROM documents",
        "scp_id": f"""SELECT {URL} AS url, CASE WHEN lang = 'es' THEN 0 ELSE {ID_BASE} + doc_id END AS scp_id
FROM documents""",
        "url_tail_id": f"SELECT {URL} AS url, {ID_BASE} + doc_id AS article_id FROM documents",
        "reject_articles": f"""SELECT {URL} AS url, CASE lang WHEN 'es' THEN 'title' ELSE 'publish_date' END AS missing
FROM documents WHERE lang IN ('es', 'de') AND source <> 'src0' UNION ALL SELECT url, 'root' FROM pages""",
        "sequence_name": "SELECT o_orderkey, year(o_orderdate) || printf('%04d', o_orderkey) AS name FROM orders",
        "drop_epoch": "SELECT event_id, user_id, event_type FROM events",
        "list_literal_parse": f"""SELECT doc_id, len({LINES}) AS n_items, array_to_string({LINES}, '; ') AS items
FROM documents""",
        "list_round_trip": f"""SELECT {ID_BASE} + doc_id AS article_id, array_to_string({LINES}, '; ') AS items
FROM documents""",
        "parse_dates": f"""SELECT o_orderkey, strftime({PARSED}, '%Y-%m-%d') AS iso_date
FROM (SELECT o_orderkey, {WRITTEN} AS written FROM orders)""",
        "check_dates": f"""SELECT o_orderkey, {PARSED} IS NOT NULL AS is_date
FROM (SELECT o_orderkey, {WRITTEN} AS written FROM orders)""",
        "publish_dates": f"SELECT {URL} AS url, {DAY} AS publish_date FROM documents",
        "epoch_and_double": """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS timestamp,
  CAST(value AS DOUBLE) AS rating FROM events""",
        "dedupe_by_id": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey
  ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey, l_quantity) = 1""",
        "dedupe_any": "SELECT DISTINCT l_orderkey FROM lineitem",
        "union_distinct": "SELECT text FROM documents UNION SELECT text FROM benchmark",
        "merge_new_rows": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM orders t WHERE t.o_orderstatus = 'F' AND t.o_orderkey = o.o_orderkey)""",
        "read_back": "SELECT * FROM customer",
        "csv_round_trip": articles,
        "csv_odd_fields": f"""SELECT {ID_BASE} + doc_id AS article_id, '  ' || {LINES}[1] || chr(9) || ' ' AS title,
  CASE lang WHEN 'es' THEN '' WHEN 'de' THEN NULL ELSE text END AS abstract
FROM documents WHERE source <> 'src0'""",
        "csv_mixed_headers": articles,
        "csv_parts": articles,
        "checked_load": f"""WITH lines AS (
  SELECT doc_id, lang, doc_id * 1000000 + generate_subscripts({LINES}, 1) - 1 AS id FROM documents)
SELECT doc_id AS id, 'Article ' || CASE WHEN doc_id % 11 = 0 THEN 'key more than once' WHEN lang = 'en'
  THEN 'key already there' WHEN doc_id % 13 = 0 THEN 'no keywords' ELSE 'accepted' END AS outcome
FROM documents, range(CASE WHEN doc_id % 11 = 0 THEN 2 ELSE 1 END) WHERE doc_id % 17 <> 0
UNION ALL SELECT id, 'ArticleKeywords ' || CASE WHEN lang = 'en' THEN 'key already there'
  WHEN doc_id % 11 = 0 OR doc_id % 17 = 0 THEN 'no article' ELSE 'accepted' END
FROM lines WHERE doc_id % 13 <> 0""",
        "csv_unreadable_lists": 'SELECT doc_id AS "Article Id" FROM documents WHERE lang <> \'en\'',
        "bulk_init": articles,
        "load_twice_append": f"""SELECT {ID_BASE} + doc_id AS article_id,
  CASE WHEN lang = 'en' THEN 3 ELSE 2 END AS n_rows
FROM documents WHERE source <> 'src0'""",
        "load_twice_merge": articles,
        "merge_load": articles,
        "merge_null_keys": f"""SELECT {COUNTRY} AS country, count(*) AS n_rows FROM documents
WHERE source <> 'src0' AND lang <> 'es' GROUP BY lang
UNION ALL SELECT 'rejected', 2 * count(*) FROM documents WHERE source <> 'src0' AND lang = 'es'""",
        "json_folder": FOLDER_ARTICLES,
        "raw_landing": f"SELECT {URL} AS url, {YEAR} AS year, text AS abstract FROM documents",
        "explode_keywords": f"SELECT article_id, pos, keyword FROM ({KEYWORD_ROWS})",
        "keyword_ids": f"""SELECT row_number() OVER (ORDER BY article_id, pos) AS id, article_id, keyword
FROM ({KEYWORD_ROWS})""",
        "article_keywords": KEYWORD_ROWS,
        "rebuild_keywords": f"""SELECT article_id, pos // 10000 AS part,
  string_agg(keyword, '; ' ORDER BY pos) AS keywords
FROM ({KEYWORD_ROWS}) GROUP BY ALL""",
        "fk_violations": """SELECT l_orderkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL
AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""",
        "pk_violations": """SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey
HAVING count(*) > 1 OR l_orderkey IS NULL""",
        "normalise": _pair("rows.article_id"),
        "normalise_serial": _pair("dense_rank() OVER (ORDER BY rows.article_id)"),
        "create_and_fill": _filled(f"max({ID_BASE} + doc_id)"),
        "create_and_fill_serial": _filled("count(*)"),
        "create_and_resume": _filled(f"max({ID_BASE} + doc_id)"),
        "create_and_resume_serial": _filled("count(*)"),
        "search_read": BY_YEAR,
        "search_read_years": f"""SELECT * FROM ({BY_YEAR})
WHERE year > (SELECT DISTINCT year(o_orderdate) AS y FROM orders ORDER BY y
  LIMIT 1 OFFSET (SELECT count(DISTINCT year(o_orderdate)) // 2 FROM orders))""",
        "search_stream": f"""SELECT year, row_number() OVER (PARTITION BY year ORDER BY id) AS rank,
  {_quote(URL_BASE)} || id AS url FROM ({ORDERED})""",
        "listing_join": """SELECT l_orderkey, l_linenumber, 'https://api.example.org/content/part/' || l_partkey AS url,
  p_name AS title FROM lineitem JOIN part ON l_partkey = p_partkey""",
        "top_by_year": f"SELECT year, year_rank AS rank, id, citations FROM ({ORDERED})",
        "paging": f"""SELECT rank, (rank - 1) // 25 AS page, (rank - 1) // 25 * 25 AS start, total AS total_results, id,
  citations FROM ({ORDERED})""",
        "capped_harvest": _capped(ORDERED),
        "capped_harvest_repeated": _capped(ORDERED.replace("FROM orders", "FROM (FROM orders UNION ALL FROM orders)")),
        "page_requests": f"""SELECT year, year_rank AS rank, 1 AS page, 25 AS start, year_total AS total_results, id,
  citations FROM ({ORDERED}) WHERE year_rank BETWEEN 26 AND 50""",
        "first_n_harvest": f"SELECT id, citations FROM ({ORDERED}) WHERE has_keywords ORDER BY rank LIMIT 11",
        "full_harvest": f"SELECT year, id, citations FROM ({ORDERED}) WHERE has_keywords",
        "landed_listing": BY_YEAR,
        "search_pages": f"""SELECT year, (year_rank - 1) // 25 * 25 AS start, year_total AS total_results,
  string_agg({_quote(URL_BASE)} || id, ' ' ORDER BY year_rank) AS urls
FROM ({ORDERED}) GROUP BY ALL""",
        "harvest_by_year": articles,
        "harvest_by_year_capped": _articles("source <> 'src0' AND (kept_before <= 10 OR r = 1)", f"({VISITS})"),
        "harvest_recent": articles,
        "harvest_with_gaps": f"""SELECT url, 'kept' AS outcome FROM (
  SELECT {URL} AS url FROM documents WHERE source <> 'src0' AND lang NOT IN ('de', 'fr'))
UNION ALL SELECT {URL}, CASE lang WHEN 'de' THEN 'TimeoutError' ELSE 'no article' END FROM documents
WHERE lang IN ('de', 'fr')""",
        "ratings_per_title": PER_TITLE,
        "topk_group": f"SELECT * FROM ({PER_TITLE}) ORDER BY qty_ratings DESC, title LIMIT 10",
        "stream_incremental": """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
        "stream_two_sources": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
        "stream_articles": articles,
        "stream_dedupe": "SELECT event_id, user_id, event_type, value, props FROM events",
        "stream_late_events": """WITH arrivals AS (
  SELECT *, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 5
    + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS file FROM events),
marks AS (
  SELECT file, max(max(ts)) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark
  FROM arrivals GROUP BY file),
judged AS (SELECT event_id, coalesce(ts <= mark - INTERVAL 1 DAY, FALSE) AS late FROM arrivals JOIN marks USING (file))
SELECT event_id, CASE WHEN late THEN 'late' ELSE 'row' END AS outcome,
  CASE WHEN late AND event_id % 3 = 0 THEN 2 ELSE 1 END AS n_rows FROM judged""",
    }
    return oracles
