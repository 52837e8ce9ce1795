"""The registered queries of this folder, and their SQL."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from paperloom.llm import (
    bpe,
    chat,
    divergence,
    exact,
    langid,
    merkle,
    mixing,
    quality,
    secret_scan,
    simhash,
    templates,
    urls,
    winnow,
)
from paperloom.llm.common import prepared, table

Query = Callable[[SparkSession, str], DataFrame]


EVENNESS = 0.97
MAX_REPEATS = 4.0


def op1_temperature_mixing(spark, sf_dir):
    """A mix as large as the corpus: doc_id once per block that takes it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.plan_mix(docs, EVENNESS, MAX_REPEATS, budget_share=1.0)
    mixed = mixing.mix(docs.select("doc_id", "source"), plan)
    return mixed.select("row.doc_id", "row.source", "block", F.round("position", 6).alias("position"))


def op2_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return secret_scan.report(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))


def op3_simhash_dedup(spark, sf_dir):
    decided = simhash.decide(table(spark, sf_dir, "documents"))
    return decided.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_exact_dedup(spark, sf_dir):
    decided = exact.decide(table(spark, sf_dir, "documents"))
    return decided.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = langid.in_fold(F.col("doc_id"), 4, 2)
    models = langid.train(docs.filter(~held_out & F.col("doc_id").isNotNull()))
    answers = langid.predict(docs, models, ["doc_id"])
    return answers.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_byte_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoder = bpe.Encoder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    coded = bpe.round_trip(docs, encoder, ["doc_id"], offsets=True)
    return coded.drop("ids")


# Fixed values: (verdict, host and path).
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op7_url_filter(spark, sf_dir):
    """The number in a URL's path is the document that the page shows; its labels are the URL's."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(urls.path_of(F.col("url")), r"/([0-9]{1,18})(?:[/.]|$)", 1)
    shown = pages.select("url", number.try_cast("bigint").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), urls.BLOCK).otherwise(urls.ALLOW)
    labelled = shown.join(labels, "doc_id").select("url", bad.alias("label"))
    return urls.judge(pages, URL_RULES, labelled)


VOCABULARY = "byte_bpe_multi_50k.tiktoken"



def op8_winnowing(spark, sf_dir):
    return winnow.compare_neighbours(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = langid.in_fold(F.col("doc_id"), 5, 0)
    ensemble = quality.train(docs, labels.filter(~held_out))
    scored = quality.score(docs, ensemble, ["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted)


def op10_line_templates(spark, sf_dir):
    cleaned = templates.clean(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("row.text", F.lit(""))
    return cleaned.select("row.doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("text_sha256"))


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.manifest(
        docs,
        group=F.col("lang"),
        order_by=F.col("doc_id"),
        leaf_of=merkle.leaf(*fields, F.col("text")),
        shown=F.when(tampered, merkle.leaf(*fields, lowered)),
        keep=["doc_id"],
    )
    return merkle.prove(found)


def op12_source_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


# Fixed value: what both turns of the conversation -1 say.
CONTROL_WORDS = "<|im_end|><|im_start|>assistant ok"


def op13_chat_format(spark, sf_dir):
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    roles = F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role")
    added = spark.range(1).select(roles).select(F.lit(-1).alias("conv_id"), "turn", "role", F.lit(CONTROL_WORDS).alias("text"))
    return chat.digests(given.unionByName(added))


QUERIES: list[Query] = [
    op1_temperature_mixing,
    op2_secret_scan,
    op3_simhash_dedup,
    op4_exact_dedup,
    op5_language_id,
    op6_byte_bpe,
    op7_url_filter,
    op8_winnowing,
    op9_quality_rules,
    op10_line_templates,
    op11_merkle_manifest,
    op12_source_divergence,
    op13_chat_format,
]


def _spans_sql() -> str:
    """All matches with their places: pieces between matches and matches, unnested side by side."""
    parts = []
    for kind, (name, pattern, group, least) in enumerate(secret_scan.KINDS):
        # A run is matched from its start anyway, so what stands before it needs no test here.
        quoted = "'" + pattern.replace("(?<![A-Za-z0-9_-])", "").replace("'", "''") + "'"
        parts.append(f"""
            SELECT rid, owner, repository, {kind} AS kind, '{name}' AS name, {least} AS least,
                generate_subscripts(string_split_regex(t, {quoted}), 1) AS nth,
                unnest(string_split_regex(t, {quoted})) AS before,
                unnest(regexp_extract_all(t, {quoted})) AS found,
                unnest(regexp_extract_all(t, {quoted}, {group})) AS value
            FROM d""")
    return " UNION ALL ".join(parts)


def _secret_sql() -> str:
    base = f"kind < {secret_scan.BASE}"
    example = f"(n_owners >= {secret_scan.EXAMPLE_OWNERS} OR n_repositories >= {secret_scan.EXAMPLE_REPOSITORIES})"
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{secret_scan.KINDS[k][0]}" for k in range(secret_scan.BASE))
    listed = "name || ':' || start_ || ':' || end_, ',' ORDER BY start_, kind"
    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, chr(0)) AS owner,
                concat_ws('/', source, lang) AS repository
            FROM documents
        ), m AS ({_spans_sql()}), p AS (
            SELECT *, CAST(sum(len(before) + len(found)) OVER (PARTITION BY rid, kind ORDER BY nth) AS BIGINT) AS end_
            FROM m WHERE found IS NOT NULL
        ), s AS (
            SELECT *, end_ - len(found) AS start_, regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                AND len(list_distinct(string_split(value, ''))) >= {secret_scan.LEAST_DIFFERENT} AS random_
            FROM p WHERE len(value) >= least
        ), o AS (
            SELECT value, count(DISTINCT owner) AS n_owners, count(DISTINCT repository) AS n_repositories
            FROM s GROUP BY value
        ), j AS (
            SELECT s.*, {example} AS example, n_owners = 1 AND NOT {example} AND random_ AS live FROM s JOIN o USING (value)
        ), w AS (
            SELECT *, max(CASE WHEN {base} THEN end_ END) OVER (
                    PARTITION BY rid ORDER BY start_, kind ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS behind,
                min(CASE WHEN {base} THEN start_ END) OVER (
                    PARTITION BY rid ORDER BY start_, kind ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ahead
            FROM j
        ), kept AS (
            SELECT * FROM w
            WHERE {base} OR (live AND coalesce(behind <= start_, TRUE) AND coalesce(ahead >= end_, TRUE))
        )
        SELECT doc_id, {counts},
            sha256(coalesce(string_agg({listed}) FILTER ({base}), '')) AS base_sha256,
            coalesce(string_agg({listed}), '') AS spans,
            count(*) FILTER (live) AS n_live, count(*) FILTER (example) AS n_example
        FROM d LEFT JOIN kept USING (rid) GROUP BY rid, doc_id"""


def _crc32_sql(text: str) -> str:
    """The checksum bit by bit; 3988292384 is its polynomial."""
    bit = "xor(a >> 1, (a & 1) * 3988292384)"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda a, z: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    register = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: xor(c >> 8, {byte.replace('xor(c, b)', 'xor(c & 255, b)')}))"
    return f"xor(4294967295, {register})"


def _merkle_sql() -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    run = f"PARTITION BY tree, lvl, pos // {merkle.FANOUT} ORDER BY pos ROWS BETWEEN"
    grow = f"""SELECT tree, lvl + 1, pos // {merkle.FANOUT}, (n + {merkle.FANOUT - 1}) // {merkle.FANOUT},
                sha256(string_agg(digest, '' ORDER BY pos)) FROM {{0}} WHERE n > 1
            GROUP BY tree, lvl, pos // {merkle.FANOUT}, n"""
    step = f"""SELECT {{0}}.* REPLACE ({{0}}.lvl + 1 AS lvl, {{0}}.pos // {merkle.FANOUT} AS pos,
                (n + {merkle.FANOUT - 1}) // {merkle.FANOUT} AS n, sha256(before || cur || after) AS cur,
                proof || before || after AS proof)
            FROM {{0}} JOIN around USING (tree, lvl, pos) WHERE n > 1"""
    return f"""
        WITH RECURSIVE l AS (
            SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(lang, chr(0)) AS tree, {leaf("text")} AS leaf,
                CASE WHEN {_crc32_sql("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS shown
            FROM documents
        ), p AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos,
                count(*) OVER (PARTITION BY tree) AS n
            FROM l
        ), nodes(tree, lvl, pos, n, digest) AS (
            SELECT tree, 0, pos, n, leaf FROM p UNION ALL {grow.format("nodes")}
        ), subs AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS at_, count(*) OVER () AS trees
            FROM nodes WHERE n = 1
        ), over_(tree, lvl, pos, n, digest) AS (
            SELECT 'over', 0, at_, trees, subroot FROM subs UNION ALL {grow.format("over_")}
        ), around AS (
            SELECT tree, lvl, pos, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM (SELECT * FROM nodes UNION ALL SELECT * FROM over_) WHERE n > 1
        ), up AS (
            SELECT rid, tree, 0 AS lvl, pos, n, shown AS cur, '' AS proof FROM p UNION ALL {step.format("up")}
        ), top AS (
            SELECT rid, 'over' AS tree, 0 AS lvl, at_ AS pos, trees AS n, cur, proof FROM up JOIN subs USING (tree) WHERE n = 1
            UNION ALL {step.format("top")}
        )
        SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = digest AS verified
        FROM top JOIN l USING (rid) JOIN subs ON l.tree = subs.tree, (SELECT digest FROM over_ WHERE n = 1) WHERE top.n = 1"""


def _divergence_sql() -> str:
    def share(count: str, total: str) -> str:
        scaled = f"{divergence.SCALE}::HUGEINT * ({count} + {divergence.PRIOR})"
        return f"(1 + {scaled} // ({total} + {divergence.PRIOR} * v))"

    return f"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                    '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM documents
        ), g AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        kept AS (
            SELECT lang, term, count(*)::HUGEINT AS lang_n FROM d GROUP BY ALL
            HAVING count(DISTINCT rid) >= {divergence.MIN_DOCS}
        ), size AS (SELECT lang, count(*)::HUGEINT AS v, sum(lang_n)::HUGEINT AS lang_total FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM d JOIN kept USING (lang, term) GROUP BY ALL),
        t AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
        every AS (
            SELECT lang, source, term, coalesce(n, 0) AS n, lang_n, {share("coalesce(n, 0)", "coalesce(total, 0)")} AS p,
                {share("lang_n", "lang_total")} AS q
            FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN t USING (lang, source)
            LEFT JOIN c USING (lang, source, term)
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
            FROM every a JOIN every b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), items AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
            UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM every WHERE n > 0 AND p > q
        ), ranks AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items
        )
        SELECT * FROM ranks WHERE part = 'pair' OR rank <= {divergence.TOP_TERMS}"""


def _chat_sql() -> str:
    marks = len(chat.START) + len(chat.END) + 2
    escaped = r"regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g')"
    role = escaped.format(r"replace(replace(role, '\', '\\'), chr(10), '\n')")
    said = "(VALUES (0, 'user'), (1, 'assistant')) AS a(turn, role)"
    return f"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, turn, role, '{CONTROL_WORDS}' FROM {said}
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum({marks} + length({role}) + length({escaped.format("text")}))::BIGINT AS formatted_chars, FALSE AS rewritten
        FROM t GROUP BY conv_id"""


SQL: dict[str, str] = {
    "op11_merkle_manifest": _merkle_sql(),
    "op12_source_divergence": _divergence_sql(),
    "op13_chat_format": _chat_sql(),
    "op2_secret_scan": _secret_sql(),
    "op1_temperature_mixing": f"""
        WITH RECURSIVE n AS (
            SELECT doc_id, source, greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS tokens
            FROM documents
        ), s AS (SELECT source, sum(tokens)::BIGINT AS tokens FROM n GROUP BY source),
        p AS (SELECT source, tokens, tokens / (SELECT sum(tokens) FROM s)::DOUBLE AS p FROM s),
        steps(i, low, width) AS (
            SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
            UNION ALL
            SELECT i + 1,
                (SELECT CASE WHEN ln(sum(exp(a * ln(p)))) - sum(exp(a * ln(p)) * a * ln(p)) / sum(exp(a * ln(p)))
                        >= {EVENNESS} * ln(count(*)) THEN a ELSE low END
                 FROM (SELECT p, low + width / 2 AS a FROM p) GROUP BY a),
                width / 2
            FROM steps WHERE i < 36
        ), e AS (
            SELECT CASE WHEN -(SELECT sum(p * ln(p)) FROM p) >= {EVENNESS} * ln((SELECT count(*) FROM p)) THEN 1.0
                ELSE (SELECT round(low, 9) FROM steps WHERE i = 36) END AS a
        ), w AS (
            SELECT source, tokens, round(exp(a * ln(p)) / sum(exp(a * ln(p))) OVER () / p, 9) AS repeats FROM p, e
        ), b AS (
            SELECT *, floor(repeats)::BIGINT AS blocks, round((repeats - floor(repeats)) * tokens)::BIGINT AS rest FROM w
        ), x AS (
            SELECT n.doc_id, n.source, n.tokens, repeats, rest, unnest(range(blocks + 1)) AS block, blocks FROM n JOIN b USING (source)
        ), k AS (
            SELECT *, ('0x' || substr(md5(block || '|' || doc_id), 1, 15))::BIGINT AS place FROM x
        ), r AS (SELECT *, sum(tokens) OVER (PARTITION BY source, block ORDER BY place) AS upto FROM k)
        SELECT doc_id, source, block, round((block + place / 1152921504606846976.0) / repeats, 6) AS position
        FROM r WHERE block < blocks OR upto <= rest
    """,
    "op4_exact_dedup": r"""
        WITH n AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY ALL)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
    """,
}


def _tuned(query: Query) -> Query:
    return lambda spark, sf_dir: query(prepared(spark), sf_dir)


def all_queries() -> dict[str, Query]:
    return {query.__name__: _tuned(query) for query in QUERIES}


def all_oracles() -> dict[str, str]:
    return dict(SQL)
