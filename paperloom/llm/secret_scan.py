"""Secret scans with corpus-wide ownership frequency.

Three fixed kinds are found in every text. A fourth scan takes candidates without a keyword:
long words that mix letters and digits. Every value found is hashed, and for each hash the
corpus tells in how many repositories and with how many owners it occurs: a value that many
own is an example copied from documentation, a value of one owner that looks random is live.
Candidates that are live and outside all base spans are added as spans of kind ``owned``.

Only functions of Spark: a match's place follows from the lengths of the pieces between the
matches, summed up in a window over the matches of one text.

Defined cases: a null or empty text has no spans; a null owner or repository counts as one of
its own; identical rows are scanned each for itself and count once for their owner; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.llm.common import numbered, whole_text
from paperloom.session import stage_table

# The kinds in their order, the group that holds the value, the least length of
# that group. Runs of one class are matched from their least length on, which finds the same.
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
EITHER_CASE = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word) for word in KEYWORDS
)
KINDS: list[tuple[str, str, int, int]] = [
    ("assign", rf"({EITHER_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("owned", r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}", 0, 20),
]
BASE = 3
EXAMPLE_OWNERS = 3
EXAMPLE_REPOSITORIES = 5
LEAST_DIFFERENT = 10


def _matches(kind: int) -> Column:
    """The matches of one kind in ``text``: (before, length, value) with the length of the
    piece before each match; null if there is none."""
    _, pattern, group, _ = KINDS[kind]
    text = F.col("text")
    before = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.transform(
        found,
        lambda match, i: F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            F.get(before, i).alias("before"),
            F.length(match).alias("length"),
            F.get(values, i).alias("value"),
        ),
    )
    return F.when(text.rlike(pattern), zipped)


def find_spans(docs: DataFrame, owner: Column, repository: Column) -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row of ``docs`` with a ``row_id``, and one row per match with its
    kind, start, end (code points, end exclusive) and the hash of its value. Written tables."""
    texts = docs.select("doc_id", owner.alias("owner"), repository.alias("repository"), whole_text().alias("text"))
    every = [F.coalesce(_matches(k), F.array().cast(_MATCHES)) for k in range(len(KINDS))]
    scanned = numbered(texts.select("doc_id", "owner", "repository", F.concat(*every).alias("found")), "scanned")
    each = scanned.filter(F.size("found") > 0).select("row_id", "owner", "repository", F.inline("found"))
    order = Window.partitionBy("row_id", "kind").orderBy("nth")
    end = F.sum(F.col("before") + F.col("length")).over(order)
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("length"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("kind") + 1)
    spans = placed.filter(F.length("value") >= least).select(
        "row_id",
        "owner",
        "repository",
        "kind",
        "start",
        "end",
        F.unhex(F.sha2("value", 256)).alias("hash"),
        _looks_random(F.col("value")).alias("random"),
    )
    return scanned.select("row_id", "doc_id"), stage_table(spans, "spans")


_MATCHES = "array<struct<kind:int,nth:int,before:int,length:int,value:string>>"


def _looks_random(value: Column) -> Column:
    different = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (different >= LEAST_DIFFERENT)


def ownership(spans: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories): repeats of a value at the same place are one row
    before anything is counted."""
    named = spans.select(
        "hash", *[F.coalesce(F.xxhash64(c), F.lit(0)).alias(c) for c in ("owner", "repository")]
    ).distinct()
    repositories = named.groupBy("hash").agg(F.countDistinct("repository").alias("n_repositories"))
    owners = named.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"))
    return repositories.join(owners, "hash")


def scan(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``spans``, sorted by start and kind, each with
    its kind, start, end, n_owners, n_repositories, live and example."""
    rows, spans = find_spans(docs, owner, repository)
    example = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repositories") >= EXAMPLE_REPOSITORIES)
    live = (F.col("n_owners") == 1) & ~example & F.col("random")
    judged = spans.join(ownership(spans), "hash").withColumns({"example": example, "live": live})
    # An owned span must not touch a base span: neither one that started before and still runs,
    # nor one that starts inside.
    base_end = F.when(F.col("kind") < BASE, F.col("end"))
    base_start = F.when(F.col("kind") < BASE, F.col("start"))
    order = Window.partitionBy("row_id").orderBy("start", "kind")
    behind = F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(base_start).over(order.rowsBetween(1, Window.unboundedFollowing))
    apart = F.coalesce(behind <= F.col("start"), F.lit(True)) & F.coalesce(ahead >= F.col("end"), F.lit(True))
    kept = judged.withColumn("apart", apart).filter((F.col("kind") < BASE) | (F.col("live") & F.col("apart")))
    span = F.struct("start", "kind", "end", "n_owners", "n_repositories", "live", "example")
    per_row = kept.groupBy("row_id").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return rows.join(per_row, "row_id", "left").select("doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


_SPANS = (
    "array<struct<start:bigint,kind:int,end:bigint,n_owners:bigint,n_repositories:bigint,live:boolean,example:boolean>>"
)


def named(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    shown = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(shown, ",")


def report(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """doc_id, how many spans of each base kind, digests of the spans, live and example counts."""
    spans = scan(docs, owner, repository)
    base = F.filter("spans", lambda s: s["kind"] < BASE)

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def of_kind(kind: int) -> Column:
        return count(lambda s: s["kind"] == kind).alias(f"n_{KINDS[kind][0]}")

    return spans.select(
        "doc_id",
        *[of_kind(k) for k in range(BASE)],
        F.sha2(named(base), 256).alias("base_sha256"),
        named(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: s["example"]).alias("n_example"),
    )
