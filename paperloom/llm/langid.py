"""Language ID by character language models.

One interpolated Kneser-Ney model of order 4 per language. The counts come from all labelled
documents: each task counts what it reads, Spark adds the counts up, and discounts, contexts and
probabilities are aggregations and joins over the n-grams, so no table of n-grams passes the driver
to be fitted. The models are sorted arrays of n-gram hashes with one column of log probabilities
per language; a text gets the language with the lowest cross-entropy per character.

The arrays are sent to the workers while they are small (``ARRAY_BYTES``, checked before anything is
collected). Larger models stay tables, and the n-grams of the texts are joined with them; both
ways give the same answers.

Rejection is calibrated: on every labelled document, scored by models of the half of the documents
that it is not in, the cross-entropy above the language's median is measured, scaled by the root
of the length (short texts scatter more), and texts far beyond a high quantile of it are
rejected, which a few wrong labels do not move. The quantile of a language is drawn towards
that of all by ``SHRINK`` rows.

Defined cases: a null text and a text without letters are ``und`` with score 0 and rejected;
equal texts get equal answers; a null doc_id is neither trained on nor held out; null labels
are not trained on; without any labelled text every answer is ``und``; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import numbered, whole_text
from paperloom.session import stage_table

ORDER = 4
UNKNOWN = "und"
LENGTH_CAP = 400
QUANTILE = 0.9
# Weight, in rows, of the quantile of all languages in that of one.
SHRINK = 100
MARGIN = 3.0
LEAST_LIMIT = 30.0
CELLS_AT_ONCE = 4_000_000
# Rows of a written table of n-grams that go into one file: tables are narrow, and each is read several times.
GRAMS_A_FILE = 500_000
# Models up to this size are sent to the workers.
ARRAY_BYTES = 128 << 20
PAD = ORDER - 1

# Fixed value: an odd multiplier for the polynomial hash.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

_fold: np.ndarray | None = None


def fold_table() -> np.ndarray:
    """Lower case for every letter, a space for every other code point."""
    global _fold
    if _fold is None:
        _fold = np.full(sys.maxunicode + 1, 32, np.uint32)
        for code in range(sys.maxunicode + 1):
            char = chr(code)
            if char.isalpha():
                _fold[code] = ord(char.lower()[0])
    return _fold


def codes_of(text: str) -> np.ndarray:
    """Letters in lower case, everything between words as one space, padded in front so that
    the first letter has a context. Empty if there is no letter."""
    folded = fold_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    letters = folded != 32
    if not letters.any():
        return np.zeros(0, np.uint32)
    first = np.flatnonzero(letters)[0]
    kept = letters[first:] | np.concatenate([[False], letters[first:-1]])
    return np.concatenate([np.full(PAD, 32, np.uint32), folded[first:][kept]])


def hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """Hash of the ``order`` codes that end at each position from ``PAD`` on."""
    found = np.zeros(len(codes) - PAD, np.uint64)
    for back in range(order - 1, -1, -1):
        found *= MULTIPLIER
        found += codes[PAD - back : len(codes) - back]
    return found


# --- counting -------------------------------------------------------------------------


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(apart, lang, gram, n) of the rows of one task; holds the distinct grams only."""
    totals: dict[tuple[bool, str], Grams] = {}
    for batch in batches:
        texts: dict[tuple[bool, str], list[np.ndarray]] = {}
        for *key, text in zip(*[column.to_pylist() for column in batch.columns]):
            texts.setdefault(tuple(key), []).append(codes_of(text))
        for key, found in texts.items():
            for codes, inside in _joined(found, 1 << 20):
                totals[key] = _add(totals.get(key), codes, inside)
    for (apart, lang), (_, windows, counts) in totals.items():
        n = len(counts)
        columns = [pa.array([apart] * n), pa.array([lang] * n), pa.array(_as_text(windows)), pa.array(counts)]
        yield pa.record_batch(columns, ["apart", "lang", "gram", "n"])


# Hashes of n-grams, their codes and how often they occur.
Grams = tuple[np.ndarray, np.ndarray, np.ndarray]


def _joined(texts: list[np.ndarray], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts one after the other, in arrays of about ``size``, and which of the codes are no padding."""
    group, total = [], 0
    for codes in texts:
        group.append(codes)
        total += len(codes)
        if total >= size:
            yield np.concatenate(group), _not_padding(group)
            group, total = [], 0
    if total:
        yield np.concatenate(group), _not_padding(group)


def _not_padding(texts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.arange(len(codes)) >= PAD for codes in texts])


def _add(counts: Grams | None, codes: np.ndarray, inside: np.ndarray) -> Grams:
    """``counts`` and the n-grams that end at the codes ``inside``."""
    ends = np.flatnonzero(inside)
    keys = hashes(codes, ORDER)[ends - PAD]
    order, starts = _equal_runs(keys)
    first = ends[order[starts]]
    windows = np.stack([codes[first - PAD + i] for i in range(ORDER)], axis=1)
    now = keys[order[starts]], windows, np.diff(starts, append=len(keys)).astype(np.int64)
    if counts is None:
        return now
    keys, windows, n = (np.concatenate(pair) for pair in zip(counts, now))
    order, starts = _equal_runs(keys)
    return keys[order[starts]], windows[order[starts]], np.add.reduceat(n[order], starts)


def _equal_runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together, and where each run of them starts."""
    order = np.argsort(keys)
    found = keys[order]
    return order, np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))


def _as_text(windows: np.ndarray) -> list[str]:
    whole = np.ascontiguousarray(windows, "<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [whole[i : i + ORDER] for i in range(0, len(whole), ORDER)]


def count_grams(docs: DataFrame, apart: Column | None = None) -> DataFrame:
    """(apart, lang, gram, n) over every row of ``docs`` (lang, text, and what ``apart`` asks for): all
    rows, whole texts, in one pass; rows with ``apart`` are counted on their own."""
    flag = F.lit(False) if apart is None else F.coalesce(apart, F.lit(False))
    rows = docs.filter(F.col("lang").isNotNull()).select(flag.alias("apart"), "lang", whole_text().alias("text"))
    counted = rows.mapInArrow(_count_grams, "apart boolean, lang string, gram string, n long")
    return counted.groupBy("apart", "lang", "gram").agg(F.sum("n").alias("n"))


# --- the models -----------------------------------------------------------------------


@dataclass
class Arrays:
    """Per order, the sorted hashes of the n-grams seen in any language with their log
    probability in each, and the sorted hashes of contexts with the log weight of the next
    lower order."""

    langs: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    contexts: list[tuple[np.ndarray, np.ndarray]]
    floor: float


@dataclass
class Models:
    """Per order, two written tables (gram, logs): of the n-grams seen in any language with
    their log probability in each, and of contexts with the log weight of the next lower order;
    the same as ``arrays`` if they are small."""

    langs: list[str]
    grams: list[DataFrame]
    contexts: list[DataFrame]
    floor: float
    arrays: Arrays | None = None
    median: list[float] | None = None
    limit: list[float] | None = None


def _gram_hashes(grams: list[str]) -> np.ndarray:
    if not grams or not grams[0]:
        return np.zeros(len(grams), np.uint64)
    codes = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").reshape(len(grams), -1)
    found = np.zeros(len(grams), np.uint64)
    for i in range(codes.shape[1]):
        found = found * MULTIPLIER + codes[:, i]
    return found


def _per_lang(langs: list[str], value) -> Column:
    """``value`` of each language's place."""
    return F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), value)


def _files(rows: int) -> int:
    return -(-max(1, rows) // GRAMS_A_FILE)


def gram_counts(counts: DataFrame, langs: list[str], files: int) -> DataFrame:
    """(ord, gram, head, ns) of all orders from (lang, gram, n): ``ns`` has a number per
    language, the count in the highest order, and below it the number of different characters
    before the n-gram. Written table."""
    sums = [F.coalesce(F.sum(F.when(F.col("lang") == lang, F.col("n"))), F.lit(0)) for lang in langs]
    highest = counts.groupBy("gram").agg(F.array(*sums).alias("ns"))
    every = [stage_table(highest.coalesce(files), "grams")]
    while len(every) < ORDER:
        types = [F.sum((F.col("ns")[i] > 0).cast("long")) for i in range(len(langs))]
        below = every[0].groupBy(F.substring("gram", 2, ORDER).alias("gram")).agg(F.array(*types).alias("ns"))
        every.insert(0, below)
    numbered_orders = [
        table.select(
            F.lit(order).alias("ord"), "gram", F.substring("gram", 1, order - 1).alias("head"), "ns"
        )
        for order, table in enumerate(every, 1)
    ]
    found = numbered_orders[0]
    for table in numbered_orders[1:]:
        found = found.unionByName(table)
    return stage_table(found.coalesce(files), "gram-counts")


def _discounts(counts: DataFrame, langs: list[str]) -> tuple[list[list[float]], int]:
    """Absolute discount per order and language, from how many n-grams count one and two, and how many
    characters there are: one row per order comes to the driver."""
    places = range(len(langs))
    ones = F.array(*[F.sum((F.col("ns")[i] == 1).cast("long")) for i in places])
    twos = F.array(*[F.sum((F.col("ns")[i] == 2).cast("long")) for i in places])
    rows = sorted(counts.groupBy("ord").agg(ones, twos, F.count(F.lit(1))).collect())
    found = [[min(0.9, max(0.1, a / (a + 2 * b))) if a + b else 0.5 for a, b in zip(r[1], r[2])] for r in rows]
    return found, rows[0][3]


def fit(counts: DataFrame) -> Models | None:
    """Models from (lang, gram, n); None if there is nothing."""
    langs = sorted(row[0] for row in counts.select("lang").distinct().collect())
    if not langs:
        return None
    files = _files(counts.count())
    counted = gram_counts(counts, langs, files)
    discounts, characters = _discounts(counted, langs)
    per_order = F.array(*[F.array(*[F.lit(d) for d in order]) for order in discounts])
    discounted = counted.withColumn("discount", F.get(per_order, F.col("ord") - 1))
    contexts = stage_table(_contexts(discounted, langs).coalesce(files), "contexts")
    floor = 1.0 / (characters + 1)

    def probability(i: Column) -> Column:
        left = F.greatest(F.col("ns")[i] - F.col("discount")[i], F.lit(0.0))
        own = F.when(F.col("totals")[i] > 0, left / F.col("totals")[i]).otherwise(0.0)
        return own + F.col("weights")[i] * F.col("lower")[i]

    rows = discounted.join(contexts.withColumnRenamed("gram", "head"), ["ord", "head"])
    grams: list[DataFrame] = []
    for order in range(1, ORDER + 1):
        now = rows.filter(F.col("ord") == order)
        if grams:
            lower = grams[-1].select(F.col("gram").alias("rest"), F.col("p").alias("lower"))
            now = now.join(lower, F.substring("gram", 2, ORDER) == F.col("rest"))
        else:
            now = now.withColumn("lower", F.array(*[F.lit(floor)] * len(langs)))
        now = now.select("gram", _per_lang(langs, probability).alias("p"))
        grams.append(stage_table(now.coalesce(files), "probabilities"))

    def logs(table: DataFrame, name: str) -> DataFrame:
        return table.select("gram", F.transform(name, lambda x: F.log(x).cast("float")).alias("logs"))

    models = Models(
        langs,
        [logs(table, "p") for table in grams],
        [logs(contexts.filter(F.col("ord") == order), "weights") for order in range(1, ORDER + 1)],
        float(np.log(floor)),
    )
    models.arrays = _as_arrays(models)
    return models


def _contexts(counted: DataFrame, langs: list[str]) -> DataFrame:
    """(ord, gram, totals, weights) of the contexts of all orders; one that a language lacks leaves
    all weight to the lower order."""
    totals = F.array(*[F.sum(F.col("ns")[i]) for i in range(len(langs))])
    types = F.array(*[F.sum((F.col("ns")[i] > 0).cast("long")) for i in range(len(langs))])
    summed = counted.groupBy("ord", F.col("head").alias("gram")).agg(
        totals.alias("totals"), types.alias("types"), F.first("discount").alias("discount")
    )

    def weight(i: Column) -> Column:
        share = F.col("types")[i] * F.col("discount")[i] / F.col("totals")[i]
        return F.when(F.col("totals")[i] > 0, share).otherwise(1.0)

    return summed.select("ord", "gram", "totals", _per_lang(langs, weight).alias("weights"))


def _as_arrays(models: Models) -> Arrays | None:
    """The models as sorted arrays, or None if they are larger than ``ARRAY_BYTES``."""
    tables = [*models.grams, *models.contexts]
    every = reduce(DataFrame.unionByName, [t.withColumn("part", F.lit(i)) for i, t in enumerate(tables)])
    if every.count() * (8 + 4 * len(models.langs)) > ARRAY_BYTES:
        return None
    collected = every.toArrow()
    found = [_sorted_arrays(collected.filter(pc.equal(collected["part"], i)), len(models.langs)) for i in range(len(tables))]
    return Arrays(models.langs, found[:ORDER], found[ORDER:], models.floor)


def _sorted_arrays(found: pa.Table, n_langs: int) -> tuple[np.ndarray, np.ndarray]:
    logs = found.column("logs").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    keys = _gram_hashes(found.column("gram").to_pylist())
    order = np.argsort(keys, kind="stable")
    return keys[order], np.ascontiguousarray(logs.reshape(-1, n_langs)[order], np.float32)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def log_probabilities(codes: np.ndarray, models: Arrays) -> np.ndarray:
    """Log probability of each character from ``PAD`` on, one column per language."""
    out = np.zeros((len(codes) - PAD, len(models.langs)), np.float32)
    open_ = np.arange(len(out))
    for order in range(ORDER, 0, -1):
        keys, values = models.grams[order - 1]
        at, hit = _find(keys, hashes(codes, order)[open_])
        out[open_[hit]] += values[at[hit]]
        open_ = open_[~hit]
        if not len(open_):
            return out
        keys, values = models.contexts[order - 1]
        if order > 1:
            shifted = np.concatenate([[np.uint32(32)], codes[:-1]])
            wanted = hashes(shifted, order - 1)[open_]
        else:
            wanted = np.zeros(len(open_), np.uint64)
        at, hit = _find(keys, wanted)
        out[open_[hit]] += values[at[hit]]
    out[open_] += models.floor
    return out


def cross_entropies(texts: list[str], models: Arrays) -> tuple[np.ndarray, np.ndarray]:
    """(cross-entropy per character in each language, number of characters) of each text."""
    every = [codes_of(t) for t in texts]
    lengths = np.array([max(0, len(c) - PAD) for c in every])
    entropies = np.zeros((len(texts), len(models.langs)))
    size = max(1, CELLS_AT_ONCE // len(models.langs))
    for i, codes in enumerate(every):
        if not lengths[i]:
            continue
        total = np.zeros(len(models.langs))
        for start in range(0, lengths[i], size):
            piece = codes[start : start + size + PAD]
            total += log_probabilities(piece, models).sum(axis=0, dtype=np.float64)
        entropies[i] = -total / lengths[i]
    return entropies, lengths


# --- prediction -----------------------------------------------------------------------

ANSWER = ["lang_pred", "score", "cross_entropy", "n_letters", "rejected"]


def predict(docs: DataFrame, models: Models | None, keep: list[str], text: str | None = None) -> DataFrame:
    """``keep`` columns and the answer for every whole text. ``text`` names a string column, or
    a field of a struct column in ``keep`` (``column.field``), so that a text that is kept
    anyway is sent to the workers once."""
    kept = F.struct(*keep).alias("kept")
    rows = docs.select(kept) if text else docs.select(kept, whole_text().alias("text"))
    if models is None:
        unknown = [F.lit(UNKNOWN), F.lit(0.0), F.lit(0.0), F.lit(0).cast("long"), F.lit(True)]
        return rows.select("kept.*", *[c.alias(name) for c, name in zip(unknown, ANSWER)])
    path = text.split(".") if text else None
    scored = _scored_by_arrays(rows, models.arrays, path) if models.arrays else _scored_by_joins(rows, models, path)
    return _judged(scored, models)


def _judged(scored: DataFrame, models: Models) -> DataFrame:
    """The answer from (kept, entropies, n_letters)."""
    entropies, n = F.col("entropies"), F.col("n_letters")
    found = scored.withColumn("cross_entropy", F.array_min(entropies))
    best = F.array_position(entropies, F.col("cross_entropy")).cast("int")
    least, temper = F.col("cross_entropy"), F.least(n, F.lit(50))
    total = F.aggregate(entropies, F.lit(0.0), lambda s, x: s + F.exp((least - x) * temper))
    median, limit = (
        F.element_at(F.array(*[F.lit(float(v)) for v in values or [default] * len(models.langs)]), best)
        for values, default in ((models.median, 0.0), (models.limit, np.inf))
    )
    above = (least - median) * F.sqrt(F.least(n, F.lit(LENGTH_CAP)))
    lang = F.element_at(F.array(*[F.lit(name) for name in models.langs]), best)
    return found.select(
        "kept.*",
        F.when(n == 0, F.lit(UNKNOWN)).otherwise(lang).alias("lang_pred"),
        F.when(n == 0, F.lit(0.0)).otherwise(1.0 / total).alias("score"),
        "cross_entropy",
        "n_letters",
        ((n == 0) | (above > limit)).alias("rejected"),
    )


def _texts_of(batch: pa.RecordBatch, path: list[str] | None) -> list[str]:
    texts = batch.column(batch.num_columns - 1)
    for field in path or []:
        texts = pc.struct_field(texts, field)
    return [t or "" for t in texts.to_pylist()]


def _scored_by_arrays(rows: DataFrame, arrays: Arrays, path: list[str] | None) -> DataFrame:
    """(kept, entropies, n_letters) with the models in each worker."""
    shared = rows.sparkSession.sparkContext.broadcast(arrays)  # at most ARRAY_BYTES
    schema = rows.schema["kept"].dataType.simpleString()
    names = ["kept", "entropies", "n_letters"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                entropies, lengths = cross_entropies(_texts_of(part, path), shared.value)
                offsets = np.arange(0, entropies.size + 1, entropies.shape[1], dtype=np.int32)
                listed = pa.ListArray.from_arrays(offsets, entropies.ravel())
                yield pa.record_batch([part.column(0), listed, pa.array(lengths, pa.int64())], names)

    return rows.mapInArrow(run, f"kept {schema}, entropies array<double>, n_letters long")


def _grams_of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row_id, gram, n): the different n-grams of each whole text."""
    for batch in batches:
        for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes = codes_of(text)
            if len(codes):
                _, windows, counts = _add(None, codes, np.arange(len(codes)) >= PAD)
                columns = [pa.array([row_id] * len(counts)), pa.array(_as_text(windows)), pa.array(counts)]
                yield pa.record_batch(columns, ["row_id", "gram", "n"])


def _scored_by_joins(rows: DataFrame, models: Models, path: list[str] | None) -> DataFrame:
    """(kept, entropies, n_letters) for models of any size: each different n-gram of the texts is
    scored once, by joins with the tables of all orders, and the texts' n-grams by a join with those."""
    staged = numbered(rows, "to-identify")
    text = F.coalesce(F.col(".".join(["kept", *path])) if path else F.col("text"), F.lit(""))
    grams = staged.select("row_id", text.alias("text")).mapInArrow(_grams_of_rows, "row_id long, gram string, n long")
    grams = stage_table(grams, "text-grams")
    values = _gram_values(grams.select("gram").distinct(), models)
    places = range(len(models.langs))
    sums = F.array(*[-F.sum(F.col("logs")[i].cast("double") * F.col("n")) / F.sum("n") for i in places])
    summed = grams.join(values, "gram").groupBy("row_id").agg(sums.alias("entropies"), F.sum("n").alias("n_letters"))
    zeros = F.array(*[F.lit(0.0) for _ in places])
    return staged.join(summed, "row_id", "left").select(
        "kept", F.coalesce("entropies", zeros).alias("entropies"), F.coalesce("n_letters", F.lit(0)).alias("n_letters")
    )


def _gram_values(grams: DataFrame, models: Models) -> DataFrame:
    """(gram, logs): log probability of the last character of each n-gram in each language."""
    found = grams
    for order in range(1, ORDER + 1):
        tail, head = f"tail{order}", f"head{order}"
        table = models.grams[order - 1].select(F.col("gram").alias(tail), F.col("logs").alias(f"own{order}"))
        context = models.contexts[order - 1].select(F.col("gram").alias(head), F.col("logs").alias(f"weight{order}"))
        start = ORDER - order + 1
        found = found.join(table, F.substring("gram", start, order) == F.col(tail), "left")
        found = found.join(context, F.substring("gram", start, order - 1) == F.col(head), "left")
    floor = F.array(*[F.lit(models.floor).cast("float") for _ in models.langs])
    nothing = F.array(*[F.lit(0.0).cast("float") for _ in models.langs])
    logs = floor
    for order in range(1, ORDER + 1):
        weight = F.coalesce(F.col(f"weight{order}"), nothing)
        logs = F.coalesce(F.col(f"own{order}"), F.zip_with(weight, logs, lambda a, b: a + b))
    return stage_table(found.select("gram", logs.alias("logs")), "gram-values")


def train(labelled: DataFrame) -> Models | None:
    """Models and calibration from ``labelled`` (doc_id, lang, text).

    A hash of doc_id deals the rows into two halves. The calibration scores every row with models of
    the other half. The models that are returned count every row, and every n-gram that was counted.
    """
    known = labelled.filter(F.col("lang").isNotNull())
    apart = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    counted = stage_table(count_grams(known, apart), "grams")
    models = fit(counted)
    if models is None:
        return None
    halves = [(known.filter(half), fit(counted.filter(others))) for half, others in ((apart, "not apart"), (~apart, "apart"))]
    return calibrate(models, halves)


def calibrate(models: Models, halves: list[tuple[DataFrame, Models | None]]) -> Models:
    """``models`` with the median cross-entropy per language and the limit of what lies above it,
    from all rows of ``halves``, each with models that know none of its rows. Two rows per language
    come to the driver."""
    models.median, models.limit = [0.0] * len(models.langs), [np.inf] * len(models.langs)
    right = (F.col("lang_pred") == F.col("lang")) & (F.col("n_letters") > 0)
    judged = [predict(rows, others, ["lang"]).filter(right) for rows, others in halves if others]
    if not judged:
        return models
    scored = stage_table(reduce(DataFrame.unionByName, judged), "calibration")
    median = dict(scored.groupBy("lang").agg(F.percentile_approx("cross_entropy", 0.5)).collect())
    if not median:
        return models
    overall = sum(median.values()) / len(median)
    models.median = [median.get(lang, overall) for lang in models.langs]
    medians = F.create_map(*[F.lit(x) for pair in median.items() for x in pair])
    root = F.sqrt(F.least(F.col("n_letters"), F.lit(LENGTH_CAP)))
    excess = scored.select("lang", ((F.col("cross_entropy") - medians[F.col("lang")]) * root).alias("above"))
    high = F.percentile_approx("above", QUANTILE)
    of_all = excess.agg(high).first()[0]
    each = {r[0]: (r[1], r[2]) for r in excess.groupBy("lang").agg(high, F.count(F.lit(1))).collect()}
    for place, lang in enumerate(models.langs):
        own, n = each.get(lang, (of_all, 0))
        shrunken = (own * n + of_all * SHRINK) / (n + SHRINK)
        models.limit[place] = max(LEAST_LIMIT, MARGIN * shrunken)
    return models


def in_fold(doc_id: Column, parts: int, part: int) -> Column:
    """crc32 of the id as text leaves ``part``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))
