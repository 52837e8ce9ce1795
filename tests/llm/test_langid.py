import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from odd_rows import collect, documents, empty
from paperloom.llm import langid


def normal(text):
    folded = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
    start = len(folded) - len(folded.lstrip(" "))
    out = ""
    for c in folded[start:]:
        if c != " " or out[-1:] != " ":
            out += c
    return "   " + out if out.strip() else ""


class Plain:
    """Interpolated Kneser-Ney written down by its definition."""

    def __init__(self, texts, vocabulary):
        top = {}
        for text in map(normal, texts):
            for i in range(len(text) - 3):
                top[text[i : i + 4]] = top.get(text[i : i + 4], 0) + 1
        self.counts = {4: top}
        for order in (3, 2, 1):
            self.counts[order] = {}
            for gram in self.counts[order + 1]:
                self.counts[order][gram[1:]] = self.counts[order].get(gram[1:], 0) + 1
        self.floor = 1 / vocabulary

    def probability(self, gram):
        if not gram:
            return self.floor
        counts = self.counts[len(gram)]
        ones, twos = (sum(c == k for c in counts.values()) for k in (1, 2))
        discount = min(0.9, max(0.1, ones / (ones + 2 * twos))) if ones + twos else 0.5
        following = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
        lower = self.probability(gram[1:])
        if not following:
            return lower
        own = max(counts.get(gram, 0) - discount, 0) / sum(following)
        return own + discount * len(following) / sum(following) * lower


TEXTS = {"en": ["the cat and the dog", "then the other one"], "fr": ["le chat et le chien", "les autres, là!"]}


def models(spark):
    rows = [(lang, t) for lang, texts in TEXTS.items() for t in texts]
    return langid.fit(langid.count_grams(spark.createDataFrame(rows, "lang string, text string")))


def test_probabilities_match_the_definition(spark):
    fitted = models(spark)
    characters = {c for texts in TEXTS.values() for t in texts for c in normal(t)}
    for lang, texts in TEXTS.items():
        plain = Plain(texts, len(characters) + 1)
        for text in ("the chat", "zzz été", "autre"):
            codes = langid.codes_of(text)
            found = langid.log_probabilities(codes, fitted.arrays)[:, fitted.langs.index(lang)]
            padded = normal(text)
            want = [math.log(plain.probability(padded[i : i + 4])) for i in range(len(padded) - 3)]
            assert found == pytest.approx(want, abs=1e-4)


def test_long_texts_are_scored_in_pieces(spark, monkeypatch):
    fitted = models(spark)
    text = "the other chat et " * 300
    whole = langid.cross_entropies([text, "a", "!"], fitted.arrays)[0]
    monkeypatch.setattr(langid, "CELLS_AT_ONCE", 64)
    assert np.allclose(langid.cross_entropies([text, "a", "!"], fitted.arrays)[0], whole, atol=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = langid.in_fold(F.col("doc_id"), 4, 2)
    fitted = langid.train(docs.filter(~held_out))
    answers = langid.predict(docs, fitted, ["doc_id", "lang"]).filter(held_out).toPandas()
    assert len(answers) > 30
    assert (answers["lang"] == answers["lang_pred"]).mean() > 0.97
    assert not answers["rejected"].any()


def test_strange_scripts_are_rejected(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fitted = langid.train(docs)
    strange = spark.createDataFrame([(1, "Щы жэ ёцъ фгшщ юйя пвн. " * 40), (2, "ⵣⵉⵏ ⴰⵎⴰⵣ " * 99)], "doc_id long, text string")
    assert langid.predict(strange, fitted, ["doc_id"]).filter("rejected").count() == 2


def test_junk_among_the_labels_does_not_open_the_filter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    ids = [r[0] for r in spark.range(10**6, 10**6 + 200).filter(F.pmod(F.xxhash64("id"), F.lit(10)) == 0).collect()]
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect())
    junk = [(ids[0], lang, chr(0x4E00) * 400) for lang in langs]  # the language that it is taken for among them
    rows = docs.unionByName(spark.createDataFrame(junk, "doc_id long, lang string, text string"))
    fitted = langid.train(rows)
    strange = spark.createDataFrame([(1, "Щы жэ ёцъ фгшщ юйя пвн. " * 40)], "doc_id long, text string")
    assert langid.predict(strange, fitted, ["doc_id"]).filter("rejected").count() == 1


def test_every_labelled_row_and_gram_is_in_the_model(spark):
    rows = [(i, "xx", "".join(chr(0x4E00 + (i * 977 + j * j * 31) % 20000) for j in range(500))) for i in range(450)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    fitted = langid.train(table)
    want = {t[i : i + 4] for _, _, text in rows for t in [normal(text)] for i in range(len(t) - 3)}
    assert len(want) > 200_000
    assert np.isin(langid._gram_hashes(sorted(want)), fitted.arrays.grams[-1][0]).all()
    assert fitted.grams[-1].count() == len(want)  # and nothing that lies between two texts


def test_large_models_stay_tables(spark, sf_dir, monkeypatch):
    """Beyond the bound of the arrays the answers are the same, by joins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    docs = docs.unionByName(documents(spark).select("doc_id", "lang", "text"))
    small = langid.train(docs)
    monkeypatch.setattr(langid, "ARRAY_BYTES", 0)
    large = langid.train(docs)
    assert small.arrays and large.arrays is None
    assert np.allclose(small.limit, large.limit, rtol=1e-3)
    rows = docs.select(F.struct("doc_id", "text").alias("row"), "doc_id")
    one, two = (
        {r["doc_id"]: r for r in langid.predict(rows, m, ["row", "doc_id"], text="row.text").collect() if r["doc_id"]}
        for m in (small, large)
    )
    assert one.keys() == two.keys()
    for key, row in one.items():
        assert (row["lang_pred"], row["n_letters"], row["rejected"]) == tuple(two[key][c] for c in ("lang_pred", "n_letters", "rejected"))
        assert row["cross_entropy"] == pytest.approx(two[key]["cross_entropy"], abs=1e-4)


def test_every_labelled_row_calibrates(spark, monkeypatch):
    """Each of them once, scored by models that do not know it."""
    letters = "abcdefghij"
    rows = [(i, "ab"[i % 2], f"{letters[i % 10]}{letters[i // 10]} word of the text") for i in range(100)]
    table = spark.createDataFrame([*rows, (100, None, "no label")], "doc_id long, lang string, text string")
    seen, plain = [], langid.predict

    def watched(docs, models, keep, text=None):
        seen.append((sorted(r.doc_id for r in docs.collect()), models))
        return plain(docs, models, keep, text)

    monkeypatch.setattr(langid, "predict", watched)
    fitted = langid.train(table)
    assert sorted(i for ids, _ in seen for i in ids) == list(range(100))
    for ids, others in seen:
        grams = {r.gram for r in others.grams[-1].collect()}
        unknown = {normal(rows[i][2])[:4] for i in range(100)} - {normal(rows[i][2])[:4] for i in range(100) if i not in ids}
        assert not unknown & grams
    assert all(limit < math.inf for limit in fitted.limit)


def test_counts_of_many_arrays_add_up():
    texts = [langid.codes_of(t) for t in ("the cat", "the other cat", "été 𝔘𝔫 the")]
    counts = None
    for codes in texts:
        counts = langid._add(counts, codes, np.arange(len(codes)) >= langid.PAD)
    want = {}
    for text in map(normal, ("the cat", "the other cat", "été 𝔘𝔫 the")):
        for i in range(len(text) - 3):
            want[text[i : i + 4]] = want.get(text[i : i + 4], 0) + 1
    assert dict(zip(langid._as_text(counts[1]), counts[2].tolist())) == want


def test_fold_is_crc32(spark):
    rows = spark.range(200).select("id", langid.in_fold(F.col("id"), 4, 2).alias("held")).collect()
    assert all(r["held"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_odd_rows(spark):
    docs = documents(spark)
    fitted = langid.train(docs.filter("doc_id is not null"))
    rows = collect(langid.predict(docs, fitted, ["row_id", "text"]))
    assert len(rows) == docs.count()
    for row in rows:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters)
        assert 0 <= row["score"] <= 1 and row["rejected"] >= (not letters)


def test_nothing_to_learn_from(spark):
    assert langid.train(empty(spark)) is None
    assert langid.predict(empty(spark), None, ["doc_id"]).count() == 0
    rows = collect(langid.predict(documents(spark), None, ["doc_id"]))
    assert {r["lang_pred"] for r in rows} == {"und"}
