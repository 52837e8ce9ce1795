import math
import random

import pytest
from pyspark.sql import functions as F

from odd_rows import collect, documents, empty
from paperloom.llm import langid, quality


def test_statistics(spark):
    docs = spark.createDataFrame([(1, "Ab ab  ab C3! \n$$ é"), (2, ""), (3, None), (4, " \n ")], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in collect(quality.with_statistics(docs, ["doc_id"]).select("kept.*", *quality.NAMES))}
    n = len("Ab ab  ab C3! \n$$ é")
    first = rows[1]
    assert first["n_words"] == 6 and first["distinct"] == 4 / 6
    assert first["repeated"] == 0 and first["upper"] == 2 / n and first["letters"] == 8 / n
    assert first["digits"] == 1 / n and first["symbols"] == 3 / n and first["lines"] == 1 / 6
    assert {rows[i]["n_words"] for i in (2, 3, 4)} == {0.0}


def test_rules_are_the_paths_of_the_trees():
    shown = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=9
  Tree 0 (weight 1.0):
    If (feature 4 <= 0.5)
     If (feature 2 <= 0.25)
      Predict: 1.0
     Else (feature 2 > 0.25)
      Predict: 0.0
    Else (feature 4 > 0.5)
     Predict: 0.0
  Tree 1 (weight 1.0):
    Predict: 1.0
"""
    low, high = ("upper", "<=", 0.5), ("upper", ">", 0.5)
    assert quality.tree_rules(shown) == sorted(
        [(low,), (high,), tuple(sorted([low, ("distinct", "<=", 0.25)])), tuple(sorted([low, ("distinct", ">", 0.25)]))]
    )


def test_compiled_score_is_the_sum_of_the_rules(spark):
    rules = [((("upper", ">", 0.5),), 1.5), ((("n_words", "<=", 2.0), ("upper", "<=", 0.5)), -2.0)]
    ensemble = quality.Ensemble(0.25, rules)
    docs = documents(spark)
    stats = {r["row_id"]: r for r in collect(quality.with_statistics(docs, ["row_id"]).select("kept.*", *quality.NAMES))}
    for row in collect(quality.score(docs, ensemble, ["row_id"])):
        s = stats[row["row_id"]]
        total = 0.25 + 1.5 * (s["upper"] > 0.5) - 2.0 * (s["n_words"] <= 2 and s["upper"] <= 0.5)
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held_out = langid.in_fold(F.col("doc_id"), 5, 0)
    ensemble = quality.train(docs, labels.filter(~held_out))
    assert ensemble.rules
    scored = quality.score(docs, ensemble, ["doc_id"]).join(labels, "doc_id").filter(held_out).toPandas()
    assert len(scored) > 40
    assert ((scored["score"] >= 0.3) == (scored["label"] == 1)).mean() > 0.93
    good, bad = scored[scored["label"] == 1]["score"], scored[scored["label"] == 0]["score"]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.93


def test_one_kind_of_label_or_none(spark):
    docs = documents(spark)
    for labels, want in (([(1, 1), (4, None), (None, 0)], True), ([(1, 0)], False)):
        ensemble = quality.train(docs, spark.createDataFrame(labels, "doc_id long, label int"))
        scores = [r["score"] for r in collect(quality.score(docs, ensemble, ["row_id"]))]
        assert len(scores) == docs.count() and all((s > 0.5) == want for s in scores)
    none = quality.train(docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r["score"] for r in collect(quality.score(docs, none, ["row_id"]))} == {0.5}
    assert quality.score(empty(spark), none, ["doc_id"]).count() == 0


def test_mixed_labels_on_odd_rows(spark):
    draw = random.Random(1)
    labels = [(i, draw.randrange(2)) for i in range(1, 12)] + [(3, 1), (99, 0)]
    ensemble = quality.train(documents(spark), spark.createDataFrame(labels, "doc_id long, label int"))
    assert all(0 <= r["score"] <= 1 for r in collect(quality.score(documents(spark), ensemble, ["row_id"])))
