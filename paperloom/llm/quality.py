"""Quality classifier as a sparse ensemble of rules.

Statistics of a text are column expressions. Trees are grown on them over a bounded sample of
labelled documents, every path in a tree from its root is a rule (a conjunction of comparisons), and
a logistic regression with an L1 penalty keeps the few rules that matter. What it keeps is
compiled back into one column expression: no model object is needed to score.

Defined cases: a null text is empty and is scored like any other; equal texts get equal
scores; null labels and documents with a null doc_id are not learned from; with labels of one
kind only (or none) the score is that kind (or one half); an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import SPACE, whole_text
from paperloom.session import stage_table

# The classifier is fitted on about so many labelled rows, chosen by a hash of doc_id.
SAMPLE_ROWS = 20_000
TREES = 12
DEPTH = 3
PENALTY = 0.002
SEED = 7

Condition = tuple[str, str, float]
Rule = tuple[Condition, ...]


def statistics(text: Column) -> dict[str, Column]:
    """What the rules may ask about a text: shares of characters and of words."""
    chars = F.greatest(F.length(text), F.lit(1))
    words = F.filter(F.split(F.lower(text), f"{SPACE}+"), lambda w: w != "")

    def share(dropped: str) -> Column:
        return F.length(F.regexp_replace(text, dropped, "")) / chars

    repeated = F.regexp_count(text, F.lit(r"(?<!\S)(\S++)(?=[\x20\x09-\x0D]\1(?!\S))"))
    n_words = F.size(words)
    return {
        "n_words": n_words.cast("double"),
        "word_length": F.length(text) / F.greatest(n_words, F.lit(1)),
        "distinct": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1)),
        "repeated": repeated / F.greatest(n_words, F.lit(1)),
        "upper": share(r"[^\p{Lu}]+"),
        "letters": share(r"[^\p{L}]+"),
        "digits": share(r"[^0-9]+"),
        "symbols": share(r"[\p{L}\p{N}\s.,;:'\"()?-]+"),
        "lines": F.regexp_count(text, F.lit("\n")) / F.greatest(n_words, F.lit(1)),
    }


def with_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` as a struct and one column per statistic, whole texts: no kept name can clash."""
    named = statistics(whole_text())
    return docs.select(F.struct(*keep).alias("kept"), *[column.alias(name) for name, column in named.items()])


NAMES = ["n_words", "word_length", "distinct", "repeated", "upper", "letters", "digits", "symbols", "lines"]


@dataclass
class Ensemble:
    """Weighted rules; the score is the logistic function of the sum of those that hold."""

    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(holds(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def holds(rule: Rule) -> Column:
    tests = [F.col(name) <= F.lit(at) if side == "<=" else F.col(name) > F.lit(at) for name, side, at in rule]
    return reduce(Column.__and__, tests)


def tree_rules(shown: str) -> list[Rule]:
    """All paths of the trees in a model's debug text, as conjunctions: one per node below a
    root. Nested conditions are indented by one space each."""
    rules: set[Rule] = set()
    path: list[Condition] = []
    base = 0
    for line in shown.splitlines():
        depth = len(line) - len(line.lstrip()) - base
        found = re.match(r" *(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if line.lstrip().startswith("Tree "):
            path, base = [], base + depth + 2
        elif found:
            del path[depth:]
            path.append((NAMES[int(found[1])], found[2], float(found[3])))
            rules.add(tuple(sorted(path)))
    return sorted(rules)


def sampled_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of about ``SAMPLE_ROWS`` labelled documents, chosen by a hash."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    share = min(1.0, SAMPLE_ROWS / max(1, known.count()))
    return known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(10**9)) < int(share * 10**9))


def train(docs: DataFrame, labels: DataFrame) -> Ensemble:
    """The ensemble for ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1)."""
    sample = stage_table(sampled_labels(labels), "sampled-labels")
    labelled = docs.select("doc_id", "text").join(sample, "doc_id")
    rows = stage_table(with_statistics(labelled, ["label"]).withColumn("label", F.col("kept.label")), "labelled-statistics")
    counts = {row["label"]: row["n"] for row in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Ensemble({0: -20.0, 1: 20.0}.get(next(iter(counts), None), 0.0), [])
    rows = rows.withColumn("label", F.col("label").cast("double"))
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy="sqrt", seed=SEED
    ).fit(vectors)
    rules = tree_rules(forest.toDebugString)
    named = [f"rule{i}" for i in range(len(rules))]
    held = rows.select("label", *[holds(r).cast("double").alias(n) for r, n in zip(rules, named)])
    inputs = VectorAssembler(inputCols=named, outputCol="features").transform(held)
    fitted = stage_table(inputs.select("label", "features"), "held-rules")
    lasso = LogisticRegression(labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(fitted)
    weights = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return Ensemble(float(lasso.intercept), weights)


def score(docs: DataFrame, ensemble: Ensemble, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` for every whole text."""
    return with_statistics(docs, keep).select("kept.*", ensemble.score().alias("score"))
