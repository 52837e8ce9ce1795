import hashlib
import math

import pytest

from odd_rows import collect, documents, empty
from paperloom.llm import mixing


def place(block, doc_id):
    return int(hashlib.md5(f"{block}|{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)


def weights(shares, alpha):
    powers = {s: p**alpha for s, p in shares.items()}
    return {s: v / sum(powers.values()) for s, v in powers.items()}


def corpus(spark):
    rows = [(i, "w " * (1 + i % 5), "big" if i % 3 else f"s{i % 9}") for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_plan_and_blocks_match_brute_force(spark):
    docs, rows = corpus(spark)
    tokens = {}
    for i, text, source in rows:
        tokens.setdefault(source, {})[i] = len(text.split())
    total = sum(sum(t.values()) for t in tokens.values())
    shares = {s: sum(t.values()) / total for s, t in tokens.items()}
    low, high = 0.0, 1.0
    for _ in range(36):
        middle = (low + high) / 2
        w = weights(shares, middle).values()
        enough = -sum(x * math.log(x) for x in w) >= 0.95 * math.log(len(shares))
        low, high = (middle, high) if enough else (low, middle)
    wanted = weights(shares, round(low, 9))
    plan = mixing.plan_mix(docs, evenness=0.95, budget_share=1.5)
    found = {r["source"]: r for r in collect(plan)}
    assert {s: r["weight"] for s, r in found.items()} == pytest.approx(wanted)
    expected = set()
    for s, docs_of in tokens.items():
        repeats = round(wanted[s] * 1.5 / shares[s], 9)
        blocks = int(repeats)
        rest = round((repeats - blocks) * sum(docs_of.values()))
        expected |= {(d, b) for d in docs_of for b in range(blocks)}
        for d in sorted(docs_of, key=lambda d: place(blocks, d)):
            if docs_of[d] > rest:
                break
            rest -= docs_of[d]
            expected.add((d, blocks))
    mixed = mixing.mix(docs, plan)
    got = [(r["row"]["doc_id"], r["block"]) for r in mixed.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_repeats_are_limited_and_nothing_is_lost(spark):
    docs, rows = corpus(spark)
    plan = mixing.plan_mix(docs, evenness=1.0, max_repeats=2.0)
    repeats = [r["repeats"] for r in collect(plan)]
    assert min(repeats) == 1.0 and max(repeats) == pytest.approx(2.0, abs=1e-6)
    assert {r["row"]["doc_id"] for r in mixing.mix(docs, plan).collect()} == {r[0] for r in rows}


def test_odd_rows(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs, mixing.plan_mix(docs, evenness=1.0, max_repeats=1.0))
    assert mixed.select("row.*").columns == docs.columns
    assert mixed.count() == docs.count()


def test_empty_table(spark):
    docs = empty(spark)
    assert mixing.mix(docs, mixing.plan_mix(docs, evenness=1.0, max_repeats=2.0)).count() == 0
