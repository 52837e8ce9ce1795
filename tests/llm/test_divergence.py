"""The audit against sums over every kept term."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from odd_rows import documents, empty
from paperloom.llm import divergence

SCHEMA = "lang string, source string, text string"


def plain(rows, min_docs, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    found = []
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted(s for l, s in groups if l == lang)
        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})

        def shares(of):
            total = sum(of[t] for t in kept)
            return {t: 1 + 10**9 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s]
            terms = [(q[t] - p[s][t], t.encode(), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (value, _, item) in enumerate(sorted(items)[:most], 1):
                    found.append((lang, s, part, item, -value, rank))
    return sorted(found)


def audited(df, min_docs, top=5):
    return sorted(tuple(r) for r in divergence.audit(df, min_docs, top).collect())


def made(n_docs, n_sources, seed=1):
    draw = np.random.default_rng(seed)
    rows = []
    for i in range(n_docs):
        lang = ("en", "fr", None)[i % 3]
        terms = [f"Wé{chr(97 + k % 26)}{'x' * (k // 26)}" for k in draw.zipf(1.3, 40) % 90]
        rows.append((lang, f"s{draw.integers(n_sources)}", " ".join(terms)))
    return rows


def test_equals_sums_over_terms(spark):
    rows = made(300, 4)
    assert audited(spark.createDataFrame(rows, SCHEMA), 3) == plain(rows, 3, 5)


def test_tiles_and_flushed_counts(spark, monkeypatch):
    rows = made(400, 70)
    whole = plain(rows, 2, 5)
    monkeypatch.setattr(divergence, "TILE", 16)
    assert audited(spark.createDataFrame(rows, SCHEMA).repartition(3), 2) == whole


def test_many_words_of_terms(spark):
    """More terms than one block of words holds, and counts above each other's words."""
    words = [f"{a}{b}{c}" for a in "abcdefghijkl" for b in "abcdefghijkl" for c in "abcdefghijkl"]
    rows = [("en", f"s{i % 3}", " ".join(words[i % 7 :: 1 + i % 3])) for i in range(12)]
    assert len(words) > 64 * divergence.WORDS_AT_ONCE
    assert audited(spark.createDataFrame(rows, SCHEMA), 2) == plain(rows, 2, 5)


def test_no_kept_terms(spark):
    rows = [("en", "a", "one"), ("en", "b", "two"), ("en", None, None), ("fr", "a", "")]
    assert audited(spark.createDataFrame(rows, SCHEMA), 5) == [
        ("en", "", "pair", "a", 0, 1),
        ("en", "", "pair", "b", 0, 2),
        ("en", "a", "pair", "", 0, 1),
        ("en", "a", "pair", "b", 0, 2),
        ("en", "b", "pair", "", 0, 1),
        ("en", "b", "pair", "a", 0, 2),
    ]


@pytest.mark.parametrize("min_docs", [1, 2])
def test_odd_rows(spark, min_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in documents(spark).collect()]
    assert audited(documents(spark), min_docs) == plain(rows, min_docs, 5)


def test_empty(spark):
    assert audited(empty(spark), 1) == []


def test_joint_cells_are_popcounts():
    one, two = np.array([0b1011, 2**63], np.uint64), np.array([0b0011, 2**64 - 1], np.uint64)
    assert divergence.joint_cells(one, two).tolist() == [[2, 3], [0, 1]]
