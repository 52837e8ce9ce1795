import random
from collections import Counter

import xxhash

from odd_rows import collect, documents, empty
from paperloom.llm import simhash
from paperloom.llm.common import components


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for text in (None, "", "One", "one TWO", "a b c d e f a b c", "É É é x y z " * 50, "w " * 70000):
        assert simhash.fingerprint(text) == brute_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def near(values):
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 2]


def test_links_tie_what_brute_force_ties(spark, monkeypatch):
    draw = random.Random(3)
    values = {draw.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for value in list(values)[:30]:
        for _ in range(6):
            values.add(value ^ 1 << draw.randrange(64) ^ (1 << draw.randrange(64) if draw.random() < 0.7 else 0))
    values = sorted(signed(v) for v in values)
    want = roots(values, near(values))
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    for limit in (64, 1):  # all pairs of a bucket, then meeting points in every bucket
        monkeypatch.setattr(simhash, "BUCKET_ROWS", limit)
        found = [tuple(r) for r in simhash.links(fps).collect()]
        assert set(map(frozenset, found)) <= set(map(frozenset, near(values)))
        assert roots(values, found) == want


def test_components(spark):
    draw = random.Random(5)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    pairs += [(draw.randrange(200, 400), draw.randrange(200, 400)) for _ in range(120)]
    nodes = {n for p in pairs for n in p}
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == roots(nodes, pairs)


def test_whole_operator_matches_brute_force(spark):
    docs = documents(spark)
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in collect(docs)]
    values = sorted({signed(f) for _, f in rows})
    root = roots(values, near(values))
    decided = collect(simhash.decide(docs))
    assert Counter((r["doc_id"], r["fp"]) for r in decided) == Counter((d, signed(f)) for d, f in rows)
    for row in decided:
        ids = [d for d, f in rows if root[signed(f)] == root[row["fp"]] and d is not None]
        assert row["component_id"] == (min(ids) if ids else None)
    left = simhash.dedup(docs)
    assert left.columns == docs.columns
    assert left.count() == len(set(root.values()))


def test_empty_table(spark):
    assert simhash.decide(empty(spark)).count() == 0
    assert simhash.dedup(empty(spark)).count() == 0
