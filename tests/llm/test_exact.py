import hashlib
import re
from collections import Counter

import numpy as np

from odd_rows import collect, documents, empty
from paperloom.llm import exact


def brute(rows):
    def digest(text):
        return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).digest()

    groups = {}
    for doc_id, text in rows:
        groups.setdefault(digest(text), []).append(doc_id)
    return groups


def test_hash_places_every_digest_once_and_finds_it():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 5000):
        digests = rng.integers(0, 256, (n, 32), dtype=np.uint8)
        sizes, bits, slots = exact.build_hash(digests)
        assert sorted(slots) == list(range(n))
        assert (exact.find_slots(digests, sizes, bits) == slots).all()


def test_groups_match_brute_force(spark):
    docs = documents(spark)
    groups = brute([(r["doc_id"], r["text"]) for r in collect(docs)])
    decided = collect(exact.decide(docs))
    assert len(decided) == 15
    for row in decided:
        ids = groups[bytes(row["digest"])]
        known = [i for i in ids if i is not None]
        assert row["keep_id"] == (min(known) if known else None)
        assert row["group_size"] == len(ids)
    kept = Counter(bytes(r["digest"]) for r in decided if r["kept"])
    assert kept == Counter(groups.keys())


def test_dedup_keeps_one_row_of_each_group(spark):
    docs = documents(spark)
    left = exact.dedup(docs)
    assert left.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"]) for r in collect(left))
    assert set(kept.values()) == {1}
    assert len(kept) == len(brute([(r["doc_id"], r["text"]) for r in collect(docs)]))
    assert (3, "One two three four five six seven.") not in kept


def test_many_copies_over_both_halves(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('text ', if(id % 3 = 0, 0, id % 500)) as text")
    decided = exact.decide(docs)
    hot = decided.filter("keep_id = 0").agg({"group_size": "max", "doc_id": "count"}).first()
    assert decided.count() == 3000 and hot[0] == hot[1]
    wrong = decided.groupBy("digest").agg({"doc_id": "min", "keep_id": "max"}).filter("min(doc_id) <> max(keep_id)")
    assert wrong.count() == 0


def test_empty_table(spark):
    assert exact.decide(empty(spark)).count() == 0
    assert exact.dedup(empty(spark)).columns == empty(spark).columns
