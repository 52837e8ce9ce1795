import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from odd_rows import LONG, collect, documents, empty
from paperloom.llm import winnow


def brute(text):
    """Every window looked at on its own."""
    kept = [(c.lower() if "A" <= c <= "Z" else c, i) for i, c in enumerate(text) if c not in " \t\n\x0b\x0c\r"]
    if not kept:
        return []
    codes = np.array([ord(c) for c, _ in kept], np.uint64)
    if len(codes) < winnow.GRAM:
        codes = np.concatenate([codes, np.zeros(winnow.GRAM - len(codes), np.uint64)])
    hashes = [int(winnow.rolling_hashes(codes[i : i + winnow.GRAM])[0]) for i in range(len(codes) - winnow.GRAM + 1)]
    window = min(winnow.WINDOW, len(hashes))
    places = set()
    for start in range(len(hashes) - window + 1):
        least = min(hashes[start : start + window])
        places.add(max(i for i in range(start, start + window) if hashes[i] == least))
    return [(hashes[p], kept[p][1]) for p in sorted(places)]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=200) | st.text(alphabet="ab ", max_size=300))
def test_chosen_hashes_match_brute_force(text):
    hashes, positions = winnow.winnow(text)
    assert list(zip(hashes.tolist(), positions.tolist())) == brute(text)


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet="abcdefgh", min_size=47, max_size=47), st.text(max_size=90), st.text(max_size=90))
def test_a_long_enough_match_is_found(shared, before, after):
    assert len(shared) == winnow.GRAM + winnow.WINDOW - 1
    a, _ = winnow.winnow(before + shared + after)
    b, _ = winnow.winnow("x" + shared)
    assert set(a.tolist()) & set(b.tolist())


def neighbours(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    for i, (doc_id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        half = len(text) // 2
        yield doc_id, text, text[: len(text) - half] + following[:half], following


def like(a, b):
    a, b = {h for h, _ in brute(a)}, {h for h, _ in brute(b)}
    return 1.0 if not a | b else len(a & b) / len(a | b)


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_neighbours_match_brute_force(spark, parts):
    rows = [(i * 7, t) for i, t in enumerate(["", None, "a", "Some text of a few words. " * 9, "Other text, " * 20, "é😀" * 40, "a"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in collect(winnow.compare_neighbours(docs, parts))}
    assert len(found) == len(rows)
    for doc_id, text, edited, following in neighbours(rows):
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(like(text, edited))
        assert row["near_next"] == pytest.approx(like(text, following))
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (brute(text) and [h for h, _ in brute(text)] == [h for h, _ in brute(edited)] or brute(text) == brute(edited))


def test_odd_rows(spark):
    docs = documents(spark)
    found = collect(winnow.compare_neighbours(docs))
    assert len(found) == docs.count()
    prints = collect(winnow.fingerprints(docs, ["row_id", "text"]))
    for row in prints:
        hashes, positions = winnow.winnow(row["text"] or "")
        assert row["hashes"] == hashes.view(np.int64).tolist() and row["positions"] == positions.tolist()
    assert len(LONG) > 100_000


def test_single_document_and_empty_table(spark):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    row = winnow.compare_neighbours(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and row["near_next"] == 1.0
    assert winnow.compare_neighbours(empty(spark)).count() == 0
