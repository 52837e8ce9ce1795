import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from odd_rows import collect, documents, empty
from paperloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
TOKENIZER = bpe.build_tokenizer(RANKS, public_tokenizers.PATTERN)
PIECES = bpe.token_bytes(TOKENIZER)
CODER = bpe.WordCoder(TOKENIZER, public_tokenizers.PATTERN)
EXPECTED = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(alphabet="ab 1\n\t'sé日́😀\x85\xa0!", max_size=60))
def test_ids_are_tiktokens_and_come_back(text):
    ids = CODER.encode(text).tolist()
    assert ids == EXPECTED.encode_ordinary(text) == TOKENIZER.encode(text, add_special_tokens=False).ids
    starts, ends = CODER.offsets(text, CODER.encode(text))
    assert list(zip(starts, ends)) == TOKENIZER.encode(text, add_special_tokens=False).offsets
    assert bpe.decode_bytes(ids, PIECES) == text.encode()
    assert bpe.decode_text(ids, PIECES) == text


def test_long_text_in_pieces(monkeypatch):
    text = "Some words, été 日本 \n\n  and more. " * 300
    monkeypatch.setattr(bpe, "UNITS_AT_ONCE", 50)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 7)
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    assert bpe.WordCoder(TOKENIZER, public_tokenizers.PATTERN).encode(text).tolist() == EXPECTED.encode_ordinary(text)


def test_alphabet_and_split_characters():
    assert len(set(bpe.byte_alphabet())) == 256
    ids = TOKENIZER.encode("𒀀", add_special_tokens=False).ids
    assert len(ids) > 1
    assert "�" in bpe.decode_text(ids[:1], PIECES)


@pytest.fixture(scope="module")
def encoder(spark):
    return bpe.Encoder(spark, PATH, public_tokenizers.PATTERN)


def test_round_trip(spark, encoder):
    docs = documents(spark)
    found = collect(bpe.round_trip(docs, encoder, ["row_id"]))
    texts = {r["row_id"]: r["text"] or "" for r in collect(docs)}
    assert len(found) == len(texts)
    for row in found:
        ids = EXPECTED.encode_ordinary(texts[row["row_id"]])
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["row_id"]].encode()).hexdigest()


def test_digests_of_offsets_and_of_half_the_tokens(spark, encoder):
    extra = spark.createDataFrame([(100 + i, t) for i, t in enumerate(["𒀀𒀁", "é𒀀x😀", "a"])], "row_id long, text string")
    docs = documents(spark).select("row_id", "text").unionByName(extra)
    rows = collect(bpe.round_trip(docs, encoder, ["row_id", "text"], offsets=True))
    for row in rows:
        found = TOKENIZER.encode(row["text"] or "", add_special_tokens=False)
        starts, ends = (np.array([o[i] for o in found.offsets], "<i4") for i in (0, 1))
        assert row["offsets_sha256"] == hashlib.sha256(starts.tobytes() + ends.tobytes()).hexdigest()
        assert row["n_split"] == sum(a[1] > b[0] for a, b in zip(found.offsets, found.offsets[1:]))
        half = EXPECTED.decode_bytes(found.ids[: len(found.ids) // 2]).decode("utf-8", "replace")
        assert row["half_sha256"] == hashlib.sha256(half.encode()).hexdigest()
    assert any(row["n_split"] for row in rows)


def test_offsets_cover_the_text(spark, encoder):
    rows = collect(bpe.encode(documents(spark), encoder, ["row_id", "text"]))
    for row in rows:
        covered = set()
        for start, end in zip(row["starts"], row["ends"]):
            covered |= set(range(start, end))
        assert covered == set(range(len(row["text"] or "")))


def test_empty_table(spark, encoder):
    assert bpe.round_trip(empty(spark), encoder, ["doc_id"]).count() == 0
