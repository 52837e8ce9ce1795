"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A text is cut into matches of the pattern; each distinct match goes once through the library's
model, spelled with one character per byte, and its ids and offsets are looked up from then on.

A rank file lists byte strings in the order in which they may be merged. The library wants
text, so each byte stands for one printable character (the byte alphabet), and each merge
names its two parts: they are what merging by the lower ranks leaves of the token. Decoding
goes back through the alphabet to bytes; a character whose bytes lie in several tokens is
whole again once those tokens are joined, and ``decode_text`` marks one that stays cut.

Defined cases: a null or empty text has no ids; every character takes part; special tokens
are never used; identical rows are encoded alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from paperloom.llm.common import whole_text

UNITS_AT_ONCE = 500_000
WORDS_AT_ONCE = 100_000
KNOWN_WORDS = 150_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def byte_alphabet() -> list[str]:
    """The character of each byte: itself where it is printable Latin-1, else the next free
    one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


def merge_parts(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What is left of ``token`` after all merges of a lower rank than its own."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 1:
        joined = [ranks.get(a + b, limit) for a, b in zip(parts, parts[1:])]
        least = min(joined)
        if least >= limit:
            break
        at = joined.index(least)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def build_tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """Text that is one token as a whole is taken as such, also where merges don't reach it."""
    alphabet = byte_alphabet()

    def spell(token: bytes) -> str:
        return "".join(alphabet[b] for b in token)

    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            parts = merge_parts(token, ranks)
            if len(parts) == 2:
                merges.append((spell(parts[0]), spell(parts[1])))
    vocabulary = {spell(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer


def token_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """The bytes of each id, by the reversed alphabet."""
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    vocabulary = tokenizer.get_vocab()
    pieces = [b""] * (max(vocabulary.values()) + 1)
    for spelled, number in vocabulary.items():
        pieces[number] = bytes(byte_of[c] for c in spelled)
    return pieces


def decode_bytes(ids: list[int], pieces: list[bytes]) -> bytes:
    return b"".join([pieces[i] for i in ids])


def decode_text(ids: list[int], pieces: list[bytes]) -> str:
    """A character of which only some bytes are there becomes the replacement character."""
    return decode_bytes(ids, pieces).decode("utf-8", "replace")


def _lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists), pa.int32()))


def _slices(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of about ``UNITS_AT_ONCE`` units; a longer row comes alone."""
    start, ends = 0, np.cumsum(sizes.to_numpy(zero_copy_only=False))
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + UNITS_AT_ONCE, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class WordCoder:
    """Codes matches of the pattern one by one with the library's model, and keeps what it has
    coded up to a bound: words come again and again."""

    def __init__(self, tokenizer: Tokenizer, pattern: str) -> None:
        self.model = tokenizer.model
        self.pieces = token_bytes(tokenizer)
        self.pattern = regex.compile(pattern)
        self.spelling = dict(enumerate(byte_alphabet()))
        self.lengths = np.array([len(piece) for piece in self.pieces])
        self.known: dict[str, bytes] = {}

    def code(self, word: str) -> bytes:
        """Ids of one match as bytes of int32. The model sees one character per byte."""
        spelled = word.encode().decode("latin-1").translate(self.spelling)
        return array("i", [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def _words(self, text: str) -> Iterator[list[str]]:
        if len(text) <= UNITS_AT_ONCE:
            yield self.pattern.findall(text)
            return
        found = (match.group() for match in self.pattern.finditer(text))
        while some := list(islice(found, WORDS_AT_ONCE)):
            yield some

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        parts = []
        for words in self._words(text):
            if len(self.known) > KNOWN_WORDS:
                self.known.clear()
            for word in set(words).difference(self.known):
                self.known[word] = self.code(word)
            parts.append(b"".join(map(self.known.__getitem__, words)))
        return np.frombuffer(b"".join(parts), np.int32)

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, ends) of the characters of which each token has bytes."""
        lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        char_of = np.cumsum(lead) - 1
        ends = np.cumsum(self.lengths[ids])
        starts = ends - self.lengths[ids]
        return char_of[starts].astype(np.int32), (char_of[ends - 1] + 1).astype(np.int32)


_coders: dict[str, WordCoder] = {}


class Encoder:
    """A tokenizer as a broadcast string (its size is that of the vocabulary), from which each
    worker process builds its coder once."""

    def __init__(self, spark: SparkSession, path: str, pattern: str) -> None:
        self._name = f"{path} {pattern}"
        self._pattern = pattern
        self._text = spark.sparkContext.broadcast(build_tokenizer(load_ranks(path), pattern).to_str())

    def coder(self) -> WordCoder:
        if self._name not in _coders:
            _coders[self._name] = WordCoder(Tokenizer.from_str(self._text.value), self._pattern)
        return _coders[self._name]


# Digests of what the offsets say: of all starts, then all ends, as little-endian int32; how many tokens begin
# inside a character; and of the text that the first half of the tokens, rounded down, decodes to.
DIGESTS = {"offsets_sha256": "string", "n_split": "long", "half_sha256": "string"}


def _digests(coder: WordCoder, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[str, int, str]:
    half = decode_text(ids[: len(ids) // 2], coder.pieces).encode()
    split = int(np.count_nonzero(starts[1:] < ends[:-1]))
    return hashlib.sha256(starts.tobytes() + ends.tobytes()).hexdigest(), split, hashlib.sha256(half).hexdigest()


def encode(docs: DataFrame, encoder: Encoder, keep: list[str], offsets: bool = True, digests: bool = False) -> DataFrame:
    """``keep`` columns and ``ids`` of every whole text; with ``offsets`` also ``starts`` and
    ``ends``, the characters that each token covers (all of a character of which it has some
    bytes), or, with ``digests``, the ``DIGESTS`` in their place."""
    rows = docs.select(F.struct(*keep).alias("kept"), whole_text().alias("text"))
    schema = rows.schema["kept"].dataType
    arrays = ["ids", "starts", "ends"] if offsets and not digests else ["ids"]
    names = ["kept", *arrays, *(DIGESTS if digests else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder.coder()
        for batch in batches:
            for part in _slices(batch, pc.utf8_length(batch.column(1))):
                texts = part.column(1).to_pylist()
                found = [(coder.encode(text),) for text in texts]
                if offsets:
                    found = [(ids, *coder.offsets(text, ids)) for text, (ids,) in zip(texts, found)]
                columns = list(zip(*found))
                if digests:
                    said = zip(*[_digests(coder, *row) for row in found])
                    columns = [_lists(columns[0]), *[pa.array(c) for c in said]]
                else:
                    columns = [_lists(c) for c in columns]
                yield pa.record_batch([part.column(0), *columns], names)

    types = dict.fromkeys(arrays, "array<int>") | (DIGESTS if digests else {})
    out = ", ".join(f"{name} {kind}" for name, kind in {"kept": schema.simpleString(), **types}.items())
    return rows.mapInArrow(run, out).select("kept.*", *names[1:])


def decode_lists(ids: pa.Array, pieces: pa.Array) -> pa.Array:
    """The bytes of each list of ids: pieces are taken by id, and the borders of the lists
    become the borders of the results."""
    taken = pieces.take(ids.flatten())
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(taken).to_numpy(zero_copy_only=False))])
    borders = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))])
    places = pa.array(ends[borders].astype(np.int64))
    data = pa.py_buffer(b"".join(taken.to_pylist())) if taken.offset else taken.buffers()[2]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, places.buffers()[1], data]).cast(pa.binary())


def decode(encoded: DataFrame, encoder: Encoder, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``decoded``, the bytes of ``ids``."""
    rows = encoded.select(F.struct(*keep).alias("kept"), "ids")
    schema = rows.schema["kept"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(encoder.coder().pieces, pa.binary())
        for batch in batches:
            for part in _slices(batch, pc.list_value_length(batch.column(1))):
                decoded = decode_lists(part.column(1), pieces)
                yield pa.record_batch([part.column(0), decoded], ["kept", "decoded"])

    return rows.mapInArrow(run, f"kept {schema.simpleString()}, decoded binary").select("kept.*", "decoded")


def round_trip(docs: DataFrame, encoder: Encoder, keep: list[str], offsets: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids, ids_sha256 and decoded_sha256 of every text; with ``offsets``
    also the ``DIGESTS``."""
    encoded = encode(docs, encoder, keep, offsets, digests=offsets)
    digests = list(DIGESTS) if offsets else []
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    summed = encoded.select(
        *keep,
        *digests,
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
    )
    keep_all = [*keep, *digests, "ids", "n_tokens", "ids_sha256"]
    decoded = decode(summed, encoder, keep_all)
    return decoded.select(*keep_all, F.sha2("decoded", 256).alias("decoded_sha256"))
