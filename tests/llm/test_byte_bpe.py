"""Byte-level BPE against the tiktoken library, pieces against the published pattern."""

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from response_ledger.llm import byte_bpe
from response_ledger.llm.splitting import NEWER_LETTERS, NEWER_NUMBERS, Splitter, portions

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = regex.compile(public_tokenizers.PATTERN)
SPLITTER = Splitter(columns=7)

TEXTS = [
    None, "", " ", "\n \n", "don't we'll ''s I'VE 're'st", "a  b   c \t\n d", "é中文😀́x", "x" * 3000,
    "ab" * 200 + "  　y", "<|endoftext|>!", "\x1c\x85 1Ⅷ²", "the " * 500,
]


@pytest.fixture(scope="module")
def library():
    ranks = byte_bpe.read_ranks(RANKS)
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.PieceEncoder(byte_bpe.read_ranks(RANKS))


@given(st.lists(st.text("ab1é' \n\t!Ⅷ　strelv中", max_size=60), max_size=5))
@settings(max_examples=200, deadline=None)
def test_pieces_are_the_patterns(texts):
    assert SPLITTER.pieces(texts) == [PATTERN.findall(text) for text in texts] if texts else True


def test_newer_letters_and_numbers_are_known_to_the_library(library, encoder):
    for first, last in NEWER_LETTERS + NEWER_NUMBERS:
        for code in (first, last):
            text = f"a{chr(code)}1{chr(code)} {chr(code)}"
            assert encoder.encode_texts(SPLITTER.pieces([text]))[0].tolist() == library.encode_ordinary(text)


@pytest.mark.parametrize("size", [2, 127, 128, 129, 2000])
def test_long_pieces_merge_as_short_ones(library, encoder, size):
    rng = random.Random(size)
    for letters in ("ab", "theranod", "é中x"):
        text = "".join(rng.choice(letters) for _ in range(size))
        assert encoder.encode_texts([[text]])[0].tolist() == library.encode_ordinary(text)


def test_kept_pieces_are_bounded(encoder):
    small = byte_bpe.PieceEncoder(encoder.ranks, kept=10)
    for i in range(50):
        small.encode_texts([[f"x{i}", f"y{i}"]])
        assert len(small.known) <= 12


def test_round_trip_of_a_table(spark, library):
    rows = [(i // 2, text, "clash") for i, text in enumerate(TEXTS)] + [(None, "x", None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    expected = sorted(
        (
            doc_id,
            len(ids := library.encode_ordinary(text or "")),
            hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest(),
        )
        for doc_id, text, _ in rows
        if doc_id is not None
    )
    chained = byte_bpe.decode_documents(byte_bpe.encode_documents(documents, RANKS), RANKS)
    assert chained.columns == ["doc_id", "text", "ids", "byte_ends", "decoded"]
    for decoded in (chained, byte_bpe.round_trip(documents, RANKS)):
        found = byte_bpe.digests(decoded)
        assert sorted(map(tuple, found.where("doc_id is not null").collect())) == expected
        assert found.count() == len(rows)
    assert byte_bpe.round_trip(documents.limit(0), RANKS).collect() == []


def test_offsets_are_the_ends_of_the_tokens(spark):
    documents = spark.createDataFrame([(1, "two words é")], "doc_id long, text string")
    (row,) = byte_bpe.encode_documents(documents, RANKS).collect()
    assert row["byte_ends"][-1] == len("two words é".encode()) and row["byte_ends"] == sorted(row["byte_ends"])
    assert len(row["ids"]) == len(row["byte_ends"])


def test_portions_hold_every_text_once():
    sizes = [5, 0, 100, 3, 3, 3, 50]
    cuts = portions(sizes, 10)
    assert [i for a, b in cuts for i in range(a, b)] == list(range(len(sizes))) and portions([], 10) == []
