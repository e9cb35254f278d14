"""The range coder's round trips, its checks, and the stored table against a plain count."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from response_ledger.llm import mixing_coder
from response_ledger.session import setting as session_setting

PATH = public_tokenizers.path("byte_bpe_50k.json")


@given(st.lists(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 50_256)), max_size=80), max_size=6))
@settings(max_examples=60, deadline=None)
def test_blocks_round_trip(blocks):
    arrays = [np.array(block, np.uint16) for block in blocks]
    coded = mixing_coder.encode_blocks(arrays)
    assert [one.tolist() for one in mixing_coder.decode_blocks(coded, list(map(len, blocks)))] == blocks


def test_long_and_extreme_blocks_round_trip_and_shrink():
    rng = np.random.default_rng(2)
    blocks = [
        np.full(9_000, 50_256), np.tile([7, 8, 9, 50_000], 1_500), rng.integers(0, 50_257, 5_000),
        np.minimum(rng.geometric(0.01, 5_000), 50_256),
    ]
    coded = mixing_coder.encode_blocks(blocks)
    for block, back in zip(blocks, mixing_coder.decode_blocks(coded, list(map(len, blocks)))):
        assert (block == back).all()
    assert len(coded[0]) < 300 and len(coded[1]) < 300 and len(coded[3]) < 2 * 5_000 * 0.7


def test_a_block_stands_alone():
    one, two = np.arange(100), np.arange(300, 450)
    assert mixing_coder.encode_blocks([one, two])[1] == mixing_coder.encode_blocks([two])[0]


def test_damage_is_found():
    blocks = mixing_coder.encode_blocks([np.arange(50)])
    payload = mixing_coder.pack([3], [50], blocks, [50])
    assert mixing_coder.unpack(payload) == ([3], [50], blocks, [50])
    for broken in (b"x" + payload[1:], payload[:-3] + b"abc", payload[:-1], payload + b"z"):
        with pytest.raises(ValueError, match="token ids"):
            mixing_coder.unpack(broken)


@pytest.mark.parametrize("sizes", [(50, 3, 7), (mixing_coder.SEGMENT, mixing_coder.LANES, mixing_coder.BLOCK)])
def test_stored_documents_come_back(spark, monkeypatch, sizes):
    for name, value in zip(("SEGMENT", "LANES", "BLOCK"), sizes):
        monkeypatch.setattr(mixing_coder, name, value)
    rng = random.Random(1)
    rows = [(None, None), (None, "b"), (5, "<|endoftext|>x!"), (5, ""), (2, None), (-3, "!!! hello " * 30), (9, "a" * 5000)]
    rows += [(rng.randint(10, 99), "word " * rng.randint(0, 60)) for _ in range(40)]
    library, expected, at = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0, row[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = mixing_coder.read_tokens(mixing_coder.write_tokens(documents, PATH)).collect()
    assert sorted(map(tuple, found), key=lambda row: row[1]) == expected
    assert mixing_coder.read_tokens(mixing_coder.write_tokens(documents.limit(0), PATH)).collect() == []


def test_units_give_the_ids_of_whole_texts():
    rng = random.Random(3)
    signs = [*" \n\t\r\x0b\x1c\x85\xa0\u3000\u2003ab'sltre1.,\0\u00e9\u4e2d\u0301\u180e\u200b", "<|endoftext|>", "  ", " word", "'ll"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(4_000)]
    texts += ["a" * 9_000, " " * 9_000 + "b", "ab\n" * 4_000, "x " * 3 + "\n" * 5_000]
    library, encoder = Tokenizer.from_file(PATH), mixing_coder.LibraryEncoder(PATH, kept=500)
    for i in range(0, len(texts), 100):
        for text, ids in zip(texts[i : i + 100], encoder.ids(texts[i : i + 100])):
            assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text[:80]


def test_rows_without_doc_id_are_dealt_to_many_shards(spark):
    rows = [(None, f"{i * 7919 % 4_001} text") for i in range(4_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    with_names = documents.withColumn("shard", documents.text).withColumn("start", documents.doc_id)
    with session_setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        segments = mixing_coder.write_tokens(with_names, PATH)
    assert segments.select("shard").distinct().count() > 1
    found = mixing_coder.read_tokens(segments).orderBy("start").collect()
    library = Tokenizer.from_file(PATH)
    assert [one["ids"][:-1] for one in found] == [library.encode(text).ids for _, text in sorted(rows)]


def test_new_units_reach_the_library_joined():
    encoder, library = mixing_coder.LibraryEncoder(PATH), Tokenizer.from_file(PATH)
    given_texts, real = [], encoder.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given_texts.extend(texts)
            return real.encode_batch_fast(texts, **options)

    encoder.tokenizer = Counting()
    text = " ".join(f"w{'abcdefghij'[i % 10]}{i}\u00e9, was" for i in range(2_000)) + "\n\n end"
    (ids,) = encoder.ids([text])
    assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0]
    assert len(given_texts) < 100


def test_units_end_with_their_text():
    texts = ["a\n\n", "b", "\n", "\u3000 c", "x ", " ", "y", "", "<|endoftext|>\n", "z"]
    library = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, mixing_coder.LibraryEncoder(PATH).ids(texts)):
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, 0], text


def test_groups_hold_all_segments(monkeypatch):
    monkeypatch.setattr(mixing_coder, "LANES", 4)
    segments = [(i, [0] * size) for i, size in enumerate([1, 1, 9, 2, 2, 2, 2, 1])]
    groups = list(mixing_coder._groups(iter(segments), 1))
    assert [one for group in groups for one in group] == segments and len(groups) > 1
