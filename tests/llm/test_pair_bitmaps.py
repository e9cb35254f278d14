"""Alignment of two tokenizers against a plain version on whole texts, and compressed bitmaps."""

import hashlib
import os
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from response_ledger.llm import pair_bitmaps as pb

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(rows):
    """The contract read literally: loops over whole texts and over all pairs of a group."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = pb.byte_letters()
    names = {i: bytes(letters[c] for c in t) for t, i in a.get_vocab().items() if all(c in letters for c in t)}

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    counts, found = Counter(), []
    for doc_id, text in rows:
        whole = b" " + (text or "").encode()
        left = a.encode(" " + (text or ""), add_special_tokens=False).ids
        right = b.encode(text or "")
        sides = [[names[i] for i in left], [piece(i) for i in right]]
        if not text or any(b"".join(side) != whole for side in sides):
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in sides]
        shared = sorted(set(ends[0]) & set(ends[1]))
        spans = [list(zip([0, *one], one, ids)) for one, ids in zip(ends, (left, right))]
        groups, links, i, j = [], [], 0, 0
        for end in shared:
            first = (i, j)
            while i < len(left) and spans[0][i][1] <= end:
                i += 1
            while j < len(right) and spans[1][j][1] <= end:
                j += 1
            mine, other = spans[0][first[0] : i], spans[1][first[1] : j]
            groups.append(",".join(str(t[2]) for t in mine) + "|" + ",".join(str(t[2]) for t in other))
            links += [(x[2], y[2]) for x in mine for y in other if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        found.append((doc_id, len(left), len(right), len(groups), links, digest))
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(
        (
            (doc_id, n_a, n_b, n_groups, len(links), sum(counts[x, y] == most[y] for x, y in links),
             sum(counts[one] for one in links), digest)
            for doc_id, n_a, n_b, n_groups, links, digest in found
        ), key=repr,
    )


HARD = [
    None, "", " ", "   ", "a", " a", "a ", "a  b", "\n", "a\n b", "a \n  b\t c ", "x<|endoftext|>y <s> </s> <unk> <0x41>",
    "▁", "a▁b c", "a ▁ b", "naïve 你好 \U0001f600 é", " a  b", "don't we'll I'M 's",
    "a\x00b \x1c c\x85 d", "1234567 3.14 --- ...", "ﬁ Ａ ½", "x" * 3000, " ".join(["same words again"] * 400),
    "　 a  b", "a" * 300 + " " + "b" * 300,
]


def test_against_a_plain_version(spark):
    texts = [row[0] for row in duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()]
    rows = [(i, one) for i, one in enumerate(HARD + texts)] + [(3, "a"), (None, "a  b"), (None, "a  b")]
    table = spark.createDataFrame([(*one, 1) for one in rows], "doc_id long, text string, block int").repartition(5)
    found = sorted((tuple(row) for row in pb.align(table, A, B).collect()), key=repr)
    assert found == plain(rows)


def test_few_kept_units_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pb, "BLOCK_BYTES", 300)
    monkeypatch.setattr(pb, "PORTION", 50)
    monkeypatch.setattr(pb, "KEPT_CHARS", 4)
    aligner = pb.Aligner(A, B, kept=3)
    rows = [(i, one) for i, one in enumerate(HARD)]
    stats, digests, places, codes = zip(*(aligner.align([text or ""]) for _, text in rows + rows))
    expected = {one[0]: one for one in plain(rows)}
    for (doc_id, _), one, digest in zip(rows + rows, stats, digests):
        assert (*one[0].tolist(), digest[0]) == (*expected[doc_id][1:5], expected[doc_id][7])


def test_units_that_came_again_outlive_a_full_cache():
    aligner = pb.Aligner(A, B, kept=8)
    texts = ["the cat sat", "the cat ran", "unit after unit fills it up", "the cat fills 你好"]
    found = [aligner.align([text]) for text in texts[:3]]
    assert {"the", "cat"} <= set(aligner.index) and "sat" not in aligner.index
    found.append(aligner.align(texts[3:]))
    for text, (stats, digests, _, codes) in zip(texts, found):
        whole = pb.Aligner(A, B).align([text])
        assert (stats == whole[0]).all() and digests == whole[1] and (codes == whole[3]).all()


def test_units_joined_for_the_library_have_the_ids_they_have_alone(monkeypatch):
    units = [*dict.fromkeys(unit for text in HARD if text for unit in [*pb.units_of(text), text])]
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    expected = [library.encode(" " + unit, add_special_tokens=False).ids for unit in units]
    aligner = pb.Aligner(A, B)
    for joined in (1, 5, 512):
        monkeypatch.setattr(pb, "JOINED_UNITS", joined)
        ids, sizes = aligner.first_library(units, [b" " + unit.encode() for unit in units])
        assert [one.tolist() for one in np.split(ids, np.cumsum(sizes)[:-1])] == expected


def test_scores_over_blocks_and_planes(spark, monkeypatch):
    monkeypatch.setattr(pb, "BLOCK_BYTES", 2000)
    rows = [(i, " ".join(["the cat sat"] * (1 + i % 37)) + " unbelievably" * (i % 3)) for i in range(700)]
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    assert sorted((tuple(row) for row in pb.align(table, A, B).collect()), key=repr) == plain(rows)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_bitmaps_pack_and_unpack():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 255, 256, 257, 4096, 0, 3]
    containers = np.repeat(np.arange(len(sizes)), sizes)
    places = np.concatenate([np.sort(rng.permutation(pb.BLOCK_DOCS)[:n]) for n in sizes])
    column = pb.packed(containers, places, len(sizes))
    assert [len(one) for one in column.to_pylist()] == [0, 2, 510, 512, 512, 512, 0, 6]
    for some in (column, column.slice(2, 5)):
        found = sorted(zip(*(one.tolist() for one in pb.unpacked(some))))
        first = 0 if some is column else 2
        assert found == [(c - first, p) for c, p in zip(containers.tolist(), places.tolist()) if 0 <= c - first < len(some)]
    assert pb.unpacked(pa.array([], pa.binary()))[0].tolist() == []


def test_empty_table(spark):
    assert pb.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


@pytest.mark.parametrize("text", HARD[1:])
def test_units_join_to_the_text(text):
    assert "".join(" " + unit for unit in pb.units_of(text)) == " " + text
