"""Token counts against the library on whole texts, with chunks far smaller than the texts."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from response_ledger.llm import resync_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", "é", "1", " ", " ", "\n", "'", "s", "ll", "<|endoftext|>", "<|end", "!!", "  ", "中文"]


def texts():
    rng = random.Random(5)
    found = [
        None, "", "x" * 3000, " " * 2000 + "a", "<|endoftext|>" * 100, "don't we'll " * 200,
        "a" * 700 + "<|endo" + "ftext|>" * 20, ("word " * 50 + "<|endoftext|>") * 10, "\n" * 900 + "x\n\n  y" * 50,
    ]
    for _ in range(25):
        runs = (rng.choice(PARTS) * rng.choice([1, 1, 1, 7, 90]) for _ in range(rng.randint(1, 400)))
        found.append("".join(runs))
    return found


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 20), (400, 40)])
def test_counts_are_the_librarys(spark, chunk, overlap):
    library = Tokenizer.from_file(PATH)
    rows = [(i // 2, text, "clash") for i, text in enumerate(texts())]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = resync_counts.count_tokens(documents, PATH, chunk, overlap, limit=100)
    expected = []
    for doc_id, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 100))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_an_empty_table_and_a_wrong_overlap(spark):
    documents = spark.createDataFrame([], "doc_id long, text string")
    assert resync_counts.count_tokens(documents, PATH).collect() == []
    with pytest.raises(ValueError, match="wider"):
        resync_counts.count_tokens(documents, PATH, 10, 20)
