"""The pipeline against plain versions of its stages, one after another."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from response_ledger.llm import byte_bpe, fair_mix, host_rules

from . import test_fair_mix, test_host_rules, test_odd_sketch, test_sentence_spans

SF_DIR = "/root/testdata/sf0.001"


def test_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    rows = {row["doc_id"]: row for row in docs.collect()}
    stages = [stage for _, stage in corpus_pipeline.STAGES]

    # Every host of this table is far below the limit, so the base rules decide.
    measured = {i: test_host_rules.plain(row["text"]) for i, row in rows.items()}
    good = {i for i, (n, _, _, _, repeated, _) in measured.items() if n >= host_rules.MIN_WORDS and 100 * repeated <= 50 * n}
    kept = stages[0](spark, docs, SF_DIR)
    assert kept.columns == columns and {row["doc_id"] for row in kept.collect()} == good

    texts = sorted((i, rows[i]["text"]) for i in good)
    alone = {one[0] for one in test_odd_sketch.brute(texts, 5, 80) if one[3]}
    kept = stages[1](spark, kept, SF_DIR)
    assert kept.columns == columns and {row["doc_id"] for row in kept.collect()} == alone

    clean = {one[0]: one[1] for one in test_sentence_spans.expected([one for one in texts if one[0] in alone])}
    clean = {i: text for i, text in clean.items() if text.strip(" ")}
    kept = stages[2](spark, kept, SF_DIR)
    assert kept.columns == columns and {row["doc_id"]: row["text"] for row in kept.collect()} == clean

    mixed = test_fair_mix.expected([(i, rows[i]["source"], text) for i, text in clean.items()])
    wanted = sorted(i for i, size, _, _, taken in mixed if size for _ in range(taken // size))
    kept = stages[3](spark, kept, SF_DIR)
    assert kept.columns == columns and sorted(row["doc_id"] for row in kept.collect()) == wanted

    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = []
    for i in wanted:
        ids = library.encode_ordinary(clean[i])
        digests = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), clean[i].encode())]
        expected.append((i, len(ids), *digests))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect())) == expected


@pytest.mark.parametrize("rows", [0, 3])
def test_stages_bear_nulls_and_empty_tables(spark, rows):
    some = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "word " * 60, None, "a", 300)]
    docs = spark.createDataFrame(some[:rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("kept", fair_mix.F.lit("x")).withColumn("size", fair_mix.F.lit("y"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
