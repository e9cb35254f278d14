"""Measures against plain counts, shrunk host rates, verdicts."""

import random
import re
from collections import Counter

import duckdb

from response_ledger.llm import host_rules
from response_ledger.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {i + k for i, window in enumerate(windows) if seen[window] > 1 for k in range(3)}
    symbols = sum(text.count(sign) for sign in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def test_measures_against_plain_counts(spark):
    rng = random.Random(7)
    parts = ["a", "b", "é", "#*", "\n", "\x85", "\xa0", "<c>", "\t", "\x1c", "a b c\n"]
    texts = [None, "", " \n ", "x " * 5000] + [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 90))) for _ in range(150)]
    rows = [(i, text, "clash") for i, text in enumerate(texts)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = host_rules.measure(documents).select("doc_id", *host_rules.MEASURES).collect()
    assert sorted(map(tuple, found)) == [(i, *plain(text)) for i, text in enumerate(texts)]


def prose(rng, n=80):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))


def test_bad_hosts_go_and_small_ones_are_shrunk(spark):
    rng = random.Random(3)
    rows = [(i, f"good{i % 10}", prose(rng)) for i in range(400)]
    rows += [(1000 + i, "bad", prose(rng) if i % 5 == 0 else "short") for i in range(100)]
    rows += [(2000, "one", prose(rng)), (2001, None, prose(rng)), (2002, None, None), (2000, "one", prose(rng))]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = host_rules.judge(documents).collect()
    assert len(found) == len(rows)
    for row in found:
        good = len((row["text"] or "").split()) >= 50
        assert row["base_failed"] == (not good)
        assert row["kept"] == (good and row["source"] != "bad")
    rate = {row["source"]: row["host_rate"] for row in found}
    assert 0 < rate["one"] < 0.3 and rate[None] < 0.6 and 0.5 < rate["bad"] < 0.8


def test_hosts_by_the_registered_query(spark, tmp_path):
    rng = random.Random(5)
    # Books: long clean texts with a separator between chapters, beside short clean ones.
    book = lambda: "\n* * *\n".join("\n".join(prose(rng, 12) for _ in range(9)) for _ in range(9))
    rows = [(i, "books", book() if i < 60 else prose(rng)) for i in range(80)]
    rows += [(100 + i, "menus", "\n".join([prose(rng, 60)] + ["home | about"] * 3)) for i in range(80)]
    rows += [(200 + i, None if i % 2 else "blog", prose(rng)) for i in range(120)]
    documents = spark.createDataFrame(rows, "doc_id long, source string, text string")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    frame = QUERIES["op9_host_rules"](spark, str(tmp_path))
    found = {row["doc_id"]: row["kept"] for row in frame.collect()}
    assert found == {doc_id: source != "menus" for doc_id, source, _ in rows}
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    expected = connection.execute(ORACLES["op9_host_rules"])
    names = [one[0] for one in expected.description]
    assert sorted(expected.fetchall()) == sorted(tuple(row) for row in frame.select(*names).collect())


def test_empty_table(spark):
    documents = spark.createDataFrame([], "doc_id long, source string, text string")
    assert host_rules.judge(documents).collect() == []
