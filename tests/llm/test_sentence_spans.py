"""Sentence spans against a plain version that keeps every run in a dictionary."""

import random
import re

import xxhash

from response_ledger.llm import sentence_spans

SPACE = r"[^ \t\n\x0b\x0c\r]+"


def sentences(text):
    words = [match.span() for match in re.finditer(SPACE, text)]
    starts, new = [], True
    for i, (a, b) in enumerate(words):
        if new:
            starts.append(i)
        tail = re.search(r"[^A-Za-z0-9\x80-\U0010ffff]*$", text[a:b]).group()
        after = words[i + 1][0] if i + 1 < len(words) else len(text)
        new = any(mark in tail for mark in ".!?,;:|") or "\n" in text[b:after]
    return words, starts


def digest(text):
    """The signed hash Spark has of a text, which orders rows that share a doc_id."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def expected(rows, run=sentence_spans.RUN, least=sentence_spans.RUN_WORDS):
    known, first = [], {}
    for i, (doc_id, text) in enumerate(rows):
        if text is None:
            known.append(None)
            continue
        words, starts = sentences(text)
        bounds = [*starts, len(words)]
        lower = [re.sub("[A-Z]", lambda m: m.group().lower(), text[a:b]) for a, b in words]
        runs = []
        if len(starts) < run:
            runs = [(0, len(starts))] if len(words) >= least else []
        else:
            for a in range(len(starts) - run + 1):
                b = a + run
                while b <= len(starts) and bounds[b] - bounds[a] < least:
                    b += 1
                if b <= len(starts):
                    runs.append((a, b))
        keyed = {(a, b): tuple(lower[bounds[a] : bounds[b]]) for a, b in runs}
        known.append((text, words, starts, keyed))
        for (a, _), key in keyed.items():
            place = (doc_id is not None, doc_id or 0, digest(text), a)
            first[key] = min(first.get(key, place), place)
    found = []
    for (doc_id, _), one in zip(rows, known):
        if one is None:
            found.append((doc_id, None, 0, 0, 0))
            continue
        text, words, starts, keyed = one
        gone = set()
        for (a, b), key in keyed.items():
            if first[key] != (doc_id is not None, doc_id or 0, digest(text), a):
                gone.update(range(a, b))
        cuts = [0, *(words[i][0] for i in starts[1:]), len(text)]
        kept = "".join(text[cuts[i] : cuts[i + 1]] for i in range(len(starts)) if i not in gone)
        found.append((doc_id, kept if gone else text, len(starts), len(gone), len(gone)))
    return sorted(found, key=repr)


def test_spans_against_the_plain_version(spark):
    rng = random.Random(4)
    parts = ["a", "b.", "c,", "!", "\n", "d e", "|", "é.", "x;y", "  ", " \t"]
    rows = [
        (None, "a. " * 20), (None, None), (1, None), (2, ""), (3, "   "), (3, "a b c d e f g h i j k l m"),
        (4, "A b c d e f g h i j k l m"), (5, "a b c."), (5, "a b c."), (6, "q " * 30_000 + "end."),
    ]
    rows += [(rng.randint(7, 60), " ".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for _ in range(200)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = sentence_spans.without_repeats(documents).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)


def test_a_pasted_passage_goes_from_all_but_the_first(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    prose = lambda n: " ".join(word() + (", " if i % 7 == 3 else ". " if i % 11 == 5 else "") for i in range(n))
    passage = prose(60)
    rows = [(i, f"{prose(40)} {passage} {prose(40)}", "x") for i in range(30)]
    rows += [(100 + i, prose(80), "x") for i in range(30)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n_removed string")
    clean = {row["doc_id"]: row for row in sentence_spans.without_repeats(documents).collect()}
    middle = " ".join(passage.split()[15:45])
    assert [i for i in clean if middle in " ".join(clean[i]["text"].split())] == [0]
    assert all(clean[100 + i]["text"] == rows[30 + i][1] for i in range(30))


def test_of_rows_without_an_id_one_is_first(spark):
    rng = random.Random(12)
    passage = ". ".join(" ".join(rng.choice("abcdefgh") + str(rng.randint(0, 99)) for _ in range(20)) for _ in range(4)) + "."
    rows = [(None, f"{passage} tail {i} of its own here.") for i in range(3)] + [(7, passage + " one."), (7, passage + " two.")]
    frame = spark.createDataFrame([(*row, 5, "x") for row in rows], "doc_id long, text string, places int, hashes string")
    found = sentence_spans.without_repeats(frame).collect()
    assert len(found) == 5 and sum(passage in row["text"] for row in found) == 1
    assert {(row["places"], row["hashes"]) for row in found} == {(5, "x")}
    assert sorted(row["n_removed"] for row in found) == [0, 4, 4, 4, 4]
    assert all(row["n_in_spans"] == row["n_removed"] for row in found)
    own = spark.createDataFrame([(*row, 9) for row in rows], "doc_id long, text string, n_removed int")
    assert {row["n_removed"] for row in sentence_spans.cleaned_documents(own).collect()} == {9}


def test_emptied_documents_go_and_empty_tables_stay(spark):
    text = "one two three, four five six, seven eight nine, ten eleven twelve."
    documents = spark.createDataFrame([(1, text), (2, text), (3, ""), (4, None)], "doc_id long, text string")
    assert sorted(row["doc_id"] for row in sentence_spans.cleaned_documents(documents).collect()) == [1, 3, 4]
    assert sentence_spans.without_repeats(documents.limit(0)).collect() == []


def test_rows_that_share_an_id_or_have_none_lose_their_own_repeats(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    prose = lambda n: " ".join(word() + (". " if i % 6 == 5 else "") for i in range(n))
    passages = [prose(30) for _ in range(4)]
    rows = [(1, " ".join(passages))]
    rows += [(5, f"{passage} {prose(30)}") for passage in passages[:2]]
    rows += [(5, rows[1][1])] * 3
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = sentence_spans.without_repeats(documents).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)
    assert sorted(row["n_removed"] for row in found) == [0] + [5] * 5
    # Rows without id come before all others; the passages stand in them at different places.
    rows = [(None, f"{passages[0]} {passages[1]} {prose(30)} {passages[0]} {prose(30)}")]
    rows += [(None, f"{prose(30)} {prose(30)} {prose(30)} {passages[1]}"), (7, "x")]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = sentence_spans.without_repeats(documents).collect()
    assert sorted(map(tuple, found), key=repr) == expected(rows)
    # Of the rows without id the one with the lesser digest is first as a whole.
    assert sorted(row["n_removed"] for row in found) == [0, 0, 10]


def test_passages_of_any_shape_go(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    plain = lambda n: " ".join(word() for _ in range(n))
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(n))
    # Each passage, with its middle, which has to go, and surroundings that differ from row to row.
    one, two = plain(60), f"{plain(30)}, {plain(30)}"
    parts = f"{plain(16)}, {plain(20)}, {plain(16)}"
    four = f"{plain(13)}; {plain(13)}; {plain(13)}; {plain(13)}"
    chinese = "。".join(han(14) for _ in range(5))
    unmarked, unmarked_chinese, arabic = plain(70), han(70), "، ".join(plain(13) for _ in range(5))
    cases = [
        (f"{one}.", one, lambda t: f"{plain(8)}. {t} {plain(9)}."),
        (f"{two}.", two, lambda t: f"{plain(8)}. {t} {plain(9)}."),
        (parts, parts.split(", ")[1], lambda t: f"{plain(5)} {t} {plain(5)}."),
        (four, four[100:250], lambda t: f"{plain(5)} {t} {plain(5)}."),
        (unmarked, " ".join(unmarked.split()[20:50]), lambda t: f"{plain(300)} {t} {plain(300)}"),
        (chinese, chinese[20:50], lambda t: f"{han(30)}{t}{han(40)}。"),
        (unmarked_chinese, unmarked_chinese[20:50], lambda t: f"{han(200)}{t}{han(200)}"),
        (arabic, arabic[150:300], lambda t: f"{plain(5)} {t} {plain(5)}"),
    ]
    rows, middles = [], {}
    for n, (passage, middle, around) in enumerate(cases):
        for i in range(3):
            rows.append((10 * n + i, around(passage)))
            middles[10 * n + i] = middle
    # Short documents that stand whole inside longer ones.
    for n, whole in ((100, f"{plain(55)}."), (110, f"{plain(30)}. {plain(25)}.")):
        rows += [(n, f"{plain(9)}. {whole} {plain(9)}, {plain(4)}, {plain(3)}."), (n + 1, whole)]
        middles |= {n: whole, n + 1: whole}
    unique = [(200 + i, plain(200)) for i in range(5)]
    documents = spark.createDataFrame(rows + unique, "doc_id long, text string")
    clean = {row["doc_id"]: row for row in sentence_spans.without_repeats(documents).collect()}
    assert [i for i in middles if middles[i] in clean[i]["text"]] == [i for i in middles if i % 10 == 0]
    assert all(clean[i]["text"] == text and clean[i]["n_removed"] == 0 for i, text in unique)
    for i, text in rows:
        if i % 10 == 0:
            assert clean[i]["text"] == text
        else:
            # Nothing of the surroundings goes but what is fused with a part of the passage.
            assert len(clean[i]["text"]) >= len(text) - len(cases[i // 10][0] if i < 100 else text) - 1
