import json
import random
import re
from html import unescape
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from response_ledger.functions.text import (
    SPACES,
    decode_entities,
    inline_elements,
    normalize_space,
    resolve_link,
    sentence_columns,
    spec_link,
    split_columns,
)
from response_ledger.operators.vocabulary import (
    documented_columns,
    heading_columns,
    vocabulary,
    vocabulary_errors,
)
from response_ledger.sources.documents import read_documents


def values(spark, texts, expression):
    frame = spark.createDataFrame([(i, one) for i, one in enumerate(texts)], "i int, t string")
    return [one["x"] for one in frame.select("i", expression(F.col("t")).alias("x")).orderBy("i").collect()]


def elements(spark, *texts):
    return [[tuple(one) for one in found] for found in values(spark, texts, inline_elements)]


def test_elements_keep_document_order(spark):
    (found,) = elements(
        spark, "Start <b>One &#9679; </b> between <i>x, y &lt; z</i><b>Two</b>, <i>w</i> end"
    )
    assert found == [("b", "One ● "), ("i", "x, y < z"), ("b", "Two"), ("i", "w")]


def test_elements_of_odd_markup(spark):
    found = elements(
        spark,
        "<b>lost <i>kept</b> on</i>",
        "<B class='a>b'>x <u>y</u>&amp;z</B >",
        "<i/>after<br><b>open",
        "<b title=it's>don't</b><i a = 'x>y' b=\">\">u <a href='>'>v</a></i>",
        "<b " + "a='>' " * 20_000 + ">end</b>",
        "<!-- <b>no</b> --><base><i>1 < 2</i><img>",
        "",
        "<b></b><script>'<b>no</b>'</script>",
        "<i>a</i><style-x><i>b</i><style>x</style><i>c</i><script><i>d</i>",
        "<i>a</i><!-- <i>b</i>" + "<!-- <i>b</i>" * 50_000,
    )
    assert found == [
        [("i", "kept on")],
        [("b", "x y&z")],
        [("i", "")],
        [("b", "don't"), ("i", "u v")],
        [("b", "end")],
        [("i", "1 < 2")],
        [],
        [("b", "")],
        [("i", "a"), ("i", "b"), ("i", "c")],
        [("i", "a")],
    ]


def test_elements_against_a_token_walk(spark):
    rng = random.Random(5)
    tokens = ["<b>", "</b>", "<i>", "</i>", "<u>", "</u>", "x", " ", "&amp;", "<I>", "</I>", "<br/>", "y,"]
    texts = ["".join(rng.choice(tokens) for _ in range(rng.randint(0, 14))) for _ in range(3000)]

    def walk(text):
        found, current, gathered = [], None, ""
        for token in re.findall(r"<[^>]*>|[^<]+", text):
            name = token.strip("</>").lower()
            if not token.startswith("<"):
                gathered += token
            elif name in ("b", "i") and not token.startswith("</"):
                current, gathered = name, ""
            elif name == current:
                found.append((name, unescape(gathered)))
                current = None
        return found

    assert elements(spark, *texts) == [walk(one) for one in texts]


def test_long_texts_are_read_whole(spark):
    names = ", ".join(f"Column{one}" for one in range(50_000))
    (found,) = elements(spark, f"<p>{'<u>z</u>' * 20_000}<i>{names}</i>")
    assert found == [("i", names)]


def test_entities_and_space_match_the_standard_library(spark):
    rng = random.Random(1)
    parts = [
        "&", "amp;", "&amp;", "&lt", "&notit;", "&#65;", "&#x41;", "&#0;", "&#128;", "&#x9f;", "&#x81;",
        "&#xD800;", "&#1114112;", "&#99999999999999999999;", "&#11;", "&#xFFFE;", "&#x1F600;", "&#13;",
        "&eacute;", "&eacute", "&unknown;", "x", " ", "&#", "&#x", "&copy2", "&NotEqualTilde;", ";",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    assert values(spark, texts, decode_entities) == [unescape(one) for one in texts]
    parts = [*SPACES, *",,,,,,", "a", "B", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)]
    assert values(spark, texts, normalize_space) == [" ".join(one.split()) for one in texts]
    assert values(spark, texts, split_columns) == [
        [name.strip().lower() for name in one.split(",") if name.strip()] for one in texts
    ]


def test_sentences(spark):
    found = values(
        spark,
        [
            "Gets it in JSON format including the following columns:  centercd, ProductTypeShortTxt.\n",
            "Gets nothing in particular.",
            "the following columns:a",
            "following columns: .",
        ],
        sentence_columns,
    )
    assert found == [["centercd", "producttypeshorttxt"], [], ["a"], []]


def lists(spark, fragment, **headings):
    frame = spark.createDataFrame([(fragment,)], "description string")
    return [tuple(one) for one in heading_columns(frame, headings).first()["lists"]]


def test_heading_lists(spark):
    assert lists(spark, "<b> Order\n by</b>: <i>CenterCd ,  Rid,PHASETXT </i> <i>more</i>", sort="Order by") == [
        ("sort", ["centercd", "rid", "phasetxt"], None)
    ]


@pytest.mark.parametrize(
    "fragment, heading, error",
    [
        ("<b>One</b><i>x</i>", "Two", "occurs 0 times"),
        ("<b>One</b><i>x</i><b> One</b><i>y</i>", "One", "occurs 2 times"),
        ("<i>x</i><b>One</b> and no more", "One", "no list behind"),
    ],
)
def test_heading_errors(spark, fragment, heading, error):
    ((_, columns, found),) = lists(spark, fragment, role=heading)
    assert columns is None and error in found


def test_spec_links(spark):
    pages = ['<script>url = "a.html"; var url = "src/main/spec.json"; url="b.json"</script>', "x = 'a.json'"]
    assert values(spark, pages, spec_link) == ["src/main/spec.json", None]


def test_spec_links_in_scripts_of_all_kinds(spark):
    cases = {
        # Quotes that do not match, or are escaped, belong to the string.
        "<script>url = \"a.json'; url = 'b.json'</script>": None,
        "<script>url = \"a'b.json\"</script>": "a'b.json",
        "<script>url = 'a\\'b.json'</script>": "a'b.json",
        '<script>url = "src\\/main\\/x.json"</script>': "src/main/x.json",
        "<script>url=`t.json`</script>": "t.json",
        # Comments assign nothing, and no comment begins inside a string.
        "<script>// url = 'a.json'\nurl = 'b.json'</script>": "b.json",
        "<script>/* url = 'a.json';\n */ url = 'http://h/b.json'</script>": "http://h/b.json",
        "<script>url = '/*c.json'; x = '*/'; url = 'd.json'</script>": "/*c.json",
        "<script>x = \"url = 'a.json'\"; url = 'b.json'</script>": "b.json",
        # Other names, comparisons and other values.
        "<script>specurl = 'a.json'; my_url='b.json'; url2 = 'c.json'; $url = 'd.json'</script>": None,
        "<script>if (url == 'a.json') { window.url = 'b.json' }</script>": "b.json",
        "<script>url = f('a.json'); url = 'b.html'; url\n =\n'c.json'</script>": "c.json",
        # Scripts only, the first of them first.
        "<p>url = 'a.json'</p><SCRIPT type=x>var u</script><script>url = 'b.json'</script>": "b.json",
        "<script>url = 'a.js</script>on'": None,
        "<scripts>url = 'a.json'</scripts>": None,
        "<script>url = 'a" + "x" * 100_000 + ".json'": "a" + "x" * 100_000 + ".json",
    }
    assert values(spark, list(cases), spec_link) == list(cases.values())


def test_links_are_resolved(spark):
    links = {
        "src/x.json": "https://h.example/docs/src/x.json",
        "/x.json": "https://h.example/x.json",
        "../x.json": "https://h.example/x.json",
        "./a/../x.json": "https://h.example/docs/x.json",
        "//o.example/x.json": "https://o.example/x.json",
        "http://o.example/x.json": "http://o.example/x.json",
    }
    for page in ("https://h.example/docs/", "https://h.example/docs/index.html?a=/b#/c"):
        found = values(spark, list(links), lambda link: resolve_link(F.lit(page), link))  # noqa: B023
        assert found == list(links.values())


SPEC = {
    "paths": {
        "/recalls/": {
            "post": {
                "description": "<b>Display columns</b> <i>ProductId, rid, codeinformation</i>"
                "<b>Sort </b>- <i>productid</i><b>Filter</b> <i>eventlmdfrom, eventlmdto</i>"
            },
            "parameters": [{"in": "body"}],
        },
        "/search/producttypes": {
            "get": {"description": "Lists the following columns: centercd, producttypeshorttxt.\n"}
        },
        "/recalls/product/{productid}": {"get": {"description": "No list here."}},
    }
}


def test_vocabulary(spark, tmp_path):
    (tmp_path / "spec.json").write_text(json.dumps(SPEC, indent=4))
    specs = read_documents(spark, str(tmp_path / "spec.json"))
    rows = vocabulary(specs).orderBy("request_type", "role", "ordinal").collect()
    found = {}
    for one in rows:
        found.setdefault((one["request_type"], one["role"]), []).append(one["column"])
    assert found == {
        ("PRODUCT_TYPES", "display"): ["centercd", "producttypeshorttxt"],
        ("RECALLS", "display"): ["productid", "rid", "codeinformation"],
        ("RECALLS", "filter"): ["eventlmdfrom", "eventlmdto"],
        ("RECALLS", "sort"): ["productid"],
    }
    assert vocabulary_errors(specs).count() == 6
    assert documented_columns(specs, "RECALLS") == ["productid", "rid", "codeinformation"]
    assert documented_columns(specs, "PRODUCT") == []
    assert documented_columns(specs, "PRODUCT_TYPES", "sort") == []
    with pytest.raises(ValueError, match="more than one"):
        documented_columns(specs.union(specs), "RECALLS")
    with pytest.raises(ValueError, match="not in the spec"):
        documented_columns(specs, "EVENT")


def test_an_unknown_endpoint_is_an_error(spark):
    specs = spark.createDataFrame([("{}",)], "text string")
    with pytest.raises(ValueError, match="TYPO"):
        documented_columns(specs, "TYPO")


def test_landed_documents_come_back_and_are_linked(spark):
    from response_ledger.session import scratch_path
    from response_ledger.sources.documents import land_documents, linked_specs, read_landed

    rows = [
        ("https://a.example/x/index.html?q=1&r=%2F", "<script>url = '../s.json';</script>\n\n"),
        ("https://a.example/s.json", "{}\n"),
        ("https://a.example/lost.html", "<script>url = 'gone.json';</script>"),
        ("https://a.example/empty", ""),
        ("https://a.example/twice", "1"),
        ("https://a.example/twice", "2\r\n3"),
        (None, "no address"),
    ]
    path = scratch_path(spark, "documents")
    frame = spark.createDataFrame(rows, "url string, text string")
    land_documents(frame.limit(4), path)
    land_documents(frame.offset(4).union(spark.createDataFrame([("https://a.example/null", None)], frame.schema)), path)
    landed = read_landed(spark, path)
    found = sorted(map(tuple, landed.collect()), key=repr)
    assert found == sorted([*rows, ("https://a.example/null", "")], key=repr)
    assert sorted(map(tuple, linked_specs(landed).collect())) == [
        ("https://a.example/lost.html", "https://a.example/gone.json", None),
        ("https://a.example/x/index.html?q=1&r=%2F", "https://a.example/s.json", "{}\n"),
    ]


def test_documents_of_one_task_are_landed_by_many(spark, tmp_path):
    from response_ledger.sources.documents import land_documents, read_landed

    rows = [(f"https://a.example/{one}", f"text {one}") for one in range(40)]
    land_documents(spark.createDataFrame(rows, "url string, text string").coalesce(1), str(tmp_path))
    files = [one.name for one in tmp_path.rglob("part-*.txt")]
    assert len(files) == 40 and len({name.split("-")[1] for name in files}) > 1
    assert sorted(map(tuple, read_landed(spark, str(tmp_path)).collect())) == sorted(rows)


def odd_documents(spark):
    rows = [(f"https://a.example/{chr(one)}x{one}", f"{chr(one)}\n") for one in range(1, 128)]
    rows += [("", "no address"), (None, None), ("%41", "\r\n"), (".", "1"), ("..", "2"), ("a=b", ""), ("c d", "\n\n")]
    rows += [("https://a.example/often", f"{one % 3}") for one in range(40)]
    rows += [("https://a.example/long", "é" * length) for length in (255, 256, 700_000)]
    return spark.createDataFrame(rows, "url string, text string")


def test_documents_are_landed_and_read_as_by_spark(spark, tmp_path):
    from response_ledger.sources.documents import land_documents, read_landed

    documents, mine, sparks = odd_documents(spark), str(tmp_path / "my own %41"), str(tmp_path / "sparks")
    for _ in range(2):
        land_documents(documents, mine)
        documents.withColumnRenamed("text", "value").write.mode("append").partitionBy("url").option(
            "maxRecordsPerFile", 1
        ).text(sparks)

    def bodies(path):
        files = [one for one in Path(path).rglob("*") if one.is_file() and one.name != "._SUCCESS.crc"]
        return sorted((one.parent.name if "url=" in str(one) else one.name, one.read_bytes()) for one in files)

    assert bodies(mine) == bodies(sparks) and len(bodies(mine)) == 4 * documents.count() + 1
    by_spark = spark.read.schema("value string, url string").text(sparks, wholetext=True)
    expected = sorted(((one["url"], one["value"].removesuffix("\n")) for one in by_spark.collect()), key=repr)
    assert sorted(map(tuple, read_landed(spark, mine).collect()), key=repr) == expected
    assert sorted(map(tuple, read_landed(spark, sparks).collect()), key=repr) == expected
    by_spark = spark.read.schema("value string, url string").text(mine, wholetext=True)
    assert sorted(((one["url"], one["value"].removesuffix("\n")) for one in by_spark.collect()), key=repr) == expected


def test_stores_that_are_not_local_are_left_to_spark(spark, tmp_path, monkeypatch):
    from response_ledger.sources import documents as module

    monkeypatch.setattr(module, "_local_folder", lambda spark, path: None)
    rows = [("https://a.example/1", "1"), ("https://a.example/1", "1"), ("https://a.example/2", "")]
    module.land_documents(spark.createDataFrame(rows, "url string, text string"), str(tmp_path))
    assert sorted(map(tuple, module.read_landed(spark, str(tmp_path)).collect())) == rows


def test_landing_starts_no_process_for_each_file(spark, tmp_path):
    from response_ledger.sources.documents import land_documents

    def started():
        (line,) = [one for one in Path("/proc/stat").read_text().splitlines() if one.startswith("processes ")]
        return int(line.split()[1])

    if not Path("/proc/stat").exists():
        pytest.skip("processes are counted by /proc/stat")
    documents = spark.range(1500).selectExpr("concat('https://a.example/', id) url", "string(id) text")
    before = started()
    land_documents(documents, str(tmp_path))
    assert started() - before < 1500
    assert len(list(tmp_path.glob("url=*/part-*.txt"))) == 1500


def test_a_landing_that_fails_lands_none(spark, tmp_path):
    from response_ledger.sources.documents import land_documents, read_landed

    land_documents(spark.createDataFrame([("a", "1")], "url string, text string"), str(tmp_path))
    documents = spark.range(100).selectExpr(
        "concat('https://a.example/', id) url", "if(id = 70, raise_error('lost'), 'x') text"
    )
    with pytest.raises(Exception, match="lost"):
        land_documents(documents, str(tmp_path))
    documents = spark.range(100).selectExpr("if(id = 70, repeat('x', 300), string(id)) url", "'x' text")
    with pytest.raises(Exception, match="File name too long"):
        land_documents(documents, str(tmp_path))
    assert sorted(one.name for one in tmp_path.iterdir()) == ["_SUCCESS", "url=a"]
    assert [tuple(one) for one in read_landed(spark, str(tmp_path)).collect()] == [("a", "1")]


def test_what_was_landed_before_is_read(spark, tmp_path):
    from response_ledger.sources.documents import land_documents, read_landed

    documents = spark.createDataFrame([("é", "1"), ("b", "2")], "url string, text string")
    land_documents(documents.limit(0), str(tmp_path))
    none = read_landed(spark, str(tmp_path))
    land_documents(documents, str(tmp_path))
    (tmp_path / "url=b" / "empty.txt").touch()
    (tmp_path / "url=b" / "_hidden.txt").write_text("3\n")
    both = read_landed(spark, str(tmp_path))
    land_documents(documents, str(tmp_path))
    assert none.collect() == [] and none.columns == ["url", "text"]
    assert sorted(map(tuple, both.collect())) == [("b", "2"), ("é", "1")]


def test_folders_that_another_try_moved_are_passed_over(tmp_path):
    from response_ledger.sources.documents import _move, _move_folders

    staged, place = tmp_path / "staged", tmp_path / "place"
    for folder, file in (("url=a", "1"), ("url=b", "2"), ("url=b", "3")):
        (staged / folder).mkdir(parents=True, exist_ok=True)
        (staged / folder / file).touch()
    (place / "url=b").mkdir(parents=True)
    (place / "url=b" / "0").touch()
    for _ in range(2):
        _move_folders(bytes(staged), bytes(place))
    _move(bytes(staged / "url=a"), bytes(place / "url=a"))
    found = sorted(str(one.relative_to(place)) for one in place.rglob("*") if one.is_file())
    assert found == ["url=a/1", "url=b/0", "url=b/2", "url=b/3"]
    (staged / "url=c").mkdir()
    with pytest.raises(FileNotFoundError):
        _move(bytes(staged / "url=c"), bytes(tmp_path / "none" / "url=c"))


def test_a_damaged_file_is_an_error(spark, tmp_path):
    from response_ledger.sources.documents import land_documents, read_landed

    land_documents(spark.createDataFrame([("a", "x" * 2000)], "url string, text string"), str(tmp_path))
    (file,) = tmp_path.glob("url=a/part-*.txt")
    file.write_bytes(b"x" * 1500 + b"y" + b"x" * 499 + b"\n")
    with pytest.raises(Exception, match="does not match its checksums"):
        read_landed(spark, str(tmp_path)).collect()
    (tmp_path / "url=a" / f".{file.name}.crc").unlink()
    assert [len(one["text"]) for one in read_landed(spark, str(tmp_path)).collect()] == [2000]
