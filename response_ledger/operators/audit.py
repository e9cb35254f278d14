"""Readers that an append-only ledger calls for: current rows, integrity, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from response_ledger.functions.calls import canonical_filters
from response_ledger.operators.intervals import merged
from response_ledger.operators.outcomes import read_envelopes
from response_ledger.operators.records import STRICT_JSON, read_pages
from response_ledger.schemas import SOURCE_TYPE
from response_ledger.session import landed

_NO_KEY = -(1 << 63)
_NO_START = -1

# What tells responses apart that hold different things.
RESPONSE_KEY = ("request_type", "response_id", "scope", "page_set", "page_start", "page_rows")
SCOPE = ("request_type", "scope")
PAGE_SET = (*SCOPE, "page_set")

# Rows of a file that one bitmap of Spark's bitmap functions tells about.
BITMAP_ROWS = 32_768
# Bytes of bitmaps a scan is given at once; beyond that files are dealt into more scans.
BITMAP_BYTES = 32 << 20


def latest_per_key(rows: DataFrame, key: tuple[str, ...], latest: tuple[str, ...]) -> DataFrame:
    """
    The row of each key that is greatest by the `latest` columns.

    Spark keeps only each task's best row per key before the exchange (the rank filter is
    pushed below it), so a key with a third of all rows reaches its window as one row per
    task.
    """
    window = Window.partitionBy(*key).orderBy(*[F.col(name).desc() for name in latest])
    return (
        rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")
    )


def located(ledger: DataFrame, paged: bool) -> DataFrame:
    """
    The narrow columns of a ledger's pages, or of its other responses: what a response is of,
    and the file and row number it sits at. The ledger must be read from files.

    A by-id response is told by its id. A page is told by its filters (`scope`), by the set of
    pages it belongs to (run folder, order, columns), its offset and its size; `total` is the
    number of records it reports. Only pages have their bodies read, for that number alone.
    """
    file = F.col("_metadata.file_path")
    none = F.lit("")
    page_set = F.to_json(
        F.struct(
            F.regexp_extract(file, "/run_id=([^/]*)/", 1).alias("run"), "sort", "sort_order", "display_columns"
        )
    )
    total = F.from_json("content", "struct<RESULTCOUNT:string>", STRICT_JSON)["RESULTCOUNT"].try_cast("bigint")
    rows = ledger.where(F.col("start").isNotNull() if paged else F.col("start").isNull())
    return rows.select(
        "request_type",
        F.coalesce("path_id", F.lit(_NO_KEY)).alias("response_id"),
        (canonical_filters(F.col("filters")) if paged else none).alias("scope"),
        (page_set if paged else none).alias("page_set"),
        (F.col("start").cast("bigint") if paged else F.lit(_NO_START).cast("bigint")).alias("page_start"),
        (F.coalesce(F.greatest("rows", F.lit(1)), F.lit(1)).cast("bigint") if paged else F.lit(0).cast("bigint")).alias(
            "page_rows"
        ),
        (total if paged else F.lit(None).cast("bigint")).alias("total"),
        "fetched_at",
        "sha_256",
        file.alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )


def latest_places(places: DataFrame) -> DataFrame:
    """The latest of the places with the same key; of several at one time one is chosen for good."""
    order = ["fetched_at", "sha_256", "_file", "_row", "total"]
    latest = places.groupBy(*RESPONSE_KEY).agg(F.max(F.struct(*order)).alias("one"))
    return latest.select(*RESPONSE_KEY, *[F.col(f"one.{name}").alias(name) for name in order])


def earlier_places(places: DataFrame) -> DataFrame:
    """
    The places that a later one with the same key supersedes. Keys are counted first, by partial
    aggregates, and only places of keys that repeat are looked at further.
    """
    key = list(RESPONSE_KEY)
    repeated = landed(places.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    again = places.join(repeated, key, "left_semi")
    latest = latest_places(again).select(*key, F.struct("_file", "_row").alias("latest"))
    return again.join(latest, key).where(F.struct("_file", "_row") != F.col("latest")).select("_file", "_row")


def page_spans(pages: DataFrame) -> DataFrame:
    """Pages with the offsets `low` to `high` they cover, within the total their set reports."""
    sets = pages.groupBy(*PAGE_SET).agg(F.max("total").alias("reported"), F.max("fetched_at").alias("set_at"))
    low, high = F.col("page_start"), F.col("page_start") + F.col("page_rows") - 1
    within = F.least(high, F.greatest("reported", low))
    return pages.join(sets, list(PAGE_SET)).withColumn("low", low).withColumn("high", within)


def current_sets(spans: DataFrame) -> DataFrame:
    """
    For each request type and filters the page set that is current: the one fetched last of
    those whose pages cover the total they report; while there is none, the one that covers most.
    A set that reports no total counts as covered.
    """
    sets = spans.groupBy(*PAGE_SET).agg(F.max("reported").alias("reported"), F.max("set_at").alias("set_at"))
    islands = merged(spans.select(*PAGE_SET, "low", "high"), list(PAGE_SET))
    inside = islands.join(sets, list(PAGE_SET)).where(F.col("reported").isNull() | (F.col("low") <= F.col("reported")))
    covered = inside.groupBy(*PAGE_SET).agg(F.sum(F.col("high") - F.col("low") + 1).alias("covered"))
    judged = sets.join(covered, list(PAGE_SET), "left").fillna({"covered": 0})
    whole = F.col("reported").isNull() | (F.col("covered") >= F.col("reported"))
    rank = F.struct(whole.alias("whole"), F.when(whole, 0).otherwise(F.col("covered")).alias("part"), "set_at", "page_set")
    return judged.groupBy(*SCOPE).agg(F.max(rank)["page_set"].alias("current_set"))


def hidden_pages(pages: DataFrame) -> DataFrame:
    """
    (file, row) of the pages, one of each key, that are not current: those of other sets than the
    current one, and those of it whose offsets pages of another size, fetched later, cover.
    """
    spans = landed(page_spans(pages), "spans")
    chosen = spans.join(current_sets(spans), list(SCOPE))
    other = chosen.where(F.col("page_set") != F.col("current_set")).select("_file", "_row")
    standing = chosen.where(F.col("page_set") == F.col("current_set"))
    sizes = standing.groupBy(*PAGE_SET, "page_rows").agg(F.max("fetched_at").alias("size_at"))
    later = sizes.select(*PAGE_SET, F.col("page_rows").alias("later_rows"), F.col("size_at").alias("later_at"))
    pairs = (
        sizes.join(later, list(PAGE_SET))
        .where(F.struct("later_at", "later_rows") > F.struct("size_at", "page_rows"))
        .select(*PAGE_SET, F.col("page_rows").alias("of_rows"), F.col("later_rows").alias("page_rows"))
    )
    by_size = [*PAGE_SET, "of_rows"]
    after = merged(standing.join(pairs, [*PAGE_SET, "page_rows"]).select(*by_size, "low", "high"), by_size).select(
        *PAGE_SET, F.col("of_rows").alias("page_rows"), F.col("low").alias("from"), F.col("high").alias("to")
    )
    cut_anew = standing.join(after, [*PAGE_SET, "page_rows"]).where("low >= from and high <= to")
    return other.unionByName(cut_anew.select("_file", "_row"))


def superseded_places(ledger: DataFrame) -> DataFrame:
    """
    (file, row) of every response of a ledger read from files that is not current.

    Pages are current as a set, see `current_sets`: pages of an earlier run or beyond a total that
    has shrunk hold records the current set has again, or has no more, and those of a run that is
    not complete yet do not hide the complete one before it. Within a set, and for by-id
    responses, the latest response of a key is current. A ledger without pages has its bodies
    left unread: no row group of it holds an offset.
    """
    earlier = earlier_places(located(ledger, paged=False))
    pages = landed(located(ledger, paged=True), "pages")
    if pages.isEmpty():
        return earlier
    latest = landed(latest_places(pages), "pages")
    return earlier.unionByName(earlier_places(pages)).unionByName(hidden_pages(latest))


def bitmaps(places: DataFrame) -> DataFrame:
    """(file, bucket, rows): (file, row) places as bitmaps of `BITMAP_ROWS` rows each."""
    # The functions count from 1.
    place = F.col("_row") + 1
    bucket = F.expr(f"_row div {BITMAP_ROWS}")
    return places.groupBy("_file", bucket.alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("rows_out")
    )


def without_rows(ledger: DataFrame, out: DataFrame) -> DataFrame:
    """
    A ledger read from files less the rows that `out`, bitmaps written to a table, tells of.

    No body is moved: the scan is given the bitmaps. Their size is checked first, and files are
    dealt by a hash of their name into as many scans as it takes for none to get more than about
    `BITMAP_BYTES`.
    """
    total = out.agg(F.sum(F.octet_length("rows_out") + F.length("_file"))).first()[0]
    if not total:
        return ledger
    scans = -(-total // BITMAP_BYTES)
    columns = ledger.columns
    file, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")

    def one_scan(scan: int) -> DataFrame:
        mine, told = ledger, out
        if scans > 1:
            dealt = [F.pmod(F.xxhash64(name), F.lit(scans)) == scan for name in (file, F.col("_file"))]
            mine, told = ledger.where(dealt[0]), out.where(dealt[1])
        placed = mine.select("*", file.alias("_file"), row.alias("_row")).withColumn(
            "_bucket", F.expr(f"_row div {BITMAP_ROWS}")
        )
        bit = F.col("_row") % BITMAP_ROWS
        byte = F.conv(F.hex(F.substring("rows_out", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        gone = F.expr("shiftright(_byte, cast(_row % 8 as int)) & 1") == 1
        met = placed.join(F.broadcast(told), ["_file", "_bucket"], "left").withColumn("_byte", byte)
        return met.where(F.col("_byte").isNull() | ~gone).select(*columns)

    parts = [one_scan(scan) for scan in range(scans)]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def current_responses(ledger: DataFrame) -> DataFrame:
    """The current responses of a ledger read from files, see `superseded_places`."""
    return without_rows(ledger, landed(bitmaps(superseded_places(ledger)), "superseded"))


def integrity(ledger: DataFrame) -> DataFrame:
    """Responses whose digest is not that of their content; a row is judged on its own."""
    digest = F.sha2(F.col("content").cast("binary"), 256)
    return ledger.where(~digest.eqNullSafe(F.col("sha_256"))).select(
        "request_type", "url", "path_id", "start", "sha_256", digest.alias("content_sha_256")
    )


def malformed(ledger: DataFrame) -> DataFrame:
    """Responses whose content is not one JSON object, which JSON readers would skip."""
    return (
        read_envelopes(ledger).where(~F.col("well_formed"))
        .select("request_type", "url", "path_id", "start", "sha_256")
    )


def coverage(ledger: DataFrame, id_column: str, run: tuple[str, ...] = ()) -> DataFrame:
    """
    Per run, how many records the service reported and how many distinct ids the pages hold.

    `run` names the columns that tell runs apart. The distinct count is aggregated per
    (run, id) first, so one run holding everything still spreads over all tasks.
    """
    pages = ledger.where(F.col("request_type") == SOURCE_TYPE)
    # Outer, so that a page without records still reports its total.
    ids = (
        read_pages(pages, [id_column], run)
        .select(*run, "total", F.explode_outer("records").alias("record"))
        .select(*run, "total", F.col("record")[id_column.upper()].cast("bigint").alias("id"))
    )
    found = ids.groupBy(*run, "id").agg(F.max("total").alias("total"), F.count("id").alias("copies"))
    return found.groupBy(*run).agg(
        F.max("total").alias("reported"),
        F.count("id").alias("distinct_ids"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("records"),
    )
