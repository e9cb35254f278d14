"""
Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source's documents are shuffled by a hash. A document finishes when its source, served
in proportion to its target, has got through all its words so far: words before and in it,
divided by the target. Sorting all documents of all sources by that virtual finish time, and
cutting the sequence where the total budget is used up, gives each source its target. Each
source queues its documents twice, the second time behind the first, so a target can ask for
up to two times a source.

Prefix sums over a source, and over all finish times, are taken in two levels: the rows are
dealt into slices of some thousand rows, the slices' sums are added up, and only inside a
slice are rows sorted. So neither a source with a third of all rows nor the global order goes
through one task. A slice that a frequent doc_id, or the lack of one, has made too large is cut
further, along the order of its rows: by key, size and a hash of the row, and where equal rows are
too many, which may swap places without a trace, among them at will.

Defined cases: a null text has size 0 and is never taken; rows with a null source form a
source of their own, the last; repeated rows are queued each; an empty table gives no rows.
Columns of the input with the name of an output column are replaced; others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from response_ledger.llm.batches import put_back, set_aside
from response_ledger.session import landed

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
PASSES = 2
SLICE_ROWS = 8_192

ADDED = ("size", "source_size", "target", "copies", "taken")


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """
    One row per source of (source, size): its size, rows, place by code point, and target.

    Targets are weight times one level, but no more than `PASSES` times the source. In order
    of how soon a source is full, the level is what the budget leaves after all fuller ones,
    over the weights from there on; it is the one of the first source that is not full by it.
    One row per source goes through the windows.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sums = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    ranked = (
        sums.withColumn("place", place)
        .withColumn("weight", F.get(cycle, F.col("place") % len(weights)))
        .withColumn("most", F.col("source_size") * PASSES)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(Window.partitionBy()) * F.lit(share))
    )
    order = Window.orderBy("full_at", "place")
    fuller = F.coalesce(
        F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", (F.col("budget") - fuller) / rest)
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "place", "level"))).over(
        Window.partitionBy()
    )["level"]
    return levels.withColumn("target", F.least(F.col("most").cast("double"), level * F.col("weight"))).select(
        "source", "source_size", "source_rows", "place", "target", "budget"
    )


def dealt(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """`rows` (source, size, __key, __tie, __id) with their source's columns and their `__slice`."""
    slices = F.ceil(F.col("__rows") / SLICE_ROWS).cast("bigint")
    fraction = F.conv(F.substring("__key", 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    named = targets.select(
        F.col("source").alias("__source"), "source_size", "target",
        F.col("source_rows").alias("__rows"), F.col("place").alias("__place"),
    )
    joined = rows.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    return joined.withColumn("__slice", F.floor(fraction * slices)).drop("__rows")


def crowded(rows: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """
    Of dealt rows the slices that are far too large, with the bits of the rows' hash to cut them
    by, and in them the equal rows that are too many still, with how many ways to part them.
    """
    many = F.count(F.lit(1))
    shift = (64 - F.ceil(F.log2(F.col("__many") / SLICE_ROWS))).cast("int")
    slices = landed(
        rows.groupBy("__place", "__slice").agg(many.alias("__many")).where(F.col("__many") > 4 * SLICE_ROWS)
        .select("__place", "__slice", shift.alias("__shift")),
        "crowded",
    )
    if slices.isEmpty():
        return None
    same = ["__place", "__slice", "__key", "size", "__tie"]
    equal = (
        rows.join(slices, ["__place", "__slice"], "left_semi").groupBy(*same).agg(many.alias("__many"))
        .where(F.col("__many") > SLICE_ROWS)
        .select(*same, F.ceil(F.col("__many") / SLICE_ROWS).cast("bigint").alias("__ways"))
    )
    return slices, landed(equal, "equal")


def queued(rows: DataFrame, targets: DataFrame, cuts: tuple[DataFrame, DataFrame] | None) -> DataFrame:
    """`rows` with their source's columns and `__done`, the source's words up to and in them."""
    placed, part = dealt(rows, targets), ["__place", "__slice"]
    if cuts is not None:
        slices, equal = cuts
        met = placed.join(slices, part, "left").join(equal, [*part, "__key", "size", "__tie"], "left")
        hot, alike = F.col("__shift").isNotNull(), F.col("__ways").isNotNull()
        finer = {
            "__a": F.when(hot, F.col("__key")).otherwise(""),
            "__b": F.when(hot, F.col("size")).otherwise(0),
            "__c": F.when(hot, F.expr("shiftright(__tie, __shift)")).otherwise(0),
            # Rows that are alike come after the others of their part.
            "__d": alike,
            "__e": F.when(alike, F.col("__tie")).otherwise(0),
            "__f": F.when(alike, F.pmod("__id", "__ways")).otherwise(0),
        }
        placed, part = met.withColumns(finer).drop("__shift", "__ways"), [*part, *finer]
    sums = placed.groupBy(*part).agg(F.sum("size").alias("__words"))
    before = Window.partitionBy("__place").orderBy(*part[1:]).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*part, F.coalesce(F.sum("__words").over(before), F.lit(0)).alias("__before"))
    inside = (
        Window.partitionBy(*part).orderBy("__key", "size", "__tie")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = placed.withColumn("__words", F.sum("size").over(inside)).join(sums, part)
    done = (F.col("__before") + F.col("__words")).cast("double")
    return summed.withColumn("__done", done).drop("__words", "__before", *part[1:])


def finish(nth: int) -> Column:
    """The virtual time at which a document has been served for the nth time, from 0."""
    served = F.col("__done") + F.col("source_size").cast("double") * nth
    return F.when((F.col("target") > 0) & (F.col("size") > 0), served / F.col("target"))


def cut_off(times: DataFrame, budget: float, rows: int) -> tuple[int, float, int] | None:
    """
    The last event taken, as (time slice, finish, place of its source): events in order of
    finish, then place, are taken while their sizes add up to `budget` at most. None: all are.
    """
    per_unit = max(1, -(-rows * PASSES // SLICE_ROWS))
    events = times.select(
        F.col("__place").alias("place"), "size",
        F.explode(F.array(*[finish(n) for n in range(PASSES)])).alias("finish"),
    ).where(F.col("finish").isNotNull()).withColumn("__time", F.floor(F.col("finish") * per_unit))
    running = Window.orderBy("__time").rowsBetween(Window.unboundedPreceding, 0)
    sums = events.groupBy("__time").agg(F.sum("size").alias("words"))
    crossing = (
        sums.withColumn("after", F.sum("words").over(running))
        .where(F.col("after") > budget)
        .agg(F.min(F.struct("__time", "after", "words")).alias("at"))
        .select("at.*").first()
    )
    if crossing["__time"] is None:
        return None
    before = crossing["after"] - crossing["words"]
    inside = Window.orderBy("finish", "place").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        events.where(F.col("__time") == crossing["__time"])
        .withColumn("after", F.sum("size").over(inside) + before)
        .where(F.col("after") <= budget)
        .agg(F.max(F.struct("finish", "place")).alias("last"))
        .select("last.*").first()
    )
    if last["finish"] is None:
        return crossing["__time"], -1.0, -1
    return crossing["__time"], last["finish"], last["place"]


def mix(
    documents: DataFrame,
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    share: float = SHARE,
    keep_text: bool = True,
) -> DataFrame:
    """
    `documents` (doc_id, source, text and more) with `size` in words, its source's `source_size`
    and `target`, `copies`, how often the mix takes it (0 to `PASSES`), and `taken` words.
    """
    kept = [c for c in documents.columns if c not in ADDED and (keep_text or c != text)]
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    marked = documents.withColumn("size", n_words(text))
    # Rows equal in all columns may swap places without a trace.
    rows = marked.select(
        *kept, "size", key.alias("__key"), F.xxhash64(*kept).alias("__tie"),
        F.monotonically_increasing_id().alias("__id"),
    )
    own = ["source", "size", "__key", "__tie", "__id"]
    # Sizes are counted once and written; where texts are to be kept, they are counted again
    # instead of writing the texts.
    narrow = landed(rows.select(*own) if keep_text else rows, "sized")
    rows = rows if keep_text else narrow
    targets = landed(source_targets(narrow, weights, share), "targets")
    total = targets.agg(F.sum("source_rows").alias("rows"), F.max("budget").alias("budget")).first()
    cuts = crowded(dealt(narrow.select(*own), targets))
    times = queued(rows, targets, cuts)
    if not total["budget"]:
        return times.select(*kept, "size", "source_size", "target", F.lit(0).alias("copies"), F.lit(0).cast("bigint").alias("taken"))
    last = cut_off(queued(narrow.select(*own), targets, cuts), total["budget"], total["rows"])
    if last is None:
        hits = [finish(n).isNotNull() for n in range(PASSES)]
    else:
        per_unit = max(1, -(-total["rows"] * PASSES // SLICE_ROWS))
        hits = []
        for n in range(PASSES):
            time = F.floor(finish(n) * per_unit)
            inside = F.struct(finish(n), "__place") <= F.struct(F.lit(last[1]), F.lit(last[2]))
            hits.append(F.coalesce((time < last[0]) | ((time == last[0]) & inside), F.lit(False)))
    copies = sum((hit.cast("int") for hit in hits), F.lit(0))
    return times.withColumn("copies", copies).select(
        *kept, "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents of the mix themselves: each as often as it is taken."""
    copies = mix(set_aside(documents, ADDED), text).where(F.col("copies") > 0)
    each = copies.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return put_back(each, documents.columns, ADDED)
