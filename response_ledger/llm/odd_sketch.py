"""
Near-duplicates by MinHash bands, verified by odd sketches and confirmed on full shingle sets.

1. Each whole text becomes its set of word shingles, hashed to 64 bits. Texts with the same
   set are one class from here on, so exact copies cost one row each.
2. A class gets `SAMPLES` MinHashes: bands of `band_rows` of them are its buckets, and all of
   them, folded by parity into `SKETCH_BITS` bits, its odd sketch. The population count of
   the XOR of two sketches tells a high similarity precisely.
3. Inside a bucket, classes are compared by sketch in blocks of at most some hundred, a pair of
   blocks a task's unit of work. Of the pairs alike enough only a spanning forest is written.
   The components of these forests are families: every candidate pair lies in one family.
4. Inside a family, again by pairs of blocks, the intersections of full sets are counted
   exactly, by products of 0/1 matrices, and a spanning forest of the links is written.
5. The components of the links are the groups.

Nothing is dropped: a bucket or family of any size is worked off in blocks. A pair at the
similarity threshold shares no band with probability (1 - s^r)^b, which `BAND_MISS` bounds, and
is missed by the sketch beyond `SIGMAS` standard deviations, 1e-6.

Defined cases: null and empty texts have no shingles and are linked with nothing; fewer words
than a shingle has make one shingle; rows that share a doc_id count as one document and are
linked; a row without doc_id is linked with nothing. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from response_ledger.llm.batches import evaluated
from response_ledger.llm.components import connected_components
from response_ledger.llm.splitting import text_portions
from response_ledger.session import landed

SAMPLES = 252
BAND_MISS = 5e-6
SKETCH_BITS = 512
SIGMAS = 4.75
BUCKET_BLOCK = 512
FAMILY_BLOCK, FAMILY_SHINGLES = 256, 1 << 20
PORTION = 1 << 20
_COLUMNS = 4096

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r")] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with their bits stirred."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Hashes the word shingles of texts; the same in every task."""

    def __init__(self, words: int) -> None:
        rng = np.random.default_rng(20)
        self.words = words
        self.of_byte = rng.integers(0, 1 << 63, 256, np.uint64)
        self.base = rng.integers(0, 1 << 63, 1, np.uint64)[0] | np.uint64(1)
        inverse = pow(int(self.base), -1, 1 << 64)
        self.inverse = np.uint64(inverse)
        self.place = rng.integers(0, 1 << 63, words, np.uint64) | np.uint64(1)
        self.powers = np.ones(1, np.uint64)
        self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size > len(self.powers):
            ones = np.ones(size, np.uint64)
            for name, factor in (("powers", self.base), ("inverses", self.inverse)):
                steps = ones.copy()
                steps[1:] = factor
                setattr(self, name, np.multiply.accumulate(steps))

    def words_of(
        self, raw: list[bytes]
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """
        The texts' bytes with a line feed behind each, where each text ends, and where the
        words of all begin and end, with their hashes (A-Z in either case).
        """
        buffer = np.frombuffer(b"\n".join([*raw, b""]).lower(), np.uint8)
        ends = np.cumsum([len(one) + 1 for one in raw])
        space = _SPACE[buffer]
        # A word's hash: its bytes' numbers times powers of the base, from prefix sums.
        self._grow(len(buffer))
        sums = np.cumsum(self.of_byte[buffer] * self.powers[: len(buffer)], dtype=np.uint64)
        starts, stops = self.word_edges(buffer, space)
        before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
        hashes = mixed((sums[stops - 1] - before) * self.inverses[starts])
        return buffer, ends, starts, stops, hashes

    def word_edges(self, buffer: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin and end: between white space."""
        edges = np.diff(space.astype(np.int8), prepend=1)
        return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's distinct shingle hashes, sorted."""
        _, ends, starts, _, hashes = self.words_of([t.encode() for t in texts])
        cuts = np.searchsorted(starts, ends).tolist()
        found = []
        for first, last in zip([0, *cuts], cuts):
            count = last - first
            if not count:
                found.append(np.empty(0, np.uint64))
                continue
            used = min(self.words, count)
            total = np.full(count - used + 1, used, np.uint64)
            for k in range(used):
                total = total + hashes[first + k : last - used + 1 + k] * self.place[k]
            found.append(np.unique(mixed(total)))
        return found


def band_rows(similarity: float) -> int:
    """The most MinHashes a band can have for pairs of this similarity to share one."""
    rows = (r for r in range(SAMPLES, 0, -1) if SAMPLES % r == 0)
    return next(r for r in rows if r == 1 or (1 - similarity**r) ** (SAMPLES // r) <= BAND_MISS)


class Sketcher:
    """MinHash bands and odd sketches of shingle sets."""

    def __init__(self, rows: int) -> None:
        rng = np.random.default_rng(21)
        self.rows, self.bands = rows, SAMPLES // rows
        self.turn = rng.integers(0, 1 << 32, (SAMPLES, 1), np.uint32)
        self.factor = rng.integers(0, 1 << 32, (SAMPLES, 1), np.uint32) | np.uint32(1)
        self.combine = rng.integers(0, 1 << 63, rows, np.uint64) | np.uint64(1)
        self.band = rng.integers(0, 1 << 63, self.bands, np.uint64)
        self.sample = rng.integers(0, 1 << 63, SAMPLES, np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
        for i in range(0, len(low), 1024):
            part = (low[None, i : i + 1024] ^ self.turn) * self.factor
            np.minimum(least, part.min(1), out=least)
        return least

    def buckets(self, samples: np.ndarray) -> np.ndarray:
        rows = samples.astype(np.uint64).reshape(len(samples), self.bands, self.rows)
        return mixed((rows * self.combine).sum(2, dtype=np.uint64) + self.band).view(np.int64)

    def sketches(self, samples: np.ndarray) -> np.ndarray:
        bits = mixed(samples.astype(np.uint64) + self.sample) >> np.uint64(64 - int(math.log2(SKETCH_BITS)))
        flat = bits.astype(np.int64) + np.arange(len(samples))[:, None] * SKETCH_BITS
        counts = np.bincount(flat.reshape(-1), minlength=len(samples) * SKETCH_BITS) & 1
        return np.packbits(counts.astype(np.uint8).reshape(len(samples), SKETCH_BITS), axis=1)


def sketch_limit(similarity: float, samples: int = SAMPLES, bits: int = SKETCH_BITS) -> int:
    """Differing sketch bits that a pair of this similarity exceeds only beyond `SIGMAS`."""
    differ = samples * (1 - similarity)
    expected = bits / 2 * (1 - math.exp(-4 * differ / bits))
    by_sample = 2 * math.exp(-4 * differ / bits) * math.sqrt(differ * similarity)
    by_bit = math.sqrt(bits / 4 * (1 - math.exp(-8 * differ / bits)) - 2 * differ * math.exp(-8 * differ / bits))
    return math.ceil(expected + SIGMAS * math.hypot(by_sample, by_bit))


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return (
        int(hashes.sum(dtype=np.uint64).view(np.int64)),
        int(mixed(hashes ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).view(np.int64)),
    )


def features(documents: DataFrame, words: int, rows: int, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, buckets, sketch) of every whole text."""
    source = documents.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    doc_type = source.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {doc_type}, n_shingles long, set_a long, set_b long, buckets array<long>, sketch binary"
    )

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, sketcher = Shingler(words), Sketcher(rows)
        for batch in batches:
            for first, last, texts in text_portions(batch.column(1), PORTION):
                sets = shingler.sets(texts)
                samples = np.stack([sketcher.samples(one) for one in sets])
                buckets, sketches = sketcher.buckets(samples), sketcher.sketches(samples)
                ids = [digest(one) for one in sets]
                columns = [
                    batch.column(0).slice(first, last - first),
                    pa.array([len(one) for one in sets], pa.int64()),
                    pa.array([a for a, _ in ids], pa.int64()),
                    pa.array([b for _, b in ids], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * sketcher.bands),
                        pa.array(buckets.reshape(-1)),
                    ),
                    pa.array([row.tobytes() for row in sketches], pa.binary()),
                ]
                names = ["doc_id", "n_shingles", "set_a", "set_b", "buckets", "sketch"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return source.mapInArrow(featured, schema)


def forest(alike: np.ndarray) -> np.ndarray:
    """For a symmetric relation, each row's least row within reach."""
    labels = np.arange(len(alike))
    alike = alike | np.eye(len(alike), dtype=bool)
    while True:
        least = np.where(alike, labels[None, :], len(labels)).min(1)
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least


def in_blocks(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Deals a group's rows (with `node`) into blocks and every pair of blocks: (group, low, high)."""
    return (
        rows.withColumn("__blocks", blocks)
        .withColumn("__block", F.pmod(F.xxhash64("node"), "__blocks"))
        .withColumn("__other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__blocks") - 1)))
        .withColumn("low", F.least("__block", "__other"))
        .withColumn("high", F.greatest("__block", "__other"))
        .drop("__blocks", "__block", "__other")
        .withColumn("unit", F.xxhash64(group, "low", "high"))
    )


def by_unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches sorted by `unit` as tables that hold whole units."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        units = batch.column("unit").to_numpy()
        starts = np.flatnonzero(np.diff(units))
        if held and held[-1].column("unit")[-1].as_py() != units[0]:
            yield pa.Table.from_batches(held)
            held = []
        if len(starts):
            cut = int(starts[-1]) + 1
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def unit_ranges(table: pa.Table) -> list[tuple[int, int]]:
    units = table.column("unit").to_numpy()
    cuts = [0, *(np.flatnonzero(np.diff(units)) + 1).tolist(), len(units)]
    return list(zip(cuts, cuts[1:]))


def edge_batch(nodes: list[np.ndarray], roots: list[np.ndarray]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(one) if one else np.empty(0, np.int64)) for one in (nodes, roots)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def candidates(classes: DataFrame, limit: int) -> DataFrame:
    """Edges that connect all classes which share a bucket and whose sketches are alike."""
    in_buckets = classes.select("node", F.explode("buckets").alias("bucket"))
    sizes = in_buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = in_buckets.join(sizes, "bucket").join(classes.select("node", "sketch"), "node")
    units = in_blocks(rows, "bucket", F.ceil(F.col("size") / BUCKET_BLOCK))
    dealt = units.select("unit", "node", "sketch").repartition("unit").sortWithinPartitions("unit", "node")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            nodes = table.column("node").to_numpy()
            bits = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint64)
            bits = bits.reshape(len(nodes), -1)
            ranges = unit_ranges(table)
            # Pairs, by far the most, all at once.
            twos = np.array([first for first, last in ranges if last - first == 2], np.int64)
            differ = np.bitwise_count(bits[twos] ^ bits[twos + 1]).sum(1, dtype=np.int64)
            twos = twos[differ <= limit]
            left, right = [nodes[twos + 1]], [nodes[twos]]
            for first, last in ranges:
                if last - first > 2:
                    part = bits[first:last]
                    differ = np.zeros((len(part), len(part)), np.uint16)
                    for k in range(part.shape[1]):
                        differ += np.bitwise_count(part[:, None, k] ^ part[None, :, k])
                    root = forest(differ <= limit)
                    hung = np.flatnonzero(root != np.arange(len(root)))
                    left.append(nodes[first + hung])
                    right.append(nodes[first + root[hung]])
            yield edge_batch(left, right)

    return dealt.mapInArrow(compared, "a long, b long")


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets are alike: 100 * intersection >= percent * union, counted exactly."""
    sizes = np.array([len(one) for one in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(count), -1)
    place[shared] = np.arange(len(shared))
    column = place[column]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), np.int64)
    for first in range(0, len(shared), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        ones = np.zeros((len(sets), _COLUMNS), np.float32)
        ones[owner[a:b], column[a:b] - first] = 1
        both += (ones @ ones.T).astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    return both * 100 >= union * percent


def links(documents: DataFrame, classes: DataFrame, families: DataFrame, words: int, percent: int) -> DataFrame:
    """Edges that connect all classes linked by their full sets; the texts are read again for them."""
    rows = families.join(classes.select("node", "n_shingles", "set_a", "set_b"), "node")
    sizes = rows.groupBy("family").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / FAMILY_BLOCK), F.ceil(F.sum("n_shingles") / FAMILY_SHINGLES)
        ).alias("blocks")
    )
    wanted = landed(rows.join(sizes, "family"), "families")
    # One plan for any size: left to itself Spark broadcasts a small family table.
    texts = documents.select(F.col("doc_id").alias("node"), "text").join(wanted.hint("merge"), "node")
    schema = "node long, family long, blocks long, shingles binary"

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            expected = [
                *zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
            ]
            for first, last, some in text_portions(batch.column("text"), PORTION):
                sets = shingler.sets(some)
                # Rows that share the doc_id may have another text.
                rows = [i for i, one in enumerate(sets) if digest(one) == expected[first + i]]
                part = batch.slice(first, last - first).take(pa.array(rows, pa.int64()))
                columns = [part.column(name) for name in ("node", "family", "blocks")]
                columns.append(pa.array([sets[i].tobytes() for i in rows], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["node", "family", "blocks", "shingles"])

    known = texts.select("node", "family", "blocks", "set_a", "set_b", F.coalesce("text", F.lit("")).alias("text"))
    units = in_blocks(known.mapInArrow(shingled, schema), "family", F.col("blocks"))
    dealt = units.select("unit", "node", "shingles").repartition("unit").sortWithinPartitions("unit", "node")

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            nodes = table.column("node").to_numpy()
            column = table.column("shingles")
            left, right = [], []
            for first, last in unit_ranges(table):
                sets = [np.frombuffer(one, np.uint64) for one in column.slice(first, last - first).to_pylist()]
                root = forest(linked(sets, percent))
                hung = np.flatnonzero(root != np.arange(len(root)))
                left.append(nodes[first + hung])
                right.append(nodes[first + root[hung]])
            yield edge_batch(left, right)

    return dealt.mapInArrow(confirmed, "a long, b long")


def near_duplicates(documents: DataFrame, words: int = 3, percent: int = 85, text: str = "text") -> DataFrame:
    """Per row of `documents`: doc_id, n_shingles, component_id and whether it is the one kept."""
    documents = documents.select("doc_id", F.col(text).alias("text"))
    rows = evaluated(features(documents, words, band_rows(percent / 100)), "features")
    sets = rows.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    key = ["n_shingles", "set_a", "set_b"]
    least = F.min(F.struct("doc_id", "buckets", "sketch")).alias("one")
    classes = landed(
        sets.groupBy(*key).agg(least).select(*key, F.col("one.doc_id").alias("node"), "one.buckets", "one.sketch"),
        "classes",
    )
    found = connected_components(candidates(classes, sketch_limit(percent / 100)))
    families = landed(found.select(F.col("vertex").alias("node"), F.col("component").alias("family")), "families")
    edges = links(documents, classes, families, words, percent)
    # Rows that share a doc_id are one document, whatever their texts.
    repeated = sets.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    same = (
        sets.join(repeated, "doc_id").join(classes, key)
        .select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    )
    groups = connected_components(edges.unionByName(same))
    named = classes.join(groups.withColumnRenamed("vertex", "node"), "node", "left").select(
        *key, F.coalesce("component", "node").alias("component")
    )
    named = landed(named, "named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.select("doc_id", *key).join(named, key, "left")
        .select("doc_id", "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def without_near_duplicates(
    documents: DataFrame, words: int = 3, percent: int = 85, lone: bool = True
) -> DataFrame:
    """
    `documents` less all but one row of each group, the one with the least doc_id. Rows that
    share a doc_id are of one group. Rows without doc_id are not compared with any, or, if not
    `lone`, as all others are; rows with an id are then kept rather than they.
    """
    # Written, so that a row has the same number whenever it is read.
    numbered = landed(documents.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    compared = numbered if not lone else numbered.where(F.col("doc_id").isNotNull())
    alike = near_duplicates(
        compared.select(F.col("__row").alias("doc_id"), "text"), words, percent
    ).select(F.col("doc_id").alias("__row"), F.col("component_id").alias("__group"))
    rows = landed(numbered.select("__row", "doc_id").join(alike.hint("merge"), "__row"), "rows")
    ids = rows.where(F.col("doc_id").isNotNull())
    # Groups that share a doc_id are one: each hangs on the least group of that doc_id.
    least = ids.groupBy("doc_id").agg(F.min("__group").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    edges = ids.join(least.hint("merge"), "doc_id").select(F.col("__group").alias("a"), "b").where("a <> b").distinct()
    joined = connected_components(edges)
    rows = rows.join(joined.hint("merge"), F.col("__group") == F.col("vertex"), "left")
    order = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.col("__row").alias("row"))
    kept = rows.groupBy(F.coalesce("component", "__group").alias("g")).agg(F.min(order).alias("one")).select(
        F.col("one.row").alias("__row")
    )
    if lone:
        kept = kept.unionByName(numbered.where(F.col("doc_id").isNull()).select("__row"))
    return numbered.join(kept.hint("merge"), "__row", "left_semi").select(*documents.columns)
