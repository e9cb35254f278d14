"""
Nearest neighbours by cosine with a hash-prefix forest.

A vector gets a 64-bit hash string per tree, from the signs of random orthogonal projections;
a tree is the array of these strings in sorted order, so the vectors that share a prefix with a
query are one range of it. A query descends to its longest matching prefix in every tree and
then ascends, in all trees at the same depth, taking in the ranges of ever shorter prefixes
until they hold enough candidates. These are scored exactly on the original vectors.

The index is dealt into blocks of some thousand vectors by a hash of vec_id, each with trees of
its own, so that equal vectors spread evenly, and the queries into blocks, too. A pair of
blocks is a task's unit of work; it returns its best few per query, which are then merged.

How many candidates a query needs depends on the data. The measured recall against brute force
with the values below is in the README; vectors without any neighbourhood, spread evenly over
the sphere, are the hardest case and set `SHARE`.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component take
no part, neither do rows without vec_id; vectors of different lengths have no cosine, so each
length has an index of its own and is searched for its own queries; a query with fewer candidates
returns all of them; rows that share a vec_id are candidates each, but none of them of its own; an
empty table gives no rows. Other columns are not read, so their names clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from response_ledger.llm.odd_sketch import by_unit, unit_ranges
from response_ledger.session import landed

TREES, BITS = 64, 64
# Candidates taken in over all trees, one counted in each: this share of the block's vectors,
# but no fewer than `LEAST`.
SHARE, LEAST = 0.5, 2_000
NEAREST = 5
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 4_096
# Scores this close in the fast pass are worked out again, one like the other.
_CLOSE = 1e-9


def projections(dim: int, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """(dim, trees * bits) directions, orthogonal in groups of `dim`; the same in every task."""
    rng = np.random.default_rng(31)
    groups = -(-trees * bits // dim)
    parts = [np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(groups)]
    return np.concatenate(parts, axis=1)[:, : trees * bits]


def hash_strings(vectors: np.ndarray, directions: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(tree, vector) hash strings, the first bit the highest."""
    packed = np.packbits(vectors @ directions > 0, axis=1)
    strings = packed.reshape(len(vectors), -1, bits // 8)
    return np.ascontiguousarray(strings).view(">u8")[:, :, 0].T.astype(np.uint64)


class Forest:
    """The sorted arrays of one block of vectors."""

    def __init__(self, vectors: np.ndarray, directions: np.ndarray) -> None:
        strings = hash_strings(vectors, directions)
        self.order = strings.argsort(axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def ranges(self, strings: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """(tree, query) the ranges that share the first `depth` bits with the query."""
        rest = np.uint64((1 << (BITS - depth)) - 1)
        low, high = strings & ~rest, strings | rest
        first = np.stack([tree.searchsorted(one, "left") for tree, one in zip(self.sorted, low)])
        last = np.stack([tree.searchsorted(one, "right") for tree, one in zip(self.sorted, high)])
        return first, last

    def candidates(self, strings: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
        """For each query the places of its candidates: the deepest level that has `wanted`."""
        queries = strings.shape[1]
        first = np.zeros(strings.shape, np.int64)
        last = np.full(strings.shape, self.order.shape[1], np.int64)
        open_ = np.arange(queries)
        # Levels below the one at which a random vector is alone have nothing to add.
        if wanted >= self.order.size:
            open_ = open_[:0]
        for depth in range(min(BITS - 1, int(np.log2(max(2, self.order.shape[1]))) + 8), 0, -1):
            a, b = self.ranges(strings[:, open_], depth)
            enough = (b - a).sum(0) >= wanted
            first[:, open_[enough]], last[:, open_[enough]] = a[:, enough], b[:, enough]
            open_ = open_[~enough]
            if not len(open_):
                break
        for q in range(queries):
            hit = np.zeros(self.order.shape[1], bool)
            for tree, a, b in zip(self.order, first[:, q].tolist(), last[:, q].tolist()):
                hit[tree[a:b]] = True
            yield np.flatnonzero(hit)


def cosines(vectors: np.ndarray, norms: np.ndarray, query: np.ndarray, norm: float) -> np.ndarray:
    """Exact cosines, each worked out like any other, so that equal vectors score the same."""
    return np.add.reduce(vectors * query, axis=1) / (norms * norm)


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, nearest: int, share: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query_id, vec_id, score): the best of one block for each query."""
    directions = projections(vectors.shape[1])
    norms = np.sqrt(np.add.reduce(vectors * vectors, axis=1))
    query_norms = np.sqrt(np.add.reduce(queries * queries, axis=1))
    unit = vectors / norms[:, None]
    forest = Forest(unit, directions)
    strings = hash_strings(queries / query_norms[:, None], directions)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    wanted = max(nearest + 1, LEAST, int(share * len(ids)))
    for q, places in enumerate(forest.candidates(strings, wanted)):
        places = places[ids[places] != query_ids[q]]
        if not len(places):
            continue
        fast = unit[places] @ (queries[q] / query_norms[q])
        if len(places) > nearest:
            least = np.partition(fast, -nearest)[-nearest]
            places = places[fast >= least - _CLOSE]
        score = cosines(vectors[places], norms[places], queries[q], query_norms[q])
        best = np.lexsort((ids[places], -score))[:nearest]
        out.append((np.full(len(best), query_ids[q]), ids[places][best], score[best]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(one) for one in zip(*out))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    embeddings: DataFrame, every: int = 50, nearest: int = NEAREST, share: float = SHARE
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose vec_id is divisible by `every`."""
    vector = F.col("embedding").cast("array<double>")
    good = embeddings.select("vec_id", vector.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("embedding")), F.lit(False))
    )
    rows = landed(good, "vectors")
    sizes = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect()
    best = None
    for size in sizes:
        alike = rows.where(F.size("embedding") == size["dim"])
        found = searched_blocks(alike, size["n"], size["dim"], every, nearest, share)
        best = found if best is None else best.unionByName(found)
    if best is None:
        return good.select(
            F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")
        )
    order = Window.partitionBy("query_id", "dim").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
        .select("query_id", "rank", "vec_id", "score")
    )


def searched_blocks(
    rows: DataFrame, many: int, size: int, every: int, nearest: int, share: float
) -> DataFrame:
    """(query_id, vec_id, score, dim): the best of each block for the queries among vectors of one length."""
    blocks = max(1, -(-many // BLOCK_ROWS))
    queries = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    query_blocks = max(1, -(-queries.count() // BLOCK_QUERIES))

    def dealt(frame: DataFrame, kind: int) -> DataFrame:
        own = F.pmod(F.xxhash64("vec_id", F.lit(kind)), F.lit((blocks, query_blocks)[kind]))
        other = F.explode(F.sequence(F.lit(0), F.lit((query_blocks, blocks)[kind] - 1)))
        pair = frame.withColumn("own", own).withColumn("other", other)
        block, query_block = ("own", "other") if kind == 0 else ("other", "own")
        return pair.select(
            (F.col(block).cast("bigint") * query_blocks + F.col(query_block)).alias("unit"),
            F.lit(kind).alias("kind"), "vec_id", "embedding",
        )

    units = dealt(rows, 0).unionByName(dealt(queries, 1))
    together = units.repartition(blocks * query_blocks, "unit").sortWithinPartitions("unit", "kind", "vec_id")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            for first, last in unit_ranges(table):
                part = table.slice(first, last - first).combine_chunks()
                kind = part.column("kind").to_numpy()
                ids = part.column("vec_id").to_numpy()
                flat = part.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                vectors = flat.reshape(len(ids), size)
                if not (kind == 0).any() or not (kind == 1).any():
                    continue
                found = search_block(
                    ids[kind == 0], vectors[kind == 0], ids[kind == 1], vectors[kind == 1], nearest, share
                )
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    found = together.mapInArrow(searched, "query_id long, vec_id long, score double")
    return found.withColumn("dim", F.lit(size))
