"""
Near-duplicates of embeddings by cosine, found in a robust-pruned flat graph.

Copies first. Equal vectors are one class. Classes near to each other are gathered in balls: a ball
is a class and those within `BALL` of the limit's angle of it, so all in it are linked with each
other. From here on the graph's nodes are the balls' centres.

The graph is built on overlapping shards: centres learned from a bounded sample cut space into
clusters, and a node is in the shards of its `OVERLAP` nearest ones. In a shard each node gets a
list of neighbours, robustly pruned: the nearest candidate stays, and drops those that are closer to
it (`ALPHA` times) than to the node. Links are added both ways and nodes that no medoid reaches are
hung on the nearest one that is. Then the lists that a node has in its shards are united.

Every node is a query in the shard of its nearest cluster. A greedy search with a beam starts from
the shard's medoids, on the united lists, and where it gets within range it expands from all nodes
in range until no further one turns up. The range allows for the radii of both balls.

What is found is verified: if the angle between two centres plus both radii is within the limit, all
of one ball are linked with all of the other; if it is less both radii beyond it, none; else the
vectors of both are compared, one by one, in double precision. No link is made below the limit.

Recall is audited: the links of a bounded sample of classes are counted by brute force against all
classes, and if the graph found less than `RECALL` of them, it is built and searched again with twice
the overlap and beam. With the overlap at all clusters and the beam at whole shards nothing is left out.

Shards, parts and balls have at most about `SHARD_ROWS` rows: clusters beyond that are dealt into
parts by a hash, and a query goes to all parts of its cluster.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component link with
nothing; vectors of different lengths are not compared. Rows that repeat a vec_id are vectors of
their own. A row without vec_id counts as a link, but names no component, and is kept if it is
linked with nothing. An empty table gives no rows. Other columns are not read, so none can clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from response_ledger.llm.components import connected_components
from response_ledger.llm.odd_sketch import by_unit, forest, unit_ranges
from response_ledger.llm.prefix_forest import usable
from response_ledger.session import landed

LIMIT = 0.9
# The radius of a ball, as a share of the limit's angle; below one half, so that all in it are linked.
BALL = 0.4
# Vectors the clusters are learned from, and the most clusters.
SAMPLE, CLUSTERS = 8_192, 1_024
SHARD_ROWS, OVERLAP = 4_096, 3
# A node's candidates, its links, and its links with those the other way.
POOL, DEGREE, MOST = 48, 24, 48
ALPHA = 1.2
MEDOIDS, BEAM = 32, 24
QUERIES = 512
AUDIT, RECALL = 512, 0.97
SALTS = 16
# Angles are good to some 1e-8; what is this close to a bound is compared in full.
_MARGIN = 1e-6


class Index(NamedTuple):
    """How wide the graph is built and searched."""

    centres: np.ndarray
    overlap: int
    beam: int


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as rows in double precision, each scaled by a power of two to a size near 1."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)
    _, exponent = np.frexp(np.abs(rows).max(1, initial=0))
    return np.ldexp(rows, -exponent[:, None])


def unit_rows(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt(np.add.reduce(rows * rows, axis=1))[:, None]


def nearest(unit: np.ndarray, centres: np.ndarray, many: int) -> np.ndarray:
    """(row, many) the nearest centres, nearest first."""
    scores = unit @ centres.T
    many = min(many, len(centres))
    best = np.argpartition(-scores, many - 1, axis=1)[:, :many]
    order = np.argsort(-np.take_along_axis(scores, best, 1), axis=1, kind="stable")
    return np.take_along_axis(best, order, 1)


def learned_centres(unit: np.ndarray, many: int, rounds: int = 8) -> np.ndarray:
    """Unit centres by k-means on the sphere."""
    rng = np.random.default_rng(11)
    centres = unit[rng.permutation(len(unit))[:many]]
    for _ in range(rounds):
        home = (unit @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        norms = np.linalg.norm(sums, axis=1)
        centres = np.where(norms[:, None] > 1e-9, sums / np.maximum(norms, 1e-9)[:, None], centres)
    return centres


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1, 1))


def balls_of(unit: np.ndarray, radius: float) -> np.ndarray:
    """Each row's centre: the first row that is its own centre and within `radius`."""
    centre = np.arange(len(unit))
    least = np.cos(radius)
    near = [np.flatnonzero(row) for row in (unit @ unit.T >= least)]
    free = np.ones(len(unit), bool)
    for i, others in enumerate(near):
        if free[i] and len(others) > 1:
            mine = others[free[others]]
            mine = mine[mine >= i]
            centre[mine] = i
            free[mine] = False
    return centre


def pruned(unit: np.ndarray, of: np.ndarray, pool: np.ndarray, degree: int) -> np.ndarray:
    """
    (row, degree) the robustly pruned links of rows `of` out of their `pool`, nearest first;
    -1 stands for no candidate and no link.
    """
    out = np.full((len(of), degree), -1, np.int64)
    for first in range(0, len(of), 256):
        rows, some = of[first : first + 256], pool[first : first + 256]
        points = unit[some]
        own = 2 - 2 * np.einsum("qd,qnd->qn", unit[rows], points)
        between = 2 - 2 * np.matmul(points, points.transpose(0, 2, 1))
        alive = some >= 0
        at = np.arange(len(rows))
        for k in range(degree):
            best = np.where(alive, own, np.inf).argmin(1)
            held = alive[at, best]
            if not held.any():
                break
            out[first + at[held], k] = some[at[held], best[held]]
            drop = ALPHA * between[at, best] <= own
            alive &= ~(drop & held[:, None])
            alive[at, best] = False
    return out


def nearest_rows(unit: np.ndarray, many: int) -> np.ndarray:
    """(row, many) every row's nearest other rows; -1 where there are fewer."""
    many_here = min(many, len(unit) - 1)
    out = np.full((len(unit), many), -1, np.int64)
    for first in range(0, len(unit), QUERIES):
        scores = unit[first : first + QUERIES] @ unit.T
        scores[np.arange(len(scores)), first + np.arange(len(scores))] = -np.inf
        if many_here:
            out[first : first + QUERIES, :many_here] = np.argpartition(-scores, many_here - 1, axis=1)[:, :many_here]
    return out


def listed(edges: np.ndarray, rows: int) -> np.ndarray:
    """Directed links (from, to) as padded lists, -1 for none."""
    edges = edges[np.lexsort((edges[:, 1], edges[:, 0]))]
    sizes = np.bincount(edges[:, 0], minlength=rows)
    lists = np.full((rows, max(1, int(sizes.max(initial=0)))), -1, np.int64)
    lists[edges[:, 0], np.arange(len(edges)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = edges[:, 1]
    return lists


def edges_of(lists: np.ndarray) -> np.ndarray:
    row, column = np.nonzero(lists >= 0)
    return np.stack([row, lists[row, column]], axis=1)


def medoids(unit: np.ndarray) -> np.ndarray:
    """The rows nearest to the shard's mean and to the means of some regions of it."""
    means = learned_centres(unit, min(MEDOIDS, len(unit)), rounds=2)
    means = np.concatenate([unit.mean(0)[None, :], means])
    return np.unique((means @ unit.T).argmax(1))


def reached_from(lists: np.ndarray, starts: np.ndarray) -> np.ndarray:
    seen = np.zeros(len(lists) + 1, bool)
    seen[-1] = True  # the place of -1
    seen[starts] = True
    front = starts
    while len(front):
        found = np.unique(lists[front])
        front = found[~seen[found]]
        seen[front] = True
    return seen[:-1]


def built(unit: np.ndarray) -> np.ndarray:
    """Padded lists of the graph of one shard."""
    rows = len(unit)
    unit = unit.astype(np.float32)
    lists = pruned(unit, np.arange(rows), nearest_rows(unit, POOL), DEGREE)
    edges = edges_of(lists)
    both = np.unique(np.concatenate([edges, edges[:, ::-1]]), axis=0)
    lists = listed(both, rows)
    full = np.flatnonzero((lists >= 0).sum(1) > MOST)
    if len(full):
        again = pruned(unit, full, lists[full], MOST)
        lists[full] = -1
        lists[full, : again.shape[1]] = again
    starts = medoids(unit)
    while True:
        seen = reached_from(lists, starts)
        lost = np.flatnonzero(~seen)
        if not len(lost):
            return lists
        # Hung on the nearest row that is reached; a row less or more, as lists are flat.
        inside = np.flatnonzero(seen)
        hooks = np.concatenate(
            [inside[(unit[some] @ unit[inside].T).argmax(1)] for some in np.array_split(lost, -(-len(lost) // QUERIES))]
        )
        lists = listed(np.unique(np.concatenate([edges_of(lists), np.stack([hooks, lost], axis=1)]), axis=0), rows)


def found_in_range(
    unit: np.ndarray, lists: np.ndarray, queries: np.ndarray, reach: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """
    (query, row) of all rows whose cosine with a query is at least its `reach`, as far as greedy search
    from the medoids and expansion from all that is in range get.
    """
    rows, many = len(unit), len(queries)
    unit = np.concatenate([unit, np.zeros((1, unit.shape[1]), unit.dtype)])
    lists = np.where(lists < 0, rows, lists)
    seen = np.zeros((many, rows + 1), bool)
    seen[:, rows] = True
    starts = medoids(unit[:-1])
    seen[:, starts] = True
    scores = queries @ unit[starts].T
    hits = [np.nonzero(scores >= reach[:, None])]
    hits = [(hits[0][0], starts[hits[0][1]])]
    beam = max(beam, 1)
    held, ids = np.full((many, beam), -np.inf, np.float32), np.full((many, beam), rows, np.int64)
    top = np.argsort(-scores, axis=1)[:, :beam]
    held[:, : top.shape[1]] = np.take_along_axis(scores, top, 1)
    ids[:, : top.shape[1]] = starts[top]
    done = ids == rows
    going = np.arange(many)
    while len(going):
        pick = np.where(done[going], -np.inf, held[going]).argmax(1)
        open_ = ~done[going, pick]
        going, pick = going[open_], pick[open_]
        if not len(going):
            break
        done[going, pick] = True
        next_ = lists[ids[going, pick]]
        new = ~seen[going[:, None], next_]
        seen[going[:, None], next_] = True
        at, column = np.nonzero(new)
        rows_found, of = next_[at, column], going[at]
        score = np.einsum("nd,nd->n", queries[of], unit[rows_found])
        hit = score >= reach[of]
        hits.append((of[hit], rows_found[hit]))
        fresh = np.full(next_.shape, -np.inf, np.float32)
        fresh[at, column] = score
        all_scores = np.concatenate([held[going], fresh], axis=1)
        best = np.argpartition(-all_scores, beam - 1, axis=1)[:, :beam]
        held[going] = np.take_along_axis(all_scores, best, 1)
        ids[going] = np.take_along_axis(np.concatenate([ids[going], next_], axis=1), best, 1)
        finished = np.concatenate([done[going], np.broadcast_to(False, next_.shape)], axis=1)
        done[going] = np.take_along_axis(finished, best, 1) | np.isneginf(held[going])
    front = tuple(np.concatenate(one) for one in zip(*hits))
    out = [front]
    while len(front[0]):
        next_ = lists[front[1]]
        of = np.broadcast_to(front[0][:, None], next_.shape)
        code = np.unique((of * (rows + 1) + next_)[~seen[of, next_]])
        of, row = np.divmod(code, rows + 1)
        seen[of, row] = True
        hit = np.concatenate(
            [np.zeros(0, bool)]
            + [
                np.einsum("nd,nd->n", queries[of[i : i + 65_536]], unit[row[i : i + 65_536]]) >= reach[of[i : i + 65_536]]
                for i in range(0, len(of), 65_536)
            ]
        )
        front = (of[hit], row[hit])
        out.append(front)
    return tuple(np.concatenate(one) for one in zip(*out))


def dealt(rows: DataFrame, cluster: str, hashed: str) -> tuple[DataFrame, dict[int, int]]:
    """Rows with their `part`, and the parts of each cluster: there are at most `CLUSTERS`."""
    sizes = rows.groupBy(cluster).count().collect()
    parts = {row[cluster]: -(-row["count"] // SHARD_ROWS) if row["count"] > 2 * SHARD_ROWS else 1 for row in sizes}
    if not parts:
        return rows.withColumn("part", F.lit(0)), parts
    many = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])[F.col(cluster)]
    return rows.withColumn("part", F.pmod(F.xxhash64(hashed, F.lit(5)), many).cast("int")), parts


def with_near(rows: DataFrame, centres: np.ndarray, many: int, dim: int) -> DataFrame:
    """Rows with `near`, the numbers of the nearest clusters, nearest first."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = nearest(unit_rows(matrix(batch.column("vector"), dim)), centres, many).astype(np.int32)
            offsets = pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1])
            lists = pa.ListArray.from_arrays(offsets, pa.array(near.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "near"])

    schema = T.StructType([*rows.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(placed, schema)


def gathered(classes: DataFrame, centres: np.ndarray, dim: int, radius: float) -> DataFrame:
    """Each class (node, n) with its `ball`; a ball's centre also with vector, radius and weight."""
    placed = with_near(classes.select("node", "n", "vector"), centres, 1, dim)
    homes = landed(placed.withColumn("home", F.col("near")[0]).drop("near"), "homes")
    parted, _ = dealt(homes, "home", "node")
    unit = (F.col("home").cast("bigint") * (1 << 32) + F.col("part")).alias("unit")
    units = parted.select(unit, "node", "n", "vector").repartition("unit").sortWithinPartitions("unit", "node")
    kind = classes.schema["vector"].dataType.simpleString()

    def balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            for first, last in unit_ranges(table):
                part = table.slice(first, last - first).combine_chunks().to_batches()[0]
                unit = unit_rows(matrix(part.column("vector"), dim))
                centre = balls_of(unit, radius)
                own = centre == np.arange(len(unit))
                wide = np.zeros(len(unit))
                np.maximum.at(wide, centre, np.where(own, 0, angles(np.einsum("nd,nd->n", unit, unit[centre])) + _MARGIN))
                weight = np.bincount(centre, part.column("n").to_numpy(), len(unit)).astype(np.int64)
                node = part.column("node").to_numpy()
                columns = [
                    part.column("node"), part.column("n"), pa.array(node[centre]), pa.array(wide[centre]),
                    pa.array(weight[centre]), pa.array(np.where(own, np.arange(len(unit)), -1)),
                ]
                held = pa.array(np.arange(len(unit)), pa.int32(), mask=~own)
                columns[-1] = part.column("vector").take(held)
                yield pa.RecordBatch.from_arrays(columns, names=["node", "n", "ball", "radius", "weight", "vector"])

    schema = f"node long, n long, ball long, radius double, weight long, vector {kind}"
    return landed(units.mapInArrow(balls, schema), "balls")


def shards(centres_of_balls: DataFrame, index: Index, dim: int) -> tuple[DataFrame, dict[int, int]]:
    """A row for each ball and each of its nearest clusters, `place` 0 being the nearest."""
    near = with_near(centres_of_balls, index.centres, index.overlap, dim)
    rows = near.select(*centres_of_balls.columns, F.posexplode("near").alias("place", "cluster"))
    return dealt(rows, "cluster", "node")


def united_lists(rows: DataFrame, dim: int) -> DataFrame:
    """(node, links): the lists a node has in its shards, united."""
    unit = (F.col("cluster").cast("bigint") * (1 << 32) + F.col("part")).alias("unit")
    units = rows.select(unit, "node", "vector").repartition("unit").sortWithinPartitions("unit", "node")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            for first, last in unit_ranges(table):
                part = table.slice(first, last - first).combine_chunks().to_batches()[0]
                node = part.column("node").to_numpy()
                found = built(unit_rows(matrix(part.column("vector"), dim)))
                held = found >= 0
                offsets = np.concatenate([[0], np.cumsum(held.sum(1))]).astype(np.int32)
                links = pa.ListArray.from_arrays(pa.array(offsets), pa.array(node[found[held]]))
                yield pa.RecordBatch.from_arrays([pa.array(node), links], names=["node", "links"])

    each = units.mapInArrow(lists, "node long, links array<long>")
    return each.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.Table]]:
    """(unit, queries only, rows): a unit's index as one table, then its queries in tables of some rows."""
    held: list[pa.RecordBatch] = []
    now: tuple[int, bool] | None = None
    for batch in batches:
        units, only = batch.column("unit").to_numpy(), batch.column("only").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(units) != 0) | (only[1:] != only[:-1])) + 1
        for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if first == last:
                continue
            key = (int(units[first]), bool(only[first]))
            if held and (key != now or now[1]):
                yield *now, pa.Table.from_batches(held)
                held = []
            now = key
            held.append(batch.slice(first, last - first))
    if held:
        yield *now, pa.Table.from_batches(held)


def ball_pairs(
    rows: DataFrame, parts: dict[int, int], lists: DataFrame, dim: int, beam: int, limit: float
) -> DataFrame:
    """(a, b, weight_a, weight_b, sure): balls with links, `sure` if all of one and the other have."""
    columns = ["node", "vector", "radius", "weight"]
    unit = (F.col("cluster").cast("bigint") * (1 << 32) + F.col("part")).alias("unit")
    indexed = rows.join(lists, "node").select(
        unit, F.lit(False).alias("only"), (F.col("place") == 0).alias("asks"), *columns, "links"
    )
    split = [cluster for cluster, many in parts.items() if many > 1]
    if split:
        many = F.create_map(*[F.lit(x) for cluster in split for x in (cluster, parts[cluster])])[F.col("cluster")]
        asking = (
            rows.where((F.col("place") == 0) & F.col("cluster").isin(split))
            .withColumn("own", F.col("part"))
            .withColumn("part", F.explode(F.sequence(F.lit(0), many - 1)))
            .where("part <> own")
        )
        none = F.lit(None).cast("array<long>").alias("links")
        indexed = indexed.unionByName(
            asking.select(unit, F.lit(True).alias("only"), F.lit(True).alias("asks"), *columns, none)
        )
    units = indexed.repartition("unit").sortWithinPartitions("unit", "only", "node")
    wide = float(np.arccos(limit))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node = raw = unit = lists_here = radius = weight = None
        for _, only, table in _by_shard(batches):
            part = table.combine_chunks().to_batches()[0]
            own = matrix(part.column("vector"), dim)
            numbers = part.column("node").to_numpy()
            wide_of, weight_of = part.column("radius").to_numpy(), part.column("weight").to_numpy()
            if not only:
                node, raw, radius, weight = numbers, own, wide_of, weight_of
                unit = unit_rows(raw).astype(np.float32)
                links = part.column("links")
                sizes = np.asarray(links.value_lengths()).astype(np.int64)
                to = links.flatten().to_numpy()
                order = np.argsort(node)
                place = np.minimum(np.searchsorted(node[order], to), len(node) - 1)
                here = node[order[place]] == to
                edges = np.stack([np.repeat(np.arange(len(node)), sizes), order[place]], axis=1)[here]
                lists_here = listed(edges, len(node))
            asks = np.flatnonzero(part.column("asks").to_numpy(zero_copy_only=False))
            for first in range(0, len(asks), QUERIES):
                some = asks[first : first + QUERIES]
                # A little wider, as the search goes in single precision.
                reach = np.cos(np.minimum(np.pi, wide + wide_of[some] + radius.max(initial=0) + 1e-4))
                query = unit_rows(own[some]).astype(np.float32)
                q, row = found_in_range(unit, lists_here, query, reach.astype(np.float32), beam)
                q = some[q]
                other = numbers[q] != node[row]
                q, row = q[other], row[other]
                norms = np.sqrt(np.add.reduce(own[q] ** 2, axis=1) * np.add.reduce(raw[row] ** 2, axis=1))
                cosine = np.add.reduce(own[q] * raw[row], axis=1) / norms
                angle, slack = angles(cosine), wide_of[q] + radius[row]
                single = slack == 0
                sure = np.where(single, cosine >= limit, angle + slack <= wide - _MARGIN)
                maybe = np.where(single, cosine >= limit, angle - slack <= wide + _MARGIN)
                q, row, sure = q[maybe], row[maybe], sure[maybe]
                swap = numbers[q] > node[row]
                sides = [(numbers[q], node[row]), (weight_of[q], weight[row])]
                columns = [np.where(swap, side[1 - k], side[k]) for side in sides for k in (0, 1)]
                names = ["a", "b", "weight_a", "weight_b", "sure"]
                yield pa.RecordBatch.from_arrays([pa.array(one) for one in (*columns, sure)], names=names)

    found = units.mapInArrow(searched, "a long, b long, weight_a long, weight_b long, sure boolean")
    return found.groupBy("a", "b", "weight_a", "weight_b").agg(F.max("sure").alias("sure"))


def compared(mixed: DataFrame, balls: DataFrame, classes: DataFrame, dim: int, limit: float) -> DataFrame:
    """
    The members of pairs of balls compared one by one: (node, links, root), a member's links
    in the other ball and the member that stands for all it is connected to by them.
    """
    pairs = landed(mixed.select(F.monotonically_increasing_id().alias("unit"), "a", "b"), "mixed")
    sides = pairs.select("unit", F.col("a").alias("ball"), F.lit(0).alias("side")).unionByName(
        pairs.select("unit", F.col("b").alias("ball"), F.lit(1).alias("side"))
    )
    members = sides.join(balls.select("ball", "node", "n"), "ball").join(classes.select("node", "vector"), "node")
    units = members.select("unit", "side", "node", "n", "vector").repartition("unit")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_unit(batches):
            for first, last in unit_ranges(table):
                part = table.slice(first, last - first).combine_chunks().to_batches()[0]
                side, n = part.column("side").to_numpy(), part.column("n").to_numpy()
                rows = matrix(part.column("vector"), dim)
                norms = np.sqrt(np.add.reduce(rows * rows, axis=1))
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                cosine = rows[left] @ rows[right].T / (norms[left][:, None] * norms[right])
                # As good as the limit itself in another order of adding: worked out alike everywhere.
                for i, j in np.argwhere(np.abs(cosine - limit) < 1e-12):
                    a, b = left[i], right[j]
                    cosine[i, j] = np.add.reduce(rows[a] * rows[b]) / np.sqrt(
                        np.add.reduce(rows[a] ** 2) * np.add.reduce(rows[b] ** 2)
                    )
                alike = np.zeros((len(rows), len(rows)), bool)
                alike[np.ix_(left, right)] = cosine >= limit
                alike |= alike.T
                node = part.column("node").to_numpy()
                columns = [node, alike @ n, node[forest(alike)]]
                yield pa.RecordBatch.from_arrays([pa.array(one) for one in columns], names=["node", "links", "root"])

    return units.sortWithinPartitions("unit", "side", "node").mapInArrow(linked, "node long, links long, root long")


def searched_links(
    classes: DataFrame, balls: DataFrame, index: Index, dim: int, limit: float
) -> tuple[DataFrame, DataFrame]:
    """(node, links) of all classes, copies included, and edges (a, b) that connect what is linked."""
    centres = balls.where(F.col("node") == F.col("ball")).select("node", "vector", "radius", "weight")
    rows, parts = shards(centres, index, dim)
    lists = landed(united_lists(rows, dim), "lists")
    pairs = landed(ball_pairs(rows, parts, lists, dim, index.beam, limit), "pairs")
    singles = landed(compared(pairs.where("not sure"), balls, classes, dim, limit), "compared")
    sure = pairs.where("sure")
    by_ball = sure.select(F.col("a").alias("ball"), F.col("weight_b").alias("more")).unionByName(
        sure.select(F.col("b").alias("ball"), F.col("weight_a").alias("more"))
    ).groupBy("ball").agg(F.sum("more").alias("more"))
    by_node = singles.groupBy("node").agg(F.sum("links").alias("some"))
    zero = F.lit(0).cast("bigint")
    links = F.col("weight") - 1 + F.coalesce("more", zero) + F.coalesce("some", zero)
    counted = balls.drop("vector").join(by_ball, "ball", "left").join(by_node, "node", "left")
    edges = (
        sure.select("a", "b")
        .unionByName(singles.select(F.col("node").alias("a"), F.col("root").alias("b")))
        .unionByName(balls.select(F.col("node").alias("a"), F.col("ball").alias("b")))
        .where("a <> b")
    )
    return landed(counted.select("node", links.alias("links")), "links"), edges


def audited_recall(classes: DataFrame, links: DataFrame, dim: int, limit: float, rows: int = AUDIT) -> float:
    """The share of a sample's links that were found, by brute force against all classes."""
    sample = classes.orderBy(F.xxhash64("node", F.lit(17)), "node").limit(rows).select("node", "vector").collect()
    own = matrix(pa.array([row["vector"] for row in sample], pa.list_(pa.float64())), dim)
    queries, nodes = unit_rows(own), [row["node"] for row in sample]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(queries), np.int64)
        for batch in batches:
            unit = unit_rows(matrix(batch.column("vector"), dim))
            total += ((unit @ queries.T >= limit) * batch.column("n").to_numpy()[:, None]).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(total)], names=["node", "true"])

    true = classes.select("n", "vector").mapInArrow(counted, "node long, true long").groupBy("node").agg(
        (F.sum("true") - 1).alias("true")
    )
    both = true.join(links, "node").agg(F.sum(F.least("true", "links")).alias("found"), F.sum("true").alias("all"))
    row = both.first()
    return 1.0 if not row["all"] else row["found"] / row["all"]


def linked_classes(classes: DataFrame, many: int, dim: int, limit: float) -> tuple[DataFrame, DataFrame]:
    """Links and edges of the classes of one length, searched ever wider until the audit is passed."""
    sample = classes.orderBy(F.xxhash64("node", F.lit(3)), "node").limit(SAMPLE).select("vector").collect()
    unit = unit_rows(matrix(pa.array([row["vector"] for row in sample], pa.list_(pa.float64())), dim))
    centres = learned_centres(unit, max(1, min(CLUSTERS, len(unit), -(-many * OVERLAP // SHARD_ROWS))))
    balls = gathered(classes, centres, dim, BALL * float(np.arccos(limit)))
    index = Index(centres, OVERLAP, BEAM)
    while True:
        links, edges = searched_links(classes, balls, index, dim, limit)
        whole = index.overlap >= len(centres) and index.beam >= 2 * SHARD_ROWS
        if whole or audited_recall(classes, links, dim, limit) >= RECALL:
            return links, edges
        index = Index(centres, 2 * index.overlap, 2 * index.beam)


def near_duplicates(embeddings: DataFrame, limit: float = LIMIT) -> DataFrame:
    """Per row: vec_id, n_links, component_id (the least vec_id within reach) and kept."""
    spark = embeddings.sparkSession
    single = embeddings.schema["embedding"].dataType.simpleString() == "array<float>"
    vector = F.col("embedding").cast("array<float>" if single else "array<double>")
    rows = landed(
        embeddings.select(
            F.col("vec_id").cast("bigint").alias("vec_id"),
            F.when(F.coalesce(usable(vector), F.lit(False)), vector).alias("vector"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "vectors",
    )
    grouped = rows.where(F.col("vector").isNotNull()).groupBy("vector").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least")
    )
    classes = landed(grouped, "classes")
    found: list[tuple[DataFrame, DataFrame]] = []
    for row in classes.groupBy(F.size("vector").alias("dim")).count().orderBy("dim").collect():
        alike = classes.where(F.size("vector") == row["dim"])
        found.append(linked_classes(alike, row["count"], row["dim"], limit))
    if not found:
        none = spark.createDataFrame([], "node long, links long")
        found = [(none, spark.createDataFrame([], "a long, b long"))]
    links, edges = found[0]
    for more, others in found[1:]:
        links, edges = links.unionByName(more), edges.unionByName(others)
    groups = connected_components(edges)
    named = classes.select("node", "n", "least").join(links, "node").join(
        groups.withColumnRenamed("vertex", "node"), "node", "left"
    )
    named = landed(named.withColumn("component", F.coalesce("component", "node")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    results = landed(named.join(least, "component").select("node", "n", "links", "component_id"), "results")
    # Rows of repeated vectors find their class by the vector, dealt by a salt, as one may hold most
    # rows; those of the others are the class's node.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    repeated = classes.where("n > 1").select("node", "vector").join(
        results.select("node", F.col("links").alias("more"), F.col("component_id").alias("of_copies")), "node"
    ).select("vector", "more", "of_copies", salts)
    alone = results.where("n = 1").select(F.col("node").alias("row"), "links", "component_id")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    joined = salted.join(repeated, ["vector", "salt"], "left").join(alone, "row", "left")
    n_links = F.coalesce("links", "more", F.lit(0).cast("bigint"))
    component = F.when(n_links == 0, F.col("vec_id")).otherwise(F.coalesce("component_id", "of_copies"))
    return joined.select(
        "vec_id", n_links.alias("n_links"), component.alias("component_id"),
        F.when(n_links == 0, F.lit(True)).otherwise(F.coalesce(F.col("vec_id") == component, F.lit(False))).alias("kept"),
    )
