"""
Whitening of embeddings on their leading components, found by spectrum slicing.

Vectors are taken on an integer grid, x = floor(64 * c) + 1000000, and each distinct one counts
once in the fit: n vectors, their sums S by dimension and the covariance of x - S / n. All
sums over rows are Spark's: each task adds up its own rows, and the partial rows of a matrix meet by
their index, so the driver gets one matrix of the vectors' length, whatever the number of rows.

The eigenvalues are then found there by slicing. The signs of the pivots of an LDLᵀ factorisation of
V - s I tell how many eigenvalues lie above s (Sylvester). Bisection on s isolates each leading
eigenvalue, Rayleigh quotient iteration converges to it cubically, and two more counts, just above
and just below, certify that the eigenvalue found is the one of that number. Eigenvalues that no
count can tell apart are taken together, with an orthonormal basis of their space.

Defined cases: rows whose vector is null or holds a null or non-finite component are left out, also
of the fit; rows without vec_id stay; rows that repeat a vec_id or a vector are returned each, but
an equal vector counts once in the fit. Vectors of different lengths have fits of their own.
Components without variance (an eigenvalue that is zero but for rounding) do not exist, so a fit
of one vector, or of empty ones, returns no rows, and neither does an empty table. 64 * c beyond
2**62 counts as 2**62. A deviation that no long holds is null. Other columns are not read, so their
names can clash with nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from response_ledger.session import landed

COMPONENTS = 16
GRID, ORIGIN, LARGEST = 64, 1_000_000, 2**62
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
_EPS = float(np.finfo(float).eps)


class Sums(NamedTuple):
    """A fit's exact figures: vectors, their sums by dimension, the largest absolute entry."""

    n: int
    total: list[int]
    most: int


class Model(NamedTuple):
    sums: Sums
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def on_grid(vector: Column) -> Column:
    """A vector's whole-number form; null where it takes no part."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(
        vector, lambda c: F.greatest(F.least(F.floor(c * GRID), F.lit(LARGEST)), F.lit(-LARGEST)) + ORIGIN
    )
    return F.when(F.coalesce(finite, F.lit(False)), scaled)


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, matrix) for each length of vector in a batch."""
    lengths = np.asarray(column.value_lengths())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else lengths
    for dim in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == dim)
        yield dim, places, flat[starts[places][:, None] + np.arange(dim)]


def scaled_deviation(x: np.ndarray, sums: Sums) -> np.ndarray:
    """n * x - S, exact: in 64 bits where they hold it, else in Python's integers."""
    if 2 * sums.n * sums.most < 2**62:
        return sums.n * x - np.array(sums.total, np.int64)
    return sums.n * x.astype(object) - np.array(sums.total, object)


def centred(x: np.ndarray, sums: Sums) -> np.ndarray:
    return (scaled_deviation(x, sums) / sums.n).astype(float)


def fit_sums(fit: DataFrame) -> dict[int, Sums]:
    """Exact figures of the fit list, by length of vector."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for dim, places, x in by_length(batch.column("x")):
                n, high, low, most = held.get(dim, (0, 0, 0, np.zeros(dim, np.int64)))
                held[dim] = [
                    n + len(places), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0),
                    np.maximum(most, np.abs(x).max(0, initial=0)),
                ]
        for dim, (n, high, low, most) in held.items():
            if dim:
                columns = [np.full(dim, dim), np.arange(dim), np.full(dim, n), high, low, most]
                names = ["dim", "place", "n", "high", "low", "most"]
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()) for one in columns], names=names)

    parts = fit.select("x").mapInArrow(added, "dim long, place long, n long, high long, low long, most long")
    exact = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("n", "high", "low")]
    rows = parts.groupBy("dim", "place").agg(*exact, F.max("most").alias("most")).orderBy("dim", "place").collect()
    out: dict[int, Sums] = {}
    for row in rows:
        so_far = out.get(row["dim"], Sums(int(row["n"]), [], 0))
        total = (int(row["high"]) << 32) + int(row["low"])
        out[row["dim"]] = Sums(so_far.n, [*so_far.total, total], max(so_far.most, row["most"], abs(total) // so_far.n))
    return out


def product_sums(fit: DataFrame, rows_of: Callable[[int, np.ndarray], np.ndarray | None]) -> dict[int, np.ndarray]:
    """For each length the sum of rowᵀ row over what `rows_of` makes of the fit's vectors."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in by_length(batch.column("x")):
                rows = rows_of(dim, x)
                if rows is not None:
                    held[dim] = held.get(dim, 0.0) + rows.T @ rows
        yield from _matrix_rows({(dim, i): row for dim, matrix in held.items() for i, row in enumerate(matrix)})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, i, part in zip(*(batch.column(name).to_pylist() for name in ("dim", "i")), batch.column("part")):
                held[dim, i] = held.get((dim, i), 0.0) + part.values.to_numpy()
        yield from _matrix_rows(held)

    schema = "dim long, i long, part array<double>"
    parts = fit.select("x").mapInArrow(partial, schema).repartition("dim", "i").mapInArrow(summed, schema)
    out: dict[int, list] = {}
    for row in parts.orderBy("dim", "i").collect():
        out.setdefault(row["dim"], []).append(row["part"])
    return {dim: np.array(rows) for dim, rows in out.items()}


def _matrix_rows(held: dict[tuple[int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    columns = [
        pa.array([dim for dim, _ in held], pa.int64()), pa.array([i for _, i in held], pa.int64()),
        pa.array([row.tolist() for row in held.values()], pa.list_(pa.float64())),
    ]
    yield pa.RecordBatch.from_arrays(columns, names=["dim", "i", "part"])


def inertia_above(matrix: np.ndarray, shift: float) -> int:
    """
    How many eigenvalues of a symmetric matrix are above `shift`: the positive pivots of an
    LDLᵀ factorisation of matrix - shift I, pivots of one or two rows chosen for stability.
    """
    a = matrix - shift * np.eye(len(matrix))
    size, k, above = len(a), 0, 0
    ratio = (1 + 17**0.5) / 8
    while k < size:
        own, wide, swap = abs(a[k, k]), 1, k
        if k + 1 < size:
            below = np.abs(a[k + 1 :, k])
            r = int(below.argmax()) + k + 1
            most = below[r - k - 1]
            if own < ratio * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if own * other < ratio * most * most:
                    swap = r
                    if abs(a[r, r]) < ratio * other:
                        wide = 2
        at = k + wide - 1
        if swap != at and swap != k:
            a[[at, swap]] = a[[swap, at]]
            a[:, [at, swap]] = a[:, [swap, at]]
        pivot, rest = a[k : k + wide, k : k + wide], a[k + wide :, k : k + wide]
        if wide == 1:
            if pivot[0, 0] > 0:
                above += 1
            if pivot[0, 0] != 0:
                a[k + 1 :, k + 1 :] -= rest * (rest.T / pivot[0, 0])
        else:
            above += 1  # such a pair of rows has one eigenvalue of each sign
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
        k += wide
    return above


class Spectrum:
    """The leading eigenpairs of a covariance; `counts` remembers what each shift has told."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.matrix = (matrix + matrix.T) / 2
        self.norm = float(np.abs(self.matrix).sum(0).max(initial=0.0))
        self.least = 8 * max(1, len(matrix)) * _EPS * self.norm
        self.counts: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = inertia_above(self.matrix, shift)
        return self.counts[shift]

    def leading(self, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """(values, rows of unit vectors), by falling value, of those that are not zero."""
        values: list[float] = []
        vectors: list[np.ndarray] = []
        exist = self.above(self.least) if self.norm else 0
        while len(values) < min(wanted, exist):
            found = self.next(len(values) + 1, np.array(vectors).reshape(-1, len(self.matrix)))
            values += [value for value, _ in found]
            vectors += [vector for _, vector in found]
        values, vectors = values[:wanted], vectors[:wanted]
        return np.array(values), np.array(vectors).reshape(-1, len(self.matrix))

    def next(self, number: int, before: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """The eigenpair of that number, or all those that no count tells apart from it."""
        low = max([s for s, n in self.counts.items() if n >= number], default=0.0)
        high = min([s for s, n in self.counts.items() if n < number], default=2 * self.norm)
        apart = 16 * max(8, len(self.matrix)) * _EPS * self.norm
        while high - low > apart:
            if self.above(low) == number and high - low < 0.05 * high:
                pair = self.refined((low + high) / 2, before)
                if pair and self.certified(pair[0], number, apart):
                    return [pair]
            middle = (low + high) / 2
            if middle in (low, high):
                break
            low, high = (middle, high) if self.above(middle) >= number else (low, middle)
        return self.together((low + high) / 2, self.above(low) - number + 1, before)

    def certified(self, value: float, number: int, apart: float) -> bool:
        return self.above(value - apart) == number and self.above(value + apart) == number - 1

    def solve(self, shift: float, right: np.ndarray) -> np.ndarray:
        try:
            out = np.linalg.solve(self.matrix - shift * np.eye(len(self.matrix)), right)
            if np.isfinite(out).all():
                return out
        except np.linalg.LinAlgError:
            pass
        # The shift is an eigenvalue to the last bit; beside it the direction is the same.
        beside = shift + 4 * _EPS * self.norm
        return np.linalg.solve(self.matrix - beside * np.eye(len(self.matrix)), right)

    def refined(self, shift: float, before: np.ndarray) -> tuple[float, np.ndarray] | None:
        """Rayleigh quotient iteration from the vector that `shift` blows up most."""
        vector = np.random.default_rng(7).normal(size=len(self.matrix))
        for _ in range(2):
            vector = self.solve(shift, vector)
            vector /= np.linalg.norm(vector)
        best = (float("inf"), 0.0, vector)
        for _ in range(12):
            value = float(vector @ self.matrix @ vector)
            residual = float(np.linalg.norm(self.matrix @ vector - value * vector))
            if residual >= best[0]:
                break
            best = (residual, value, vector)
            vector = self.solve(value, vector)
            vector /= np.linalg.norm(vector)
        residual, value, vector = best
        if residual > 64 * len(self.matrix) * _EPS * self.norm:
            return None
        vector = vector - before.T @ (before @ vector)
        return value, signed(vector / np.linalg.norm(vector))

    def together(self, shift: float, many: int, before: np.ndarray) -> list[tuple[float, np.ndarray]]:
        """An orthonormal basis of the space of `many` eigenvalues around `shift`."""
        basis = np.random.default_rng(7).normal(size=(len(self.matrix), many))
        for _ in range(6):
            basis = self.solve(shift, basis)
            basis -= before.T @ (before @ basis)
            basis = np.linalg.qr(basis / np.linalg.norm(basis, axis=0))[0]
        values, turn = np.linalg.eigh(basis.T @ self.matrix @ basis)
        basis = basis @ turn
        return [(float(values[i]), signed(basis[:, i])) for i in range(many - 1, -1, -1)]


def signed(vector: np.ndarray) -> np.ndarray:
    """Of the two signs, the one whose largest entry is positive."""
    return vector if vector[np.abs(vector).argmax()] > 0 else -vector


def fitted(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """A model for each length of vector in the fit list (a column `x`)."""
    sums = fit_sums(fit)
    products = product_sums(fit, lambda dim, x: centred(x, sums[dim]) if dim in sums else None)
    out = {}
    for dim, product in products.items():
        covariance = product / sums[dim].n
        values, vectors = Spectrum(covariance).leading(components)
        if len(values):
            out[dim] = Model(sums[dim], vectors, values, float(np.trace(covariance)))
    return out


def whitened_rows(x: np.ndarray, model: Model) -> np.ndarray:
    return centred(x, model.sums) @ model.vectors.T / np.sqrt(model.values)


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length, the largest entry of the whitened fit's covariance less the identity."""
    # What is centred in x has whitened values of mean zero, so these are centred, too.
    products = product_sums(fit, lambda dim, x: whitened_rows(x, models[dim]) if dim in models else None)
    return {
        dim: float(np.abs(product / models[dim].sums.n - np.eye(len(product))).max())
        for dim, product in products.items()
    }


def exact_squares(scaled: np.ndarray) -> pa.Array:
    """Sums of squares by row; null where no long holds them."""
    if scaled.dtype != object:
        most = int(np.abs(scaled).max(initial=0))
        if most * most * scaled.shape[1] < 2**63:
            return pa.array((scaled * scaled).sum(1))
    sums = [sum(int(one) * int(one) for one in row) for row in scaled.tolist()]
    return pa.array([one if one < 2**63 else None for one in sums], pa.int64())


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """
    (vec_id, component, n, deviation, whitened, explained, identity_error) for each row that takes
    part and each component of its fit.
    """
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select("vec_id", on_grid(vector).alias("x")).where(F.col("x").isNotNull())
    fit = landed(rows.select("x").distinct(), "fit")
    models = fitted(fit, components)
    errors = identity_errors(fit, models)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, places, x in by_length(batch.column("x")):
                if dim not in models:
                    continue
                model = models[dim]
                many, count = len(places), len(model.values)
                each = pa.array(np.repeat(np.arange(many), count))
                columns = [
                    batch.column("vec_id").take(pa.array(places)).take(each),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * count, model.sums.n)),
                    exact_squares(scaled_deviation(x, model.sums)).take(each),
                    pa.array(whitened_rows(x, model).reshape(-1)),
                    pa.array(np.tile(model.values / model.trace, many)),
                    pa.array(np.full(many * count, errors[dim])),
                ]
                names = [one.split()[0] for one in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "x").mapInArrow(projected, RESULT)
