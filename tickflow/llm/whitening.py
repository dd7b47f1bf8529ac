"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

With the rows centred, ``X`` is reduced step by step to a bidiagonal matrix: a product ``Xv`` gives
the next left vector, a product ``X'u`` the next right one, each made orthogonal to all before it.
A step is one pass over the table, in which each task takes both products for its own rows and
returns their sums. A left vector has an entry per row and is never stored: it is ``X`` times a short
vector, so tasks compute their entries from the rows at hand. The singular values of the small bidiagonal matrix are the
deviations, its right singular vectors the components in terms of the right vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.tables import settle

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
"""An entry c becomes the whole number floor(SCALE * c) + SHIFT."""
TINY = 1e-13
"""Deviations below this share of the largest are rounding; so are residuals of converged ones."""
BLOCK_ROWS = 1 << 13
PASS_TASKS = 4096
"""Tasks of a pass at most: the driver adds up as many short vectors."""
_LONGEST = 2**63 - 1


def whole_entries(vector: str) -> Column:
    """The vector's entries as whole numbers, in doubles until they are long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT)


def usable(vector: str) -> Column:
    """Neither null nor with entries that are null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & finite, F.lit(False))


def _matrices(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches, a bounded number of rows at a time, with their vectors as a matrix."""
    for batch in batches:
        for first in range(0, len(batch), BLOCK_ROWS):
            part = batch.slice(first, BLOCK_ROWS)
            yield part, part["x"].flatten().to_numpy().reshape(-1, dimensions)


@dataclass(frozen=True)
class Centre:
    """How many vectors there are, their exact sums per dimension, and the exact range of each."""

    n: int
    sums: tuple[int, ...]
    lows: tuple[int, ...]
    highs: tuple[int, ...]

    def __len__(self) -> int:
        return len(self.sums)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """Rows less their mean; a whole number near the mean goes first, so that nothing is rounded off."""
        near = np.array([total // self.n for total in self.sums], dtype=np.int64)
        rest = np.array([(total % self.n) / self.n for total in self.sums])
        return (rows - near).astype(np.float64) - rest

    def deviations(self, rows: np.ndarray) -> np.ndarray:
        """The exact sum over dimensions of (n * x - sum) ** 2 for every row."""
        sums = np.array(self.sums, dtype=np.int64)
        return ((rows * self.n - sums) ** 2).sum(axis=1)

    def check(self) -> None:
        """Raises unless every row's deviation fits 64 bits."""
        largest = sum(
            max(self.n * high - total, total - self.n * low) ** 2
            for total, low, high in zip(self.sums, self.lows, self.highs)
        )
        if largest > _LONGEST or self.n * max(map(abs, (*self.lows, *self.highs)), default=0) > _LONGEST:
            raise OverflowError("a deviation may not fit a long")


def _totals(rows: DataFrame) -> Centre:
    """One row per dimension comes to the driver; sums are exact."""
    entries = rows.select(F.posexplode("x").alias("at", "entry"))
    found = entries.groupBy("at").agg(
        F.count("*").alias("n"),
        F.sum(F.col("entry").cast("decimal(38,0)")).alias("total"),
        F.min("entry").alias("low"),
        F.max("entry").alias("high"),
    )
    listed = sorted(found.collect())
    return Centre(
        listed[0]["n"] if listed else 0,
        tuple(int(row["total"]) for row in listed),
        tuple(row["low"] for row in listed),
        tuple(row["high"] for row in listed),
    )


def _summed(rows: DataFrame, centre: Centre, of) -> np.ndarray:
    """The sum over all rows of a fixed number of values; ``of`` gives those of a centred block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, block in _matrices(batches, len(centre)):
            found = of(centre.centred(block))
            total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()])], ["sums"])

    tasks = rows.select("x").coalesce(PASS_TASKS).mapInArrow(add, "sums array<double>")
    return np.sum([row["sums"] for row in tasks.collect()], axis=0)


def _orthogonal(vector: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The part of a vector that is orthogonal to the columns of a basis, taken twice."""
    for _ in range(2):
        vector = vector - basis @ (basis.T @ vector)
    return vector


def bidiagonalise(rows: DataFrame, centre: Centre, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors as columns, singular values) of the centred rows, largest first.

    Steps end when every direction has been seen or the wanted values no longer move. The driver
    holds vectors of as many entries as there are dimensions.
    """
    size = len(centre)
    rng = np.random.default_rng(0)

    def fresh(basis: np.ndarray) -> np.ndarray:
        vector = _orthogonal(rng.standard_normal(size), basis)
        return vector / np.linalg.norm(vector)

    right = np.zeros((size, 0))
    # Column j of short, times X, is the left vector j; column j of back is X' times that.
    short, back = np.zeros((size, 0)), np.zeros((size, 0))
    diagonal, above = [], []
    vector, scale = fresh(right), 0.0
    while True:
        right = np.column_stack([right, vector])

        # Every left vector's share of Xv is known, as X' times it is; what rounding leaves of
        # them is found in the same pass as X' times the new one, and taken out too.
        aim = vector - short @ (back.T @ vector)

        def both(block: np.ndarray, v: np.ndarray = aim, left: np.ndarray = short) -> np.ndarray:
            entries = block @ v
            return np.concatenate([block.T @ entries, (block @ left).T @ entries, [entries @ entries]])

        found = _summed(rows, centre, both)
        turned, again, square = found[:size], found[size:-1], found[-1]
        length = float(np.sqrt(max(square - again @ again, 0.0)))
        scale = max(scale, length)
        if length > TINY * scale and scale > 0:
            short = np.column_stack([short, (aim - short @ again) / length])
            back = np.column_stack([back, (turned - back @ again) / length])
            next_right = back[:, -1] - length * vector
        else:
            length = 0.0
            short, back = (np.column_stack([x, np.zeros(size)]) for x in (short, back))
            next_right = np.zeros(size)
        diagonal.append(length)
        steps = len(diagonal)
        if steps == size:
            break
        next_right = _orthogonal(next_right, right)
        step = float(np.linalg.norm(next_right))
        scale = max(scale, step)
        if scale == 0.0:
            break
        if step > TINY * scale:
            # All residuals small: what is left of the matrix does not touch the wanted values.
            left_side, values, _ = np.linalg.svd(_bidiagonal(diagonal, above))
            residuals = step * np.abs(left_side[-1, : min(wanted, steps)])
            if steps >= wanted and (residuals < TINY * values[0]).all():
                break
            vector = next_right / step
        else:
            # The space is used up; another direction may hold more.
            step, vector = 0.0, fresh(right)
        above.append(step)
    _, values, turned = np.linalg.svd(_bidiagonal(diagonal, above[: len(diagonal) - 1]))
    components = right @ turned.T
    # Either sign is right; the entry of most weight is positive, so that runs agree.
    most = np.abs(components).argmax(axis=0)
    return components * np.sign(components[most, np.arange(components.shape[1])]), values


def _bidiagonal(diagonal: list[float], above: list[float]) -> np.ndarray:
    matrix = np.diag(diagonal)
    at = np.arange(len(diagonal) - 1)
    matrix[at, at + 1] = above[: len(at)]
    return matrix


def whiten(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Every usable vector on the principal components, in units of their deviations.

    ``vectors`` needs the key and the vector column; others are ignored. Returns for each row with
    a usable vector and each of at most ``components`` components, numbered from 1 by falling
    variance: the key, component, n (usable vectors), deviation (exact sum over dimensions of
    (n * x - sum of x) ** 2), whitened, explained (share of all variance) and identity_error (the
    largest absolute entry of whitened's covariance less the identity, one value for all).

    Rows whose vector is null or holds null or non-finite entries are dropped. The dimension is
    that of most usable vectors, the larger among equals; vectors of another length are dropped,
    and empty ones have no components. Repeated rows and null keys count and are answered each.
    A direction in which vectors do not differ is no component, so equal vectors, a single one and
    an empty table give no rows. Sums that do not fit a long raise an error.
    """
    taken = vectors.filter(usable(vector)).select(F.col(key), whole_entries(vector).alias("x"))
    rows = settle(taken, "whole-vectors")
    # One row per length.
    lengths = rows.groupBy(F.size("x").alias("length")).count().collect()
    layout = f"component int, n long, deviation long, whitened double, explained double, identity_error double"
    dimensions = max(lengths, key=lambda row: (row["count"], row["length"]))["length"] if lengths else 0
    rows = rows.filter(F.size("x") == dimensions)
    centre = _totals(rows)
    if not centre.n:
        nothing = [F.lit(None).cast(part.split()[1]).alias(part.split()[0]) for part in layout.split(", ")]
        return rows.select(key, *nothing).limit(0)
    centre.check()
    axes, values = bidiagonalise(rows, centre, components)
    kept = np.flatnonzero(values > TINY * max(values[0], 1e-300) * 10)[:components]
    axes, deviations = axes[:, kept], values[kept] / np.sqrt(centre.n)
    # The trace of the covariance needs no decomposition.
    trace = float(_summed(rows, centre, lambda block: (block**2).sum(axis=0)).sum()) / centre.n
    explained = deviations**2 / trace if trace else deviations
    turn = axes / deviations

    def moments(block: np.ndarray) -> np.ndarray:
        white = block @ turn
        return np.concatenate([white.sum(axis=0), (white.T @ white).ravel()])

    error = 0.0
    if len(kept):
        found = _summed(rows, centre, moments) / centre.n
        mean, second = found[: len(kept)], found[len(kept) :].reshape(len(kept), len(kept))
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(kept))).max())

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, block in _matrices(batches, dimensions):
            count = len(kept)
            numbers = pa.array(np.repeat(np.arange(len(part)), count))
            size = len(part) * count
            columns = [
                part[key].take(numbers),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(part))),
                pa.array(np.full(size, centre.n)),
                pa.array(np.repeat(centre.deviations(block), count)),
                pa.array((centre.centred(block) @ turn).ravel()),
                pa.array(np.tile(explained, len(part))),
                pa.array(np.full(size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, *(part.split()[0] for part in layout.split(", "))])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(answer, f"{key} {kind}, {layout}")
