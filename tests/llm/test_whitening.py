import numpy as np
import pytest

from tickflow.llm import whitening
from tickflow.llm.whitening import whiten


def table(spark, vectors, **extra):
    rows = [(number, None if v is None else [None if x is None else float(x) for x in v]) for number, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)


def compare(frame, vectors, dimensions, components):
    kept = [
        (number, v) for number, v in enumerate(vectors)
        if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(np.float32(x)) for x in v)
    ]
    exact = [[int(np.floor(64 * float(np.float32(x)))) + 1_000_000 for x in v] for _, v in kept]
    x, n = np.array(exact, dtype=np.int64), len(kept)
    centred = x - x.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    rows = sorted(frame.collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.vec_id, r.component) for r in rows] == [(k, c) for k, _ in kept for c in range(1, components + 1)]
    white = np.array([r.whitened for r in rows]).reshape(n, components)
    expected = centred @ axes / np.sqrt(values)
    assert np.abs(white * np.sign((white * expected).sum(axis=0)) - expected).max() < 1e-7
    explained = np.array([r.explained for r in rows]).reshape(n, components)[0]
    assert np.allclose(explained, values / np.trace(centred.T @ centred / n), rtol=1e-9)
    sums = [sum(column) for column in zip(*exact)]
    deviations = [sum((n * entry - total) ** 2 for entry, total in zip(row, sums)) for row in exact]
    assert [r.deviation for r in rows[::components]] == deviations
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-9


def test_whitened_equals_an_eigendecomposition(spark):
    rng = np.random.default_rng(4)
    vectors = list(rng.normal(size=(200, 7)) * [9, 5, 3, 3, 1, 1, 0.5] + rng.normal(size=7))
    vectors += [None, [None] * 7, [1.0] * 6 + [float("nan")], [float("inf")] * 7, [], [1.0, 2.0]]
    vectors += [vectors[0]] * 60
    compare(whiten(table(spark, vectors)), vectors, 7, 7)
    compare(whiten(table(spark, vectors), components=3), vectors, 7, 3)


def test_directions_without_deviation_are_no_components(spark):
    rng = np.random.default_rng(5)
    flat = rng.integers(-3, 4, size=(50, 2))
    # Whole numbers stay exact when scaled: two directions in five dimensions.
    vectors = [[a, b, a + b, a - b, 1.0] for a, b in flat.tolist()]
    compare(whiten(table(spark, vectors)), vectors, 5, 2)
    compare(whiten(table(spark, [[0.0], [3.0], [5.0]])), [[0.0], [3.0], [5.0]], 1, 1)


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_rows_without_deviation(spark, vectors):
    assert whiten(table(spark, vectors)).collect() == []


def test_other_columns_and_overflow(spark):
    rows = [(k, [float(k), float(k * k % 7)], "a", 1.0, 5) for k in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, x string, whitened double, n int")
    compare(whiten(frame), [row[1] for row in rows], 2, 2)
    wide = spark.createDataFrame([(k, [k * 1e9]) for k in range(5)], "vec_id long, embedding array<double>")
    with pytest.raises(OverflowError):
        whiten(wide)


def test_close_values_converge_early(spark, monkeypatch):
    rng = np.random.default_rng(6)
    scales = np.concatenate([[50, 30], np.full(18, 0.05)])
    vectors = list(rng.normal(size=(300, 20)) * scales)
    compare(whiten(table(spark, vectors), components=2), vectors, 20, 2)
    assert whitening.COMPONENTS == 32
