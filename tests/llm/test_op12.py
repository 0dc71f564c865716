"""Whitening against a dense solver, updates of spectra against numpy."""

from __future__ import annotations

import numpy as np
import pytest

from parcelflow.llm import spectrum, whitening
from parcelflow.llm.common import table

CASES = {
    "random": lambda r: r.normal(size=(120, 24)) * 100,
    "few directions": lambda r: np.repeat(r.normal(size=(4, 16)), 20, axis=0),
    "axes": lambda r: np.eye(12)[r.integers(0, 12, 90)],
    "small integers": lambda r: r.integers(-1, 2, (90, 6)).astype(float),
    "zeros": lambda r: np.zeros((5, 4)),
    "one dimension": lambda r: r.normal(size=(60, 1)),
    "graded": lambda r: r.normal(size=(80, 14)) * 10.0 ** -np.arange(14),
    "equal rows": lambda r: np.ones((50, 5)),
}


def _holds(d, u, scatter):
    size = max(1e-300, np.abs(scatter).max())
    assert np.abs(u.T @ u - np.eye(len(d))).max() < 1e-12
    assert (np.diff(d) >= 0).all() and np.abs((u * d) @ u.T - scatter).max() < 1e-12 * size


@pytest.mark.parametrize("case", CASES)
def test_rank_one_updates_give_the_scatters_spectrum(case):
    rows = CASES[case](np.random.default_rng(4))
    d, u = spectrum.empty(rows.shape[1])
    for v in rows:
        d, u = spectrum.updated(d, u, v)
    _holds(d, u, rows.T @ rows)
    parts = [spectrum.with_rows(*spectrum.empty(rows.shape[1]), rows[i::3]) for i in range(3)]
    whole = spectrum.combined(spectrum.combined(parts[0], parts[1]), parts[2])
    _holds(*whole, rows.T @ rows)


def _plain(rows, components=8):
    """The contract with a dense solver; sums in whole numbers."""
    ok = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    dims = [len(v) for _, v in ok]
    dim = min(set(dims), key=lambda d: (-dims.count(d), d)) if ok else 0
    ok = [(i, [int(np.floor(1024 * float(c))) + 100_000 for c in v]) for i, v in ok if len(v) == dim]
    if not ok:
        return []
    n = len(ok)
    total = [sum(x[k] for _, x in ok) for k in range(dim)]
    centred = np.array([[(n * x[k] - total[k]) / n for k in range(dim)] for _, x in ok])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for (i, x), c in zip(ok, centred, strict=True):
        deviation = sum((n * x[k] - total[k]) ** 2 for k in range(dim))
        for k in range(min(components, dim)):
            some = values[k] > 1e-12 * max(values[0], 0)
            out.append((str(i), k + 1, n, deviation, abs(c @ vectors[:, k]) / np.sqrt(values[k]) if some else 0.0, values[k] / values.sum() if some else 0.0))
    return sorted(out)


def _same(df, rows):
    got, want = df.collect(), _plain(rows)
    have = sorted((str(r.vec_id), r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    assert [h[:4] for h in have] == [w[:4] for w in want]
    assert np.allclose([h[4] for h in have], [w[4] for w in want], rtol=1e-7, atol=1e-9)
    assert np.allclose([h[5] for h in have], [w[5] for w in want], rtol=1e-9)
    assert len({r.identity_error for r in got}) <= 1 and all(r.identity_error < 1e-8 for r in got)


def test_equals_a_dense_solver(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    _same(whitening.whitened(vectors.repartition(19)), rows)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    rows += [(None, [0.5] * 5), (3, rows[3][1]), (70, None), (71, []), (72, [1.0, None, 0.0, 0.0, 0.0]), (73, [float("nan")] * 5)]
    rows += [(74, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (75, [1.0, 2.0])]
    schema = "vec_id long, embedding array<double>, component int, n string, x string, id string"
    odd = spark.createDataFrame([(i, v, 1, "a", "b", "c") for i, v in rows], schema).repartition(4)
    _same(whitening.whitened(odd), rows)
    assert whitening.whitened(odd.where("false")).count() == 0
    assert whitening.whitened(odd.where("embedding is null")).count() == 0


def test_rows_without_variance(spark):
    same = [(i, [0.25, 0.5, 0.75]) for i in range(9)]
    line = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    for rows in (same[:1], same, line):
        _same(whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), rows)


def test_deviations_beyond_a_long_are_null_and_others_exact():
    x = np.array([[1 << 40, 3], [5, 3]])
    assert whitening._deviation(x, 2, ((1 << 40) + 5, 6)) == [None, None]
    assert whitening._deviation(x // 1024, 2, (1 << 30, 0)) == [(1 << 60) + 0, (1 << 60) + 0]


def test_long_partitions_fold_rows_in_blocks(spark):
    rows = [(i, [float((i * k) % 97) / 8 for k in range(1, 9)]) for i in range(9000)]
    _same(whitening.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)), rows)
