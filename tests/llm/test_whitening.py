"""Whitening against an eigendecomposition of the plain covariance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, components=4):
    """{vec_id: (n, deviation, |whitened|, explained)}"""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array(sorted({tuple(v) for _, v in good}), float)
    n, sums = len(x), [sum(int(v) for v in col) for col in x.T]
    centred = x - x.mean(0)
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    out = []
    for i, v in good:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = (np.array(v) - x.mean(0)) @ axes / np.sqrt(np.maximum(e, 1e-300))
        out += [(i, k + 1, n, deviation, z[k], e[k] / e.sum()) for k in range(min(components, len(e)))]
    return out


def check(got, want, tolerance=1e-9):
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[3])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:4]) for r in got] == [tuple(r[:4]) for r in want]
    for k in {r[1] for r in want}:
        a, b = (np.array([r[4] for r in rows if r[1] == k], float) for rows in (got, want))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, want))


def rows_of(df):
    return [tuple(r) for r in df.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error").collect()]


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(200, 6)) * [5, 3, 2, 1, .5, .2] + 4
    rows = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(base)]
    rows += [rows[0]] * 60 + [(None, rows[1][1], 0)]
    dropped = [(900, None, 0), (901, [None, 1.0, 1.0, 1.0, 1.0, 1.0], 0), (902, [float("nan")] + [1.0] * 5, 0), (903, [float("-inf")] + [1.0] * 5, 0)]
    df = spark.createDataFrame(rows + dropped, SCHEMA)
    got = rows_of(whitening.whitened(df))
    check(got, plain(rows))
    assert {r[6] for r in got} == {got[0][6]} and got[0][6] < 1e-9
    check(rows_of(whitening.whitened(df.repartition(7))), plain(rows))


def test_ill_conditioned_rows(spark):
    """Variances ten decades apart: squared, they would drown in rounding."""
    rng = np.random.default_rng(5)
    turn, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    base = np.rint((rng.normal(size=(400, 4)) * [1e8, 1e6, 1e4, 1e3]) @ turn)
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(base)], "vec_id long, embedding array<double>, label int")
    got = rows_of(whitening.whitened(df))
    x = np.floor(base * 256)
    x = x - x.mean(0)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    z = np.array([[r[4] for r in sorted(got) if r[1] == k + 1] for k in range(4)]).T
    want = x @ vt.T / (s / math.sqrt(len(x)))
    assert np.abs(np.abs(z) - np.abs(want)).max() < 1e-7
    assert got[0][6] < 1e-8


def test_dependent_dimensions_have_no_variance(spark):
    rng = np.random.default_rng(7)
    a = rng.integers(-99, 99, size=(50, 2))
    rows = [(i, [float(p), float(q), float(p + q), 7.0], 0) for i, (p, q) in enumerate(a)]
    got = rows_of(whitening.whitened(spark.createDataFrame(rows, SCHEMA)))
    assert all((r[4] is None) == (r[1] > 2) for r in got)
    check([r for r in got if r[1] <= 2], [r for r in plain(rows) if r[1] <= 2])
    assert got[0][6] < 1e-9


@pytest.mark.parametrize("vectors", [[[1.0, 2.0]], [[1.0, 2.0]] * 5, [[0.0, 0.0]]])
def test_a_single_distinct_vector(spark, vectors):
    got = rows_of(whitening.whitened(spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], SCHEMA)))
    assert len(got) == 2 * len(vectors)
    assert {(r[2], r[3], r[4], r[6]) for r in got} == {(1, 0, None, None)}


def test_no_usable_rows(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [None], 0)]):
        assert rows_of(whitening.whitened(spark.createDataFrame(rows, SCHEMA))) == []


def test_other_lengths_are_left_out_and_clashing_columns_ignored(spark):
    rows = [(i, [float(i % 7), float(i % 5)], 0) for i in range(30)]
    df = spark.createDataFrame(rows + [(99, [1.0], 0), (98, [], 0)], SCHEMA)
    for c in ("id", "v", "x", "z", "at", "w", "n", "line", "component"):
        df = df.withColumn(c, F.lit("x"))
    check(rows_of(whitening.whitened(df)), plain(rows))


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(1, [1e30, 0.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = rows_of(whitening.whitened(df))
    assert len(got) == 6 and {r[3] for r in got if r[0] == 1} == {None}


def test_given_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check(rows_of(whitening.whitened(df)), plain([tuple(r) for r in df.collect()]))
