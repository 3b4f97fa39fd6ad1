"""Whitening against numpy's own eigenvectors, exact integers, and rows that hold nothing usable."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tallyframe.llm import queries, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 3.0, 2.0, 1.0, 0.5, 0.1], [4.0, 4.0, 4.0, 1.0, 1.0], [1e9, 1e-9, 0.0], [0.0, 0.0, 0.0], [2.0], [3.0, -5.0],
    [1 + 1e-13 * k for k in range(8)], list(np.linspace(10, 0, 40)),
])
def test_components_of_a_matrix(values):
    matrix = symmetric(values, len(values))
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.leading_components(matrix, 4)
    size, scale = min(4, len(values)), max(map(abs, values))
    assert np.allclose(found, sorted(values, reverse=True)[:size], atol=1e-14 * max(scale, 1e-300) * len(values))
    assert np.allclose(vectors @ vectors.T, np.eye(size), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * found, atol=2e-14 * scale * len(values) + 1e-300)


def test_diagonal_and_split_matrices():
    found, vectors = whitening.leading_components(np.diag([1.0, 7.0, 3.0]), 2)
    assert np.allclose(found, [7, 3], rtol=1e-15) and np.allclose(vectors, [[0, 1, 0], [0, 0, 1]])
    split = np.array([[2.0, 1, 0, 0], [1, 2, 0, 0], [0, 0, 2, 1], [0, 0, 1, 2]])
    found, vectors = whitening.leading_components(split, 4)
    assert np.allclose(found, [3, 3, 1, 1]) and np.allclose(split @ vectors.T, vectors.T * found)
    assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-13)


def expected(rows, wanted=4):
    """Rows by numpy and whole numbers, up to sign."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for _, v in rows]
    distinct = sorted(set(map(tuple, x)))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array(distinct, float) - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    e, v = np.linalg.eigh(covariance)
    made = []
    for (key, _), row in zip(rows, x):
        deviation = sum((n * a - s) ** 2 for a, s in zip(row, sums))
        for k in range(min(wanted, len(sums))):
            w = (np.array(row) - np.array([s / n for s in sums])) @ v[:, -1 - k] / np.sqrt(e[-1 - k])
            made.append((key, k + 1, n, deviation, w, e[-1 - k] / np.trace(covariance)))
    return made


def compare(got, rows):
    want = expected(rows)
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0], r[1], r[3], r[4]))
    signs = {}
    for k in {w[1] for w in want}:
        a = np.array(sorted((w for w in want if w[1] == k), key=lambda w: (w[0], w[3], w[4])), float)[:, 4]
        b = np.array([g for g in got if g[1] == k], float)[:, 4]
        signs[k] = 1 if np.abs(np.sort(a) - np.sort(b)).max() < 1e-8 else -1
    want = sorted(((w[0], w[1], w[2], w[3], w[4] * signs[w[1]], w[5]) for w in want), key=lambda r: (r[0], r[1], r[3], r[4]))
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], atol=1e-8)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-10)
    assert len({g[6] for g in got}) == 1 and got[0][6] < 1e-9


def test_query_against_numpy(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got = queries.QUERIES["op13_whitening"](spark, SF)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    compare(got.collect(), rows)


def test_copies_weigh_nothing_and_unusable_rows_go(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(c) for c in rng.normal(0, [1, 2, 3, 4, 5])]) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(300)] + [(3, rows[9][1])] + [(4, [-0.0, 0.0, -0.001, 2.0, 1.0])]
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [1.0, math.nan, 1.0, 1.0, 1.0]),
           (904, [math.inf, 1.0, 1.0, 1.0, 1.0]), (905, [1.0]), (906, [3e38, 1.0, 1.0, 1.0, 1.0])]
    table = spark.createDataFrame(rows + bad, SCHEMA).repartition(7)
    compare(whitening.whiten(table, whitening.fit(table)).collect(), rows)
    clash = table.selectExpr("*", "vec_id as n", "'x' as whitened", "1 as component", "embedding as packed")
    assert whitening.whiten(clash, whitening.fit(clash)).count() == 4 * len(rows)
    nobody = spark.createDataFrame([(None, rows[0][1]), (None, rows[0][1]), (1, rows[1][1])], SCHEMA)
    assert whitening.whiten(nobody, whitening.fit(nobody)).where("vec_id is null").count() == 8


def test_nothing_one_vector_and_few_dimensions(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty, whitening.fit(empty)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)
    got = whitening.whiten(one, whitening.fit(one)).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)] * 2
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0]) for i in range(9)], SCHEMA)
    got = whitening.whiten(line, whitening.fit(line)).where("vec_id = 8").orderBy("component").collect()
    assert got[0]["whitened"] is not None and [r["whitened"] for r in got[1:]] == [None, None]
    assert abs(got[0]["explained"] - 1) < 1e-12 and got[0]["identity_error"] < 1e-9


def test_great_entries_stay_exact(spark):
    rows = [(i, [2.0**43 - 2.0**24 * i, float(i)]) for i in range(5)]
    table = spark.createDataFrame(rows, SCHEMA)
    got = whitening.whiten(table, whitening.fit(table)).where("component = 1").orderBy("vec_id").collect()
    x = [[int(256 * float(np.float32(c))) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    exact = [sum((5 * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    assert [r["deviation"] for r in got] == [e if e < 2**63 else None for e in exact] and None not in exact
