from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import whitening as W

FIELDS = "vec_id bigint, embedding array<double>, label int"


def dense(x):
    """Eigenvalues and eigenvectors of the covariance, largest first, without the operator's code."""
    u = np.unique(x, axis=0)
    values, vectors = np.linalg.eigh(np.cov(u.T, bias=True).reshape(x.shape[1], -1))
    return len(u), u, values[::-1], vectors[:, ::-1]


def products_of(rows):
    def products(q, w):
        p = rows @ q
        return float(p @ p), (rows @ w).T @ p, rows.T @ p
    return products


@pytest.mark.parametrize("n,d,wanted", [(200, 12, 12), (500, 40, 5), (6, 20, 20), (400, 200, 6)])
def test_singular_values_and_vectors(n, d, wanted):
    rng = np.random.default_rng(n)
    rows = rng.standard_normal((n, d)) * np.geomspace(1, 1e-3, d)
    sigma, right = W.bidiagonalise(products_of(rows), d, wanted)
    _, want, vt = np.linalg.svd(rows, full_matrices=False)
    count = min(wanted, n, d)
    assert len(sigma) == count
    np.testing.assert_allclose(sigma, want[:count], rtol=1e-10)
    np.testing.assert_allclose(np.abs((right * vt[:count].T).sum(axis=0)), 1, rtol=1e-8)
    np.testing.assert_allclose(right.T @ right, np.eye(count), atol=1e-11)


@pytest.mark.parametrize("scales", [[3, 3, 3, 2, 2, 1], [5, 1, 1, 1, 1], [2, 2, 2, 2], [4, 0, 0, 1]])
def test_repeated_and_zero_values_are_all_found(scales):
    """The Krylov space of one start holds each value once; new starts find the others."""
    rows = np.linalg.qr(np.random.default_rng(3).standard_normal((50, len(scales))))[0] * np.array(scales, float)
    sigma, right = W.bidiagonalise(products_of(rows), len(scales), len(scales))
    np.testing.assert_allclose(sigma, sorted([s for s in scales if s], reverse=True), rtol=1e-10)
    np.testing.assert_allclose(np.linalg.norm(rows @ right, axis=0), sigma, rtol=1e-9)


def test_repeated_values_are_found_where_few_components_settle_early():
    scales = np.concatenate([[9, 9, 9], np.full(117, 1.0) - np.linspace(0, 0.2, 117)])
    rows = np.linalg.qr(np.random.default_rng(4).standard_normal((300, 120)))[0] * scales
    calls = []
    products = products_of(rows)
    sigma, _ = W.bidiagonalise(lambda q, w: calls.append(1) or products(q, w), 120, 2)
    np.testing.assert_allclose(sigma, [9, 9], rtol=1e-10)
    assert len(calls) <= 120


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 24)) * np.linspace(2, 0.5, 24)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x)]
    rows += [(1000, rows[7][1], 0), (1001, rows[7][1], 1), (7, rows[7][1], 0), (None, rows[8][1], None)]
    return spark.createDataFrame(rows, FIELDS)


def fixed(vector):
    return np.floor(64 * np.array(vector)).astype(np.int64) + 1_000_000


def test_whitened_rows_against_dense_eigenvectors(vectors):
    got = W.whitened(vectors).orderBy("vec_id", "component").collect()
    read = vectors.collect()
    n, u, values, basis = dense(np.stack([fixed(r["embedding"]) for r in read]))
    assert n == 300 and len(got) == len(read) * 16 and {r["n"] for r in got} == {300}
    mean = u.sum(axis=0) / n
    want = {r["vec_id"]: (fixed(r["embedding"]) - mean) @ basis[:, :16] / np.sqrt(values[:16]) for r in read}
    for c in range(1, 17):
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == c}
        pairs = np.array([(mine[k], want[k][c - 1]) for k in want])
        assert min(np.abs(pairs[:, 0] - s * pairs[:, 1]).max() for s in (1, -1)) < 1e-9
        share = {r["explained"] for r in got if r["component"] == c}
        assert len(share) == 1 and abs(share.pop() / (values[c - 1] / values.sum()) - 1) < 1e-10
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() < 1e-10
    total = [int(v) for v in u.sum(axis=0)]
    exact = {r["vec_id"]: sum((n * int(a) - s) ** 2 for a, s in zip(fixed(r["embedding"]), total, strict=True)) for r in read}
    assert all(int(r["deviation"]) == exact[r["vec_id"]] for r in got)


def test_components_do_not_depend_on_partitions(vectors):
    one = {(r["vec_id"], r["component"]): r["whitened"] for r in W.whitened(vectors.coalesce(1)).collect()}
    many = {(r["vec_id"], r["component"]): r["whitened"] for r in W.whitened(vectors.repartition(9)).collect()}
    assert one.keys() == many.keys() and max(abs(one[k] - many[k]) for k in one) < 1e-9


def test_unusable_vectors_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i), float(i * i % 7)], 0) for i in range(20)]
    bad = [(90, None, 0), (91, [1.0, None], 0), (92, [nan, 1.0], 0), (93, [1.0, -inf], 0), (94, [], 0), (95, [1.0], 0),
           (96, [1.0, 2.0, 3.0], 0), (97, [1e300, 0.0], 0), (98, [None, None], 0)]
    df = spark.createDataFrame(good + bad, FIELDS).select("*", *[F.lit("x").alias(c) for c in ("x", "n", "component", "at")])
    got = W.whitened(df).collect()
    assert {r["vec_id"] for r in got} == set(range(20)) and {r["n"] for r in got} == {20} and len(got) == 40


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(1, [2.0, 3.0], 0)], [(1, [2.0], 0), (2, [2.0], 0)]])
def test_tables_without_a_direction_give_no_rows(spark, rows):
    assert W.whitened(spark.createDataFrame(rows, FIELDS)).collect() == []


def test_fewer_directions_than_components(spark):
    rows = [(i, [float(i), float(2 * i), 1.0], 0) for i in range(10)]
    got = W.whitened(spark.createDataFrame(rows, FIELDS)).collect()
    assert {r["component"] for r in got} == {1}
    assert abs(got[0]["explained"] - 1) < 1e-12


def test_deviations_are_exact_beyond_a_long():
    rng = np.random.default_rng(6)
    for high, n in ((2 ** 20, 10 ** 6), (2 ** 45, 10 ** 12), (2 ** 61, 3)):
        x = rng.integers(-high, high, (5, 3))
        sums = [n * 7 + 1, -n * 5 + 2, n * 11]
        model = W.Whitening(n, np.array([s // n for s in sums]), np.array([s % n for s in sums]), np.zeros((3, 0)), np.zeros(0), 1.0)
        want = [sum((Fraction(n) * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
        assert W.deviations(model, x) == want


def test_sums_are_exact_and_grouped_by_entry(spark):
    rows = [(i, [1e12 + i, -3.0]) for i in range(1000)]
    points = W.fixed_point(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5))
    n, sums = W.exact_sums(points)
    assert n == 1000 and sums == [sum(int(64 * (10 ** 12 + i)) + 1_000_000 for i in range(1000)), 1000 * (1_000_000 - 192)]


def test_left_vectors_never_leave_the_tasks(vectors):
    """Each step sends one number per dimension and earlier step, whatever the number of rows."""
    points = W.fixed_point(vectors)
    assert len(W._summed(points, lambda x: np.ones(x.shape[1] + 4))) == 28
    plan = points.select("x").distinct()._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("HashAggregate") >= 2
