"""Whitening against the eigenvectors of the whole covariance."""

import math

import numpy as np
import pytest

from strandloom.llm import whitening


def exact(x):
    """Whole numbers, deviations as Python integers, eigenvalues and eigenvectors by falling value."""
    x = np.floor(64 * x).astype(np.int64) + 1_000_000
    n, s = len(x), [sum(map(int, c)) for c in x.T]
    deviation = [sum((n * int(v) - t) ** 2 for v, t in zip(r, s)) for r in x]
    centred = np.array([[(n * int(v) - t) / n for v, t in zip(r, s)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return centred, deviation, values[::-1], vectors[:, ::-1]


def data(kind):
    rng = np.random.default_rng(6)
    if kind == "flat":
        return rng.normal(0, 3, (700, 60))
    if kind == "steep":
        return rng.normal(0, 1, (600, 90)) * 40 * 0.8 ** np.arange(90) + 2
    if kind == "narrow":
        return rng.normal(0, 5, (200, 7))
    if kind == "low":  # three directions alone
        return np.round(rng.normal(0, 5, (150, 3)) * 64) / 64 @ rng.integers(-3, 4, (3, 40))
    return np.full((30, 5), 2.5)


@pytest.mark.parametrize("kind", ["flat", "steep", "narrow", "low", "alike"])
@pytest.mark.parametrize("entry", ["float", "double"])
def test_components(spark, kind, entry):
    x = data(kind).astype(np.float32).astype(float)
    df = spark.createDataFrame([("x", k, r, 1) for k, r in enumerate(x.tolist())], f"VEC_ID string, vec_id long, embedding array<{entry}>, component int").repartition(5)
    got = whitening.whiten(df).collect()
    centred, deviation, values, vectors = exact(x)
    k, rank = min(32, x.shape[1]), int((values > 1e-10 * max(values[0], 1e-300)).sum()) if values[0] > 0 else 0
    assert len(got) == len(x) * k and {r["n"] for r in got} == {len(x)}
    w, d = np.zeros((len(x), k)), {}
    for r in got:
        w[r["vec_id"], r["component"] - 1], d[r["vec_id"]] = r["whitened"], r["deviation"]
    assert [d[i] for i in range(len(x))] == deviation
    own = w[:, : min(k, rank)]
    error = np.abs((own - own.mean(0)).T @ (own - own.mean(0)) / len(x) - np.eye(own.shape[1])).max(initial=0)
    reported = {r["identity_error"] for r in got}
    assert len(reported) == 1 and error < 1e-9 and abs(reported.pop() - error) < 1e-9
    explained = {r["component"]: r["explained"] for r in got}
    for c in range(k):
        if c >= rank:
            assert explained[c + 1] == 0 and not w[:, c].any()
            continue
        assert explained[c + 1] == pytest.approx(values[c] / values.sum(), rel=1e-9)
        want = centred @ vectors[:, c] / math.sqrt(values[c])
        assert min(np.abs(w[:, c] - want).max(), np.abs(w[:, c] + want).max()) < 1e-7


def test_a_steep_spectrum_needs_no_full_basis(spark, monkeypatch):
    x = np.random.default_rng(6).normal(0, 1, (500, 90)) * 40 * 0.5 ** np.arange(90)
    df = spark.createDataFrame([(k, r) for k, r in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    sizes, added = [], whitening._added
    monkeypatch.setattr(whitening, "_added", lambda rows, size, product: sizes.append(len(c := added(rows, size, product))) or c)
    assert whitening.fit(df, components=4) is not None
    assert len(sizes) <= 4 and set(sizes) == {90 * 14 + 1}


def test_rows_that_take_no_part(spark):
    inf, nan = float("inf"), float("nan")
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.0, 0.0]), (4, [3.0, -1.0])]
    bad = [(5, None), (6, [1.0, None]), (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [1.0, 2.0, 3.0]), (10, [])]
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + bad, schema).repartition(3)
    got = whitening.whiten(df).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((str(i), c) for i, _ in good for c in (1, 2))
    assert len({(r["component"], r["whitened"]) for r in got if r["vec_id"] == 1}) == 2
    for none in (bad, []):
        assert whitening.whiten(spark.createDataFrame(none, schema).filter("vec_id <> 9")).count() == 0
    one = whitening.whiten(spark.createDataFrame(good[:1], schema)).collect()
    assert [(r["whitened"], r["explained"], r["deviation"], r["identity_error"]) for r in one] == [(0, 0, 0, 0)] * 2


def test_sums_beyond_a_long(spark):
    x = [[2.0**50, 0.0], [-(2.0**50), 64.0], [2.0**56, 1.0], [1e300, 2.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 8 and all(r["deviation"] is None and math.isfinite(r["whitened"]) for r in got)
    edge = whitening.Fit(2, [2 * 1_000_000, 0])
    at = math.isqrt((1 << 63) - 1) // 2
    sums = edge.deviations(np.array([[1_000_000, at], [1_000_000, at + 1], [1_000_000, 3]])).to_pylist()
    assert sums == [(2 * at) ** 2, None, 36]
