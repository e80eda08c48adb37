import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesteward.llm import whitening
from lakesteward.llm.queries import LLM_QUERIES
from lakesteward.llm.tables import table

SCHEMA = "vec_id long, embedding array<float>"


def _usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def _integers(vector):
    return tuple(int(max(-2.0**53, min(2.0**53, math.floor(256.0 * c)))) for c in vector)


def _expected(rows, dims, wanted=4):
    """By the definition: exact sums, numpy's eigenvectors of the whole covariance."""
    kept = [(i, _integers(v)) for i, v in rows if _usable(v) and len(v) == dims]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[v - s / n for v, s in zip(x, sums)] for x in fit], float)
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    live = [k for k in range(min(wanted, dims)) if values[k] > 1e-12 * values[0] > 0]
    out = {}
    for i, x in kept:
        centred = np.array([v - s / n for v, s in zip(x, sums)], float)
        deviation = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for k in live:
            out.setdefault((i, k + 1), []).append((deviation, centred @ vectors[:, k] / math.sqrt(values[k]), values[k] / np.trace(cov)))
    return n, out


def _compare(found, n, expected):
    got = {}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-4
        got.setdefault((r.vec_id, r.component), []).append((r.deviation, r.whitened, r.explained))
    assert got.keys() == expected.keys()
    for component in {k for _, k in expected}:
        ours, theirs = [], []
        for key in expected:
            if key[1] == component:
                # Rows that share an id are compared in order of their deviation and the size of their coordinate.
                ours += sorted(got[key], key=lambda r: (r[0] or 0, abs(r[1])))
                theirs += sorted(expected[key], key=lambda r: (r[0] or 0, abs(r[1])))
        assert [r[0] for r in ours] == [r[0] if r[0] < 2**63 else None for r in theirs]
        a, b = np.array([r[1] for r in ours]), np.array([r[1] for r in theirs])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert max(abs(r[2] / s[2] - 1) for r, s in zip(ours, theirs)) < 1e-9


def test_query_matches_the_whole_covariance(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    found = LLM_QUERIES["op11_whitening"](spark, sf_dir)
    assert found.columns[:3] == ["vec_id", "component", "n"]
    _compare(found.collect(), *_expected(rows, 64))


def test_odd_rows(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(6)]) for i in range(60)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    rows += [rows[3]] * 20 + [(None, rows[4][1]), (None, rows[5][1]), (61, None), (62, []), (63, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (64, [float("nan")] * 6),
             (65, [float("inf")] + [0.0] * 5), (66, [1.0, 2.0]), (67, [-0.0] * 6), (68, [-0.001] * 6)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("clash")).repartition(5)
    _compare(whitening.whitened(docs).collect(), *_expected(rows, 6))


def test_wide_integers_and_few_dimensions(spark):
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate([(1e9, 1.0), (-3e9, 2.0), (5.0, 7e8), (2.0, 2.0), (1e9, 1.0)])]
    found = whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in found} == {1, 2} and all(r.deviation is None for r in found if r.vec_id == 1)
    _compare(found, *_expected(rows, 2))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_component_without_variance_is_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)]
    assert {r.component for r in whitening.whitened(spark.createDataFrame(rows, SCHEMA)).collect()} == {1}


@pytest.mark.parametrize("spectrum", [
    [5, 4, 3, 2, *[1.9] * 60, *[0.5] * 100], [1.0] * 90, [1e6, 1e3, 1, 1e-3, *[1e-9] * 80], [3, 3, 3, 3, *np.linspace(2.9, 0, 200)], [7, *[0] * 60],
])
def test_iteration_finds_leading_pairs(spectrum):
    rng = np.random.default_rng(8)
    basis = np.linalg.qr(rng.standard_normal((len(spectrum), len(spectrum))))[0]
    cov = (basis * np.array(spectrum, float)) @ basis.T
    calls = []
    values, vectors = whitening.leading_components(lambda block: calls.append(1) or cov @ block, len(spectrum))
    assert np.allclose(values, [s for s in sorted(spectrum, reverse=True)[:4] if s > 1e-12 * max(spectrum)], rtol=1e-11, atol=1e-13 * max(spectrum))
    assert np.abs(cov @ vectors - vectors * values).max() < 1e-12 * max(spectrum)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12) and len(calls) < 400
