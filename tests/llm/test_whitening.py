"""Whitening against numpy's own decomposition of the covariance, and rank-one updates against whole matrices."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quorumdf.llm import spectra, whitening as W


@pytest.mark.parametrize("d", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["normal", "few values", "half zero", "one line", "close"])
def test_updates_equal_the_whole_matrix(d, kind):
    rnd = np.random.default_rng(d)
    values, vectors, whole = np.zeros(d), np.eye(d), np.zeros((d, d))
    for i in range(120):
        v = rnd.normal(size=d) * 300
        if kind == "few values":
            v = np.round(v / 150) * 150
        elif kind == "half zero":
            v[: d // 2] = 0
        elif kind == "one line":
            v = np.full(d, 1.0 + i % 3)
        elif kind == "close":
            v = np.eye(d)[i % d] * (1 + 1e-13 * i)
        whole += 0.5 * np.outer(v, v)
        values, vectors = spectra.add_rank_one(values, vectors, v, 0.5)
    size = max(np.abs(whole).max(), 1e-300)
    assert (np.diff(values) >= 0).all()
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-12
    assert np.abs(vectors @ np.diag(values) @ vectors.T - whole).max() / size < 1e-12


def test_combined_spectra_equal_one():
    x = np.random.default_rng(4).integers(-(10**6), 10**6, (500, 7)) + 10**9
    one = W.Spectrum.of_batches([x], 7)
    many = None
    for part in np.array_split(x, 13):
        state = W.Spectrum.from_row(*W.Spectrum.of_batches([part[:2], part[2:]], 7).row())
        many = state if many is None else many + state
    apart = x - x.mean(axis=0)
    for s in (one, many):
        assert s.mean.n == 500 and (s.mean.high * 2**32 + s.mean.low).tolist() == x.sum(axis=0).tolist()
        assert np.allclose(s.vectors @ np.diag(s.values) @ s.vectors.T, apart.T @ apart, rtol=1e-11)


def brute(rows, k=8):
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * c) + 100000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    apart = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    values, vectors = np.linalg.eigh(apart.T @ apart / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, len(values))
    return kept, n, deviation, apart @ vectors[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def test_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(9)
    rows = [(i % 190 if i else None, [rnd.gauss(0, 1 + j) for j in range(11)]) for i in range(200)]
    rows += [(900, rows[5][1])] * 100  # one vector in a third of all rows
    rows += [(1000, None), (1001, [None] * 11), (1002, [float("nan")] * 11), (1003, [float("inf")] + [0.0] * 10), (1004, []), (1005, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit("x") for c in ("label", "n", "vector", "id", "whitened", "Component")})
    df.repartition(20).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = W.op12_whitening(spark, str(tmp_path)).collect()
    floats = [(i, v and [c if c is None else float(np.float32(c)) for c in v]) for i, v in rows if v != [0.0, 1.0]]
    kept, n, deviation, whitened, explained = brute(floats)
    assert len(got) == 8 * n == 8 * 300 and {r.n for r in got} == {300}
    key = lambda i: (i is None, i or 0)
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=lambda p: (key(p[0]), p[1])) == sorted(((i, s) for (i, _), s in zip(kept, deviation)), key=lambda p: (key(p[0]), p[1]))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    for c in range(8):
        mine = {(r.vec_id, r.deviation): r.whitened for r in got if r.component == c + 1}
        pairs = [(mine[i, s], whitened[j, c]) for j, ((i, _), s) in enumerate(zip(kept, deviation))]
        sign = math.copysign(1, pairs[0][0] * pairs[0][1])
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-9
        assert all(r.explained == pytest.approx(explained[c], rel=1e-10) for r in got if r.component == c + 1)


def test_constant_vectors_few_dimensions_and_empty_tables(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(5)], "vec_id long, embedding array<double>")
    rows = W.whiten(same).collect()
    assert len(rows) == 5 and {(tuple(r.whitened), tuple(r.explained), r.deviation, r.identity_error) for r in rows} == {((None,) * 3, (0.0,) * 3, 0, None)}
    line = W.whiten(spark.createDataFrame([("a", [0.0, 5.0]), ("b", [1.0, 5.0])], "vec_id string, embedding array<double>")).collect()
    assert {r.vec_id: (round(r.whitened[0], 9), r.whitened[1], r.explained[0]) for r in line} == {"a": (-1.0, None, 1.0), "b": (1.0, None, 1.0)}
    assert W.whiten(same.limit(0)).collect() == []
    assert W.whiten(same.filter("vec_id < 0").union(spark.createDataFrame([(1, None)], same.schema))).collect() == []


def test_huge_entries_stay_exact():
    x = np.array([[W.LIMIT + W.SHIFT, 3], [-W.LIMIT, 4], [5, 6]])
    mean = W.Mean.of(x[:1]) + W.Mean.of(x[1:])
    sums = [sum(map(int, c)) for c in x.T]
    assert [int(h) * 2**32 + int(w) for h, w in zip(mean.high, mean.low)] == sums
    assert W.deviations(x[:, 1:], W.Mean.of(x[:, 1:])) == [(3 * v - 13) ** 2 for v in (3, 4, 6)]
    assert W.deviations(x, mean)[0] is None
