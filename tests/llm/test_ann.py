"""Operator 2 against brute force."""

import numpy as np
import pytest
from conftest_llm import SF

from quayside.llm import ann
from quayside.llm.shipping import ship_package


def brute(ids, x, k, every=20):
    out = {}
    for i in range(len(ids)):
        if ids[i] % every == 0:
            s = (x * x[i]).sum(axis=1)
            others = [(-s[j], ids[j]) for j in range(len(ids)) if ids[j] != ids[i]]
            out[ids[i]] = sorted(others)[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_quantile():
    assert ann.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert ann.chi_square_cdf(21.026, 12) == pytest.approx(0.95, abs=1e-4)


def test_recall_on_the_table(spark):
    ship_package(spark)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    want, got = brute(ids, x, 20), found(ann.nearest(df, shard_rows=100, block_queries=10))
    assert set(got) == set(want)
    assert sum(len({v for _, v in want[q]} & {v for _, v in got[q]}) for q in want) >= 0.95 * 20 * len(want)
    index = {i: n for n, i in enumerate(ids)}
    for q, near in got.items():
        assert near == sorted(near)
        for score, v in near:
            assert -score == pytest.approx(float((x[index[q]] * x[index[v]]).sum()), abs=1e-12)


def test_clusters_and_norms_are_found_exactly(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((30, 16))
    x = np.repeat(centers, 20, axis=0) * rng.uniform(0.2, 3, (600, 1)) + 0.02 * rng.standard_normal((600, 16))
    ship_package(spark)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want, got = brute(list(range(600)), x, 10), found(ann.nearest(df, k=10, shard_rows=150, block_queries=7))
    assert sum(len({v for _, v in want[q]} & {v for _, v in got[q]}) for q in want) >= 0.9 * 10 * len(want)


def test_odd_vectors_and_ties(spark):
    ship_package(spark)
    rows = [(0, [1.0, 0.0], 1), (20, [0.0, 2.0], 1), (40, None, 1), (60, [], 1), (80, [0.0, 0.0], 1), (100, [1.0, None], 1), (120, [float("nan"), 1.0], 1),
            (140, [float("inf"), 1.0], 1), (None, [9.0, 9.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (20, [0.0, 2.0], 2), (160, [3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = found(ann.nearest(df, k=3))
    assert got[0] == [(-3.0, 160), (-1.0, 1), (-1.0, 2)]
    assert got[20] == [(-2.0, 1), (-2.0, 2), (-2.0, 3)]
    assert got[160] == [(-3.0, 0), (-3.0, 1), (-3.0, 2)] and set(got) == {0, 20, 160}
    many = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(400)], "vec_id long, embedding array<double>")
    assert found(ann.nearest(many, k=3, shard_rows=100))[20] == [(-5.0, 0), (-5.0, 1), (-5.0, 2)]
    assert ann.nearest(df.limit(0)).count() == 0
    assert ann.nearest(df.filter("vec_id = 0")).count() == 0


@pytest.mark.parametrize("size", [1e200, 1e-200, 1.0])
def test_vectors_whose_squares_leave_the_range(spark, size):
    ship_package(spark)
    rows = [(i, [size * (1 + i % 7), size * (i % 5)]) for i in range(60)] + [(100, [size, None]), (120, [0.0, 0.0])]
    want = brute(list(range(60)), np.array([v for _, v in rows[:60]]) / size, 5)
    got = found(ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=5, shard_rows=20))
    assert {q: [v for _, v in near] for q, near in got.items()} == {q: [v for _, v in near] for q, near in want.items()}
