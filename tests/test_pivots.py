"""Neighbours by pivots equal those of all pairs, on clustered and even vectors, with ties, copies, nulls and few rows."""

import numpy as np
import pytest

from sparkloom.operators.pivots import pruned_neighbours
from sparkloom.operators.vectors import neighbours

SCHEMA = "w bigint, v array<double>, extra string"


def frame(spark, vectors, start=0):
    return spark.createDataFrame([(start + i, v, "x") for i, v in enumerate(vectors)], SCHEMA)


def clustered(rng, rows, clusters, dims, spread):
    centres = rng.normal(0, 10, (clusters, dims))
    return (centres[rng.integers(0, clusters, rows)] + rng.normal(0, spread, (rows, dims))).tolist()


def result(df):
    return sorted((r.query_w, r.w, round(r.distance, 9)) for r in df.collect())


@pytest.mark.parametrize("spread, share", [(0.3, 1 / 3), (10.0, 1.0)])
def test_equal_to_all_pairs(spark, spread, share):
    rng, met = np.random.default_rng(7), []
    vectors = clustered(rng, 1500, 30, 12, spread)
    train, queries = frame(spark, vectors[:1350]).cache(), frame(spark, vectors[1350:], 5000).cache()
    found = pruned_neighbours(queries, train, "w", "v", 5, pivots=64, cell_rows=30, ring_rows=10, per_block=40, per_pass=7, seen=lambda *n: met.append(n))
    assert result(found) == result(neighbours(queries, train, "w", "v", 5))
    assert met[0][1] == 1350 * 150 and met[0][0] <= share * met[0][1]


def test_ties_copies_and_fewer_rows_than_asked(spark):
    vectors = [[1.0, 1.0]] * 40 + [[0.0, float(i % 5)] for i in range(30)]
    train, queries = frame(spark, vectors).cache(), frame(spark, [[1.0, 1.0], [0.0, 2.0], [9.0, 9.0]], 900)
    for k in (3, 100):
        assert result(pruned_neighbours(queries, train, "w", "v", k, pivots=4, rings=3, cell_rows=9, ring_rows=2)) == result(neighbours(queries, train, "w", "v", k))
    same = frame(spark, [[2.0, 2.0]] * 9)
    assert [r[1] for r in result(pruned_neighbours(queries, same, "w", "v", 2))] == [0, 1] * 3


def test_left_out_rows_and_empty_tables(spark):
    train = frame(spark, [[1.0, 0.0], None, [float("nan"), 0.0], [None, 1.0], [float("inf"), 0.0], [3.0, 0.0]])
    queries = frame(spark, [[0.0, 0.0], None], 900)
    assert result(pruned_neighbours(queries, train, "w", "v", 9)) == [(900, 0, 1.0), (900, 5, 3.0)]
    none = frame(spark, [])
    assert pruned_neighbours(queries, none, "w", "v", 2).count() == 0
    assert pruned_neighbours(none, train, "w", "v", 2).count() == 0


def test_large_coordinates_lose_nothing(spark):
    rng = np.random.default_rng(3)
    vectors = (1e6 + rng.integers(0, 4, (200, 3))).astype(float).tolist()  # bounds are rounded here
    train, queries = frame(spark, vectors).cache(), frame(spark, vectors[:20], 900)
    assert result(pruned_neighbours(queries, train, "w", "v", 4, pivots=16, cell_rows=12, ring_rows=3)) == result(neighbours(queries, train, "w", "v", 4))


def test_queries_are_written_once_and_copies_of_rows_k_times(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sparkloom.session.checkpoint_root", lambda _: str(tmp_path))
    rng = np.random.default_rng(5)
    vectors = rng.normal(0, 1, (600, 16)).tolist()  # even: each query meets nearly all rings
    short = "w bigint, v array<float>, extra string"
    train = spark.createDataFrame([(i, v, "x") for i, v in enumerate(vectors + [vectors[0]] * 200)], short).cache()
    queries = spark.createDataFrame([(900 + i, v, "x") for i, v in enumerate(vectors[:3] + rng.normal(0, 1, (40, 16)).tolist())], short).cache()
    found = pruned_neighbours(queries, train, "w", "v", 3, pivots=32, rings=4, cell_rows=20, ring_rows=5, per_block=50, per_pass=9)
    assert result(found) == result(neighbours(queries, train, "w", "v", 3))
    rows = lambda name: sum(spark.read.parquet(str(p)).count() for p in tmp_path.glob(f"sparkloom/{name}-*"))
    assert rows("train") == 602
    assert rows("others") <= 43


def test_vectors_of_other_length_are_an_error(spark):
    train, queries = frame(spark, [[1.0, 0.0]] * 3), frame(spark, [[1.0, 0.0], [1.0, 0.0, 0.0], [1.0]], 900)
    with pytest.raises(Exception):
        pruned_neighbours(queries, train, "w", "v", 2).count()
