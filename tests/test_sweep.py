import itertools

import numpy as np
import pytest

from pelagia.operators import kmeans, sweep


def table(spark, rows):
    return spark.createDataFrame([tuple(map(float, r)) for r in rows], "a double, b double").repartition(3)


def least_cost(x, k):
    """The least cost of k clusters on a line, over all ways to cut the sorted values."""
    x = np.sort(x)
    cuts = itertools.combinations(range(1, len(x)), k - 1)
    return min(sum(((p - p.mean()) ** 2).sum() for p in np.split(x, c)) for c in cuts)


def test_curve_has_the_least_costs_on_a_line(spark):
    x = np.array([0, 0, 1, 2, 10, 11, 11, 13, 30, 31, 33, 50, 50, 50, 52], float)
    df = spark.createDataFrame([(v,) for v in x.tolist()] + [(None,)], "x double").repartition(4)
    curve = kmeans.kmeans_cost_curve(df, ["x"], [1, 2, 3, 4], seed=3).collect()
    assert [r["clusters"] for r in curve] == [1, 2, 3, 4]
    assert [r["cost"] for r in curve] == pytest.approx([least_cost(x, k) for k in (1, 2, 3, 4)])


def test_more_clusters_than_distinct_rows(spark):
    df = table(spark, [(0, 0), (0, 0), (5, 1), (5, 1), (5, 1), (9, 9)])
    curve = kmeans.kmeans_cost_curve(df, ["a", "b"], [1, 3, 6]).collect()
    assert [(r["k"], r["clusters"]) for r in curve] == [(1, 1), (3, 3), (6, 3)]
    assert curve[1]["cost"] == curve[2]["cost"] == 0


def test_empty_table_and_repeated_runs(spark):
    df = table(spark, [(i % 7, i % 11) for i in range(200)])
    empty = kmeans.kmeans_cost_curve(df.limit(0), ["a", "b"], [1, 2]).collect()
    assert [tuple(r) for r in empty] == [(1, 0.0, 0), (2, 0.0, 0)]
    points = kmeans.weighted_points(df, ["a", "b"])
    one = sweep.sweep_centres(points, ["a", "b"], [2, 5], seed=4)
    two = sweep.sweep_centres(points.repartition(5), ["a", "b"], [5, 2], seed=4)
    alone = sweep.sweep_labels(points, ["a", "b"], one).collect()
    for k in (2, 5):
        centres = one[k]
        assert len(centres) == len(two[k]) == k
        for r in (r for r in alone if r["k"] == k):
            far = [(r["a"] - a) ** 2 + (r["b"] - b) ** 2 for a, b in centres]
            assert far[r["cluster"]] == min(far)


def test_a_curve_reads_the_points_once_per_iteration(spark):
    df = table(spark, [(i % 13 + 100 * (i % 4), i % 5) for i in range(400)])
    points = kmeans.weighted_points(df, ["a", "b"])
    passes, whole = [], sweep._pass
    try:
        sweep._pass = lambda p, c, centres: passes.append(sorted(centres)) or whole(p, c, centres)
        sweep.sweep_centres(points, ["a", "b"], list(range(1, 9)), max_iter=6)
    finally:
        sweep._pass = whole
    assert passes[0] == [0] and passes[1] == list(range(1, 9)) and len(passes) <= 7
