import numpy as np
import pytest
from pyspark.sql import functions as F

from pelagia.operators import kmeans, sampling
from pelagia.runtime import attach, fits_broadcast, is_small


def test_few_rows_of_long_text_are_not_broadcast(spark):
    wide = spark.range(3000).select("id", F.repeat(F.lit("x"), 65_536).alias("text"))
    assert not fits_broadcast(wide)
    assert fits_broadcast(wide.select("id"))
    assert not fits_broadcast(wide.select("id", F.array("text").alias("texts")))
    plan = attach(spark.range(10), wide, ["id"], broadcast_rows=200_000)
    assert plan.count() == 10 and "text" in plan.columns


def test_estimates_above_an_explode_are_not_trusted(spark):
    many = spark.createDataFrame([(0,)], "id int").select("id", F.explode(F.sequence(F.lit(1), F.lit(100_000_000))).alias("n"))
    assert not is_small(many)
    assert is_small(spark.range(10))


def test_squared_silhouette_counts_equal_rows_apart(spark):
    data = [(0.0, 0), (0.0, 0), (1.0, 0), (5.0, 1), (5.0, 1), (9.0, 1), (20.0, 2)]
    x, label = np.array([v for v, _ in data]), np.array([c for _, c in data])
    far = (x[:, None] - x[None, :]) ** 2
    scores = []
    for i, c in enumerate(label):
        own = label == c
        if own.sum() == 1:
            scores.append(0.0)
            continue
        a = far[i][own].sum() / (own.sum() - 1)
        b = min(far[i][label == o].mean() for o in set(label) - {c})
        scores.append((b - a) / max(a, b))
    got = kmeans.silhouette_squared(spark.createDataFrame(data, "x double, cluster int"), ["x"]).first()[0]
    assert got == pytest.approx(np.mean(scores))


def test_cap_rows_plans_no_window_and_writes_nothing(spark):
    plan = sampling.cap_rows(spark.range(100), 5, ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in text and "Window" not in text
    assert [r["id"] for r in plan.collect()] == [0, 1, 2, 3, 4]
