import random

import pytest

from pelagia.operators import sketches


def test_merged_sketches_stay_within_their_error(spark):
    rng = random.Random(1)
    data = [(i % 3, i % 7, rng.randint(0, 20_000) if i % 11 else None, rng.gauss(0, 5) if i % 13 else None) for i in range(30_000)]
    df = spark.createDataFrame(data, "g int, part int, code int, value double")
    fine = sketches.distinct_sketches(df, ["g", "part"], ["code"])
    found = {r["g"]: r["code_distinct"] for r in sketches.distinct_estimates(sketches.merge_sketches(fine, ["g"])).collect()}
    fine = sketches.quantile_sketches(df, ["g", "part"], ["value"])
    names = {"q05": 0.05, "q50": 0.5, "q95": 0.95}
    quantiles = {r["g"]: r for r in sketches.quantile_estimates(sketches.merge_sketches(fine, ["g"]), "value", names).collect()}
    for g in range(3):
        exact = len({c for k, _, c, _ in data if k == g and c is not None})
        assert found[g] == pytest.approx(exact, rel=4 / 2 ** (sketches.BITS / 2))
        values = [v for k, _, _, v in data if k == g and v is not None]
        for name, q in names.items():
            assert abs(sum(v <= quantiles[g][name] for v in values) / len(values) - q) < 0.03


def test_sketches_of_groups_without_values(spark):
    df = spark.createDataFrame([(1, None, None), (2, 5, 1.5)], "g int, code int, value double")
    counts = sketches.distinct_estimates(sketches.distinct_sketches(df, ["g"], ["code"]))
    assert sorted(map(tuple, counts.collect())) == [(1, 0), (2, 1)]
    quantiles = sketches.quantile_estimates(sketches.quantile_sketches(df, ["g"], ["value"]), "value", {"median": 0.5})
    assert sorted(map(tuple, quantiles.collect())) == [(1, None), (2, 1.5)]
    assert sketches.distinct_sketches(df.limit(0), ["g"], ["code"]).count() == 0
