import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pelagia.functions.expressions import group_label, haversine_km, percent_text
from pelagia.operators import niche, sampling, stats
from pelagia.plans import niche as niche_plan


def test_haversine(spark):
    df = spark.createDataFrame([(45.7597, 4.8422, 48.8567, 2.3508), (1.0, 1.0, 1.0, 1.0), (0.0, 0.0, 0.0, 180.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(392.2172595594006, abs=1e-6)
    assert got[1] == 0.0 and got[2] == pytest.approx(math.pi * 6371.0088)


def test_cluster_statistics(spark):
    df = spark.createDataFrame(
        [(-1, 0.0, 0.0, "a"), (-1, 50.0, 9.0, None), (0, 1.0, 1.0, "a"), (0, 1.0, 1.0, None), (0, 1.0, 1.0, "c"),
         (1, 2.0, 2.0, "a"), (2, 0.0, 0.0, "a"), (2, 0.0, 2.0, "b")], "cluster int, lat double, lon double, species string")
    got = {r["cluster"]: r for r in stats.cluster_statistics(df, "lat", "lon", "species").collect()}
    assert (got[-1]["radius_km"], got[-1]["density"], got[-1]["cluster_name"]) == (0.0, 0.0, "Noise")
    assert (got[0]["count"], got[0]["radius_km"], got[0]["density"]) == (2, 0.0, 2.0)
    assert (got[1]["radius_km"], got[1]["density"]) == (0.0, 1.0)
    radius = math.radians(1) * 6371.0088
    assert got[2]["radius_km"] == pytest.approx(radius)
    assert got[2]["density"] == pytest.approx(2 / (math.pi * radius ** 2))
    by_rows = {r["cluster"]: r["count"] for r in stats.cluster_statistics(df, "lat", "lon", "lat").collect()}
    assert by_rows == {-1: 2, 0: 3, 1: 1, 2: 2}


def test_all_noise_summary(spark):
    df = spark.createDataFrame([(-1,)] * 3, "cluster int")
    assert stats.clustering_summary(df).first().asDict() == {
        "n_clusters": 0, "n_noise": 3, "n_rows": 3, "noise_percent": 100.0, "noise_text": "100.00%"}
    assert stats.clustering_summary(df.limit(0)).first()["noise_percent"] is None


def test_diversity(spark):
    df = spark.createDataFrame(
        [(0, "a", None), (0, "b", None), (1, "a", "x"), (2, "a", "x"), (2, "a", "y"), (2, None, "y")],
        "cluster int, genus string, species string")
    got = {r["cluster"]: r for r in stats.taxonomy_stats(df).collect()}
    assert got[0]["genus_diversity"] == pytest.approx(math.log(2)) and got[0]["species_diversity"] == 0.0
    assert (got[0]["unique_genus_count"], got[0]["unique_species_count"]) == (2, 0)
    assert got[1]["species_diversity"] == 0.0 and got[2]["genus_diversity"] == 0.0
    assert got[2]["species_diversity"] == pytest.approx(-(1 / 3 * math.log(1 / 3) + 2 / 3 * math.log(2 / 3)))
    assert rows(stats.shannon_diversity(df).drop("genus_diversity"))[0] == (0, 0.0)


def test_environment_stats(spark):
    df = spark.createDataFrame([(0, 1.0, None), (0, 3.0, None), (1, 5.0, 2.0)], "cluster int, sst double, depth double")
    got = {r["cluster"]: r.asDict() for r in stats.environment_stats(df).collect()}
    assert got[0]["sst_std"] == pytest.approx(math.sqrt(2)) and got[0]["depth_mean"] is None
    assert got[1]["sst_std"] is None and got[1]["depth_max"] == 2.0
    assert "sss_mean" not in got[0]


def test_counts(spark):
    df = spark.createDataFrame([("SE", "a", "1"), ("SE", "a", "1"), ("SE", None, "2"), ("NA", "b", None)],
                               "countryCode string, locality string, taxonID string")
    keys = ["countryCode", "locality"]
    assert rows(stats.count_per_group(df, keys, "taxonID")) == [("NA", "b", 0), ("SE", "a", 2)]
    assert rows(stats.count_per_group(df, keys, "taxonID", distinct=True)) == [("NA", "b", 0), ("SE", "a", 1)]
    report = stats.cleaning_report(df, {"locality": F.col("locality").isNotNull(), "id": F.col("taxonID") == "1"})
    assert rows(report) == [(1, "locality", 4, 3, 1), (2, "id", 3, 2, 1)]


def numpy_profile(values):
    v = np.array(values)
    hist, edges = np.histogram(v, bins=20)
    i = int(np.argmax(hist))
    uniq, n = np.unique(v, return_counts=True)
    return {"observations": len(v), "mean": v.mean(), "median": np.median(v), "mode": uniq[np.argmax(n)],
            "peak": (edges[i] + edges[i + 1]) / 2, "min": v.min(), "max": v.max(),
            "std": v.std(ddof=1) if len(v) > 1 else None, "p05": np.percentile(v, 5), "p95": np.percentile(v, 95),
            "q1": np.percentile(v, 25), "q3": np.percentile(v, 75)}


def test_value_profile_against_numpy(spark):
    rng = np.random.default_rng(3)
    groups = {"many": rng.normal(15, 4, 400).round(1).tolist(), "equal": [5.0] * 12, "one": [2.0],
              "tie": [1.0, 1.0, 4.0, 4.0, 9.0], "grid": [float(x) for x in range(21)], "zero": [0.0, -0.0, 1.0]}
    data = [(g, v) for g, vs in groups.items() for v in vs] + [("many", None), ("many", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double").repartition(5)
    got = {r["g"]: r.asDict() for r in niche.value_profile(df, ["g"], "v").collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        for name, expected in numpy_profile(values).items():
            assert got[g][name] == (None if expected is None else pytest.approx(expected, abs=1e-9)), (g, name)


def niche_rows(spark):
    data = [("Chordata", "Gadidae", "Gadus", 5.0 + i % 3) for i in range(10)]
    data += [("Chordata", "Salmonidae", "Salmo", 9.0) for _ in range(9)]
    data += [("Annelida", "Gadidae", "Gadus", 7.0), (None, "Gadidae", "Gadus", 8.0), ("Chordata", "", None, 3.0)]
    return spark.createDataFrame(data, "phylum string, family string, genus string, water_TEMP double")


def test_multi_level_stats(spark):
    levels = ["phylum", "class", "family", "genus"]
    table = niche.multi_level_stats(niche_rows(spark), levels, "water_TEMP").collect()
    assert [(r["taxonomic_level"], r["taxonomic_group"], r["observation_count"]) for r in table] == [
        ("phylum", "Chordata", 20), ("family", "Gadidae", 12), ("genus", "Gadus", 12)]
    assert table[1]["parent_phylum"] == "Chordata" and table[2]["parent_family"] == "Gadidae"
    assert table[0]["parent_phylum"] is None
    empty = niche.multi_level_stats(niche_rows(spark).limit(0), levels, "water_TEMP")
    assert empty.count() == 0 and "optimal_range_width" in empty.columns and "parent_family" in empty.columns


def test_parent_ties_take_the_lowest_name(spark):
    df = spark.createDataFrame([("b", "g"), ("a", "g"), (None, "g"), (None, "g")], "family string, genus string")
    assert rows(niche.dominant_value(df, ["genus"], "family", "family")) == [("g", "a")]


def test_temperature_niche_plan(spark):
    done = niche_plan.temperature_niche(niche_rows(spark))
    assert [r["label"] for r in done.top.collect()] == ["Chordata (20 obs)", "Gadidae (12 obs)", "Gadus (12 obs)"]
    lists = {r["taxonomic_group"]: r for r in done.distributions.collect()}
    assert sorted(lists["Gadus"]["all_temperatures"]) == sorted([5.0 + i % 3 for i in range(10)] + [7.0, 8.0])
    with pytest.raises(ValueError):
        niche_plan.temperature_niche(niche_rows(spark).drop("water_TEMP"))


def test_collect_values_order_and_limit(spark):
    df = spark.createDataFrame([("a", i, float(100 - i)) for i in range(50)] + [("b", 99, 1.0), ("b", 98, None)],
                               "g string, id int, v double").repartition(6)
    got = {r["g"]: r["all_values"] for r in sampling.collect_values(df, ["g"], "v", "id", 10).collect()}
    assert got == {"a": [100.0 - i for i in range(10)], "b": [1.0]}


def test_samples(spark):
    df = spark.range(5000).withColumnRenamed("id", "rid").withColumn("cluster", F.when(F.col("rid") % 5 == 0, -1).otherwise(0))
    assert rows(sampling.sample_n(df, "rid", 100, seed=1)) == rows(sampling.sample_n(df.repartition(7), "rid", 100, seed=1))
    assert rows(sampling.sample_n(df, "rid", 100, seed=1)) != rows(sampling.sample_n(df, "rid", 100, seed=2))
    whole = df.orderBy(F.md5(F.concat(F.col("rid").cast("string"), F.lit(":1")))).limit(100)
    assert rows(sampling.sample_n(df, "rid", 100, seed=1)) == rows(whole)
    assert sampling.sample_n(df, "rid", 10_000).count() == 5000
    sample = sampling.preview_sample(df, "rid", points=50, noise=2000)
    assert rows(sample.groupBy("cluster").count()) == [(-1, 1000), (0, 50)]
    named = df.withColumn("cluster_name", F.when(F.col("cluster") == -1, "Noise").otherwise("Cluster 0"))
    legend = sampling.preview_legend(named, sampling.preview_sample(named, "rid", points=50, noise=10))
    assert rows(legend.select("label")) == [("Cluster 0 (n=50)",), ("Noise (n=1000)",)]
    assert rows(sampling.cap_rows(df, 7, ["rid"]).select("rid")) == [(i,) for i in range(7)]


def test_texts(spark):
    df = spark.createDataFrame([("Abcdefghijklmnopqrstuvwxyz", 12)], "g string, n int")
    assert df.select(group_label("g", "n"), percent_text("n", F.lit(96))).first()[:] == ("Abcdefghijklmnopqrstuvwxy (12 obs)", "12.50%")
