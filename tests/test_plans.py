import numpy as np
import pytest
from conftest import rows

from pelagia.plans import clusters, occurrence
from pelagia.operators.dbscan import GRID_FINE


def test_habitat_profiles(spark):
    data = [(str(i), i % 2, (i + 1) % 2, 0, 0, int(i % 7 == 0)) for i in range(40)] + [("x", None, 1, 0, 0, 0)]
    profile = spark.createDataFrame(data, "taxonID string, " + ", ".join(f"{c} int" for c in clusters.HABITAT_FLAGS))
    taxa = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "c"), ("x", "d")], "taxonID string, scientificName string")
    done = clusters.habitat_profile_clusters(profile, taxa, k=3, ks=[1, 2, 3])
    assert done.profiles.count() == 40 and [r["k"] for r in done.cost_curve.collect()] == [1, 2, 3]
    assert rows(done.taxa.select("taxonID", "scientificName")) == [("1", "a"), ("2", "c")]
    marine = {tuple(r) for r in done.profiles.select("isMarine", "isBrackish", "cluster").distinct().collect()}
    assert len({c for _, _, c in marine}) == 3


def test_localities_and_taxonomy(spark):
    data = [("SE", f"l{i % 4}", str(i)) for i in range(20)] + [("NO", "l1", "x"), (None, "l2", "y"), ("NO", None, "z")]
    combined = spark.createDataFrame(data, "countryCode string, locality string, taxonID string")
    done = clusters.locality_clusters(combined, k=2)
    assert rows(done.select("countryCode", "locality", "country_encoded", "species_count")) == [
        ("NO", "l1", 0, 1), *[("SE", f"l{i}", 1, 5) for i in range(4)]]
    assert {(r["countryCode"], r["cluster"]) for r in done.collect()} == {("NO", 0), ("SE", 1)}
    curves = clusters.locality_curves(combined, [1, 2], [2])
    assert [r["k"] for r in curves.cost_curve.collect()] == [1, 2]
    assert -1 <= curves.silhouettes.first()["silhouette"] <= 1

    names = ["taxonID", "scientificName", "vernacularName", *clusters.RANKS]
    data = [tuple(f"{c}{i % 3 if c in ('kingdom', 'phylum') else i}" for c in names) for i in range(12)]
    data.append(tuple(None if c == "genus" else "v" for c in names))
    done = clusters.taxonomy_clusters(spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names)), k=4)
    assert done.rows.count() == 12 and sum(r["rows"] for r in done.sizes.collect()) == 12
    assert {r["cluster"] for r in done.sizes.collect()} == set(range(4))
    assert {f"{r}_encoded" for r in clusters.RANKS} < set(done.rows.columns)


def test_occurrences(spark):
    rng = np.random.default_rng(2)
    pts = np.concatenate([rng.normal(c, 0.3, (40, 2)) for c in ((10, 10), (-30, 60), (50, -120))])
    data = [(f"s{i % 5}", float(a), float(b), 4.0 + i % 3, "Animalia") for i, (a, b) in enumerate(pts)]
    data += [("s0", 95.0, 0.0, 1.0, "Animalia"), ("s1", None, 0.0, 1.0, "Animalia"), ("s2", 0.0, 0.0, None, "Animalia")]
    raw = spark.createDataFrame(data, "species string, decimalLatitude double, decimalLongitude double, sst double, kingdom string")
    assert occurrence.basic_occurrences(raw).columns == ["species", "latitude", "longitude"]
    assert occurrence.basic_occurrences(raw).count() == 121
    kept = occurrence.enriched_occurrences(raw)
    assert kept.columns == ["decimalLatitude", "decimalLongitude", "species", "sst"]
    with pytest.raises(ValueError):
        occurrence.enriched_occurrences(raw.drop("decimalLatitude"))
    grid = {"eps": [0.05, 0.1], "min_samples": [5], "default": GRID_FINE["default"]}
    done = occurrence.occurrence_clusters(kept, "decimalLatitude", "decimalLongitude", grid=grid)
    assert done.summary.first()["n_clusters"] == 3 and done.summary.first()["n_noise"] == 1
    stats = {r["cluster"]: r for r in done.stats.collect()}
    assert set(stats) == {-1, 0, 1, 2} and stats[0]["count"] == 40 and stats[0]["unique_species_count"] == 5
    assert stats[0]["sst_mean"] == pytest.approx(np.mean([4.0 + i % 3 for i in range(40)]))
    assert done.rows.where("cluster_name = 'Noise' and is_noise").count() == 1
    assert occurrence.labelled_silhouette(done.rows, "decimalLatitude", "decimalLongitude").first()["silhouette"] > 0.9
    again = occurrence.cluster_stats_kmeans(done.stats, k=2, ks=[2, 3], include_noise=False)
    assert again.rows.count() == 3 and -1 <= again.silhouette.first()[0] <= 1
