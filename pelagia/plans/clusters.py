"""Clusters of habitat profiles, localities and taxonomy."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from pelagia.functions.expressions import concat_key
from pelagia.operators.clean import drop_any_null, drop_null
from pelagia.operators.features import ordinal_encode, standard_scale
from pelagia.operators.hierarchy import hierarchical_cluster
from pelagia.operators.joins import join_one_per_key
from pelagia.operators.kmeans import kmeans, kmeans_cost_curve, silhouette_curve
from pelagia.operators.stats import cluster_sizes, count_per_group
from pelagia.runtime import stage

# Fixed values.
HABITAT_FLAGS = ["isMarine", "isFreshwater", "isTerrestrial", "isExtinct", "isBrackish"]
RANKS = ["kingdom", "phylum", "class", "order", "family", "genus"]
TAXONOMY_REQUIRED = [*RANKS, "taxonID", "scientificName", "vernacularName"]


class HabitatClusters(NamedTuple):
    profiles: DataFrame
    cost_curve: DataFrame
    taxa: DataFrame


def habitat_profile_clusters(profile: DataFrame, taxon: DataFrame, k: int = 4, ks: list[int] | None = None,
                             seed: int = 42) -> HabitatClusters:
    """k-means of the scaled habitat flags, its cost curve, and the taxa joined to their cluster."""
    flags = profile.withColumns({c: profile[c].try_cast("int") for c in HABITAT_FLAGS})
    scaled = standard_scale(drop_any_null(flags), HABITAT_FLAGS)
    cols = [c + "_scaled" for c in HABITAT_FLAGS]
    curve = kmeans_cost_curve(scaled, cols, ks or list(range(1, 11)), seed)
    labelled = kmeans(scaled, cols, k, seed).drop(*cols)
    return HabitatClusters(labelled, curve, join_one_per_key(taxon, labelled, "taxonID"))


def locality_clusters(combined: DataFrame, k: int = 3, seed: int = 42, distinct: bool = False) -> DataFrame:
    """k-means of (encoded country, species count) per locality."""
    counts = count_per_group(combined, ["countryCode", "locality"], "taxonID", distinct=distinct)
    encoded = ordinal_encode(stage(counts, "localities"), ["countryCode"])
    encoded = encoded.withColumnRenamed("countryCode_encoded", "country_encoded")
    return kmeans(encoded, ["country_encoded", "species_count"], k, seed)


class LocalityCurves(NamedTuple):
    cost_curve: DataFrame
    silhouettes: DataFrame


def locality_curves(combined: DataFrame, cost_ks: list[int] | None = None, silhouette_ks: list[int] | None = None,
                    seed: int = 42) -> LocalityCurves:
    """Cost and Euclidean silhouette per k of the encoded country and locality."""
    rows = drop_null(combined, ["countryCode", "locality"])
    keyed = rows.select(concat_key(["countryCode", "locality"]).alias("country_locality"))
    encoded = stage(ordinal_encode(keyed, ["country_locality"]).select("country_locality_encoded"), "encoded")
    cols = ["country_locality_encoded"]
    return LocalityCurves(kmeans_cost_curve(encoded, cols, cost_ks or list(range(1, 11)), seed),
                          silhouette_curve(encoded, cols, silhouette_ks or list(range(2, 11)), seed))


class TaxonomyClusters(NamedTuple):
    rows: DataFrame
    sizes: DataFrame


def taxonomy_clusters(combined: DataFrame, k: int = 7) -> TaxonomyClusters:
    """Hierarchical clusters of the six encoded ranks."""
    encoded = ordinal_encode(drop_null(combined, TAXONOMY_REQUIRED), RANKS)
    labelled = stage(hierarchical_cluster(encoded, [r + "_encoded" for r in RANKS], k), "taxonomy")
    return TaxonomyClusters(labelled, cluster_sizes(labelled))
