"""Occurrence records: validity, density clusters, their statistics, and k-means of the statistics."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from pelagia.operators.clean import (
    cast_select, require_columns, select_existing, valid_coordinates, with_cluster_name, with_noise_flag, without_noise,
)
from pelagia.operators.dbscan import GRID_COARSE, best_parameters, dbscan, dbscan_grid
from pelagia.operators.features import fit_scaler, standard_scale
from pelagia.operators.joins import attach_group_stats
from pelagia.operators.kmeans import kmeans, kmeans_cost_curve, silhouette_squared
from pelagia.operators.silhouette import silhouette_without_noise
from pelagia.operators.stats import cluster_statistics, clustering_summary, environment_stats, taxonomy_stats
from pelagia.runtime import stage
from pelagia.sources.delimited import normalize_nulls, with_row_id

# Columns kept from the two feeds, and the features of a cluster.
BASIC_COLUMNS = ["species", "decimalLatitude", "decimalLongitude", "eventDate", "country", "kingdom", "phylum",
                 "class", "order", "family", "genus"]
ESSENTIAL_COLUMNS = ["decimalLatitude", "decimalLongitude"]
ENRICHED_COLUMNS = [
    *ESSENTIAL_COLUMNS, "species", "scientificName", "depth", "maximumDepthInMeters", "minimumDepthInMeters",
    "year", "date_year", "phylum", "class", "order", "family", "genus", "marine", "bathymetry", "shoredistance",
    "sst", "sss"]
CLUSTER_FEATURES = ["avg_lat", "avg_lon", "depth_mean", "sst_mean", "sss_mean", "density", "bathymetry_mean",
                    "shoredistance_mean"]


def basic_occurrences(raw: DataFrame) -> DataFrame:
    """Species and valid position of a feed, as ``species, latitude, longitude``."""
    named = cast_select(select_existing(raw, BASIC_COLUMNS), {
        "species": ("species", "string"), "decimalLatitude": ("latitude", "double"),
        "decimalLongitude": ("longitude", "double")})
    return valid_coordinates(named)


def enriched_occurrences(raw: DataFrame) -> DataFrame:
    """The known columns that exist, rows with a valid position."""
    kept = normalize_nulls(select_existing(require_columns(raw, ESSENTIAL_COLUMNS), ENRICHED_COLUMNS), [])
    typed = kept.withColumns({c: F.col(c).try_cast("double") for c in ESSENTIAL_COLUMNS})
    return valid_coordinates(typed, *ESSENTIAL_COLUMNS)


class OccurrenceClusters(NamedTuple):
    rows: DataFrame
    stats: DataFrame
    grid: DataFrame
    summary: DataFrame
    parameters: tuple[float, int]


def occurrence_clusters(df: DataFrame, lat: str = "latitude", lon: str = "longitude", count_col: str | None = None,
                        grid: dict = GRID_COARSE, row_id: str | None = None, sample: int | None = None,
                        seed: int = 0) -> OccurrenceClusters:
    """Scale, search parameters (on all rows unless ``sample`` is given), cluster all rows, and describe the clusters.

    Environment and taxonomy statistics are added for the columns that exist. The distance is Euclidean on
    scaled degrees, as the parameter grids assume; it does not wrap at 180°.
    """
    if row_id is None:
        df, row_id = with_row_id(df), "row_id"
    # the scale is fixed before the rows are read again, so every read gives the same positions
    scaled = standard_scale(df, [lat, lon], fit_scaler(df, [lat, lon]))
    coords = [lat + "_scaled", lon + "_scaled"]
    searched = stage(dbscan_grid(scaled, coords, row_id, grid["eps"], grid["min_samples"], sample, seed), "grid")
    eps, min_samples = best_parameters(searched, grid["default"])
    labelled = stage(with_noise_flag(dbscan(scaled, coords, eps, min_samples, row_id)).drop(*coords), "clusters")
    stats = cluster_statistics(labelled, lat, lon, count_col or lat)
    stats = attach_group_stats(attach_group_stats(stats, environment_stats(labelled)), taxonomy_stats(labelled))
    return OccurrenceClusters(with_cluster_name(labelled), stage(stats, "stats"), searched,
                              clustering_summary(labelled), (eps, min_samples))


def labelled_silhouette(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    """Noise-free Euclidean silhouette in degrees."""
    return silhouette_without_noise(rows, [lat, lon])


class StatsClusters(NamedTuple):
    rows: DataFrame
    cost_curve: DataFrame
    silhouette: DataFrame


def cluster_stats_kmeans(stats: DataFrame, k: int = 4, ks: list[int] | None = None, seed: int = 1,
                         include_noise: bool = True) -> StatsClusters:
    """k-means of the cluster statistics over the features that exist."""
    cols = [c for c in CLUSTER_FEATURES if c in stats.columns]
    used = (stats if include_noise else without_noise(stats)).select(*cols)
    labelled = stage(kmeans(used, cols, k, seed), "stats_clusters")
    return StatsClusters(labelled, kmeans_cost_curve(used, cols, ks or list(range(2, 11)), seed),
                         silhouette_squared(labelled, cols))
