"""Counts, cluster geometry, environment summaries and diversity per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pelagia.functions.expressions import cluster_name, is_noise, percent_text
from pelagia.operators.joins import distance_to_centroid
from pelagia.runtime import stage


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def cleaning_report(df: DataFrame, steps: dict[str, Column]) -> DataFrame:
    """Rows before, after and dropped by each filter, applied in the given order, in one pass."""
    passed = F.lit(True)
    counts = [F.count(F.lit(1)).alias("_0")]
    for i, test in enumerate(steps.values(), 1):
        passed = passed & F.coalesce(test, F.lit(False))
        counts.append(F.count_if(passed).alias(f"_{i}"))
    rows = [
        F.struct(F.lit(i).alias("step"), F.lit(name).alias("filter"),
                 F.col(f"_{i - 1}").alias("rows_before"), F.col(f"_{i}").alias("rows_after"),
                 (F.col(f"_{i - 1}") - F.col(f"_{i}")).alias("rows_dropped"))
        for i, name in enumerate(steps, 1)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def count_per_group(df: DataFrame, keys: list[str], counted: str, out: str = "species_count",
                    distinct: bool = False) -> DataFrame:
    """Non-null values (or distinct values) of ``counted`` per key combination; null keys are dropped."""
    count = F.count_distinct(F.col(counted)) if distinct else F.count(counted)
    return df.na.drop(subset=keys).groupBy(*keys).agg(count.alias(out))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("rows"))


def clustering_summary(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Clusters without the noise label, noise rows, and their share of all rows."""
    # sizes first: one row per cluster reaches the final count
    noise = is_noise(cluster)
    totals = cluster_sizes(df, cluster).agg(
        F.count(F.when(~noise, F.col(cluster))).alias("n_clusters"),
        F.coalesce(F.sum(F.when(noise, F.col("rows"))), F.lit(0)).alias("n_noise"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"))
    return totals.withColumn(
        "noise_percent", F.try_divide(F.col("n_noise") * 100.0, F.col("n_rows"))
    ).withColumn("noise_text", percent_text("n_noise", "n_rows"))


# --- cluster geometry --------------------------------------------------------------------------------

def cluster_extent(df: DataFrame, lat: str, lon: str, count_col: str, cluster: str = "cluster") -> DataFrame:
    """Count of non-null ``count_col``, mean and bounds of the coordinates per cluster, noise included."""
    return df.groupBy(cluster).agg(
        F.count(count_col).alias("count"),
        F.avg(lat).alias("avg_lat"), F.avg(lon).alias("avg_lon"),
        F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
        F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"))


def cluster_radius_km(df: DataFrame, centres: DataFrame, lat: str, lon: str, cluster: str = "cluster") -> DataFrame:
    """Greatest distance from the mean position to any row; 0 for noise."""
    far = distance_to_centroid(without_position_gaps(df, lat, lon), centres, lat, lon, cluster)
    radius = far.groupBy(cluster).agg(F.max("distance_km").alias("radius_km"))
    return radius.withColumn("radius_km", F.when(is_noise(cluster), 0.0).otherwise(F.col("radius_km")))


def without_position_gaps(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())


def cluster_density(stats: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``area_km2`` of the circle and rows per km²; an area of 0 counts as 1, noise has density 0."""
    area = F.pi() * F.col("radius_km") * F.col("radius_km")
    out = stats.withColumn("area_km2", area)
    divisor = F.when(F.col("area_km2") == 0, 1.0).otherwise(F.col("area_km2"))
    return out.withColumn("density", F.when(is_noise(cluster), 0.0).otherwise(F.col("count") / divisor))


def cluster_statistics(df: DataFrame, lat: str, lon: str, count_col: str, cluster: str = "cluster") -> DataFrame:
    """Extent, radius, area, density and readable name per cluster."""
    extent = stage(cluster_extent(df, lat, lon, count_col, cluster), "extent")
    radius = cluster_radius_km(df, extent, lat, lon, cluster)
    stats = extent.join(radius, cluster, "left").na.fill(0.0, ["radius_km"])
    return cluster_density(stats, cluster).withColumn("cluster_name", cluster_name(cluster))


# --- environment and diversity -----------------------------------------------------------------------

# Columns summarised per cluster when present.
ENVIRONMENT_COLUMNS = ["depth", "bathymetry", "shoredistance", "sst", "sss"]
TAXONOMY_COLUMNS = ["phylum", "class", "order", "family", "genus", "species"]


def environment_stats(df: DataFrame, cols: list[str] | None = None, group: str = "cluster") -> DataFrame:
    """Mean, min, max and sample deviation per group of the listed columns that exist."""
    aggs = []
    for c in cols or ENVIRONMENT_COLUMNS:
        if c in df.columns:
            v = F.col(f"`{c}`")
            aggs += [F.avg(v).alias(f"{c}_mean"), F.min(v).alias(f"{c}_min"),
                     F.max(v).alias(f"{c}_max"), F.stddev_samp(v).alias(f"{c}_std")]
    return df.groupBy(group).agg(*aggs) if aggs else df.select(group).distinct()


def _taxon_totals(df: DataFrame, group: str, ranks: list[str]) -> tuple[DataFrame, list[str]]:
    """Per group and rank: distinct taxa, N and Σ n·ln n, from one count per (group, rank, taxon)."""
    present = [r for r in ranks if r in df.columns]
    typed = df.select(F.col(group), *[F.col(f"`{r}`").cast("string").alias(r) for r in present])
    counts = (typed.unpivot([group], present, "rank", "taxon")
              .groupBy(group, "rank", "taxon").agg(F.count("taxon").alias("n")))
    # a group whose taxa are all null keeps one row with n = 0
    totals = counts.groupBy(group, "rank").agg(
        F.count("taxon").alias("taxa"), F.sum("n").alias("total"),
        F.sum(F.when(F.col("n") > 0, F.col("n") * F.ln("n")).otherwise(0.0)).alias("n_log_n"))
    return totals, present


def _diversity() -> Column:
    entropy = F.ln("total") - F.try_divide(F.col("n_log_n"), F.col("total"))
    return F.greatest(F.coalesce(F.when(F.col("total") > 0, entropy), F.lit(0.0)), F.lit(0.0))


def _spread(totals: DataFrame, group: str, ranks: list[str], value: Column, name: str) -> list[Column]:
    return [F.max(F.when(F.col("rank") == r, value)).alias(name.format(r)) for r in ranks]


def unique_counts(df: DataFrame, ranks: list[str] | None = None, group: str = "cluster") -> DataFrame:
    """Exact number of distinct non-null taxa per group and rank."""
    totals, present = _taxon_totals(df, group, ranks or TAXONOMY_COLUMNS)
    return totals.groupBy(group).agg(*_spread(totals, group, present, F.col("taxa"), "unique_{}_count"))


def shannon_diversity(df: DataFrame, ranks: list[str] | None = None, group: str = "cluster") -> DataFrame:
    """−Σ p·ln p over the non-null taxa of each rank, as ln N − Σ n·ln n / N."""
    totals, present = _taxon_totals(df, group, ranks or TAXONOMY_COLUMNS)
    return totals.groupBy(group).agg(*_spread(totals, group, present, _diversity(), "{}_diversity"))


def taxonomy_stats(df: DataFrame, ranks: list[str] | None = None, group: str = "cluster") -> DataFrame:
    """Distinct counts and diversity together, sharing one shuffle."""
    totals, present = _taxon_totals(df, group, ranks or TAXONOMY_COLUMNS)
    return totals.groupBy(group).agg(
        *_spread(totals, group, present, F.col("taxa"), "unique_{}_count"),
        *_spread(totals, group, present, _diversity(), "{}_diversity"))
