"""Temperature niche of every taxon at every rank."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from pelagia.functions.expressions import group_label
from pelagia.operators.clean import require_columns, resolve_column
from pelagia.operators.joins import match_groups
from pelagia.operators.niche import TAXONOMIC_LEVELS, multi_level_stats
from pelagia.operators.sampling import collect_values, sort_by_count, top_groups
from pelagia.runtime import stage
from pelagia.sources.delimited import with_row_id

KEYS = ["taxonomic_level", "taxonomic_group"]


class TemperatureNiche(NamedTuple):
    table: DataFrame
    top: DataFrame
    distributions: DataFrame


def niche_distributions(df: DataFrame, table: DataFrame, levels: list[str], value: str, row_id: str,
                        groups: int = 100, values: int = 1000) -> DataFrame:
    """The largest groups with their optimal range, peak and first values."""
    shown = top_groups(table, "observation_count", KEYS, groups).select(
        *KEYS, F.col("observation_count").alias("count"), F.col("optimal_temp_min").alias("optimal_min"),
        F.col("optimal_temp_max").alias("optimal_max"), F.col("peak_temperature").alias("peak"))
    rows = match_groups(df.where(F.col(value).isNotNull()), shown.select(*KEYS), levels, [value, row_id])
    lists = collect_values(rows, KEYS, value, row_id, values).withColumnRenamed("all_values", "all_temperatures")
    return shown.join(lists, KEYS, "left")


def temperature_niche(df: DataFrame, levels: list[str] | None = None, row_id: str | None = None,
                      min_obs: int = 10) -> TemperatureNiche:
    value = resolve_column(df, "sst", "temp")
    levels = levels or TAXONOMIC_LEVELS
    require_columns(df, levels, any_of=True)
    present = [c for c in levels if c in df.columns]
    if row_id is None:
        df, row_id = with_row_id(df.select(value, *[F.col(f"`{c}`") for c in present])), "row_id"
    table = stage(multi_level_stats(df, present, value, min_obs), "niche")
    top = top_groups(table, "observation_count", KEYS).withColumn(
        "label", group_label("taxonomic_group", "observation_count"))
    return TemperatureNiche(sort_by_count(table, "observation_count", KEYS), top, niche_distributions(df, table, present, value, row_id))
