"""Taxon tables: clean the four source tables, join them, and clean the exported table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pelagia.operators.clean import (
    blank_to_null, dedupe, drop_any_null, drop_blank_rows, drop_null, filter_equals, select_existing,
    strip_column_names, trim_all,
)
from pelagia.operators.joins import left_join_chain

# Columns kept from each source table.
TAXON_COLUMNS = ["taxonID", "scientificName", "kingdom", "phylum", "class", "order", "family", "genus"]
VERNACULAR_COLUMNS = ["taxonID", "vernacularName", "language"]
DISTRIBUTION_COLUMNS = ["taxonID", "locationID", "locality", "occurrenceStatus", "countryCode"]


def clean_taxon(raw: DataFrame) -> DataFrame:
    named = select_existing(strip_column_names(raw), TAXON_COLUMNS)
    return dedupe(drop_null(named, ["taxonID", "scientificName"]), ["taxonID"])


def clean_vernacular(raw: DataFrame, language: str = "ENG") -> DataFrame:
    named = select_existing(strip_column_names(raw), VERNACULAR_COLUMNS)
    return drop_null(filter_equals(named, "language", language), ["taxonID", "vernacularName"])


def clean_distribution(raw: DataFrame) -> DataFrame:
    return drop_null(select_existing(strip_column_names(raw), DISTRIBUTION_COLUMNS), ["taxonID"])


def clean_species_profile(raw: DataFrame) -> DataFrame:
    return drop_any_null(strip_column_names(raw))


def build_taxon_table(taxon: DataFrame, vernacular: DataFrame, profile: DataFrame, distribution: DataFrame,
                      language: str = "ENG") -> DataFrame:
    """The four raw tables cleaned and joined. Hot keys are counted before, so this runs jobs."""
    return left_join_chain(
        clean_taxon(taxon),
        [(clean_vernacular(vernacular, language), "_vern"), (clean_species_profile(profile), "_species"),
         (clean_distribution(distribution), "_dist")], "taxonID", unique_base=True)


def clean_taxon_csv(df: DataFrame, trim: bool = False) -> DataFrame:
    """Complete rows only. ``trim`` also strips spaces first, so text of spaces counts as missing."""
    return drop_blank_rows(trim_all(df)) if trim else drop_any_null(blank_to_null(df))
