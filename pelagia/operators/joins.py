"""Joins of the taxon tables and of groups with their lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pelagia.functions.expressions import haversine_km
from pelagia.operators.clean import dedupe
from pelagia.runtime import attach, hot_parts, skew_join


def join_on_key(a: DataFrame, b: DataFrame, key: str, how: str = "inner", hot_rows: int | None = None) -> DataFrame:
    """Equi-join with one key column in the result; hot keys are split."""
    return skew_join(a, b, [key], how, hot_rows)


def join_one_per_key(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Inner join, then one row per key.

    The least joined row is the least row of ``a`` with the least row of ``b``, so both sides are reduced
    before they meet and repeated keys never multiply.
    """
    return dedupe(a, [key]).join(dedupe(b, [key]), key, "inner")


def left_join_chain(base: DataFrame, tables: list[tuple[DataFrame, str]], key: str,
                    hot_rows: int | None = None, unique_base: bool = False) -> DataFrame:
    """``base`` left-joined with each ``(table, suffix)`` in turn on ``key``.

    Several matches multiply the row; a column already present gets the suffix; an empty table adds
    nothing. Hot keys are counted once per input table, never on a joined result; without any, all joins
    share one partitioning by ``key``. ``unique_base`` says that ``base`` has one row per key, which saves
    counting it.
    """
    result = base
    left_parts = hot_parts(base.limit(0) if unique_base else base, [key], hot_rows)
    for table, suffix in tables:
        if table.isEmpty():
            continue
        clashes = {c: c + suffix for c in table.columns if c != key and c in result.columns}
        right_parts = hot_parts(table, [key], hot_rows)
        result = skew_join(result, table.withColumnsRenamed(clashes), [key], "left",
                           left_parts=left_parts, right_parts=right_parts)
        left_parts = _multiplied(left_parts, right_parts, key)
    return result


def _multiplied(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Parts of the joined rows: a key that is hot in both tables has the product of its parts."""
    both = a.join(b.withColumnRenamed("parts", "more"), key, "full")
    return both.select(key, (F.coalesce("parts", F.lit(1)) * F.coalesce("more", F.lit(1))).alias("parts"))


def attach_group_stats(stats: DataFrame, more: DataFrame, key: str = "cluster") -> DataFrame:
    """Left join of two tables that both have one row per group."""
    return stats.join(more, key, "left")


def lookup(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Attach the value of a key → value table; a key without an entry gives null."""
    return attach(df, mapping, [key], "left")


def restrict_to_groups(df: DataFrame, groups: DataFrame, on: str | list[str]) -> DataFrame:
    on = [on] if isinstance(on, str) else on
    return attach(df, groups.select(*on), on, "left_semi")


def unpivot_levels(df: DataFrame, levels: list[str], keep: list[str]) -> DataFrame:
    """One row per (row, level): the level's name, its group and the kept columns; null groups dropped."""
    # group names are text whatever the type of their column
    text = df.select(*keep, *[F.col(f"`{c}`").cast("string").alias(c) for c in levels])
    return (text.unpivot(keep, levels, "taxonomic_level", "taxonomic_group")
            .where(F.col("taxonomic_group").isNotNull() & (F.col("taxonomic_group") != "")))


def match_groups(df: DataFrame, groups: DataFrame, levels: list[str], keep: list[str]) -> DataFrame:
    """Rows matched to (level, group) pairs, where the level names the column to compare."""
    long = unpivot_levels(df, levels, keep)
    return attach(long, groups, ["taxonomic_level", "taxonomic_group"], "inner")


def distance_to_centroid(df: DataFrame, centres: DataFrame, lat: str, lon: str, cluster: str = "cluster") -> DataFrame:
    """Add ``distance_km`` from each row to the ``avg_lat``/``avg_lon`` of its cluster."""
    joined = attach(df, centres.select(cluster, "avg_lat", "avg_lon"), [cluster], "inner")
    return joined.withColumn("distance_km", haversine_km("avg_lat", "avg_lon", lat, lon))
