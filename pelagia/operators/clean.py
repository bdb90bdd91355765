"""Projections, filters and de-duplication. All are narrow except :func:`dedupe` and the group filters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from pelagia.functions.expressions import cluster_name, is_noise, to_double
from pelagia.runtime import attach


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


# --- projections -------------------------------------------------------------------------------------

def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """The listed columns that exist, in the listed order."""
    return df.select(*[F.col(f"`{c}`") for c in cols if c in df.columns])


def require_columns(df: DataFrame, cols: list[str], any_of: bool = False) -> DataFrame:
    """Raise when columns are missing: one of them, or (``any_of``) all of them."""
    missing = [c for c in cols if c not in df.columns]
    if missing and (not any_of or len(missing) == len(cols)):
        raise ValueError(f"missing columns: {missing}")
    return df


def resolve_column(df: DataFrame, preferred: str, contains: str) -> str:
    """``preferred`` if present, else the first column whose lower-cased name contains ``contains``."""
    if preferred in df.columns:
        return preferred
    for c in df.columns:
        if contains in c.lower():
            return c
    raise ValueError(f"neither {preferred!r} nor a column containing {contains!r} found")


def cast_select(df: DataFrame, mapping: dict[str, tuple[str, str]]) -> DataFrame:
    """``{source: (name, type)}``; text which cannot be read as the type becomes null."""
    return df.select(*[
        (to_double(src) if typ == "double" else F.col(src).try_cast(typ)).alias(name)
        for src, (name, typ) in mapping.items()])


def trim_all(df: DataFrame) -> DataFrame:
    return df.select(*[F.trim(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])


def blank_to_null(df: DataFrame) -> DataFrame:
    """Exactly empty text becomes null; text of spaces is kept."""
    text = _string_columns(df)
    return df.replace("", None, subset=text) if text else df


def with_columns(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.withColumns(exprs)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def with_noise_flag(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.withColumn("is_noise", is_noise(cluster))


def with_cluster_name(df: DataFrame, out: str = "cluster_name", cluster: str = "cluster") -> DataFrame:
    """Readable label; ``out="cluster"`` replaces the number by the label."""
    return df.withColumn(out, cluster_name(cluster))


# --- filters -----------------------------------------------------------------------------------------

def drop_any_null(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def drop_null(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


def filter_equals(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def coordinate_in_range(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Null-free test; both bounds inclusive."""
    ok = to_double(lat).between(-90.0, 90.0) & to_double(lon).between(-180.0, 180.0)
    return F.coalesce(ok, F.lit(False))


def valid_coordinates(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.where(to_double(lat).between(-90.0, 90.0) & to_double(lon).between(-180.0, 180.0))


def filter_sql(df: DataFrame, predicate: str) -> DataFrame:
    return df.where(predicate)


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Rows in which every column is present and not empty (use after :func:`trim_all`)."""
    return df.where(reduce(and_, (F.coalesce(F.col(f"`{c}`") != "", F.lit(False)) for c in df.columns), F.lit(True)))


def without_noise(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.where(~is_noise(cluster))


def only_noise(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.where(is_noise(cluster))


def drop_blank_groups(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def group_sizes(df: DataFrame, group: str, value: str, n: int = 10) -> DataFrame:
    """Groups with at least ``n`` non-null values, one row per group."""
    return (df.where(F.col(group).isNotNull())
            .groupBy(group).agg(F.count(value).alias("observations"))
            .where(F.col("observations") >= n))


def min_group_size(df: DataFrame, group: str, value: str, n: int = 10) -> DataFrame:
    """Rows of the groups that have at least ``n`` non-null values."""
    sizes = group_sizes(df, group, value, n)
    counts = sizes.select(group, F.col("observations").alias("n"))
    return attach(df, sizes.select(group), [group], "left_semi", left_counts=counts)


def rows_of_group(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


# --- de-duplication ----------------------------------------------------------------------------------

def dedupe(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key: the least by ``order_by``, then by all other columns, nulls first.

    A ``min`` over a struct, so each map task already reduces a hot key to one row before the shuffle.
    """
    order_by = order_by or []
    rest = [c for c in df.columns if c not in keys]
    ordered = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not ordered:
        return df.select(*keys).distinct()
    best = df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])


# --- set operations ----------------------------------------------------------------------------------

def append_by_name(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column absent from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
