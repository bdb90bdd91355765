"""Ordinal encoding, scaling and feature vectors."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from pelagia.runtime import attach, is_small, spread_partitions, stage


def rank_within(df: DataFrame, prefix: list[str], by: list[str], out: str) -> DataFrame:
    """Position 0..n-1 of each row by ``by`` within its ``prefix``; rows must be distinct.

    The rows are range-partitioned, numbered inside each partition, and shifted by the number of rows in
    earlier partitions, so no task sees a whole prefix. Tables known to be small are numbered directly.
    """
    if is_small(df):
        position = F.row_number().over(Window.partitionBy(*prefix, F.lit(0)).orderBy(*by))
        return df.withColumn(out, (position - 1).cast("bigint"))
    parts = spread_partitions(df)
    placed = stage(df.repartitionByRange(parts, *prefix, *by).withColumn("_part", F.spark_partition_id()), "placed")
    earlier = Window.partitionBy(*prefix, F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per prefix and partition
    totals = placed.groupBy(*prefix, "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = totals.select(*prefix, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part", *prefix).orderBy(*by)
    return (attach(placed, offsets, [*prefix, "_part"])
            .withColumn(out, (F.col("_before") + F.row_number().over(inside) - 1).cast("bigint"))
            .drop("_part", "_before"))


def encoding_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, value, code)``: sorted distinct values of each column numbered from 0."""
    pairs = stage(df.unpivot([], cols, "column", "value").na.drop().distinct(), "values")
    return rank_within(pairs, ["column"], ["value"], "code")


def ordinal_encode(df: DataFrame, cols: list[str], suffix: str = "_encoded") -> DataFrame:
    """Add the code of each listed column; null stays null. Columns are encoded independently."""
    types = dict(df.dtypes)
    out = df
    for typ in dict.fromkeys(types[c] for c in cols):
        same = [c for c in cols if types[c] == typ]
        codes = stage(encoding_table(df.select(*same), same), "codes")
        for c in same:
            table = codes.where(F.col("column") == c).select(F.col("value").alias(c), F.col("code").alias(c + suffix))
            # hot values are counted on the input, not on the columns joined so far
            counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
            out = attach(out, table, [c], "left", left_counts=counts)
    return out


# --- scaling -----------------------------------------------------------------------------------------

def fit_scaler(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, from one aggregate; only these scalars reach the driver."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_pop(c).alias(f"{c}__std")]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}__mean"] or 0.0, row[f"{c}__std"] or 0.0) for c in cols}


def standard_scale(df: DataFrame, cols: list[str], params: dict[str, tuple[float, float]] | None = None,
                   suffix: str = "_scaled") -> DataFrame:
    """(x − mean) / population deviation; a constant column becomes 0."""
    params = params or fit_scaler(df, cols)
    return df.withColumns({
        c + suffix: (F.col(c) - F.lit(float(m))) / F.lit(float(s) or 1.0) for c, (m, s) in params.items()})


def standard_unscale(df: DataFrame, params: dict[str, tuple[float, float]], suffix: str = "_scaled",
                     out_suffix: str = "_unscaled") -> DataFrame:
    """Scaled columns back in original units."""
    return df.withColumns({
        c + out_suffix: F.col(c + suffix) * F.lit(float(s) or 1.0) + F.lit(float(m)) for c, (m, s) in params.items()})


def assemble_features(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Numeric columns as one vector; rows with a null in them are dropped."""
    return VectorAssembler(inputCols=cols, outputCol=out).transform(df.na.drop(subset=cols))
