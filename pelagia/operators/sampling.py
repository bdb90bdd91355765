"""Ordering, top-n and sampling. Every limit here is the operator's meaning; samples are seeded."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from pelagia.functions.expressions import count_label, is_noise, stable_order
from pelagia.runtime import attach, stage


# Parts a group is cut into before its first rows are taken.
GROUP_PARTS = 64


def sort_by_count(df: DataFrame, count_col: str, ties: list[str]) -> DataFrame:
    return df.orderBy(F.desc(count_col), *ties)


def top_groups(df: DataFrame, count_col: str, ties: list[str], n: int = 20) -> DataFrame:
    """First ``n`` by count; each task keeps its own ``n`` before they are merged."""
    return sort_by_count(df, count_col, ties).limit(n)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def cap_rows(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """First ``n`` rows by ``order_by`` (which must be unique); each task keeps its own ``n`` before they are merged."""
    return df.orderBy(*order_by).limit(n)


def sample_n(df: DataFrame, row_id: str, n: int = 10_000, seed: int = 0) -> DataFrame:
    """Uniform sample without replacement of min(n, rows) rows, the same for the same ids and seed.

    It is the ``n`` rows with the least hash. On large tables rows whose hash cannot be among them are
    dropped while reading, so what is sorted stays near ``n`` rows; should fewer than ``n`` be left, the
    bound is raised.
    """
    order = stable_order(row_id, seed)
    rows = df.count()
    share = 1.1 * (n + 1000) / max(rows, 1)
    while share < 0.25:
        below = stage(df.where(order < f"{int(share * 16 ** 12):012x}"), "sample")
        if below.count() >= n:
            df = below
            break
        share *= 4
    return df.orderBy(order, row_id).limit(n)


def preview_sample(df: DataFrame, row_id: str, points: int = 20_000, noise: int = 5_000, seed: int = 0,
                   cluster: str = "cluster") -> DataFrame:
    """A sample of clustered rows and one of noise rows, each with its own size."""
    kept = sample_n(df.where(~is_noise(cluster)), row_id, points, seed)
    return kept.unionByName(sample_n(df.where(is_noise(cluster)), row_id, noise, seed))


def preview_legend(df: DataFrame, sample: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Legend text per cluster of a preview: clusters counted in the sample, noise in the whole table."""
    shown = (sample.where(~is_noise(cluster)).groupBy("cluster_name").agg(F.count(F.lit(1)).alias("n")))
    noise = df.where(is_noise(cluster)).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    both = shown.unionByName(noise.withColumn("cluster_name", F.lit("Noise")))
    return both.withColumn("label", count_label("cluster_name", "n"))


def collect_values(df: DataFrame, keys: list[str], value: str, order_by: str, limit: int = 1000) -> DataFrame:
    """First ``limit`` non-null values per group in row order, as an array.

    The row number is limited before the arrays are built, first within parts of each group and then over
    the parts. Spark also cuts every (group, part) to ``limit`` rows inside each map task, so a hot group
    reaches no task whole; above the session's bound for that cut the rows are written with the bound raised.
    """
    parts = Window.partitionBy(*keys, "_part").orderBy("_order")
    whole = Window.partitionBy(*keys).orderBy("_order")
    first = (df.select(*keys, F.col(value).alias("_value"), F.col(order_by).alias("_order"))
             .where(F.col("_value").isNotNull())
             .withColumn("_part", F.pmod(F.xxhash64("_order"), F.lit(GROUP_PARTS)))
             .withColumn("_position", F.row_number().over(parts)).where(F.col("_position") <= limit)
             .withColumn("_position", F.row_number().over(whole)).where(F.col("_position") <= limit))
    conf, bound = df.sparkSession.conf, "spark.sql.optimizer.windowGroupLimitThreshold"
    usual = conf.get(bound)
    if limit > int(usual):
        conf.set(bound, str(limit))
        try:
            first = stage(first, "first_values")
        finally:
            conf.set(bound, usual)
    pairs = F.array_sort(F.collect_list(F.struct("_position", "_value")))
    return first.groupBy(*keys).agg(F.transform(pairs, lambda p: p.getField("_value")).alias("all_values"))


def values_of_groups(df: DataFrame, groups: DataFrame, keys: list[str], value: str, order_by: str,
                     limit: int = 1000) -> DataFrame:
    return collect_values(attach(df, groups.select(*keys), keys, "left_semi"), keys, value, order_by, limit)
