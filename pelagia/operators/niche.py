"""Value distributions per group: moments, exact quantiles, mode, histogram peak, dominant parents.

All of them are derived from one table of value counts, ``(keys…, value, n)``. Building it combines equal
values inside each map task and spreads a hot group over many tasks, because the value is part of the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pelagia.functions.expressions import to_double
from pelagia.operators.joins import unpivot_levels
from pelagia.operators.sampling import sort_by_count
from pelagia.runtime import attach, spread_partitions, stage

QUANTILES = {"p05": 0.05, "q1": 0.25, "median": 0.5, "q3": 0.75, "p95": 0.95}

# Ranks from coarse to fine.
TAXONOMIC_LEVELS = ["phylum", "class", "order", "family", "genus", "species"]


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows per group and value; null and NaN values and null groups are dropped."""
    v = df.select(*keys, to_double(value).alias("value")).na.drop()
    return v.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def group_moments(counts: DataFrame, keys: list[str], min_obs: int = 1) -> DataFrame:
    """Count, mean, min, max, mode (lowest of the most frequent) and number of distinct values."""
    # the mode is the greatest (n, -value)
    top = F.max(F.struct(F.col("n"), (-F.col("value")).alias("neg")))
    return (counts.groupBy(*keys).agg(
        F.sum("n").alias("observations"), (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
        F.count(F.lit(1)).alias("values"), top.alias("_top"))
        .withColumn("mode", F.lit(0.0) - F.col("_top").getField("neg")).drop("_top")
        .where(F.col("observations") >= min_obs))


def _bin_edge(i: Column, lo: Column, hi: Column, bins: int) -> Column:
    step = (hi - lo) / float(bins)
    return F.when(i == bins, hi).otherwise(lo + i * step)


def _bin_index(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal bins, the last one closed; checked against the edges themselves."""
    raw = F.least(F.floor((v - lo) / (hi - lo) * float(bins)).cast("int"), F.lit(bins - 1))
    below = v < _bin_edge(raw, lo, hi, bins)
    above = (v >= _bin_edge(raw + 1, lo, hi, bins)) & (raw != bins - 1)
    return F.when(below, raw - 1).when(above, raw + 1).otherwise(raw)


def _bounds() -> tuple[Column, Column]:
    same = F.col("min") == F.col("max")
    return (F.when(same, F.col("min") - 0.5).otherwise(F.col("min")),
            F.when(same, F.col("max") + 0.5).otherwise(F.col("max")))


def _sizes(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per group of the value counts, known from the moments."""
    return moments.select(*keys, F.col("values").alias("n"))


def histogram(counts: DataFrame, moments: DataFrame, keys: list[str], bins: int = 20) -> DataFrame:
    """Rows and squared deviations per group and non-empty bin."""
    m = moments.select(*keys, "min", "max", "mean")
    lo, hi = _bounds()
    v, dev = F.col("value"), F.col("value") - F.col("mean")
    return (attach(counts, m, keys, left_counts=_sizes(moments, keys)).withColumn("bin", _bin_index(v, lo, hi, bins))
            .groupBy(*keys, "bin").agg(
                F.sum("n").alias("rows"), F.sum(F.col("n") * dev * dev).alias("squares"),
                F.min("min").alias("min"), F.max("max").alias("max"))
            .withColumn("bin_low", _bin_edge(F.col("bin"), lo, hi, bins))
            .withColumn("bin_high", _bin_edge(F.col("bin") + 1, lo, hi, bins)))


def histogram_summary(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Midpoint of the fullest bin (the lowest on ties) and the sample deviation per group."""
    top = F.max(F.struct("rows", (-F.col("bin")).alias("neg"), "bin_low", "bin_high")).alias("_top")
    total = F.sum("rows")
    return hist.groupBy(*keys).agg(
        top, F.when(total > 1, F.sqrt(F.sum("squares") / (total - 1))).alias("std"),
    ).select(*keys, ((F.col("_top.bin_low") + F.col("_top.bin_high")) / 2).alias("peak"),
             (-F.col("_top.neg")).alias("peak_bin"), F.col("_top.rows").alias("peak_rows"), "std")


def histogram_peak(df: DataFrame, keys: list[str], value: str, bins: int = 20) -> DataFrame:
    """Peak of a ``bins``-bin histogram of each group's own range."""
    counts = stage(value_counts(df, keys, value), "counts")
    hist = histogram(counts, stage(group_moments(counts, keys), "moments"), keys, bins)
    return histogram_summary(hist, keys).drop("std")


def group_quantiles(counts: DataFrame, keys: list[str], quantiles: dict[str, float] | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles per group, found the same way for groups of any size.

    The value counts are range-partitioned by (keys, value), so each group is a run of partitions. Totals
    per (partition, group) give the rank before each partition, a window inside it the rank of each value.
    """
    quantiles = quantiles or QUANTILES
    parts = spread_partitions(counts)
    placed = stage(counts.repartitionByRange(parts, *keys, "value")
                   .withColumn("_part", F.spark_partition_id()), "ranked")
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per partition and group
    totals = placed.groupBy(*keys, "_part").agg(F.sum("n").alias("_n"))
    total = F.sum("_n").over(Window.partitionBy(*keys))
    offsets = totals.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                            total.alias("_total"))
    inside = Window.partitionBy("_part", *keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (attach(placed, offsets, [*keys, "_part"])
              .withColumn("_last", F.col("_before") + F.sum("n").over(inside)))

    def at(rank: Column) -> Column:
        hit = (rank < F.col("_last")) & (rank >= F.col("_last") - F.col("n"))
        return F.max(F.when(hit, F.col("value")))

    picks = []
    for name, p in quantiles.items():
        pos = (F.col("_total") - 1) * F.lit(p)
        picks += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
    picked = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *picks)

    def interpolate(name, p):
        pos = (F.col("_total") - 1) * F.lit(p)
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        return (lo + (hi - lo) * (pos - F.floor(pos))).alias(name)

    return picked.select(*keys, *[interpolate(name, p) for name, p in quantiles.items()])


def value_profile(df: DataFrame, keys: list[str], value: str, min_obs: int = 1, bins: int = 20) -> DataFrame:
    """Count, mean, median, mode, peak, min, max, deviation, quantiles and widths per group."""
    return profile_counts(stage(value_counts(df, keys, value), "counts"), keys, min_obs, bins)


def profile_counts(counts: DataFrame, keys: list[str], min_obs: int = 1, bins: int = 20) -> DataFrame:
    """The value profile from (staged) value counts."""
    moments = stage(group_moments(counts, keys, min_obs), "moments")
    shape = histogram_summary(histogram(counts, moments, keys, bins), keys)
    quantiles = group_quantiles(counts, keys)
    joined = moments.join(shape, keys).join(quantiles, keys)
    return range_widths(joined.select(
        *keys, "observations", "mean", "median", "mode", "peak", "min", "max", "std", "p05", "p95", "q1", "q3"))


def range_widths(profile: DataFrame) -> DataFrame:
    return profile.withColumns({
        "optimal_min": F.col("q1"), "optimal_max": F.col("q3"),
        "range_width": F.col("max") - F.col("min"), "optimal_width": F.col("q3") - F.col("q1")})


def describe_by_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return value_profile(df, keys, value).select(
        *keys, "observations", "mean", "median", "min", "max", "std")


def percentiles_by_group(df: DataFrame, keys: list[str], value: str,
                         quantiles: dict[str, float] | None = None) -> DataFrame:
    return group_quantiles(stage(value_counts(df, keys, value), "counts"), keys, quantiles)


def mode_by_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return group_moments(value_counts(df, keys, value), keys).select(*keys, "mode")


def dominant_value(df: DataFrame, keys: list[str], col: str, out: str) -> DataFrame:
    """Most frequent non-null value of ``col`` per group, the lowest on ties."""
    counts = (df.select(*keys, F.col(f"`{col}`").alias(out)).na.drop()
              .groupBy(*keys, out).agg(F.count(F.lit(1)).alias("n")))
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col(out)))
    return counts.groupBy(*keys).agg(best.getField(out).alias(out))


def path_counts(df: DataFrame, levels: list[str], value: str) -> DataFrame:
    """``(levels…, value, n)``: rows per distinct path of ranks and value, rows without a value dropped."""
    names = [F.col(f"`{c}`").cast("string").alias(c) for c in levels]
    typed = df.select(*names, to_double(value).alias("value")).where(F.col("value").isNotNull())
    return typed.groupBy(*levels, "value").agg(F.count(F.lit(1)).alias("n"))


def dominant_parents(counts: DataFrame, levels: list[str]) -> DataFrame:
    """Most frequent name at every coarser rank, for every group of every level.

    Takes path counts; only the distinct paths of ranks are expanded into pairs of ranks.
    """
    paths = counts.groupBy(*levels).agg(F.sum("n").alias("n"))
    pairs = [
        F.struct(F.lit(fine).alias("taxonomic_level"), F.col(f"`{fine}`").alias("taxonomic_group"),
                 F.lit(coarse).alias("rank"), F.col(f"`{coarse}`").alias("name"))
        for j, fine in enumerate(levels) for coarse in levels[:j]]
    names = ["taxonomic_level", "taxonomic_group"]
    if not pairs:
        empty = [F.lit("").alias(c) for c in names]
        return paths.limit(0).select(*empty)
    counts = (paths.select("n", F.inline(F.array(*pairs))).where("taxonomic_group IS NOT NULL AND name IS NOT NULL")
              .groupBy(*names, "rank", "name").agg(F.sum("n").alias("n")))
    best = [F.min(F.when(F.col("rank") == c, F.struct((-F.col("n")).alias("neg"), F.col("name"))))
            .getField("name").alias(f"parent_{c}") for c in levels[:-1]]
    return counts.groupBy(*names).agg(*best)


# Output names of the multi-level table.
NICHE_COLUMNS = {
    "observations": "observation_count", "mean": "mean_temperature", "median": "median_temperature",
    "mode": "mode_temperature", "peak": "peak_temperature", "min": "min_temperature",
    "max": "max_temperature", "std": "std_temperature", "p05": "p05_temperature", "p95": "p95_temperature",
    "q1": "q1_temperature", "q3": "q3_temperature", "optimal_min": "optimal_temp_min",
    "optimal_max": "optimal_temp_max", "range_width": "temp_range_width", "optimal_width": "optimal_range_width",
}


def multi_level_stats(df: DataFrame, levels: list[str], value: str, min_obs: int = 10) -> DataFrame:
    """Value profile and dominant parents of every group of every level, largest groups first.

    ``levels`` run from coarse to fine. The rows are read once, into counts per path of ranks and value; all
    levels are then profiled in one grouping by (level, group), and the parents come from the same counts.
    """
    keys = ["taxonomic_level", "taxonomic_group"]
    present = [c for c in levels if c in df.columns]
    paths = stage(path_counts(df, present, value), "paths")
    counts = unpivot_levels(paths, present, ["value", "n"]).groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    profile = profile_counts(stage(counts, "counts"), keys, min_obs)
    parents = dominant_parents(paths, present)
    table = profile.withColumnsRenamed(NICHE_COLUMNS).join(parents, keys, "left")
    return sort_by_count(table, "observation_count", keys)
