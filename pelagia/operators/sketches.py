"""Sketches of groups as columns: small, stored with a table, and merged later without the rows they were made of.

They are opt-in beside the exact operators: distinct counts are off by about ``1 / sqrt(2 ** bits)`` of their value, quantiles
by about ``2.3 / k`` of the rows in rank (Karnin, Lang & Liberty 2016).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BITS = 12
RANKS = 200
_DISTINCT, _QUANTILES = "_distinct_sketch", "_quantile_sketch"


def distinct_sketches(df: DataFrame, keys: list[str], cols: list[str], bits: int = BITS) -> DataFrame:
    """``keys…, <col>_distinct_sketch…``: one HyperLogLog sketch per group and column; nulls don't count."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), bits).alias(c + _DISTINCT) for c in cols])


def quantile_sketches(df: DataFrame, keys: list[str], cols: list[str], ranks: int = RANKS) -> DataFrame:
    """``keys…, <col>_quantile_sketch…``: one KLL sketch per group and column; nulls don't count."""
    return df.groupBy(*keys).agg(*[F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), ranks).alias(c + _QUANTILES) for c in cols])


def merge_sketches(sketches: DataFrame, keys: list[str], ranks: int = RANKS) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones or of several tables appended."""
    merged = [F.hll_union_agg(F.col(f"`{c}`"), F.lit(True)).alias(c) for c in sketches.columns if c.endswith(_DISTINCT)]
    merged += [F.kll_merge_agg_double(F.col(f"`{c}`"), ranks).alias(c) for c in sketches.columns if c.endswith(_QUANTILES)]
    return sketches.groupBy(*keys).agg(*merged)


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """Every distinct-count sketch replaced by its estimate ``<col>_distinct``."""
    return sketches.select(*[
        F.hll_sketch_estimate(f"`{c}`").alias(c.removesuffix("_sketch")) if c.endswith(_DISTINCT) else F.col(f"`{c}`") for c in sketches.columns])


def quantile_estimates(sketches: DataFrame, col: str, quantiles: dict[str, float]) -> DataFrame:
    """Named quantiles of one column, from its sketch; null for a group without values."""
    sketch = F.col(f"`{col}{_QUANTILES}`")
    some = F.kll_sketch_get_n_double(sketch) > 0
    others = [F.col(f"`{c}`") for c in sketches.columns if not c.endswith((_DISTINCT, _QUANTILES))]
    return sketches.select(*others, *[
        F.when(some, F.kll_sketch_get_quantile_double(sketch, F.lit(q))).alias(name) for name, q in quantiles.items()])
