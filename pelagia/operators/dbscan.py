"""Density clustering (DBSCAN, Ester et al. 1996) and its parameter search.

Cells of the grid with enough weight consist of core points only (Gan & Tao 2015), all core points of a cell
share a cluster, and clusters are the connected components of touching cells. Cluster numbers and border
points follow the sequential algorithm run in row-id order, so the result is fully determined:
clusters are numbered by their least core row id, a border point joins the lowest-numbered cluster in reach.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pelagia.functions.expressions import NOISE
from pelagia.operators.components import connected_components
from pelagia.operators.features import rank_within
from pelagia.operators.neighbors import (
    PAIR_LIMIT, _axes, cell_columns, cell_summary, cells_within, collapse, has_position, position_columns, positions,
    touching_cells, weight_within,
)
from pelagia.operators.sampling import sample_n
from pelagia.operators.silhouette import silhouette_euclidean
from pelagia.runtime import attach, is_small, stage


def _with_runs(rows: DataFrame, runs: list[tuple[int, float, int]]) -> DataFrame:
    """Each row once per setting ``(run, eps, min_samples)``."""
    settings = ", ".join(f"struct({r} AS run, {float(e)!r}D AS eps, {int(m)} AS min_samples)" for r, e, m in runs)
    return rows.selectExpr(f"inline(array({settings}))", "*")


def _fit(rows: DataFrame, d: int, pair_limit: int, touch_limit: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Labels of the dense cells ``(run, c0.., cluster)``, their rows ``(run, c0.., n)``, and the labels of
    the points elsewhere ``(run, x0.., cluster)``."""
    cs, xs = _axes(d, "c"), _axes(d, "x")
    cell_key = ["run", "eps", *cs]
    points = collapse(rows, d)
    cells = stage(cell_summary(points, d, "min_samples")
                  .withColumn("dense", F.col("w") >= F.col("min_samples")), "cells")
    dense_cells, sparse_cells = cells.where("dense"), cells.where("NOT dense")

    # core points: all of a dense cell; elsewhere those with enough weight in reach
    per_cell = cells.select(*cell_key, "n")
    sparse = attach(points, sparse_cells.select(*cell_key), cell_key, "left_semi", left_counts=per_cell)
    if not is_small(sparse_cells):
        sparse = stage(sparse, "sparse")
    near = weight_within(sparse, points, sparse_cells, cells, d, pair_limit=pair_limit)
    flagged = stage(sparse.join(near, ["run", "rid"], "left")
                    .withColumn("core", F.coalesce(F.col("near") >= F.col("min_samples"), F.lit(False)))
                    .drop("near"), "flagged")
    single_cores = flagged.where("core").drop("core")
    core = attach(points, dense_cells.select(*cell_key), cell_key, "left_semi", left_counts=per_cell)
    core = core.unionByName(single_cores)
    if not is_small(dense_cells):
        core = stage(core, "core")
    summary = cell_summary(single_cores, d).withColumn("dense", F.lit(False))
    core_cells = stage(summary.unionByName(dense_cells.drop("min_samples")), "core_cells")

    # clusters: components of core cells that touch, numbered by their least core row id
    edges = touching_cells(core, core_cells, d, touch_limit)
    roots = connected_components(core_cells.select("run", "id"), edges)
    numbers = rank_within(roots.select("run", "root").distinct(), ["run"], ["root"], "cluster")
    of_root = attach(roots, numbers, ["run", "root"]).select("run", "id", "cluster")
    labelled = stage(core_cells.select(*cell_key, "dense", "id").join(of_root, ["run", "id"]), "labelled")

    # border points: lowest-numbered cluster with a core point in reach
    loose = flagged.where("NOT core").drop("core")
    contacts = cells_within(loose, core, cell_summary(loose, d), core_cells, d, pair_limit)
    clusters = labelled.select("run", F.col("id").alias("b_id"), "cluster")
    border = contacts.join(clusters, ["run", "b_id"]).groupBy("run", "rid").agg(F.min("cluster").alias("cluster"))

    core_labels = single_cores.join(labelled.select(*cell_key, "cluster"), cell_key).select("run", *xs, "cluster")
    loose_labels = loose.join(border, ["run", "rid"], "left").select(
        "run", *xs, F.coalesce("cluster", F.lit(NOISE)).alias("cluster"))
    weights = cells.where("dense").select("run", *cs, F.col("w").alias("n"))
    return labelled.where("dense").select("run", *cs, "cluster"), weights, core_labels.unionByName(loose_labels)


def _label(rows: DataFrame, d: int, dense_labels: DataFrame, dense_rows: DataFrame,
           point_labels: DataFrame) -> DataFrame:
    """Rows with their cluster: by cell where the cell is dense, else by position.

    The second join cannot be skewed: fewer than ``min_samples`` rows share a position outside dense cells.
    """
    cs, xs = _axes(d, "c"), _axes(d, "x")
    placed = rows.withColumns(cell_columns(d))
    dense = attach(placed, dense_labels, ["run", *cs], left_counts=dense_rows)
    loose = attach(placed, dense_labels.select("run", *cs), ["run", *cs], "left_anti", left_counts=dense_rows)
    loose = loose.join(point_labels, ["run", *xs])
    return dense.unionByName(loose)


def dbscan(df: DataFrame, coords: list[str], eps: float, min_samples: int, row_id: str,
           out: str = "cluster", pair_limit: int | None = None) -> DataFrame:
    """Add the cluster number of every row, −1 for noise; rows without a position get null.

    ``row_id`` must be unique and ``df`` must give the same rows each time it is read (as any file does).
    Rows are labelled by joining the labels of the cells, which are broadcast where their table is small and
    shuffled with the rows otherwise; rows outside dense cells are joined by position.
    """
    d = len(coords)
    limit = max(PAIR_LIMIT if pair_limit is None else pair_limit, min_samples)
    rows = _with_runs(positions(df, coords, row_id), [(0, eps, min_samples)])
    labels = _fit(rows, d, limit, pair_limit)
    packed = df.select(F.struct("*").alias("row"), *position_columns(coords))
    placed = packed.where(has_position(d)).select("row", F.lit(0).alias("run"), F.lit(float(eps)).alias("eps"), *_axes(d, "x"))
    labelled = _label(placed, d, *labels).select("row", "cluster")
    gaps = packed.where(~has_position(d)).select("row", F.lit(None).cast("bigint").alias("cluster"))
    return labelled.unionByName(gaps).select("row.*", F.col("cluster").alias(out))


# The two search grids with their fall-back settings.
GRID_FINE = {"eps": [0.01, 0.03, 0.05, 0.1, 0.15, 0.2, 0.3], "min_samples": [5, 10, 15, 20, 30], "default": (0.1, 10)}
GRID_COARSE = {"eps": [0.05, 0.1, 0.15, 0.2, 0.3], "min_samples": [10, 20, 50, 100], "default": (0.1, 50)}


def dbscan_grid(df: DataFrame, coords: list[str], row_id: str, eps_values: list[float],
                min_samples_values: list[int], sample: int | None = None, seed: int = 0,
                pair_limit: int | None = None) -> DataFrame:
    """Clusters, noise and noise-free Euclidean silhouette per parameter pair.

    All rows are used unless the caller asks for a seeded ``sample`` of that many. All pairs run through the clustering together, as separate runs of the same jobs. ``score`` is null
    unless there are at least two clusters and more clustered rows than clusters.
    """
    d = len(coords)
    runs = [(i * len(min_samples_values) + j, e, m)
            for i, e in enumerate(eps_values) for j, m in enumerate(min_samples_values)]
    searched = positions(df, coords, row_id)
    if sample is not None:
        searched = sample_n(searched, "rid", sample, seed)
    # rows at one position share their label in every run, so each position is taken through the runs once, with its weight
    places = searched.groupBy(*_axes(d, "x")).agg(F.count(F.lit(1)).alias("w"), F.min("rid").alias("rid"))
    rows = _with_runs(stage(places, "searched"), runs)
    limit = max(PAIR_LIMIT if pair_limit is None else pair_limit, *min_samples_values)
    labelled = stage(_label(rows, d, *_fit(rows, d, limit, pair_limit)), "labelled")
    noise = F.col("cluster") == NOISE
    sizes = labelled.groupBy("run", "eps", "min_samples", "cluster").agg(F.sum("w").alias("rows"))
    counts = sizes.groupBy("run", "eps", "min_samples").agg(
        F.count(F.when(~noise, 1)).cast("int").alias("n_clusters"),
        F.coalesce(F.sum(F.when(noise, F.col("rows"))), F.lit(0)).alias("n_noise"),
        F.coalesce(F.sum(F.when(~noise, F.col("rows"))), F.lit(0)).alias("n_clustered"))
    valid = (F.col("n_clusters") >= 2) & (F.col("n_clustered") > F.col("n_clusters"))
    scored = attach(labelled.where(~noise), counts.where(valid).select("run"), ["run"], "left_semi")
    scores = silhouette_euclidean(scored, _axes(d, "x"), "cluster", run="run", weight="w").select("run", F.col("silhouette").alias("score"))
    return counts.join(scores, "run", "left").orderBy("run")


def best_parameters(grid: DataFrame, default: tuple[float, int]) -> tuple[float, int]:
    """The first setting with the strictly best score above −1, else the default."""
    row = grid.where(F.col("score") > -1).orderBy(F.desc("score"), "run").first()
    return (row["eps"], row["min_samples"]) if row else default
