"""k-means for a range of k at once: every pass over the points advances all k, so a curve costs as many passes as one fit.

Candidates are drawn in rounds from the weighted points, by their squared distance from those drawn before (k-means||,
Bahmani et al. 2012); for each k the best of several k-means++ choices among them starts the iteration. Only candidates
and centres come to the driver, whose number follows from the ks and not from the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

ROUNDS = 5
DRAWN_PER_CENTRE = 2
TRIES = 8


def _matrix(batch: pa.RecordBatch, cols: list[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in cols])


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of every point, the first of equals, and its squared distance."""
    best, at = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    for i, c in enumerate(centres):
        d = ((x - c) ** 2).sum(axis=1)
        closer = d < best
        best[closer], at[closer] = d[closer], i
    return at, best


def _draw(points: DataFrame, cols: list[str], known: np.ndarray, rows: int, seed: int) -> np.ndarray:
    """``rows`` points, drawn without replacement by weight times squared distance from the known ones.

    A point's key is exponential with that rate, from the hash of its values; the least keys are drawn. Points that
    are known already are never drawn, so fewer come back if all others are known.
    """
    def keyed(batches):
        for batch in batches:
            x = _matrix(batch, cols)
            rate = batch.column("n").to_numpy()
            if len(known):
                rate = rate * _nearest(x, known)[1]
            chance = ((batch.column("_hash").to_numpy().view(np.uint64) >> np.uint64(11)) + 0.5) / 2.0**53
            far = rate > 0
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (-np.log(chance[far]) / rate[far], *x[far].T)],
                                             ["_key", *[f"x{i}" for i in range(len(cols))]])

    axes = [f"x{i}" for i in range(len(cols))]
    hashed = points.select(*cols, "n", F.xxhash64(F.lit(seed), *cols).alias("_hash"))
    drawn = hashed.mapInArrow(keyed, ", ".join(f"{c} double" for c in ["_key", *axes])).orderBy("_key", *axes).limit(rows)
    return np.array([tuple(r)[1:] for r in drawn.collect()], float).reshape(-1, len(cols))


def _pass(points: DataFrame, cols: list[str], centres: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Weight, sum of points and cost of every cluster, per k; each task adds its points up before the shuffle."""
    def add(batches):
        total = {k: np.zeros((len(c), len(cols) + 2)) for k, c in centres.items()}
        for batch in batches:
            x, n = _matrix(batch, cols), batch.column("n").to_numpy()
            for k, c in centres.items():
                at, squares = _nearest(x, c)
                for j, value in enumerate((n, n * squares, *(n * x.T))):
                    total[k][:, j] += np.bincount(at, value, len(c))
        rows = np.concatenate(list(total.values()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(list(total), [len(t) for t in total.values()]).astype(np.int32)),
             pa.array(np.concatenate([np.arange(len(t)) for t in total.values()]).astype(np.int32)),
             *[pa.array(v) for v in rows.T.copy()]], names)

    values = ["n", "cost", *[f"s{i}" for i in range(len(cols))]]
    names = ["k", "cluster", *values]
    partial = points.select(*cols, "n").mapInArrow(add, "k int, cluster int, " + ", ".join(f"{v} double" for v in values))
    summed = partial.groupBy("k", "cluster").agg(*[F.sum(v).alias(v) for v in values]).collect()
    out = {k: (np.zeros(len(c)), np.zeros(c.shape), np.zeros(len(c))) for k, c in centres.items()}
    for k, cluster, n, cost, *sums in summed:
        weight, total, squares = out[k]
        weight[cluster], total[cluster], squares[cluster] = n, sums, cost
    return out


def _choose(candidates: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """The cheapest of several k-means++ choices of at most ``k`` candidates, each moved a few times among them."""
    best, least = candidates[:1], np.inf
    for _ in range(TRIES):
        chosen = [int(rng.choice(len(candidates), p=weight / weight.sum()))]
        while len(chosen) < k:
            pull = weight * _nearest(candidates, candidates[chosen])[1]
            if not pull.sum() > 0:
                break
            chosen.append(int(rng.choice(len(candidates), p=pull / pull.sum())))
        centres = candidates[chosen]
        for _ in range(10):
            at, squares = _nearest(candidates, centres)
            held = np.bincount(at, weight, len(centres))
            sums = np.stack([np.bincount(at, weight * v, len(centres)) for v in candidates.T], axis=1)
            centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres)
        cost = (weight * _nearest(candidates, centres)[1]).sum()
        if cost < least:
            best, least = centres, cost
    return best


def sweep_centres(points: DataFrame, cols: list[str], ks: list[int], seed: int = 1, max_iter: int = 20,
                  tol: float = 1e-4) -> dict[int, np.ndarray]:
    """Centres per k of ``points(cols.., n)``, in ascending order; fewer than k if there are fewer distinct points.

    Each of the at most ``max_iter`` iterations is one job for all k that still move by more than ``tol``. A centre that
    loses all its points stays where it is. Without any points there are no centres.
    """
    drawn = _draw(points, cols, np.zeros((0, len(cols))), 1, seed)
    if not len(drawn):
        return {k: drawn for k in ks}
    for i in range(ROUNDS):
        more = _draw(points, cols, drawn, DRAWN_PER_CENTRE * max(ks), seed + i + 1)
        if not len(more):
            break
        drawn = np.unique(np.concatenate([drawn, more]), axis=0)
    weight = _pass(points, cols, {0: drawn})[0][0]
    centres = {k: _choose(drawn, weight, k, np.random.default_rng([seed, k])) for k in ks}
    moving = set(ks)
    for _ in range(max_iter):
        for k, (held, sums, _) in _pass(points, cols, {k: centres[k] for k in moving}).items():
            moved = np.where(held[:, None] > 0, sums / np.maximum(held, 1e-300)[:, None], centres[k])
            if ((moved - centres[k]) ** 2).sum(axis=1).max() <= tol * tol:
                moving.discard(k)
            centres[k] = moved
        if not moving:
            break
    return {k: c[np.lexsort(c.T[::-1])] for k, c in centres.items()}


def sweep_costs(points: DataFrame, cols: list[str], centres: dict[int, np.ndarray]) -> dict[int, float]:
    """Cost per k, found in one pass."""
    if not all(len(c) for c in centres.values()):
        return dict.fromkeys(centres, 0.0)
    return {k: float(cost.sum()) for k, (_, _, cost) in _pass(points, cols, centres).items()}


def sweep_labels(points: DataFrame, cols: list[str], centres: dict[int, np.ndarray]) -> DataFrame:
    """``k, cols.., n, cluster``: every point once per k with the number of its nearest centre."""
    def label(batches):
        for batch in batches:
            x = _matrix(batch, cols)
            for k, c in centres.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), k, np.int32)), *batch.columns, pa.array(_nearest(x, c)[0].astype(np.int32))],
                    ["k", *cols, "n", "cluster"])

    fields = ", ".join(f"`{c}` double" for c in [*cols, "n"])
    return points.select(*cols, "n").mapInArrow(label, f"k int, {fields}, cluster int")
