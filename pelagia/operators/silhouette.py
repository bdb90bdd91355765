"""Mean silhouette with Euclidean distances, without comparing all points of a cluster with each other.

Points are first combined into distinct weighted points. Those of a cluster form a tree of boxes: a box with many points is halved
along every axis. A block of points needs its distances to its own cluster and to each one that may be the nearest other.
It goes down that cluster's tree: a box that is small beside its distance is summed as a whole, from an expansion of the distance
around its centre whose coefficients are moments of the box; a small box nearby is summed point by point; others are opened.

The expansion (Gegenbauer polynomials C_n of index -1/2, with v the way from the centre c to q, and D u the way from c to p)

    |p - q| = D Σ_n (|v|/D)^n C_n(cos(u, v)),   |C_n| <= 2 / (2n - 1) for n >= 2,

is cut after an order that the number of features allows, and boxes are taken as a whole only if their radius is so small a share of
D that the rest is at most ``TOLERANCE`` times D. With one feature the distance is linear and the sum exact. The more features,
the farther away a box has to be; with more than about six nearly all are summed point by point.
"""

from __future__ import annotations

import itertools
import math
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pelagia.operators.clean import without_noise
from pelagia.runtime import stage, stage_counting

# Points of a block, and of a box that is summed point by point.
TILE_POINTS = 4096
LEAF_POINTS = 1024
ROWS_AT_ONCE = 256
POINTS_AT_ONCE = 8192
# Error of a distance that is taken from an expansion, and the most moments of a box.
TOLERANCE = 1e-9
MAX_ORDER, MAX_MOMENTS = 12, 220
# Clusters that a block is compared with one by one.
FEW_CLUSTERS = 64
KEY_BITS, AXIS_BITS = 60, 20


def silhouette_euclidean(df: DataFrame, cols: list[str], cluster: str = "cluster", run: str | None = None,
                         weight: str | None = None, tile_points: int | None = None) -> DataFrame:
    """``silhouette`` (null below two clusters), ``clusters`` and ``points``; one row per ``run`` if given.

    Rows with a null feature or label are left out; points alone in their cluster count as 0.
    """
    key = F.col(run) if run else F.lit(0)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    xs = [f"x{i}" for i in range(len(cols))]
    rows = df.select(key.alias("run"), F.col(cluster).alias("label"), w.alias("w"),
                     *[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)]).na.drop()
    points = stage(rows.groupBy("run", "label", *xs).agg(F.sum("w").alias("w")), "points")
    clusters = stage(_clusters(points, xs), "clusters")
    counts = clusters.groupBy("run").agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("points"))
    sums = _scores(points, clusters, xs, tile_points or TILE_POINTS)
    scores = sums.groupBy("run").agg((F.sum("weighted") / F.sum("w")).alias("silhouette"))
    return counts.join(scores, "run", "left").select(
        *([F.col("run").alias(run)] if run else []), "clusters", F.col("points").cast("long").alias("points"),
        F.when(F.col("clusters") >= 2, F.col("silhouette")).alias("silhouette"))


def silhouette_without_noise(df: DataFrame, cols: list[str], cluster: str = "cluster") -> DataFrame:
    return silhouette_euclidean(without_noise(df, cluster), cols, cluster)


def _clusters(points: DataFrame, xs: list[str]) -> DataFrame:
    """``cid, run, label, size``, the mean, mean squared distance to it, and the cube around each cluster's points."""
    stats = points.groupBy("run", "label").agg(
        F.sum("w").alias("size"), *[(F.sum(F.col(x) * F.col("w")) / F.sum("w")).alias(f"mean_{x}") for x in xs],
        *[(F.sum(F.col(x) * F.col(x) * F.col("w")) / F.sum("w")).alias(f"square_{x}") for x in xs],
        *[F.min(x).alias(f"lo_{x}") for x in xs], *[F.max(x).alias(f"hi_{x}") for x in xs])
    spread = sum((F.greatest(F.lit(0.0), F.col(f"square_{x}") - F.col(f"mean_{x}") * F.col(f"mean_{x}")) for x in xs), F.lit(0.0))
    sides = [F.col(f"hi_{x}") - F.col(f"lo_{x}") for x in xs]
    side = F.greatest(*sides) if len(xs) > 1 else sides[0]
    return stats.select("run", "label", "size", *[f"mean_{x}" for x in xs], *[f"lo_{x}" for x in xs],
                        spread.alias("spread"), F.when(side > 0, side).otherwise(1.0).alias("side"),
                        F.monotonically_increasing_id().alias("cid"))


# --- expansions ----------------------------------------------------------------------------------------

class Expansion:
    """Moments of weighted points in a box, and sums of distances to them from far away."""

    def __init__(self, d: int):
        fitting = [n for n in range(2, MAX_ORDER + 1) if 1 < d <= 6 and math.comb(n + d, d) <= MAX_MOMENTS]
        self.order = max(fitting, default=1)
        self.ratio = 1.0 if d == 1 else self._ratio()
        powers = sorted((p for p in itertools.product(range(self.order + 1), repeat=d) if sum(p) <= self.order),
                        key=lambda p: (sum(p), p)) if d <= 6 else [
            tuple(int(i == j) for i in range(d)) for j in range(-1, d)]
        place = {p: i for i, p in enumerate(powers)}
        self.degree = np.array([sum(p) for p in powers])
        self.first = np.searchsorted(self.degree, np.arange(self.order + 1))
        # every monomial but 1 is a lower one times a coordinate
        self.axis = [next(i for i, k in enumerate(p) if k) if any(p) else 0 for p in powers]
        self.lower = [place[tuple(k - (i == a) for i, k in enumerate(p))] if any(p) else 0 for p, a in zip(powers, self.axis)]
        self.factors = self._factors(powers, place, d)
        shifts = [(place[a], place[g], place[tuple(i - j for i, j in zip(a, g))], math.prod(math.comb(i, j) for i, j in zip(a, g)))
                  for a in powers for g in itertools.product(*[range(k + 1) for k in a])]
        self.to, self.of, self.by, self.times = (np.array(c) for c in zip(*shifts))

    def _ratio(self) -> float:
        low, high = 0.0, 0.9
        for _ in range(60):
            middle = (low + high) / 2
            rest = 2 / (2 * self.order + 1) * middle ** (self.order + 1) / (1 - middle)
            low, high = (middle, high) if rest <= TOLERANCE else (low, middle)
        return low

    def _factors(self, powers, place, d) -> np.ndarray:
        """What the moment of one monomial gives to the coefficient of another one of the direction."""
        polynomials = [np.array([1.0]), np.array([0.0, -1.0])]
        for n in range(2, self.order + 1):
            higher = np.zeros(n + 1)
            higher[1:] += (2 * n - 3) * polynomials[n - 1] / n
            higher[:n - 1] -= (n - 3) * polynomials[n - 2] / n
            polynomials.append(higher)
        out = np.zeros((len(powers), len(powers)))
        for beta in powers:
            j = sum(beta)
            for kappa in powers:
                alpha = tuple(b + 2 * k for b, k in zip(beta, kappa))
                if alpha not in place:
                    continue
                k = sum(kappa)
                many = math.factorial(j) / math.prod(map(math.factorial, beta)) * math.factorial(k) / math.prod(map(math.factorial, kappa))
                out[place[beta], place[alpha]] += polynomials[j + 2 * k][j] * many
        return out

    def monomials(self, v: np.ndarray) -> np.ndarray:
        out = np.ones((len(v), len(self.degree)))
        for i in range(1, len(self.degree)):
            out[:, i] = out[:, self.lower[i]] * v[:, self.axis[i]]
        return out

    def moments(self, x: np.ndarray, w: np.ndarray, centre: np.ndarray, half: float) -> np.ndarray:
        return w @ self.monomials((x - centre) / half)

    def moved(self, moments: np.ndarray, centre: np.ndarray, half: float, to: np.ndarray, wide: float) -> np.ndarray:
        """The same points' moments around the centre of a wider box."""
        way = self.monomials(((centre - to) / wide)[None, :])[0]
        return np.bincount(self.to, self.times * way[self.by] * (half / wide) ** self.degree[self.of] * moments[self.of], len(moments))

    def distances(self, x: np.ndarray, moments: np.ndarray, centre: np.ndarray, half: float) -> np.ndarray:
        """Weighted sum of the distances from every ``x`` to the points of a box."""
        y = (x - centre) / half
        far = np.sqrt((y * y).sum(axis=1))
        terms = np.add.reduceat(self.factors * moments, self.first, axis=1)
        return half * ((self.monomials(y / far[:, None]) @ terms) * far[:, None] ** (1.0 - np.arange(self.order + 1))).sum(axis=1)


@cache
def _expansion(d: int) -> Expansion:
    return Expansion(d)


# --- trees of boxes ------------------------------------------------------------------------------------

def _bits(d: int) -> int:
    return min(AXIS_BITS, KEY_BITS // d)


def _key(xs: list[str], low: list[Column], side: Column) -> Column:
    """Bits of the scaled coordinates in turn, the coarsest first, so that boxes are prefixes."""
    bits, key = _bits(len(xs)), F.lit(0).cast("long")
    for i, (x, lo) in enumerate(zip(xs, low)):
        cell = F.least(F.floor((F.col(x) - lo) / side * float(2 ** bits)), F.lit(2 ** bits - 1)).cast("long")
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long")), b * len(xs) + i))
    return key


def _corner(box: int, level: int, d: int) -> np.ndarray:
    return np.array([sum((box >> (b * d + i) & 1) << b for b in range(level)) for i in range(d)], float)


def _placed(points: DataFrame, clusters: DataFrame, xs: list[str], block: int, leaf: int) -> DataFrame:
    """Points with their cluster ``cid``, the box they are summed in (``level, box, part``) and the block they belong to (``t_…``).

    Only boxes with more than ``leaf`` points are opened. Points that even the smallest box can't tell apart are dealt out
    to parts of it, one level further down.
    """
    d = len(xs)
    bits = _bits(d)
    cube = clusters.select("run", "label", "cid", "side", *[f"lo_{x}" for x in xs])
    rest = points.join(cube, ["run", "label"]).drop("run", "label")
    rest = rest.withColumns({"z": _key(xs, [F.col(f"lo_{x}") for x in xs], F.col("side")), "t_level": F.lit(None).cast("int"),
                             "t_part": F.lit(0)})
    done = None
    for level in range(bits + 1):
        box = F.shiftright("z", (bits - level) * d)
        full = rest.groupBy("cid", box.alias("box")).agg(F.count(F.lit(1)).alias("inside")).where(F.col("inside") > leaf)
        placed = rest.withColumns({"box": box, "level": F.lit(level), "part": F.lit(0)}).join(stage(full, "full"), ["cid", "box"], "left")
        inside = F.coalesce("inside", F.lit(0))
        placed = placed.withColumn("t_level", F.coalesce("t_level", F.when(inside <= block, F.lit(level))))
        if level == bits:
            deal = F.abs(F.xxhash64(*xs))
            placed = placed.withColumns({
                "t_part": F.when(F.col("t_level").isNull(), (deal % F.ceil(F.col("inside") / block)).cast("int")).otherwise(0),
                "t_level": F.coalesce("t_level", F.lit(level)),
                "part": F.when(F.col("inside").isNotNull(), (deal % F.ceil(F.col("inside") / leaf)).cast("int")).otherwise(0),
                "level": F.when(F.col("inside").isNotNull(), level + 1).otherwise(level)})
            now, many = stage(placed, "boxes"), 0
        else:
            placed, many = stage_counting(placed, F.col("inside").isNotNull(), "boxes")
            now = placed.where("inside IS NULL")
        now = now.drop("inside")
        done = now if done is None else done.unionByName(now)
        if not many:
            break
        rest = placed.where("inside IS NOT NULL").drop("inside", "box", "level", "part")
    return done.withColumn("t_box", F.expr(f"shiftright(z, ({bits} - t_level) * {d})")).drop("z")


def _leaves(placed: DataFrame, xs: list[str]) -> DataFrame:
    """A row per box without boxes inside: its centre, half side, moments and points."""
    d = len(xs)
    bits = _bits(d)

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cid, level, box, part = (int(k) for k in key)
        side = rows["side"].iat[0] / 2 ** min(level, bits)
        low = rows[[f"lo_{x}" for x in xs]].iloc[0].to_numpy(float)
        centre = low + (_corner(box, min(level, bits), d) + 0.5) * side
        x, w = rows[xs].to_numpy(), rows["w"].to_numpy()
        up = box >> d if level <= bits else box
        return pd.DataFrame([{"cid": cid, "level": level, "box": box, "part": part, "up": up, "half": side / 2, "centre": centre,
                              "moments": _expansion(d).moments(x, w, centre, side / 2), "low": low, "side": rows["side"].iat[0],
                              "xs": x.T.ravel(), "ws": w}])

    return placed.groupBy("cid", "level", "box", "part").applyInPandas(
        pack, "cid long, level int, box long, part int, up long, half double, centre array<double>, moments array<double>, "
              "low array<double>, side double, xs array<double>, ws array<double>")


def _inner_boxes(leaves: DataFrame, d: int) -> DataFrame:
    """The boxes around the leaves, with the sums of their moments."""
    bits, n = _bits(d), len(_expansion(d).degree)

    def lift(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                at = min(row.level, bits)
                for level in range(min(row.level, bits + 1)):
                    side = row.side / 2 ** level
                    box = row.box >> ((at - level) * d)
                    centre = row.low + (_corner(box, level, d) + 0.5) * side
                    moments = _expansion(d).moved(row.moments, row.centre, row.half, centre, side / 2)
                    out.append((row.cid, level, box, box >> d, side / 2, centre, moments))
            yield pd.DataFrame(out, columns=["cid", "level", "box", "up", "half", "centre", "moments"])

    lifted = leaves.drop("xs", "ws").mapInPandas(
        lift, "cid long, level int, box long, up long, half double, centre array<double>, moments array<double>")
    return lifted.groupBy("cid", "level", "box", "up").agg(
        F.first("half").alias("half"), F.first("centre").alias("centre"),
        F.array(*[F.sum(F.col("moments")[i]) for i in range(n)]).alias("moments"))


# --- which boxes a block is compared with --------------------------------------------------------------

def _gap(low: list[str], high: list[str], at: list[Column], to: list[Column] | None = None) -> Column:
    """Least distance from a box to a point, or to another box."""
    total = F.lit(0.0)
    for lo, hi, a, b in zip(low, high, at, to or at):
        gap = F.greatest(F.lit(0.0), a - F.col(hi), F.col(lo) - b)
        total = total + gap * gap
    return F.sqrt(total)


def _span_squared(low: list[str], high: list[str], at: list[Column], to: list[Column] | None = None) -> Column:
    total = F.lit(0.0)
    for lo, hi, a, b in zip(low, high, at, to or at):
        gap = F.greatest(b - F.col(lo), F.col(hi) - a)
        total = total + gap * gap
    return total


def _candidates(targets: DataFrame, clusters: DataFrame, xs: list[str]) -> DataFrame:
    """``tid, source``: the clusters each block is compared with, its own and those that may be nearest to one of its points.

    The mean distance from a point to a cluster is at least the distance to the cluster's mean and at most the root mean
    square distance. Blocks go down a tree of the cluster means; a node farther away than the least upper bound so far is
    left out, and so are the clusters below it.
    """
    d = len(xs)
    bits, low, high = _bits(d), [f"t_lo_{x}" for x in xs], [f"t_hi_{x}" for x in xs]
    means = [f"mean_{x}" for x in xs]
    row = clusters.agg(*[F.min(m).alias(f"lo_{m}") for m in means], *[F.max(m).alias(f"hi_{m}") for m in means]).first()
    side = max([(row[f"hi_{m}"] or 0.0) - (row[f"lo_{m}"] or 0.0) for m in means]) or 1.0
    keyed = stage(clusters.select("run", "cid", "spread", *means, _key(means, [F.lit(row[f"lo_{m}"] or 0.0) for m in means], F.lit(side)).alias("z")),
                  "means")
    pairs = targets.select("tid", "run", F.col("cid").alias("own"), *low, *high).withColumns(
        {"up": F.lit(0).cast("long"), "bound": F.lit(float("inf"))})
    of_block, ends = Window.partitionBy("tid"), None
    for level in range(bits + 1):
        box = F.shiftright("z", (bits - level) * d)
        nodes = keyed.groupBy("run", box.alias("node")).agg(
            F.count(F.lit(1)).alias("held"), F.min("spread").alias("spread"),
            *[F.min(m).alias(f"lo_{m}") for m in means], *[F.max(m).alias(f"hi_{m}") for m in means])
        nodes = nodes.withColumn("up", F.shiftright("node", d) if level else F.lit(0).cast("long"))
        met = pairs.join(nodes, ["run", "up"])
        lows, highs = [F.col(f"lo_{m}") for m in means], [F.col(f"hi_{m}") for m in means]
        # a node with two clusters has another one than the block's own
        above = F.when(F.col("held") > 1, F.sqrt(_span_squared(low, high, lows, highs) + F.col("spread"))).otherwise(F.lit(float("inf")))
        met = met.withColumn("bound", F.least("bound", F.min(above).over(of_block)))
        met = met.where(_gap(low, high, lows, highs) <= F.col("bound") * (1 + 1e-6))
        few = F.lit(level == bits) | (F.col("held") <= FEW_CLUSTERS)
        met, many = stage_counting(met.select(*pairs.drop("up").columns, "node", few.alias("few")), ~F.col("few"), "means")
        inside = keyed.select("run", box.alias("node"), F.col("cid").alias("source"), "spread", *means)
        found = met.where("few").drop("few").join(inside, ["run", "node"]).drop("node")
        ends = found if ends is None else ends.unionByName(found)
        if not many:
            break
        pairs = met.where("NOT few").drop("few").withColumnRenamed("node", "up")
    at = [F.col(m) for m in means]
    other = F.col("source") != F.col("own")
    above = F.when(other, F.sqrt(_span_squared(low, high, at) + F.col("spread"))).otherwise(F.lit(float("inf")))
    ends = ends.withColumn("bound", F.least("bound", F.min(above).over(of_block)))
    ends = ends.where(other & (_gap(low, high, at) <= F.col("bound") * (1 + 1e-6))).select("tid", "source")
    return ends.unionByName(targets.select("tid", F.col("cid").alias("source")))


def _sources(targets: DataFrame, wanted: DataFrame, nodes: DataFrame, d: int, xs: list[str]) -> DataFrame:
    """``tid, cid, level, box, part, far``: the boxes whose sums make up each block's distances to the wanted clusters."""
    low, high = [f"t_lo_{x}" for x in xs], [f"t_hi_{x}" for x in xs]
    centre = [F.col("centre")[i] for i in range(d)]
    near = _expansion(d).ratio * (1 - 1e-9) * _gap(low, high, centre)
    deepest = nodes.agg(F.max("level")).first()[0]
    pairs = wanted.withColumnRenamed("source", "cid").join(targets.select("tid", *low, *high), "tid").withColumn("up", F.lit(0).cast("long"))
    out = None
    for level in range((deepest or 0) + 1):
        met = pairs.join(nodes.where(F.col("level") == level), ["cid", "up"])
        met = met.withColumn("far", F.col("half") * math.sqrt(d) * (1 + 1e-9) <= near)
        met, many = stage_counting(met.drop("centre", "half"), ~F.col("far") & ~F.col("leaf"), "met")
        ended = met.where("far OR leaf").select("tid", "cid", "level", "box", "part", "far")
        out = ended if out is None else out.unionByName(ended)
        if not many:
            break
        pairs = met.where("NOT far AND NOT leaf").select("cid", "tid", *low, *high, F.col("box").alias("up"))
    return out


# --- sums ----------------------------------------------------------------------------------------------

def _point_sums(x: np.ndarray, q: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Weighted distances from every ``x`` to the points ``q`` of each label; labels begin at ``first``."""
    total = np.zeros((len(first), len(x)))
    for at in range(0, len(q), POINTS_AT_ONCE):
        to = min(at + POINTS_AT_ONCE, len(q))
        here = np.searchsorted(first, at, "right") - 1, np.searchsorted(first, to, "left")
        cuts = np.maximum(first[here[0]:here[1]] - at, 0)
        for row in range(0, len(x), ROWS_AT_ONCE):
            square = 0.0
            for axis in range(x.shape[1]):
                gap = x[row:row + ROWS_AT_ONCE, axis, None] - q[None, at:to, axis]
                square = square + gap * gap
            total[here[0]:here[1], row:row + ROWS_AT_ONCE] += np.add.reduceat(np.sqrt(square) * w[at:to], cuts, axis=1).T
    return total


def _silhouettes(own_sum, own_size, nearest, w) -> pd.DataFrame:
    """Weighted silhouettes from distance sums to the own cluster and the nearest other mean distance."""
    a = own_sum / np.maximum(own_size - 1.0, 1.0)
    top = np.maximum(a, nearest)
    s = np.where((own_size > 1) & (top > 0) & np.isfinite(top), (nearest - a) / np.where(top > 0, top, 1.0), 0.0)
    return pd.DataFrame({"weighted": [float(np.sum(s * w))], "w": [float(np.sum(w))]})


def _scores(points: DataFrame, clusters: DataFrame, xs: list[str], tile_points: int) -> DataFrame:
    """``run, weighted, w`` per block of points."""
    d = len(xs)
    placed = _placed(points, clusters, xs, tile_points, min(LEAF_POINTS, tile_points))
    block = ["cid", "t_level", "t_box", "t_part"]
    targets = placed.groupBy(*block).agg(*[F.min(x).alias(f"t_lo_{x}") for x in xs], *[F.max(x).alias(f"t_hi_{x}") for x in xs])
    targets = stage(targets.join(clusters.select("cid", "run"), "cid").withColumn("tid", F.monotonically_increasing_id()), "targets")
    leaves = stage(_leaves(placed, xs), "leaves")
    inner = stage(_inner_boxes(leaves, d), "inner").withColumns({"part": F.lit(0), "leaf": F.lit(False)})
    light = ["cid", "level", "box", "part", "up", "half", "centre", "leaf"]
    nodes = stage(leaves.withColumn("leaf", F.lit(True)).select(*light).unionByName(inner.select(*light)), "nodes")
    wanted = stage(_candidates(targets, clusters, xs), "wanted")
    sources = stage(_sources(targets, wanted, nodes, d, xs), "sources")

    key, none = ["cid", "level", "box", "part"], F.lit(None).cast("array<double>")
    whole = [F.col("centre"), F.col("half"), F.col("moments"), none.alias("xs"), none.alias("ws")]
    heavy = inner.select(*key, F.lit(True).alias("far"), *whole).unionByName(
        leaves.select(*key, F.lit(True).alias("far"), *whole)).unionByName(
        leaves.select(*key, F.lit(False).alias("far"), none.alias("centre"), F.lit(0.0).alias("half"), none.alias("moments"), "xs", "ws"))
    # an inner box and a box of points never have one key
    held = sources.join(heavy, [*key, "far"]).join(clusters.select("cid", "size"), "cid").select(
        "tid", "cid", "size", "far", "centre", "half", "moments", "xs", "ws")
    run_type = dict(clusters.dtypes)["run"]
    mine = placed.join(targets.select(*block, "tid", "run"), block).select("tid", "run", "cid", "w", *xs)

    def score(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, own = a[xs].to_numpy(), a["cid"].iat[0]
        b = b.sort_values("cid", kind="stable", ignore_index=True)
        labels, number = np.unique(b["cid"].to_numpy(), return_inverse=True)
        size = b["size"].to_numpy()[np.searchsorted(number, np.arange(len(labels)))]
        total = np.zeros((len(labels), len(a)))
        far = b["far"].to_numpy(bool)
        for i in np.flatnonzero(far):
            total[number[i]] += _expansion(d).distances(x, b["moments"].iat[i], b["centre"].iat[i], b["half"].iat[i])
        near = np.flatnonzero(~far)
        if len(near):
            q = np.concatenate([b["xs"].iat[i].reshape(d, -1).T for i in near])
            lengths = np.array([len(b["ws"].iat[i]) for i in near])
            of, begin = np.unique(number[near], return_index=True)
            first = (np.cumsum(lengths) - lengths)[begin]
            total[of] += _point_sums(x, q, np.concatenate([b["ws"].iat[i] for i in near]), first)
        i = int(np.searchsorted(labels, own))
        others = np.delete(total / size[:, None], i, axis=0)
        nearest = others.min(axis=0) if len(others) else np.full(len(a), np.inf)
        out = _silhouettes(np.maximum(total[i], 0.0), size[i], nearest, a["w"].to_numpy())
        out.insert(0, "run", [a["run"].iat[0]])
        return out

    return mine.groupBy("tid").cogroup(held.groupBy("tid")).applyInPandas(score, f"run {run_type}, weighted double, w double")
