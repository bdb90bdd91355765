"""Range join on a grid: which points of two tables lie within ``eps`` of each other.

Used by the density clustering, which never needs the pairs themselves, only how much weight lies near a
point and which cells touch. So the unit of work is a pair of grid cells, each with the exact bounding box
of its points:

* boxes entirely within ``eps`` are settled as a whole, boxes entirely beyond it are dropped;
* a pair of boxes in between with few points is settled point by point;
* a pair with many points is split into smaller boxes and tried again.

A cell holding a third of all rows is therefore never expanded into its pairs.

A points table has the columns ``run, eps, c0.. (cell), x0.. (position), w (weight), rid``. ``run`` keeps
several parameter settings apart, so that they can share one pass.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from pelagia.operators.clean import append_by_name
from pelagia.runtime import attach, stage, stage_counting

# Pairs of boxes with at most this many pairs of points are compared point by point.
PAIR_LIMIT = 65_536
# Where one contact is enough, splitting boxes finds it sooner than comparing their points.
TOUCH_LIMIT = 4_096
# Boxes are split 4-fold per axis and level; beyond this depth they hold at most a few distinct doubles.
MAX_LEVEL = 12
MAX_FEATURES = 3


def cell_side(d: int, eps: str = "eps") -> str:
    """A little under eps/√d, so that any two points of one cell are within eps."""
    return f"({eps} * {(1 - 1e-6) / math.sqrt(d)!r}D)"


def cell_columns(d: int) -> dict[str, Column]:
    return {f"c{i}": F.expr(f"floor(x{i} / {cell_side(d)})") for i in range(d)}


def _axes(d: int, prefix: str) -> list[str]:
    return [f"{prefix}{i}" for i in range(d)]


def _renamed(prefix: str, cols: list[str]) -> list[str]:
    return [f"{c} AS {prefix}{c}" for c in cols]


def cell_summary(points: DataFrame, d: int, *extra: str) -> DataFrame:
    """One row per cell: number of points, weight, bounding box and the least row id."""
    box = [f"{f}(x{i}) AS {n}{i}" for i in range(d) for f, n in (("min", "lo"), ("max", "hi"))]
    aggs = ["count(*) AS n", "sum(w) AS w", "min(rid) AS id", *box]
    return points.groupBy("run", "eps", *_axes(d, "c"), *extra).agg(*map(F.expr, aggs))


def _box_columns(d: int) -> list[str]:
    return ["n", "w", *_axes(d, "lo"), *_axes(d, "hi")]


def _with_box(points: DataFrame, d: int, level: int) -> DataFrame:
    """Add the box of the level, ``g0..``; the box of the level above is ``floor(g / 4)``."""
    return points.selectExpr("*", *[f"floor(x{i} / {cell_side(d)} * {float(4 ** level)!r}D) AS g{i}" for i in range(d)])


def _classify(pairs: DataFrame, d: int) -> DataFrame:
    """Drop pairs of boxes farther apart than eps; mark those entirely within it."""
    gaps = [f"greatest(0D, b_lo{i} - a_hi{i}, a_lo{i} - b_hi{i})" for i in range(d)]
    spans = [f"greatest(b_hi{i} - a_lo{i}, a_hi{i} - b_lo{i})" for i in range(d)]
    return (pairs.where(f"sqrt({_squares(gaps)}) <= eps")
            .withColumn("inside", F.expr(f"sqrt({_squares(spans)}) <= eps")))


def _squares(terms: list[str]) -> str:
    return " + ".join(f"({t}) * ({t})" for t in terms)


def _cell_pairs(a: DataFrame, b: DataFrame, d: int, once: bool) -> DataFrame:
    """Cells of ``a`` with the cells of ``b`` in reach; ``once`` lists each unordered pair of cells once."""
    steps = [()]
    for _ in range(d):
        steps = [s + (o,) for s in steps for o in range(-2, 3)]
    zero = (0,) * d
    steps = [s for s in steps if s > zero] if once else steps
    structs = ", ".join("struct(" + ", ".join(f"{o}L AS b_c{i}" for i, o in enumerate(s)) + ")" for s in steps)
    cols = ["id", *_axes(d, "c"), *_box_columns(d)]
    left = a.selectExpr("run", "eps", *_renamed("a_", cols), f"inline(array({structs}))")
    left = left.withColumns({f"b_c{i}": F.expr(f"a_c{i} + b_c{i}") for i in range(d)})
    pairs = left.join(b.selectExpr("run", *_renamed("b_", cols)), ["run", *_axes(d, "b_c")])
    boxes = [f"{p}_c{i} AS {p}_g{i}" for p in "ab" for i in range(d)]
    return _classify(pairs.selectExpr("*", *boxes), d)


def _children(points: DataFrame, big: DataFrame, prefix: str, d: int, level: int) -> DataFrame:
    """Boxes of ``level`` below the boxes of ``big``, with the box above as ``{prefix}g``."""
    parents = big.selectExpr("run", *[f"{prefix}g{i} AS p{i}" for i in range(d)]).distinct()
    fine = _with_box(points, d, level).selectExpr("*", *[f"floor(g{i} / 4) AS p{i}" for i in range(d)])
    inside = attach(fine, parents, ["run", *_axes(d, "p")], "left_semi")
    boxes = cell_summary(inside, d, *_axes(d, "p"), *_axes(d, "g"))
    return boxes.selectExpr("run", *[f"p{i} AS {prefix}g{i}" for i in range(d)],
                            *[f"g{i} AS {prefix}new{i}" for i in range(d)], *_renamed(prefix, _box_columns(d)))


def _split(big: DataFrame, a_points: DataFrame, b_points: DataFrame, d: int, level: int, split_a: bool) -> DataFrame:
    pairs = big
    for prefix, points, active in (("a_", a_points, split_a), ("b_", b_points, True)):
        if not active:
            continue
        boxes = _children(points, big, prefix, d, level)
        pairs = pairs.drop(*[prefix + c for c in _box_columns(d)]).join(boxes, ["run", *_axes(d, prefix + "g")])
        pairs = pairs.drop(*_axes(d, prefix + "g")).withColumnsRenamed(
            {f"{prefix}new{i}": f"{prefix}g{i}" for i in range(d)})
    return _classify(pairs, d)


def _compare(small: DataFrame, a_points: DataFrame, b_points: DataFrame, d: int, a_level: int, level: int) -> DataFrame:
    """Point pairs within eps of the listed pairs of boxes; consumers aggregate them in the same stage."""
    def members(points: DataFrame, prefix: str, at: int) -> DataFrame:
        boxes = small.selectExpr("run", *[f"{prefix}g{i} AS g{i}" for i in range(d)]).distinct()
        near = attach(_with_box(points, d, at), boxes, ["run", *_axes(d, "g")], "left_semi")
        return near.selectExpr("run", *_renamed(prefix, ["rid", "w", *_axes(d, "x"), *_axes(d, "g")]))

    listed = small.select("run", "eps", "a_id", "b_id", *_axes(d, "a_g"), *_axes(d, "b_g"))
    pairs = (listed.join(members(a_points, "a_", a_level), ["run", *_axes(d, "a_g")])
             .join(members(b_points, "b_", level), ["run", *_axes(d, "b_g")]))
    gaps = _squares([f"a_x{i} - b_x{i}" for i in range(d)])
    return pairs.where(f"sqrt({gaps}) <= eps").select("run", "a_id", "a_rid", "b_id", "b_w")


def resolve(a_points: DataFrame, b_points: DataFrame, a_cells: DataFrame, b_cells: DataFrame, d: int,
            touching_only: bool = False, split_a: bool = False,
            pair_limit: int | None = None) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """All contacts within eps between ``a_points`` and ``b_points``.

    Returns ``(whole, single)``. ``whole`` lists per level ``(run, a_id, a_g0.., b_id, b_w)``: every point in
    the box ``a_g`` of cell ``a_id`` is within eps of ``b_w`` weight of cell ``b_id``.
    ``single(run, a_id, a_rid, b_id, b_w)`` has one row per remaining pair of points; it is lazy and meant to
    be aggregated, never stored.

    Boxes of ``b`` are split; those of ``a`` only with ``split_a``, so without it cells of ``a`` should hold
    few points. With ``touching_only`` both tables are the same, each pair of cells is listed once, and a pair
    of cells is dropped as soon as one contact is known.
    """
    limit = (TOUCH_LIMIT if touching_only else PAIR_LIMIT) if pair_limit is None else pair_limit
    fits = F.col("a_n") * F.col("b_n") <= limit
    many = ~F.col("inside") & ~fits
    pairs, left_over = stage_counting(_cell_pairs(a_cells, b_cells, d, touching_only), many, "pairs")
    whole, single, level = [], [], 0
    while True:
        a_level = level if split_a else 0
        settled = pairs.where("inside").select("run", "a_id", *_axes(d, "a_g"), "b_id", "b_w")
        whole.append((a_level, settled))
        rest = pairs.where("NOT inside")
        if touching_only and level:
            rest = rest.join(settled.select("run", "a_id", "b_id").distinct(), ["run", "a_id", "b_id"], "left_anti")
        last = level == MAX_LEVEL or not left_over
        small = rest if last else rest.where(fits)
        single.append(_compare(small, a_points, b_points, d, a_level, level))
        if last:
            break
        level += 1
        pairs, left_over = stage_counting(
            _split(rest.where(~fits), a_points, b_points, d, level, split_a), many, "pairs")
    return whole, append_by_name(single)


def touching_cells(points: DataFrame, cells: DataFrame, d: int, pair_limit: int | None = None) -> DataFrame:
    """``(run, u, v)``: pairs of cells with points within eps of each other, each pair once."""
    whole, single = resolve(points, points, cells, cells, d, touching_only=True, split_a=True, pair_limit=pair_limit)
    known = append_by_name([w.select("run", "a_id", "b_id") for _, w in whole])
    both = known.unionByName(single.select("run", "a_id", "b_id")).distinct()
    return both.withColumnsRenamed({"a_id": "u", "b_id": "v"})


def cells_within(a_points: DataFrame, b_points: DataFrame, a_cells: DataFrame, b_cells: DataFrame, d: int,
                 pair_limit: int | None = None) -> DataFrame:
    """``(run, rid, b_id)``: cells of ``b`` with a point within eps of each point of ``a`` (with repeats)."""
    whole, single = resolve(a_points, b_points, a_cells, b_cells, d, pair_limit=pair_limit)
    key = ["run", "eps", *_axes(d, "c")]
    members = a_points.select(*key, "rid").join(a_cells.select(*key, F.col("id").alias("a_id")), key)
    known = append_by_name([w.select("run", "a_id", "b_id") for _, w in whole])
    return (known.join(members, ["run", "a_id"]).select("run", "rid", "b_id")
            .unionByName(single.select("run", F.col("a_rid").alias("rid"), "b_id")))


def weight_within(a_points: DataFrame, b_points: DataFrame, a_cells: DataFrame, b_cells: DataFrame, d: int,
                  split_a: bool = False, pair_limit: int | None = None) -> DataFrame:
    """``(run, rid, near)``: weight of ``b`` within eps of each point of ``a``."""
    whole, single = resolve(a_points, b_points, a_cells, b_cells, d, split_a=split_a, pair_limit=pair_limit)
    parts = [single.groupBy("run", F.col("a_rid").alias("rid")).agg(F.sum("b_w").alias("near"))]
    for level in sorted({at for at, _ in whole}):
        boxes = append_by_name([w for at, w in whole if at == level]).groupBy(
            "run", *[F.col(f"a_g{i}").alias(f"g{i}") for i in range(d)]).agg(F.sum("b_w").alias("near"))
        pushed = attach(_with_box(a_points, d, level), boxes, ["run", *_axes(d, "g")])
        parts.append(pushed.select("run", "rid", "near"))
    return append_by_name(parts).groupBy("run", "rid").agg(F.sum("near").alias("near"))


def collapse(rows: DataFrame, d: int) -> DataFrame:
    """Rows ``(run, eps, …, x0.., rid)`` to distinct points with weight and least row id.

    Copies of one position are combined inside each map task, however many there are. Rows that have a weight ``w`` are
    distinct points already.
    """
    cells = rows.withColumns(cell_columns(d))
    keys = [c for c in cells.columns if c not in ("rid", "w")]
    if "w" in cells.columns:
        return stage(cells.select(*keys, "w", "rid"), "points")
    return stage(cells.groupBy(*keys).agg(F.count(F.lit(1)).alias("w"), F.min("rid").alias("rid")), "points")


def position_columns(coords: list[str]) -> list[Column]:
    if not 1 <= len(coords) <= MAX_FEATURES:
        raise ValueError(f"between 1 and {MAX_FEATURES} coordinates are supported, got {len(coords)}")
    # adding 0.0 turns -0.0 into 0.0, which group-by and join treat as equal
    return [(F.col(c).cast("double") + F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(coords)]


def has_position(d: int) -> Column:
    known = F.lit(True)
    for i in range(d):
        known = known & F.col(f"x{i}").isNotNull() & ~F.isnan(f"x{i}")
    return known


def positions(df: DataFrame, coords: list[str], row_id: str) -> DataFrame:
    rows = df.select(F.col(row_id).alias("rid"), *position_columns(coords))
    return rows.where(has_position(len(coords)))


def neighbors_within(df: DataFrame, coords: list[str], eps: float, row_id: str,
                     pair_limit: int | None = None) -> DataFrame:
    """Exact number of rows within Euclidean distance ``eps`` of each row, itself included.

    The neighbourhood sizes are what the density clustering asks of the range join; boxes within reach as
    a whole are counted without comparing their points.
    """
    d = len(coords)
    rows = positions(df, coords, row_id).select(F.lit(0).alias("run"), F.lit(float(eps)).alias("eps"), "rid", *_axes(d, "x"))
    points = collapse(rows, d)
    cells = stage(cell_summary(points, d), "cells")
    near = weight_within(points, points, cells, cells, d, split_a=True, pair_limit=pair_limit)
    counted = points.join(near, ["run", "rid"]).select("near", *_axes(d, "x"))
    # every row at a position gets the count of the position
    return (attach(rows.select("rid", *_axes(d, "x")), counted, _axes(d, "x"))
            .select(F.col("rid").alias(row_id), F.col("near").alias("neighbors")))
