"""Bottom-up clustering with Ward's criterion (Ward 1963), in rounds of merges on the cluster.

Ward's cost is reducible: a merged centre is no nearer to a third one than the nearer of its parts was. So centres that are
each other's nearest may be merged in any order, many at once, and the tree is the same (Murtagh 1983). A round cuts space into
boxes with a bounded number of centres. A task holds one box and merges what is reciprocally nearest and cheaper than anything
that may lie outside the box. Boxes are moved from round to round, so that none stays cut off by a face. Where that
merges little, as with many features, the nearest centres of the others are found across boxes: a box descends the tree of all
boxes to those that may hold nearer centres, and only these are compared. Fewer centres than a box may hold are one box,
whose task finishes the tree.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pelagia.operators.features import rank_within
from pelagia.operators.kmeans import weighted_points
from pelagia.runtime import attach, stage, stage_counting

# Centres that one task holds.
BOX_CENTRES = 16384
# Centres that are compared with each other at once; their costs have to stay in a core's cache.
ROWS_AT_ONCE, COLUMNS_AT_ONCE = 64, 4096
# A round that merges a smaller share than this also looks across boxes.
LEAST_PROGRESS = 0.2
# Partitions for each box, so that few boxes meet in one.
TASKS_PER_BOX = 8
# Halvings of the data that tell boxes apart, and those that are counted at once.
BOX_BITS, LEVELS_AT_ONCE = 60, 12
# Levels of the tree of boxes that a search goes down at once.
LEVELS_DOWN = 3
# Guards bounds against rounding.
SLACK = 1e-9


def ward_cost(wa, wb, square):
    return wa * wb / (wa + wb) * square


# --- inside a task -------------------------------------------------------------------------------------

def _cheapest(x: np.ndarray, w: np.ndarray, own: np.ndarray, to_x: np.ndarray, to_w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest partner of each ``x`` among ``to_x`` but for the place ``own`` (-1: none), and its cost; equal costs go to the first."""
    best, cost = np.zeros(len(w), np.int64), np.full(len(w), np.inf)
    if not len(w) or not len(to_w):
        return best, cost
    # a feature that never differs adds nothing
    axes = [i for i in range(x.shape[1]) if (x[:, i] != to_x[0, i]).any() or (to_x[:, i] != to_x[0, i]).any()]
    lines = [np.ascontiguousarray(to_x[:, i]) for i in axes]
    held = [np.empty((min(ROWS_AT_ONCE, len(w)), min(COLUMNS_AT_ONCE, len(to_w)))) for _ in range(3)]
    for at in range(0, len(w), ROWS_AT_ONCE):
        rows = slice(at, min(at + ROWS_AT_ONCE, len(w)))
        many, heavy, mine = rows.stop - at, w[rows, None], own[rows]
        b, c, here = best[rows], cost[rows], np.arange(many)
        for to in range(0, len(to_w), COLUMNS_AT_ONCE):
            to_end = min(to + COLUMNS_AT_ONCE, len(to_w))
            price, gap, share = (t[:many, :to_end - to] for t in held)
            price.fill(0.0)
            for axis, line in zip(axes, lines):
                np.subtract(x[rows, axis, None], line[to:to_end], out=gap)
                np.multiply(gap, gap, out=gap)
                np.add(price, gap, out=price)
            # as ward_cost does it, in place
            np.multiply(heavy, to_w[to:to_end], out=share)
            np.add(heavy, to_w[to:to_end], out=gap)
            np.divide(share, gap, out=share)
            np.multiply(share, price, out=price)
            same = np.flatnonzero((mine >= to) & (mine < to_end))
            price[same, mine[same] - to] = np.inf
            place = price.argmin(axis=1)
            value = price[here, place]
            less = value < c
            b[less], c[less] = place[less] + to, value[less]
    return best, cost


def _nearest(x: np.ndarray, w: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cheapest partner of some centres among all, and its cost; equal costs go to the first."""
    return _cheapest(x[rows], w[rows], rows, x, w)


def merge_inside(x: np.ndarray, w: np.ndarray, height: np.ndarray, room=None, least: float = 0.0):
    """Merge reciprocal nearest centres as long as any pair is cheaper than all that may lie outside.

    ``room(x)`` is the distance from centres to the outside, where centres weigh ``least`` or more; without it there is no
    outside. Returns the places that are left, their ``x, w, height``, nearest place and its cost and whether that is certain,
    and the merges ``(place kept, place gone, height, step)``.
    """
    x, w, height = x.astype(float).copy(), w.astype(float).copy(), height.astype(float).copy()
    place, merges, step = np.arange(len(w)), [], 0
    best, cost = _nearest(x, w, place)
    while True:
        here = np.arange(len(place))
        outside = np.full(len(here), np.inf) if room is None else ward_cost(w, least, room(x) ** 2)
        certain = cost < outside
        a = here[(best[best] == here) & (here < best) & certain & certain[best]] if len(here) > 1 else here[:0]
        if not len(a):
            return place, x, w, height, best, cost, certain, merges
        b = best[a]
        height[a] = np.maximum(cost[a], np.maximum(height[a], height[b]))
        merges.append((place[a], place[b], height[a], np.full(len(a), step)))
        both = w[a] + w[b]
        x[a] = (x[a] * w[a, None] + x[b] * w[b, None]) / both[:, None]
        w[a] = both
        # a nearest centre stays nearest unless it has been merged
        moved = np.zeros(len(here), bool)
        moved[a] = moved[b] = True
        stale = moved | moved[best]
        left = np.ones(len(here), bool)
        left[b] = False
        number = np.cumsum(left) - 1
        place, x, w, height, stale = place[left], x[left], w[left], height[left], stale[left]
        best, cost = number[best[left]], cost[left]
        again = np.flatnonzero(stale)
        best[again], cost[again] = _nearest(x, w, again)
        step += 1


def ward_labels(centres: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Cut the Ward tree of weighted centres into ``k`` clusters, numbered by their least centre."""
    *_, merges = merge_inside(np.asarray(centres, float), np.asarray(weights), np.zeros(len(weights)))
    head = np.arange(len(weights))
    if merges:
        keep, gone, height, step = (np.concatenate(part) for part in zip(*merges))
        uncut = np.lexsort((step, height))[:max(len(weights) - k, 0)]
        head[gone[uncut]] = keep[uncut]
    while (head[head] != head).any():
        head = head[head]
    return np.unique(head, return_inverse=True)[1]


# --- boxes ---------------------------------------------------------------------------------------------

class _Grid:
    """Nested boxes over a range twice as wide as the data, moved by a part of that width that depends on the round.

    Each level halves the boxes along the axis that is then their longest, so a level has two boxes for each one before, and
    axes on which the data are narrow are cut late, or never.
    """

    def __init__(self, low: list[float], high: list[float], turn: int):
        d = len(low)
        self.low, self.high = np.array(low), np.array(high)
        self.width = np.where(self.high > self.low, self.high - self.low, 1.0)
        self.slack = SLACK * (float((self.high - self.low).max()) or 1.0)
        # multiples of irrational numbers are spread evenly
        self.start = self.low - self.width * (((turn + 1) * 0.6180339887498949 + 0.7548776662466927 * np.arange(d)) % 1.0)
        side = np.where(self.high > self.low, 2 * self.width, 0.0)
        if not side.any():
            side[0] = 1.0
        self.axes = []
        for _ in range(BOX_BITS):
            self.axes.append(int(side.argmax()))
            side[self.axes[-1]] /= 2

    def key(self, xs: list[str]) -> Column:
        """A bit for each level, the coarsest first, so that boxes are prefixes."""
        key = F.lit(0).cast("long")
        for i, x in enumerate(xs):
            levels = [at for at, axis in enumerate(self.axes) if axis == i]
            if levels:
                scaled = (F.col(x) - F.lit(float(self.start[i]))) / F.lit(float(2 * self.width[i])) * F.lit(float(2 ** len(levels)))
                cell = F.floor(scaled).cast("long")
                for b, at in enumerate(reversed(levels)):
                    key = key.bitwiseOR(F.shiftleft(F.shiftright(cell, b).bitwiseAND(F.lit(1).cast("long")), BOX_BITS - 1 - at))
        return key

    def room(self, level: int, box: int):
        """Distance to the outside of a box, as a function of centres in it; nothing lies outside the data."""
        d = len(self.low)
        cell, cuts = np.zeros(d, np.int64), np.zeros(d, np.int64)
        for at, axis in enumerate(self.axes[:level]):
            cell[axis] = cell[axis] << 1 | box >> (level - 1 - at) & 1
            cuts[axis] += 1
        side = 2 * self.width / 2.0 ** cuts
        floor = self.start + cell * side
        ceiling = floor + side
        floor = np.where((floor <= self.low) | (cuts == 0), -np.inf, floor)
        ceiling = np.where((ceiling > self.high) | (cuts == 0), np.inf, ceiling)

        def distance(x: np.ndarray) -> np.ndarray:
            gap = np.minimum(x - floor, ceiling - x).min(axis=1)
            return np.maximum(gap * (1 - SLACK) - self.slack, 0.0)

        return distance


def _boxed(active: DataFrame, n: int, grid: _Grid, xs: list[str], limit: int) -> DataFrame:
    """Add ``level, box, part``: boxes with at most ``limit`` centres, and parts of those that are still larger at the last level.

    The centres are counted in boxes some levels down; their sums say at which level each of them has a box small enough.
    """
    if n <= limit:
        return active.withColumns({"level": F.lit(0), "box": F.lit(0).cast("long"), "part": F.lit(0)})
    done, rest = None, active.withColumn("z", grid.key(xs))
    for above in range(0, BOX_BITS, LEVELS_AT_ONCE):
        below = min(above + LEVELS_AT_ONCE, BOX_BITS)
        fine = F.shiftright("z", BOX_BITS - below)

        def choose(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            level, inside = np.full(len(frame), -1), frame["inside"].to_numpy()
            for at in range(above + 1, below + 1):
                up, of = np.unique(frame["fine"].to_numpy() >> (below - at), return_inverse=True)
                held = np.bincount(of, inside, len(up))[of].astype(np.int64)
                level[(level < 0) & (held <= limit)] = at
            return frame[["fine", "inside"]].assign(level=level)

        counts = rest.groupBy(fine.alias("fine")).agg(F.count(F.lit(1)).alias("inside"))
        levels = counts.withColumn("top", F.shiftright("fine", below - above)).groupBy("top").applyInPandas(
            choose, "fine long, inside long, level int")
        placed, many = stage_counting(attach(rest.withColumn("fine", fine), levels, ["fine"]), F.col("level") < 0, "boxes")
        last = below == BOX_BITS or not many
        parts = F.when(F.col("level") < 0, 1 + F.pmod(F.xxhash64("id"), F.ceil(F.col("inside") / F.lit(limit)))).otherwise(0)
        now = (placed if last else placed.where("level >= 0")).withColumns({
            "part": parts.cast("int"), "level": F.when(F.col("level") < 0, below).otherwise(F.col("level"))})
        now = now.withColumn("box", F.expr(f"shiftright(z, {BOX_BITS} - level)")).drop("z", "fine", "inside")
        done = now if done is None else done.unionByName(now)
        if last:
            return done
        rest = placed.where("level < 0").drop("fine", "level", "inside")


def _merge_boxes(boxed: DataFrame, grid: _Grid, least: float, xs: list[str], tasks: int = 0) -> DataFrame:
    """Rows ``id, into, height, step`` of merges and, with ``into`` null, the centres that are left with their nearest one."""
    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        level, box, part = (int(k) for k in key)
        frame = frame.sort_values("id", ignore_index=True)
        ids = frame["id"].to_numpy()
        # a part of a box has other centres anywhere between its own
        room = (lambda x: np.zeros(len(x))) if part else grid.room(level, box)
        place, x, w, height, best, cost, certain, merges = merge_inside(
            frame[xs].to_numpy(), frame["w"].to_numpy(), frame["height"].to_numpy(), room, least)
        left = pd.DataFrame({"id": ids[place], "into": None, "height": height, "step": -1, "w": w,
                             "near": ids[place][best], "cost": cost, "certain": certain,
                             **{name: x[:, i] for i, name in enumerate(xs)}})
        out = [left]
        if merges:
            keep, gone, tall, step = (np.concatenate(part) for part in zip(*merges))
            out.append(pd.DataFrame({"id": ids[gone], "into": ids[keep], "height": tall, "step": step}))
        frame = pd.concat(out, ignore_index=True).reindex(columns=[c for c, _ in fields])
        return frame.assign(level=level, box=box, part=part).astype({"into": "Int64", "near": "Int64", "certain": "boolean"})

    fields = [("id", "long"), ("into", "long"), ("height", "double"), ("step", "int"), ("w", "double"), ("near", "long"),
              ("cost", "double"), ("certain", "boolean"), *[(x, "double") for x in xs], ("level", "int"), ("box", "long"), ("part", "int")]
    # the partitions keep their number, as their rows are few but much work
    dealt = boxed.repartition(tasks, "level", "box", "part") if tasks else boxed
    return dealt.groupBy("level", "box", "part").applyInPandas(merge, ", ".join(f"{c} {t}" for c, t in fields))


# --- across boxes --------------------------------------------------------------------------------------

def _gap_squared(low_a, high_a, low_b, high_b) -> Column:
    """Square of the least distance between two boxes, given as lists of bounds."""
    total = F.lit(0.0)
    for la, ha, lb, hb in zip(low_a, high_a, low_b, high_b):
        gap = F.greatest(F.lit(0.0), F.col(lb) - F.col(ha), F.col(la) - F.col(hb))
        total = total + gap * gap
    return total


def _span_squared(low_a, high_a, low_b, high_b) -> Column:
    total = F.lit(0.0)
    for la, ha, lb, hb in zip(low_a, high_a, low_b, high_b):
        gap = F.greatest(F.col(hb) - F.col(la), F.col(ha) - F.col(lb))
        total = total + gap * gap
    return total


def _candidate_boxes(left: DataFrame, grid: _Grid, xs: list[str]) -> DataFrame:
    """``a_*, b_*``: for each box with uncertain centres the boxes that may hold nearer ones, with their bounds.

    All boxes form a tree by their prefixes. Each searching box goes down that tree with a bound on the cost of its
    dearest centre, which every node met tightens, and leaves out nodes that are farther away than that.
    """
    key = ["level", "box", "part"]

    def lows(side):
        return [f"{side}lo_{x}" for x in xs]

    def highs(side):
        return [f"{side}hi_{x}" for x in xs]

    def bounds(side, of=lambda c, f: f(c)):
        return [*[of(x, F.min).alias(f"{side}lo_{x}") for x in xs], *[of(x, F.max).alias(f"{side}hi_{x}") for x in xs]]

    leaves = stage(left.groupBy(*key).agg(F.count(F.lit(1)).alias("b_n"), F.min("w").alias("b_light"), F.max("w").alias("b_heavy"),
                                          *bounds("b_")), "leaves")
    open_ = left.where(~F.col("certain"))
    seekers = open_.groupBy(*[F.col(c).alias(f"a_{c}") for c in key]).agg(
        F.min("w").alias("a_light"), F.max("w").alias("a_heavy"), F.max("cost").alias("limit"), *bounds("a_"))
    deepest = leaves.agg(F.max("level")).first()[0]
    pairs, found = seekers.withColumn("b_box", F.lit(0).cast("long")), None
    same_bounds = [*[F.min(c).alias(c) for c in lows("b_")], *[F.max(c).alias(c) for c in highs("b_")]]
    for level in range(0, deepest + LEVELS_DOWN, LEVELS_DOWN):
        # nodes of this level: boxes that end here or since the level before, and the common prefixes of deeper ones
        before = max(level - LEVELS_DOWN, 0)
        ends = (leaves.where((F.col("level") <= level) & (F.col("level") > before if level else F.lit(True)))
                .withColumns({"leaf": F.lit(True), "parent": F.expr(f"shiftright(box, level - {before})")}))
        inner = (leaves.where(F.col("level") > level)
                 .withColumn("box", F.expr(f"shiftright(box, level - {level})"))
                 .groupBy("box").agg(F.sum("b_n").alias("b_n"), F.min("b_light").alias("b_light"), F.max("b_heavy").alias("b_heavy"), *same_bounds)
                 .withColumns({"level": F.lit(level), "part": F.lit(0), "leaf": F.lit(False), "parent": F.shiftright("box", level - before)}))
        nodes = ends.unionByName(inner).withColumnsRenamed({"parent": "b_parent", **{c: f"b_{c}" for c in key}})
        if level:
            met = pairs.withColumnRenamed("b_box", "b_parent").join(nodes, "b_parent").drop("b_parent")
        else:
            met = pairs.drop("b_box").crossJoin(nodes.drop("b_parent"))  # the root, one row
        near = ward_cost(F.col("a_light"), F.col("b_light"), _gap_squared(lows("a_"), highs("a_"), lows("b_"), highs("b_")))
        far = ward_cost(F.col("a_heavy"), F.col("b_heavy"), _span_squared(lows("a_"), highs("a_"), lows("b_"), highs("b_")))
        # a node with two centres has one that isn't the seeker itself
        far = F.when(F.col("b_n") > 1, far).otherwise(F.lit(float("inf")))
        of_seeker = Window.partitionBy("a_level", "a_box", "a_part")
        met = met.withColumn("limit", F.least("limit", F.min(far).over(of_seeker)))
        met = stage(met.where(near <= F.col("limit") * (1 + SLACK)), "met")
        ended = met.where("leaf").drop("leaf")
        found = ended if found is None else found.unionByName(ended)
        pairs = met.where("NOT leaf").select(*seekers.columns, "b_box")
    return found


def _merge_across(left: DataFrame, grid: _Grid, xs: list[str], limit: int) -> tuple[DataFrame, DataFrame]:
    """Merge all reciprocal nearest centres, wherever they lie: the merges and the centres then left."""
    boxes = _candidate_boxes(left, grid, xs)
    key, names = ["level", "box", "part"], [f"p_{x}" for x in xs]
    point = left.where(~F.col("certain")).select(*[F.col(c).alias(f"a_{c}") for c in key], F.col("id").alias("p"),
                                                 F.col("w").alias("p_w"), F.col("cost").alias("p_cost"),
                                                 *[F.col(x).alias(n) for x, n in zip(xs, names)])
    asked = point.join(boxes.drop("a_light", "a_heavy"), [f"a_{c}" for c in key])
    gap = _gap_squared(names, names, [f"b_lo_{x}" for x in xs], [f"b_hi_{x}" for x in xs])
    near = ward_cost(F.col("p_w"), F.col("b_light"), gap)
    asked = asked.where(near <= F.least("p_cost", "limit") * (1 + SLACK))
    b_key = [F.col(f"b_{c}").alias(c) for c in key]
    asked = stage(asked.select(*b_key, "p", "p_w", *names), "asked")
    # many questions to one box are answered by several tasks, each with a copy of the box
    shares = asked.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / F.lit(limit)).cast("int").alias("shares"))
    asked = asked.join(shares, key).withColumn("share", F.pmod(F.xxhash64("p"), F.col("shares")).cast("int")).drop("shares")
    held = left.select(*key, "id", "w", *xs).join(shares, key).withColumn(
        "share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")

    def answer(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("id", ignore_index=True)
        x, w, ids = b[xs].to_numpy(), b["w"].to_numpy(), b["id"].to_numpy()
        asking = a["p"].to_numpy()
        own = np.searchsorted(ids, asking)
        own[ids[np.minimum(own, len(ids) - 1)] != asking] = -1
        best, cost = _cheapest(a[names].to_numpy(), a["p_w"].to_numpy(), own, x, w)
        return pd.DataFrame({"id": a["p"].to_numpy(), "near": ids[best], "cost": cost})

    by = [*key, "share"]
    answers = asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(answer, "id long, near long, cost double")
    best = F.min(F.struct("cost", F.least("id", "near").alias("low"), F.greatest("id", "near").alias("high"))).alias("best")
    known = left.select("id", "near", "cost").unionByName(answers).where(F.col("cost") < float("inf"))
    best = stage(known.groupBy("id").agg(best), "nearest")
    low, high = best.where("id = best.low"), best.where("id = best.high")
    pairs = stage(low.join(high.select("best"), "best").select(F.col("best.low").alias("keep"), F.col("best.high").alias("gone"), "best.cost"),
                  "pairs")
    of = pairs.select(F.col("keep").alias("id"), "keep", "cost").unionByName(pairs.select(F.col("gone").alias("id"), "keep", "cost"))
    rows = left.select("id", "w", "height", *xs).join(of, "id", "left").withColumn("keep", F.coalesce("keep", "id"))
    one = F.count(F.lit(1)) == 1
    centres = stage(rows.groupBy("keep").agg(
        F.sum("w").alias("w"), F.greatest(F.max("height"), F.max("cost")).alias("height"),
        *[F.when(one, F.min(x)).otherwise(F.sum(F.col("w") * F.col(x)) / F.sum("w")).alias(x) for x in xs]), "centres")
    merges = pairs.join(centres.select("keep", "height"), "keep").select(
        F.col("gone").alias("id"), F.col("keep").alias("into"), "height")
    return merges, centres.withColumnRenamed("keep", "id")


# --- the tree ------------------------------------------------------------------------------------------

def ward_merges(centres: DataFrame, xs: list[str], limit: int = BOX_CENTRES) -> DataFrame:
    """``id, into, height, round, step``: all merges of the tree over ``centres(id, w, xs…)``; the smaller id stays.

    Heights never fall towards the root; equal ones are in the order of ``round, step``.
    """
    active, merges, turn = centres.withColumn("height", F.lit(0.0)), None, 0

    def add(more: DataFrame, of: int) -> None:
        nonlocal merges
        more = more.select("id", "into", "height", F.lit(of).alias("round"), "step")
        merges = more if merges is None else merges.unionByName(more)

    while True:
        row = active.agg(F.count(F.lit(1)).alias("n"), F.min("w").alias("least"), *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)],
                         *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)]).first()
        n = row["n"]
        if n < 2 and merges is not None:
            return merges
        grid = _Grid([row[f"lo{i}"] or 0.0 for i in range(len(xs))], [row[f"hi{i}"] or 0.0 for i in range(len(xs))], turn)
        boxed = _boxed(active, n, grid, xs, limit)
        rows, remain = stage_counting(_merge_boxes(boxed, grid, row["least"] or 1.0, xs, n // limit * TASKS_PER_BOX), F.col("into").isNull(), "merged")
        add(rows.where("into IS NOT NULL"), 2 * turn)
        left = rows.where("into IS NULL")
        if remain < 2:
            return merges
        if remain > (1 - LEAST_PROGRESS) * n:
            across, active = _merge_across(left, grid, xs, limit)
            add(across.withColumn("step", F.lit(0)), 2 * turn + 1)
        else:
            active = left.select("id", "w", "height", *xs)
        turn += 1


def _heads(parents: DataFrame) -> DataFrame:
    """``id, into`` with ``into`` followed to the last; every round doubles the steps taken."""
    heads, moved = stage(parents, "heads"), 1
    while moved:
        further = heads.select(F.col("id").alias("into"), F.col("into").alias("next"))
        heads, moved = stage_counting(attach(heads, further, ["into"], "left"), F.col("next").isNotNull(), "heads")
        heads = heads.select("id", F.coalesce("next", "into").alias("into"))
    return heads


def hierarchical_cluster(df: DataFrame, cols: list[str], k: int = 7, max_centres: int = BOX_CENTRES) -> DataFrame:
    """Rows without null features, with their ``cluster``; clusters are numbered by their least feature row.

    Equal rows merge first at no cost, so the tree is built on the distinct feature rows with their counts; the ``k - 1``
    highest merges are left out. ``max_centres`` is the number of centres a task holds, which doesn't change the tree.
    Where different pairs cost exactly the same, one of the possible trees is taken, the same for the same rows. Fewer than ``k``
    distinct rows are a cluster each; an empty table gives an empty result.
    """
    xs = [f"x{i}" for i in range(len(cols))]
    rows = df.na.drop(subset=cols)
    points = weighted_points(df, cols).select(*[F.col(f"`{c}`").alias(x) for c, x in zip(cols, xs)], F.col("n").alias("w"))
    if len(cols) > len(set(cols)):
        raise ValueError("features are listed twice")
    # many features are not combined before; equal rows have to be one centre here
    points = points.groupBy(*xs).agg(F.sum("w").alias("w"))
    points = stage(rank_within(points, [], xs, "id"), "centres")
    merges = stage(ward_merges(points, xs, max(2, max_centres)), "merges")
    cut = merges.orderBy(F.desc("height"), F.desc("round"), F.desc("step"), "id").limit(k - 1).select("id")
    heads = _heads(merges.join(cut, "id", "left_anti").select("id", "into"))
    placed = points.join(heads, "id", "left").withColumn("into", F.coalesce("into", "id"))
    numbers = placed.select("into").distinct().withColumn(
        "cluster", (F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("into")) - 1).cast("int"))  # at most k rows
    names = [f"_f{i}" for i in range(len(cols))]
    table = attach(placed, numbers, ["into"]).select(*[F.col(x).alias(n) for x, n in zip(xs, names)], "cluster")
    keyed = rows.withColumns({n: F.col(f"`{c}`").cast("double") for n, c in zip(names, cols)})
    return attach(keyed, table, names).drop(*names)
