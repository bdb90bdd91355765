import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from pelagia.operators import components, dbscan, features, hierarchy, kmeans, neighbors, silhouette


def sequential_dbscan(x, eps, min_samples):
    """The textbook procedure in row order."""
    gaps = x[:, None, :] - x[None, :, :]
    near = np.sqrt(sum(gaps[..., i] * gaps[..., i] for i in range(x.shape[1]))) <= eps
    core, label, current = near.sum(1) >= min_samples, np.full(len(x), -1), 0
    for i in range(len(x)):
        if label[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            p = stack.pop()
            if label[p] == -1:
                label[p] = current
                if core[p]:
                    stack.extend(np.flatnonzero(near[p] & (label == -1)))
        current += 1
    return label, near.sum(1)


def points_frame(spark, x):
    names = [f"p{i}" for i in range(x.shape[1])]
    data = [(i, *map(float, row)) for i, row in enumerate(x)]
    return spark.createDataFrame(data, "rid long, " + ", ".join(f"{n} double" for n in names)).repartition(4), names


def blobs(seed, d):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(c, 0.25, (60, d)) for c in (-1.0, 0.0, 1.2)] + [rng.uniform(-3, 3, (60, d))])
    x = np.concatenate([x, x[:15], np.repeat(x[-1:], 12, axis=0)])  # repeated points, one core by weight alone
    return x[rng.permutation(len(x))].round(2)


@pytest.mark.parametrize("seed,d,eps,min_samples,limit", [
    (1, 2, 0.3, 5, None), (2, 2, 0.2, 8, 2), (3, 1, 0.05, 6, None), (4, 3, 0.5, 6, 9)])
def test_dbscan_equals_the_sequential_procedure(spark, seed, d, eps, min_samples, limit):
    x = blobs(seed, d)
    df, names = points_frame(spark, x)
    label, near = sequential_dbscan(x, eps, min_samples)
    got = dbscan.dbscan(df, names, eps, min_samples, "rid", pair_limit=limit).select("rid", "cluster")
    assert rows(got) == sorted([(i, int(c)) for i, c in enumerate(label)], key=repr)
    counted = neighbors.neighbors_within(df, names, eps, "rid", pair_limit=limit).select("rid", "neighbors")
    assert rows(counted) == sorted([(i, int(n)) for i, n in enumerate(near)], key=repr)


def test_dbscan_edges(spark):
    # exact distance eps counts; a border point between two clusters joins the one of the earlier core row
    x = np.array([[0.0], [1.0], [2.0], [3.0], [4.0], [5.0], [6.0], [50.0]])
    df, names = points_frame(spark, x)
    label, _ = sequential_dbscan(x, 1.0, 3)
    assert [c for _, c in sorted((r["rid"], r["cluster"]) for r in dbscan.dbscan(df, names, 1.0, 3, "rid").collect())] == label.tolist()
    x = np.array([[2.0, 0], [0.0, 0], [-0.5, 0], [-0.6, 0], [4.0, 0], [4.5, 0], [4.6, 0]])
    df, names = points_frame(spark, x)
    label, _ = sequential_dbscan(x, 2.0, 4)
    assert [c for _, c in sorted((r["rid"], r["cluster"]) for r in dbscan.dbscan(df, names, 2.0, 4, "rid").collect())] == label.tolist()
    gap = spark.createDataFrame([(1, 0.0, "kept"), (2, None, "gap"), (3, 0.0, "kept")], "rid long, p double, note string")
    got = dbscan.dbscan(gap, ["p"], 1.0, 2, "rid")
    assert rows(got.select("rid", "note", "cluster")) == [(1, "kept", 0), (2, "gap", None), (3, "kept", 0)]
    with pytest.raises(ValueError):
        dbscan.dbscan(gap, ["p"] * 4, 1.0, 2, "rid")


def test_range_join_has_no_nested_loop(spark):
    df, names = points_frame(spark, blobs(1, 2))
    plan = neighbors.neighbors_within(df, names, 0.3, "rid")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_components_of_a_long_chain(spark):
    ids = np.random.default_rng(0).permutation(60)
    nodes = spark.createDataFrame([(0, int(i)) for i in range(60)] + [(1, 5), (1, 3)], "run int, id long")
    edges = spark.createDataFrame([(0, int(a), int(b)) for a, b in zip(ids[:40], ids[1:41])] + [(1, 5, 3)], "run int, u long, v long")
    got = {(r["run"], r["id"]): r["root"] for r in components.connected_components(nodes, edges).collect()}
    chain = set(map(int, ids[:41]))
    assert all(got[0, i] == (min(chain) if i in chain else i) for i in range(60))
    assert got[1, 5] == got[1, 3] == 3


def brute_silhouette(x, labels):
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    names = np.unique(labels)
    if len(names) < 2:
        return None
    size = np.array([(labels == k).sum() for k in names])
    sums = np.stack([dist[:, labels == k].sum(1) for k in names], 1)
    own = np.searchsorted(names, labels)
    a = sums[np.arange(len(x)), own] / np.maximum(size[own] - 1, 1)
    means = sums / size
    means[np.arange(len(x)), own] = np.inf
    b = means.min(1)
    top = np.maximum(a, b)
    return float(np.where((size[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0).mean())


@pytest.mark.parametrize("seed,d,tile", [(1, 1, 4096), (2, 2, 4096), (3, 2, 17), (4, 3, 40)])
def test_silhouette_against_brute_force(spark, seed, d, tile):
    rng = np.random.default_rng(seed)
    x = blobs(seed, d)
    labels = np.array([int(v) for v in np.digitize(x[:, 0], [-0.5, 0.6, 2.0])])
    labels[:2] = [7, 8]  # clusters of one row
    two = rng.integers(0, 2, len(x))
    df = spark.createDataFrame(
        [(r, int(c), *map(float, p)) for r, lab in (("a", labels), ("b", two), ("c", np.zeros(len(x)))) for p, c in zip(x, lab)],
        "run string, cluster int, " + ", ".join(f"p{i} double" for i in range(d)))
    got = {r["run"]: r["silhouette"] for r in silhouette.silhouette_euclidean(
        df, [f"p{i}" for i in range(d)], run="run", tile_points=tile).collect()}
    assert got["a"] == pytest.approx(brute_silhouette(x, labels), abs=1e-9)
    assert got["b"] == pytest.approx(brute_silhouette(x, two), abs=1e-9)
    assert got["c"] is None


def test_dbscan_grid(spark):
    x = blobs(6, 2)
    df, names = points_frame(spark, x)
    eps, mins = [0.1, 0.3, 9.0], [4, 500]
    grid = dbscan.dbscan_grid(df, names, "rid", eps, mins, pair_limit=50).collect()
    assert [(r["eps"], r["min_samples"]) for r in grid] == [(e, m) for e in eps for m in mins]
    best = (-1.0, None)
    for r in grid:
        label, _ = sequential_dbscan(x, r["eps"], r["min_samples"])
        kept = label != -1
        clusters = len(set(label[kept]))
        assert (r["n_clusters"], r["n_noise"]) == (clusters, int((~kept).sum()))
        if clusters >= 2 and kept.sum() > clusters:
            score = brute_silhouette(x[kept], label[kept])
            assert r["score"] == pytest.approx(score, abs=1e-9)
            best = max(best, (score, (r["eps"], r["min_samples"])), key=lambda t: t[0])
        else:
            assert r["score"] is None
    frame = spark.createDataFrame(grid)
    assert dbscan.best_parameters(frame, (0.1, 10)) == best[1]
    assert dbscan.best_parameters(frame.where("score is null"), (0.1, 10)) == (0.1, 10)
    tied = spark.createDataFrame([(0, 0.1, 5, 0.5), (1, 0.2, 5, 0.5), (2, 0.3, 5, -1.0)], "run int, eps double, min_samples int, score double")
    assert dbscan.best_parameters(tied, (9.9, 9)) == (0.1, 5)
    assert dbscan.best_parameters(tied.where("run = 2"), (9.9, 9)) == (9.9, 9)


def ward_by_definition(x, w, k):
    groups = [([i], x[i], w[i]) for i in range(len(x))]
    while len(groups) > k:
        cost, a, b = min((ga[2] * gb[2] / (ga[2] + gb[2]) * ((ga[1] - gb[1]) ** 2).sum(), i, i + 1 + j)
                         for i, ga in enumerate(groups) for j, gb in enumerate(groups[i + 1:]))
        ga, gb = groups[a], groups.pop(b)
        groups[a] = (ga[0] + gb[0], (ga[1] * ga[2] + gb[1] * gb[2]) / (ga[2] + gb[2]), ga[2] + gb[2])
    return {frozenset(g[0]) for g in groups}


def test_ward_against_the_definition(spark):
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(60, 3)), rng.integers(1, 5, 60)
    labels = hierarchy.ward_labels(x, w, 7)
    assert {frozenset(np.flatnonzero(labels == c)) for c in range(7)} == ward_by_definition(x, w, 7)
    data = [tuple(map(float, p)) for p, n in zip(x, w) for _ in range(n)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {}
    for r in hierarchy.hierarchical_cluster(df, ["a", "b", "c"], 7).collect():
        got.setdefault(r["cluster"], set()).add((r["a"], r["b"], r["c"]))
    expected = {frozenset(tuple(map(float, x[i])) for i in g) for g in ward_by_definition(x, w, 7)}
    assert {frozenset(g) for g in got.values()} == expected
    coarse = hierarchy.hierarchical_cluster(df, ["a", "b", "c"], 3, max_centres=20)
    assert coarse.count() == len(data) and coarse.select("cluster").distinct().count() == 3


def test_kmeans_invariants(spark):
    x = blobs(9, 2)
    df, names = points_frame(spark, x)
    df = df.unionByName(spark.createDataFrame([(-5, None, 1.0)], "rid long, p0 double, p1 double"))
    out = kmeans.kmeans(df, names, 4, seed=1).collect()
    assert len(out) == len(x)
    p, c = np.array([[r["p0"], r["p1"]] for r in out]), np.array([r["cluster"] for r in out])
    centres = np.array([p[c == k].mean(0) for k in range(4)])
    assert [tuple(m) for m in centres] == sorted(tuple(m) for m in centres)
    nearest = ((p[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
    assert (nearest == c).mean() > 0.98  # Lloyd's last step may leave a few rows between two centres
    curve = {r["k"]: r["cost"] for r in kmeans.kmeans_cost_curve(df, names, [1, 2, 4, 8], seed=1).collect()}
    assert curve[1] == pytest.approx(((x - x.mean(0)) ** 2).sum())
    assert curve[1] > curve[2] > curve[4] > curve[8]
    assert curve[4] == pytest.approx(((p - centres[c]) ** 2).sum(), rel=0.05)
    assert -1 <= kmeans.silhouette_squared(kmeans.kmeans(df, names, 3), names).first()[0] <= 1
    assert kmeans.silhouette_squared(kmeans.kmeans(df, names, 3).withColumn("cluster", F.lit(0)), names).first()[0] is None


def test_silhouette_curve_matches_labels(spark):
    df = spark.createDataFrame([(float(i + 10 * (i // 5)),) for i in range(20)], "code double")
    curve = {r["k"]: r["silhouette"] for r in kmeans.silhouette_curve(df, ["code"], [2, 4], seed=42).collect()}
    x = np.array([[i + 10 * (i // 5)] for i in range(20)], float)
    assert curve[4] == pytest.approx(brute_silhouette(x, np.repeat(np.arange(4), 5)), abs=1e-9)


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "a double, b double")
    params = features.fit_scaler(df, ["a", "b"])
    out = features.standard_unscale(features.standard_scale(df, ["a", "b"], params), params)
    a = np.array([r["a_scaled"] for r in out.collect()])
    assert a.mean() == pytest.approx(0) and a.std() == pytest.approx(1)
    assert {r["b_scaled"] for r in out.collect()} == {0.0}
    assert sorted(r["a_unscaled"] for r in out.collect()) == pytest.approx([1.0, 2.0, 6.0])
    assert features.standard_scale(df.limit(1), ["a"]).first()["a_scaled"] == 0.0
    assert features.assemble_features(df, ["a", "b"]).first()["features"].toArray().tolist() == [1.0, 5.0]


@pytest.mark.parametrize("small", [True, False])
def test_ordinal_encode(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(features, "is_small", lambda df: False)
    df = spark.createDataFrame([("b", 10), ("a", 9), (None, 100), ("B", 9), ("é", None), ("b", 9)], "name string, n int")
    got = features.ordinal_encode(df.repartition(3), ["name", "n"])
    code = {None: None, "B": 0, "a": 1, "b": 2, "é": 3}
    num = {None: None, 9: 0, 10: 1, 100: 2}
    assert rows(got) == sorted([(a, n, code[a], num[n]) for a, n in [tuple(r) for r in df.collect()]], key=repr)


def ward_by_chain(x, w, k):
    """Nearest-neighbour chains over a plain list of centres."""
    n = len(x)
    c, w, alive = x.astype(float).copy(), w.astype(float).copy(), np.ones(n, bool)
    merges, chain = [], []
    while len(merges) < n - 1:
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            a = chain[-1]
            cost = w * w[a] / (w + w[a]) * ((c - c[a]) ** 2).sum(1)
            cost[~alive] = cost[a] = np.inf
            b = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[b]:
                b = chain[-2]
                break
            chain.append(b)
        del chain[-2:]
        keep, gone = min(a, b), max(a, b)
        merges.append((cost[b], len(merges), keep, gone))
        c[keep], w[keep] = (c[a] * w[a] + c[b] * w[b]) / (w[a] + w[b]), w[a] + w[b]
        alive[gone] = False
    head = np.arange(n)
    for _, _, keep, gone in sorted(merges)[:n - k]:
        a, b = head[keep], head[gone]
        head[head == max(a, b)] = min(a, b)
    return {frozenset(np.flatnonzero(head == h)) for h in set(head)}


@pytest.mark.parametrize("n,d,limit", [(3000, 2, 4096), (400, 2, 150), (90, 4, 40)])
def test_ward_on_the_cluster_equals_brute_force(spark, n, d, limit):
    rng = np.random.default_rng(n + d)
    x = np.concatenate([rng.normal(size=(n // 2, d)), 4 + rng.normal(size=(n - n // 2, d)) * rng.uniform(0.1, 3, (n - n // 2, 1))])
    w = rng.integers(1, 4, n)
    names = [f"f{i}" for i in range(d)]
    data = [tuple(map(float, p)) for p, m in zip(x, w) for _ in range(m)]
    df = spark.createDataFrame(data + [(None,) * d], ", ".join(f"{c} double" for c in names))
    place = {tuple(map(float, p)): i for i, p in enumerate(x)}
    got = {}
    for r in hierarchy.hierarchical_cluster(df, names, 7, max_centres=limit).collect():
        got.setdefault(r["cluster"], set()).add(place[tuple(r)[:d]])
    assert {frozenset(g) for g in got.values()} == ward_by_chain(x, w, 7)


def test_ward_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0), (None, 1.0), (5.0, 2.0)], "a double, b double")
    assert rows(hierarchy.hierarchical_cluster(df, ["a", "b"], 7)) == [(1.0, 2.0, 0), (1.0, 2.0, 0), (5.0, 2.0, 1)]
    assert rows(hierarchy.hierarchical_cluster(df.limit(1), ["a", "b"], 7)) == [(1.0, 2.0, 0)]
    assert hierarchy.hierarchical_cluster(df.where("a > 9"), ["a", "b"]).count() == 0
    # all distances equal: some tree, the same one each time, in several boxes
    grid = spark.createDataFrame([(float(i), float(j)) for i in range(5) for j in range(5)], "a double, b double")
    first = rows(hierarchy.hierarchical_cluster(grid, ["a", "b"], 4, max_centres=15))
    assert first == rows(hierarchy.hierarchical_cluster(grid.repartition(7), ["a", "b"], 4, max_centres=15))
    assert len({r[2] for r in first}) == 4 and len(first) == 25


@pytest.mark.parametrize("d", [1, 2, 3])
def test_silhouette_of_large_clusters_sums_far_boxes(spark, monkeypatch, d):
    monkeypatch.setattr(silhouette, "LEAF_POINTS", 8)
    rng = np.random.default_rng(d)
    x = np.concatenate([rng.normal(size=(700, d)) * 0.7, rng.normal(size=(500, d)) + 3, rng.uniform(-40, 40, (30, d)), np.zeros((20, d))])
    labels = np.repeat(["a", "b", "c", "d"], [700, 500, 30, 20])
    df, names = points_frame(spark, x)
    table = spark.createDataFrame([(i, str(v)) for i, v in enumerate(labels)], "rid long, label string")
    got = silhouette.silhouette_euclidean(df.join(table, "rid"), names, "label", tile_points=64).first()
    assert got["silhouette"] == pytest.approx(brute_silhouette(x, np.unique(labels, return_inverse=True)[1]), abs=1e-9)
    assert (got["clusters"], got["points"]) == (4, 1250)


def test_boxes_per_block_do_not_grow_with_the_cluster(spark):
    rng = np.random.default_rng(1)
    per_block = []
    for n in (800, 6_400):
        points = spark.createDataFrame(map(tuple, rng.uniform(size=(n, 2)).tolist()), "x0 double, x1 double").withColumns(
            {"run": F.lit(0), "label": F.lit("a"), "w": F.lit(1.0)})
        xs = ["x0", "x1"]
        clusters = silhouette._clusters(points, xs).cache()
        placed = silhouette._placed(points, clusters, xs, 64, 16).cache()
        targets = placed.groupBy("cid", "t_level", "t_box", "t_part").agg(
            *[f(x).alias(f"t_{n}_{x}") for x in xs for n, f in (("lo", F.min), ("hi", F.max))]).withColumn("tid", F.monotonically_increasing_id()).cache()
        leaves = silhouette._leaves(placed, xs).cache()
        light = ["cid", "level", "box", "part", "up", "half", "centre", "leaf"]
        inner = silhouette._inner_boxes(leaves, 2).withColumns({"part": F.lit(0), "leaf": F.lit(False)})
        nodes = leaves.withColumn("leaf", F.lit(True)).select(*light).unionByName(inner.select(*light)).cache()
        sources = silhouette._sources(targets, targets.select("tid", F.col("cid").alias("source")), nodes, 2, xs)
        per_block.append(sources.count() / targets.count())
    assert per_block[1] < 3 * per_block[0]  # 8 times the points


def test_ward_boxes_are_well_filled(spark):
    rng = np.random.default_rng(6)
    sides = [1, 6, 25, 50, 8, 64]  # ranks of very different numbers of values, one of them constant
    x = np.unique(rng.integers(0, sides, (3000, 6)), axis=0).astype(float)
    xs = [f"x{i}" for i in range(6)]
    active = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id long, " + ", ".join(f"{c} double" for c in xs))
    grid = hierarchy._Grid([0.0] * 6, [s - 1.0 for s in sides], 0)
    boxed = hierarchy._boxed(active, len(x), grid, xs, 400).cache()
    boxes = boxed.groupBy("level", "box", "part").count().collect()
    assert sum(b["count"] for b in boxes) == len(x) and max(b["count"] for b in boxes) <= 400
    assert {b["part"] for b in boxes} == {0} and len(boxes) <= 30
    for b in boxes[:5]:
        inside = np.array(boxed.where((boxed.level == b.level) & (boxed.box == b.box)).select("id").collect())[:, 0]
        room = grid.room(b.level, b.box)(x[inside])
        others = np.delete(x, inside, axis=0)
        nearest = np.sqrt(((x[inside][:, None] - others[None]) ** 2).sum(2)).min(1)
        assert (room <= nearest + 1e-9).all()


@pytest.mark.parametrize("limit", [300])
def test_ward_with_many_ties_does_not_depend_on_boxes(spark, limit):
    rng = np.random.default_rng(3)
    data = [tuple(map(float, p)) for p in rng.integers(0, (4, 9, 1, 7, 5), (700, 5))]
    names = list("abcde")
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in names))
    assert rows(hierarchy.hierarchical_cluster(df, names, 5, max_centres=limit)) == rows(hierarchy.hierarchical_cluster(df, names, 5))


def test_dbscan_grid_takes_each_position_once(spark, monkeypatch):
    rng = np.random.default_rng(8)
    spots = np.concatenate([rng.normal(size=(40, 2)) * 0.3, rng.normal(size=(40, 2)) * 0.3 + 5, rng.uniform(-30, 30, (10, 2))])
    copies = rng.integers(1, 9, len(spots))
    df, names = points_frame(spark, np.repeat(spots, copies, axis=0))
    held, stage = {}, dbscan.stage

    def counted(frame, name="table"):
        out = stage(frame, name)
        held[name] = out.count()
        return out

    monkeypatch.setattr(dbscan, "stage", counted)
    got = dbscan.dbscan_grid(df, names, "rid", [0.6], [4, 12]).collect()
    assert held["searched"] == len(spots) and held["labelled"] == 2 * len(spots)
    for g in got:
        labels = dbscan.dbscan(df, names, g["eps"], g["min_samples"], "rid")
        clustered = labels.where("cluster >= 0")
        assert g["n_noise"] == labels.count() - clustered.count() and g["n_clustered"] == clustered.count()
        assert g["n_clusters"] == clustered.select("cluster").distinct().count()
        if g["score"] is not None:
            assert g["score"] == pytest.approx(silhouette.silhouette_euclidean(clustered, names).first()["silhouette"], abs=1e-9)
