"""Neighbours and communities against plain versions."""

import random
import re

import numpy as np

from histoframe.operators import graph as G


def planted(seed=1, groups=6, size=30):
    r = random.Random(seed)
    pairs = {(g * size + r.randrange(size), g * size + r.randrange(size)) for g in range(groups) for _ in range(size * 4)}
    pairs |= {(r.randrange(groups * size), r.randrange(groups * size)) for _ in range(groups * 6)}
    pairs = {(a, b) for a, b in pairs if a != b}
    return pairs | {(b, a) for a, b in pairs}


def quality(pairs, label, resolution):
    total, inside = {}, 0
    for a, b in pairs:
        total[label[a]] = total.get(label[a], 0) + 1
        inside += label[a] == label[b]
    return inside / len(pairs) - resolution * sum(t * t for t in total.values()) / len(pairs) ** 2


def test_communities_are_found_and_rest(spark):
    pairs = planted()
    edges = spark.createDataFrame(sorted(pairs), "src long, dst long")
    found = G.communities(edges, 1.0)
    label = {r.node: r.label for r in found.collect()}
    assert len(set(label.values())) == 6 and all(label[a] == label[a // 30 * 30] or quality(pairs, {**label, a: label[a // 30 * 30]}, 1.0) <= quality(pairs, label, 1.0) for a in label)
    # No node and no whole community gains by another label.
    best = quality(pairs, label, 1.0) + 1e-9
    for node in label:
        assert all(quality(pairs, {**label, node: other}, 1.0) <= best for other in set(label.values()))
    for old in set(label.values()):
        assert all(quality(pairs, {n: other if x == old else x for n, x in label.items()}, 1.0) <= best for other in set(label.values()))
    assert tuple(G.open_wishes(edges, found, 1.0).first()) == (len(label), len(label), 0, 0)


def test_moves_of_a_round_raise_modularity(spark):
    pairs = planted(2)
    edges = spark.createDataFrame(sorted(pairs), "src long, dst long").selectExpr("src", "dst", "cast(1 as double) as w").cache()
    label = {a: a for a, _ in pairs}
    degree = {a: sum(x == a for x, _ in pairs) for a in label}
    for _ in range(4):
        state = spark.createDataFrame([(a, x, float(degree[a])) for a, x in label.items()], "node long, label long, k double")
        granted = G._granted(G._wishes(edges, state, float(len(pairs)), 1.0), float(len(pairs)), 1.0).collect()
        moved = {**label, **{r.node: r.new for r in granted}}
        assert granted and quality(pairs, moved, 1.0) > quality(pairs, label, 1.0)
        label = moved


def test_wishes_of_a_settled_labelling_are_seen(spark):
    """Labels of two joined cliques cut the wrong way round want to move."""
    pairs = [(a, b) for g in (0, 5) for a in range(g, g + 5) for b in range(g, g + 5) if a != b] + [(0, 5), (5, 0)]
    labels = spark.createDataFrame([(i, int(i >= 4)) for i in range(10)], "node long, label long")
    facts = G.open_wishes(spark.createDataFrame(pairs, "src long, dst long"), labels, 1.0).first()
    assert facts.moves == 1 and facts.nodes == facts.labelled == 10


def plain_neighbours(x, k):
    distance = ((x[:, None] - x[None]) ** 2).sum(2) ** 0.5
    np.fill_diagonal(distance, np.inf)
    order = [np.lexsort((np.arange(len(x)), row))[: min(k, len(x) - 1)] for row in distance]
    return {(i, int(j), rank) for i, near in enumerate(order) for rank, j in enumerate(near, 1)}


def found_neighbours(spark, x, k, **sizes):
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "cell_id long, features array<double>").repartition(3)
    return {(r.cell_id, r.neighbour, r["rank"]) for r in G.knn(df, k, **sizes).collect()}


def test_neighbours_with_ties_and_hot_places(spark):
    r = np.random.default_rng(5)
    for x, k, block in ((np.vstack([np.ones((150, 3)), r.normal(size=(120, 3))]), 4, 16), (r.integers(0, 3, (80, 2)) + 1e6, 7, 8), (r.normal(size=(3, 2)), 15, 8), (r.normal(size=(1, 2)), 3, 8)):
        assert found_neighbours(spark, x.astype(float), k, block=block) == plain_neighbours(x.astype(float), k)


def test_few_rows_meet_other_blocks(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(30, 6))[r.integers(0, 30, 900)] * 30 + r.normal(size=(900, 6))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "cell_id long, features array<double>")
    plan = G.KnnPlan(df, 5, "cell_id", "features", None, 4096)
    traffic = plan.traffic().first()
    assert traffic.pivots == 30 and traffic.share < 0.1
    assert {(r.id, r.neighbour, r["rank"]) for r in plan.neighbours().collect()} == plain_neighbours(x, 5)


def test_neighbours_of_odd_rows(spark):
    schema = "cell_id long, features array<double>, rank string"
    assert G.knn(spark.createDataFrame([], schema)).count() == 0
    rows = G.knn(spark.createDataFrame([(1, [0.0], "x"), (2, None, "x"), (3, [2.0], "x")], schema), 2).collect()
    assert {(r.cell_id, r.neighbour, r.distance) for r in rows} == {(1, 3, 2.0), (3, 1, 2.0)}


def test_a_row_goes_to_a_bundle_of_blocks_once(spark, monkeypatch):
    """Structureless rows meet nearly all blocks, but are copied once per bundle and not once per block."""
    x = np.random.default_rng(7).normal(size=(700, 16))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "cell_id long, features array<double>")
    for rows, bundles in ((4096, 1), (200, 5)):
        monkeypatch.setattr(G, "TILE_BYTES", rows * 8 * 16)
        plan = G.KnnPlan(df, 5, "cell_id", "features", None, 4096)
        copies = plan.sent.selectExpr("sum(size(bundles)) as n").first().n
        assert plan.traffic().first().share > 0.5 and copies <= 700 * bundles
        assert {(r.id, r.neighbour, r["rank"]) for r in plan.neighbours().collect()} == plain_neighbours(x, 5)


def test_pool_finds_the_same_as_in_double_precision(monkeypatch):
    """Distances picked in single precision are those of the plain search, far from the origin, with ties and repeated ids; the plain search is left to rows beyond its range."""
    plain, calls = G._nearest, []
    r = np.random.default_rng(9)
    x = r.normal(size=(1500, 8))
    cases = [(x, False), (x * 1e-9 + 1e6, False), (np.round(x), False), (np.vstack([x] * 3), False), (x * 1e200, True), (np.vstack([x, np.full((1, 8), np.nan)]), True), (x[:30], False)]
    for x, beyond in cases:
        ids = np.arange(len(x)) % 1400
        own, pool = np.arange(0, 20), np.arange(10, len(x))
        bound = np.sort(np.sqrt(((x[own, None] - x[None, :200]) ** 2).sum(2)), axis=1)[:, min(40, len(x) - 1)]
        monkeypatch.setattr(G, "_nearest", lambda *a: calls.append(1) or plain(*a))
        hosted = G.Pool(ids[pool], x[pool])
        for taken, out in ((None, slice(0, 0)), (None, slice(3, 9)), (np.arange(0, len(pool), 2), slice(4, 10))):
            calls.clear()
            got = hosted.nearest(ids[own], x[own], 5, bound, taken, out)
            assert bool(calls) == beyond
            kept = np.setdiff1d(np.arange(len(pool)) if taken is None else taken, np.arange(out.start, out.stop))
            want = plain(ids[own], x[own], ids[pool][kept], x[pool][kept], 5, bound)
            sure = [{(int(a), int(b), float(d)) for a, b, d in zip(*found) if not d > bound[int(a)]} for found in (got, want)]
            assert sure[0] == sure[1] and (len(x) < 100 or beyond or len(sure[0]) > 20)


def test_links_are_shuffled_by_node_and_label_once(spark):
    edges = spark.range(9).selectExpr("id as src", "(id + 1) % 9 as dst", "cast(1 as double) as w")
    state = spark.range(9).selectExpr("id as node", "id % 3 as label", "cast(2 as double) as k")
    plan = G._wishes(edges, state, 9.0, 1.0)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Aggregate \[\w+#\d+L?, label#\d+L?\]", plan)) == 1
