"""Run algebra against pixel sets."""

import random

import pytest
from pyspark.sql import functions as F

from histoframe.operators import evaluate as E
from histoframe.operators import runs as R


def mask_of(seed, height, width, share):
    r = random.Random(seed)
    return {(y, x) for y in range(height) for x in range(width) if r.random() < share}


def as_runs(spark, masks):
    return R.to_runs(spark.createDataFrame([(s, y, x) for s, m in masks.items() for y, x in m], "slide_id int, y int, x int"))


def frames(spark, sizes):
    return spark.createDataFrame([(s, *size) for s, size in sizes.items()], "slide_id int, height int, width int, radius int")


def pixels(runs):
    out = {}
    for r in R.to_pixels(runs).collect():
        out.setdefault(r.slide_id, set()).add((r.y, r.x))
    return out


def plain_dilation(mask, height, width, radius):
    disk = [(dy, dx) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1) if dy * dy + dx * dx <= radius * radius]
    return {(y + dy, x + dx) for y, x in mask for dy, dx in disk if 0 <= y + dy < height and 0 <= x + dx < width}


def test_dilation_over_tiles_and_strips(spark, monkeypatch):
    monkeypatch.setattr(R, "STRIP", 7)
    monkeypatch.setattr(R, "TILE", 5)
    sizes = {1: (23, 31, 0), 2: (40, 17, 3), 3: (30, 40, 9), 4: (12, 12, 40)}
    masks = {s: mask_of(s, h, w, 0.02 if s > 2 else 0.1) for s, (h, w, _) in sizes.items()}
    runs, slides = as_runs(spark, masks), frames(spark, sizes)
    grown = R.dilate(runs, slides)
    assert grown.schema == runs.schema
    assert pixels(grown) == {s: plain_dilation(masks[s], *sizes[s]) for s in sizes}
    off = {s: {(y, x) for y in range(sizes[s][0]) for x in range(sizes[s][1])} for s in sizes}
    closed = {s: off[s] - plain_dilation(off[s] - plain_dilation(masks[s], *sizes[s]), *sizes[s]) for s in sizes}
    assert pixels(R.close_runs(runs, slides)) == {s: m for s, m in closed.items() if m}


def test_pieces_do_not_grow_with_the_radius(spark):
    runs = as_runs(spark, {1: {(y, x) for y in range(0, 3000, 3) for x in (5, 900)}}).cache()
    for radius in (0, 2, 60, 500, 900):
        assert R._pieces(runs, frames(spark, {1: (3000, 1000, radius)})).count() <= 3 * runs.count()


def test_region_stats_as_on_pixels(spark):
    masks = {1: mask_of(1, 14, 16, 0.55), 2: mask_of(2, 9, 30, 0.8), 3: {(0, 0)}}
    got = {}
    for r in R.region_stats(as_runs(spark, masks)).collect():
        got.setdefault(r.slide_id, set()).add((r.area, r.y0, r.y1, r.x0, r.x1, r.n_boundary))
    for s, mask in masks.items():
        left, want = set(mask), set()
        while left:
            part, todo = set(), [left.pop()]
            while todo:
                y, x = todo.pop()
                part.add((y, x))
                near = {(y + dy, x + dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)} & left
                left -= near
                todo += near
            edge = sum(not {(y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)} <= mask for y, x in part)
            ys, xs = [y for y, _ in part], [x for _, x in part]
            want.add((len(part), min(ys), max(ys), min(xs), max(xs), edge))
        assert got[s] == want
    plan = R.covered_pixels(as_runs(spark, masks).withColumn("comp", F.lit(1).cast("bigint")))._jdf.queryExecution().executedPlan().toString()
    assert "explode" not in plan.lower()


def test_split_join_positions_and_missing_ids(spark):
    from pyspark.sql import Observation

    patches = spark.createDataFrame([(i,) for i in (30, 10, 20)], "cell_id long")
    folds = spark.createDataFrame([(20, 1, "a"), (10, 1, "b"), (20, 2, "a")], "cell_id long, fold int, position string").drop("position")
    seen = Observation()
    assert {(r.cell_id, r.fold, r.position) for r in E.split_join(folds, patches, "cell_id", seen).collect()} == {(20, 1, 1), (10, 1, 0), (20, 2, 1)}
    assert seen.get == {"rows": 3, "missing": 0, "repeated": 0}
    with pytest.raises(Exception, match="cell_id 40 of a fold is absent"):
        E.split_join(folds.union(spark.createDataFrame([(40, 1)], "cell_id long, fold int")), patches, "cell_id").collect()
    with pytest.raises(Exception, match="cell_id 20 stands more than once"):
        E.split_join(folds, patches.union(spark.createDataFrame([(20,)], "cell_id long")), "cell_id").collect()
    with pytest.raises(Exception, match="cell_id null of a fold is absent"):
        E.split_join(spark.createDataFrame([(None, 1)], "cell_id long, fold int"), patches, "cell_id").collect()
    assert E.split_join(folds.limit(0), patches.limit(0), "cell_id").count() == 0


def plain_components(mask, near):
    left, found = set(mask), set()
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            y, x = todo.pop()
            part.add((y, x))
            more = {(y + dy, x + dx) for dy, dx in near} & left
            left -= more
            todo += more
        found.add(frozenset(part))
    return found


def test_components_inside_and_across_tiles(spark, monkeypatch):
    masks = {1: mask_of(1, 23, 31, 0.55), 2: mask_of(2, 9, 40, 0.7), 3: {(0, 0)}, 4: {(y, x) for y in range(20) for x in range(30) if y % 2 == 0 or x == y % 4 * 9}}
    near = {False: [(-1, 0), (1, 0), (0, -1), (0, 1)], True: [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)]}
    for rows, columns in ((256, 1024), (4, 7)):
        monkeypatch.setattr(R, "LABEL_ROWS", rows)
        monkeypatch.setattr(R, "LABEL_COLUMNS", columns)
        for diagonal in (False, True):
            labelled = R.label_runs(as_runs(spark, masks), diagonal)
            got, firsts = {}, {}
            for r in R.to_pixels(labelled).collect():
                got.setdefault((r.slide_id, r.comp), set()).add((r.y, r.x))
            for (s, comp), part in got.items():
                y, x = min(part)
                assert comp == (s << 40) + (y << 20) + x
                firsts.setdefault(s, set()).add(frozenset(part))
            assert firsts == {s: plain_components(m, near[diagonal]) for s, m in masks.items()}


def test_components_inside_tiles_need_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(R, "connected_roots", lambda *a: pytest.fail("rounds over the whole table"))
    assert R.label_runs(as_runs(spark, {s: mask_of(s, 48, 48, 0.6) for s in range(5)}), True).count() > 0


def test_small_disks_need_no_tiles(spark, monkeypatch):
    monkeypatch.setattr(R, "_in_tiles", lambda *a: pytest.fail("a Python group per tile"))
    sizes = {1: (23, 31, 0), 2: (40, 17, 3), 3: (9, 9, 4)}
    masks = {s: mask_of(s, h, w, 0.1) for s, (h, w, _) in sizes.items()}
    assert pixels(R.dilate(as_runs(spark, masks), frames(spark, sizes))) == {s: plain_dilation(masks[s], *sizes[s]) for s in sizes}


def test_polygons_are_drawn_by_words_of_columns(spark):
    """The last ring over a pixel decides, over borders of 64 columns; no pixel is shuffled on its own."""
    from histoframe.operators import ingest as N

    r = random.Random(4)
    want, rows = {}, []
    for s, o in ((1, 0), (1, 1), (2, 0)):
        for feature in range(6):
            for ring in range(3):
                x, y, w, h = r.randrange(-5, 140), r.randrange(-2, 6), r.randrange(1, 150), r.randrange(1, 5)
                rows += [(s, o, feature, 0, ring, k, float(x + dx * w), float(y + dy * h)) for k, (dx, dy) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)))]
                covered = {(b, a) for a in range(max(0, x), min(200, x + w)) for b in range(max(0, y), min(8, y + h))}
                drawn = want.setdefault((s, o), set())
                drawn.update(covered) if ring == 0 else drawn.difference_update(covered)
    vertices = spark.createDataFrame(rows, "slide_id int, o int, feature int, part int, ring int, vertex int, x double, y double")
    slides = frames(spark, {1: (8, 200, 0), 2: (8, 200, 0)})
    found = N.rasterize_polygons(vertices, slides, ["slide_id", "o"])
    assert sorted(found.collect()) == sorted((*k, y, x) for k, px in want.items() for y, x in px)
    once = N.rasterize_polygons(vertices, slides, ["slide_id", "o"], union=["slide_id"])
    assert sorted(once.collect()) == sorted({(s, y, x) for (s, _), px in want.items() for y, x in px})
    words = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate" in line and "word" in line]
    assert len(words) == 2


def test_slides_whose_clean_mask_is_empty_are_counted(spark, tmp_path):
    """Every slide has its row: one without lines, one all of whose components are too small."""
    from histoframe.workloads import registered

    r = random.Random(5)
    points = {0: [], 1: [(3, 4), (20, 30), (47, 47)], 2: [(r.randrange(48), r.randrange(48)) for _ in range(330)], 3: [(y, x) for y in (10, 12, 15) for x in range(9, 20)] + [(y, x) for y in range(10, 16) for x in (9, 14, 19)]}
    spark.createDataFrame([(s, f"s{s}", 1) for s in points], "s_suppkey long, s_name string, s_nationkey int").write.parquet(str(tmp_path / "supplier.parquet"))
    lines = [(s, y, x, q) for s, at in points.items() for y, x in at for q in (20.0, 5.0)]
    spark.createDataFrame(lines, "l_suppkey long, l_orderkey long, l_partkey long, l_quantity double").write.parquet(str(tmp_path / "lineitem.parquet"))
    near, size, frame = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1)], (48, 48), {(y, x) for y in range(48) for x in range(48)}
    want = set()
    for s, at in points.items():
        raw = plain_components({(y + a, x + b) for y, x in at for a in (0, 1) for b in (0, 1)} & frame, near)
        kept = [c for c in raw if len(c) >= 9]
        mask = set().union(*kept)
        for hole in plain_components(frame - mask, near):
            mask |= hole if len(hole) <= 6 and all(0 < v < 47 for px in hole for v in px) else set()
        closed = frame - plain_dilation(frame - plain_dilation(mask, *size, 1), *size, 1)
        want.add((s, len(closed), len(raw), len(kept), len(plain_components(mask, near)), len(plain_components(closed, near))))
    found = registered()["mask_cleanup"].build(spark, str(tmp_path))
    assert found.columns == ["slide_id", "area", "raw", "min_area", "hole_fill", "closing"]
    got = [tuple(row) for row in found.collect()]
    assert len(got) == 4 and set(got) == want and (0, 0, 0, 0, 0, 0) in want and (1, 0, 3, 0, 0, 0) in want
