"""Steps whose memory in a task grew with the table: same results, and plans without the step that grew."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from histoframe.operators import patches as G
from histoframe.operators import tissue as T
from histoframe.operators import words as W
from histoframe.sources import readers, sinks
from histoframe.workloads import registered

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_planes_are_not_a_join_key(spark):
    plan = plan_of(registered()["pseudo_rgb_frame"].build(spark, SF))
    assert not re.search(r"hashpartitioning\(c#\d+, \d+\)", plan)


def test_cluster_map_paints_like_brute_force(spark):
    random.seed(4)
    rows = [(s, i, random.randrange(700), random.randrange(40), random.choice([None, 1, 2, 3])) for s in range(2) for i in range(60)]
    patches = spark.createDataFrame(rows, "slide_id int, patch_id int, x int, y int, label int")
    for size, factor in ((20, 3), (2, 3), (300, 4)):
        want = {}
        for s, _, x, y, label in rows:
            for cy in range(y // factor, (y + size) // factor):
                for cx in range(x // factor, (x + size) // factor):
                    want[s, cy, cx] = label
        found = T.cluster_map(patches, size, factor)
        got = found.collect()
        assert len(got) == len(want) and {(r.slide_id, r.cy, r.cx): r.label for r in got} == want
        assert not re.search(r"Aggregate\(key[^\n]*cx#", plan_of(found))


def test_last_row_of_the_last_file_wins(spark, tmp_path):
    (tmp_path / "a.csv").write_text("image,mpp\nx,0.1\ny,0.2\nx,0.3\n")
    (tmp_path / "b.csv").write_text("image,mpp\nz,0.4\nx,0.5\nx,\n")
    found = readers.read_mpp_csv(spark, str(tmp_path))
    assert {r.image: r.mpp for r in found.collect()} == {"x": None, "y": 0.2, "z": 0.4}
    # The pass over all rows is a hash aggregate; sorting is left to what it gives.
    assert "partial_max_by(mpp" in plan_of(found) and "HashAggregate" in [line for line in plan_of(found).split("\n") if "partial_max_by" in line][-1]


def test_union_of_masks_in_words(spark):
    random.seed(5)
    masks = [[(s, random.randrange(4), random.randrange(-70, 300)) for s in range(2) for _ in range(120)] for _ in range(2)]
    masks[0] += [(0, 0, x) for x in (0, 63, 64, 127, -1, -64)] * 2
    found = W.union_of(*[spark.createDataFrame(m, "slide_id int, y int, x int") for m in masks])
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == set(masks[0]) | set(masks[1])
    assert dict(found.dtypes)["x"] == "int"
    assert not re.search(r"Aggregate\(key[^\n]*x#", plan_of(registered()["mask_union"].build(spark, SF)))


@pytest.mark.parametrize("size, stride", [(16, 5), (20, 16), (100, 30), (7, 2), (30, 30)])
def test_boxes_do_not_count_what_lies_off_the_frame(spark, size, stride):
    random.seed(6)
    height, width = 103, 200
    slides = spark.createDataFrame([(0, height, width, "uint16")], "slide_id int, height int, width int, dtype string")
    points = {(random.randrange(-20, 130), random.randrange(-90, 300)) for _ in range(3000)}
    mask = spark.createDataFrame([(0, y, x) for y, x in points], "slide_id int, y int, x int")
    sums = G.box_sums(mask, slides, size, stride, [], {"n": F.lit(1)})
    counts = {r.patch_id: r.n for r in sums.collect()}
    for r in G.tissue_prop(mask, slides, size, stride).collect():
        n = sum(r.y <= y < r.y + size and r.x <= x < r.x + size for y, x in points)
        assert counts.get(r.patch_id, 0) == n and abs(r.tissue_prop - n / size**2) < 1e-6


def test_vertices_are_not_shuffled(spark):
    plan = plan_of(registered()["src_geojson"].build(spark, SF))
    assert not re.search(r"hashpartitioning\([^)]*vertex", plan)


def test_outlines_of_many_slides_share_folders(spark, tmp_path):
    rows = [(s, t, '{"type":"Feature","properties":{"tissue_id":%d,"name":"},\\"slide_id\\":7}"},"geometry":null}' % t) for s in range(-3, 300) for t in range(2)]
    features = spark.createDataFrame(rows, "slide_id int, tissue_id bigint, feature string")
    path = str(tmp_path / "out")
    sinks.write_geojson(features, path)
    assert len(list((tmp_path / "out").glob("shelf=*"))) <= sinks.SHELVES
    assert sorted(map(tuple, sinks.read_tissue(spark, path).collect())) == sorted((s, f) for s, _, f in rows)
    assert {r.slide_id for r in sinks.read_tissue(spark, path, [5, 17]).collect()} == {5, 17}
    for line in (r.value for r in spark.read.text(path).limit(5).collect()):
        assert set(json.loads(line)) == {"type", "properties", "geometry", "slide_id"}


def test_votes_are_summed_after_the_shuffle(spark):
    plan = plan_of(registered()["segmenter_plugin"].build(spark, SF))
    sums, python = plan.index("partial_avg"), plan.index("FlatMapGroupsInPandas")
    assert "REPARTITION_BY_NUM" in plan[sums:python]


def test_drawings_are_rasterized_like_vertices_without_a_shuffle(spark, monkeypatch):
    """Rows that hold a whole drawing each: the same pixels as ring by ring, and only words of united drawings are shuffled."""
    from histoframe.operators import ingest as N

    random.seed(8)
    docs = []
    for s, o in ((1, 0), (1, 1), (2, 0), (3, 0), (4, 0)):
        features = []
        for _ in range(6):
            rings = [[[random.uniform(-40, 260), random.choice([random.uniform(-5, 15), 2.5, 3.0])] for _ in range(random.randrange(1, 6))] for _ in range(3)]
            rings = [r + r[:1] if random.random() < 0.7 else r for r in rings]
            kind = random.choice(["Polygon", "MultiPolygon", "Point"])
            features.append({"type": "Feature", "geometry": {"type": kind, "coordinates": {"Polygon": rings, "MultiPolygon": [rings, rings[::-1]], "Point": rings[0][0]}[kind]}})
        docs.append((s, o, json.dumps({"type": "FeatureCollection", "features": features if s < 4 else []})))
    docs.append((2, 1, "{}"))
    text = spark.createDataFrame(docs, "slide_id int, o int, json string")
    slides = spark.createDataFrame([(1, 8, 200), (2, 12, 70), (4, 5, 5)], "slide_id int, height int, width int")
    keys = ["slide_id", "o"]
    drawings = readers.geojson_drawings(text, "json", keys)
    for union in (None, ["slide_id"]):
        want = N.rasterize_polygons(readers.flatten_geojson(text, "json", keys), slides, keys, union).collect()
        for most in (1, 1 << 20):
            monkeypatch.setattr(N, "MOST_CROSSINGS", most)
            got = N.rasterize_drawings(drawings, slides, keys, union).collect()
            assert len(want) > 300 and sorted(got) == sorted(want)
    odd = '{"features":[{"geometry":{"type":"Polygon","coordinates":[[[0,0],[null,1],[3,0],[3,2],null,[1],[0,2]],[]]}}]}'
    found = N.rasterize_drawings(readers.geojson_drawings(spark.createDataFrame([(1, odd)], "slide_id int, json string"), "json", ["slide_id"]), slides).collect()
    assert sorted(map(tuple, found)) == [(1, y, x) for y in range(2) for x in range(3)]
    plan = plan_of(registered()["poly_rasterize"].build(spark, SF))
    assert "Window" not in plan and not re.search(r"hashpartitioning\([^)]*(feature|word#\d+, [a-z])", plan)
    assert plan.count("Exchange hashpartitioning") == 2


def test_orders_are_shuffled_as_numbers(spark):
    for name in ("src_geojson", "poly_rasterize"):
        plan = plan_of(registered()[name].build(spark, SF))
        assert re.search(r"collect_list\(struct\(l_linenumber, l_linenumber#\d+, l_partkey, l_partkey#\d+L\)", plan)
