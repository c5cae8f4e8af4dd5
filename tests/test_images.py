"""Sparse images, boxes at any place, named channels."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from histoframe.operators import markers as M
from histoframe.operators import patches as G
from histoframe.operators.images import SparseImage
from histoframe.plans import encoders


def image_of(spark, seed=1, height=5, width=7, channels=3):
    r = random.Random(seed)
    counts = {(c, y, x): r.randrange(1, 200) for c in range(channels - 1) for y in range(height) for x in range(width) if r.random() < 0.4}
    pixels = spark.createDataFrame([(1, *k, v) for k, v in counts.items()], "slide_id int, c int, y int, x int, v int")
    slides = spark.createDataFrame([(1, height, width)], "slide_id int, height int, width int")
    panel = spark.createDataFrame([(1, c) for c in range(channels)], "slide_id int, c int")
    dense = np.zeros((channels, height, width))
    for k, v in counts.items():
        dense[k] = v
    return SparseImage.of_counts(pixels, panel, slides), dense


def laid_out(image, shape):
    out = np.full(shape, np.nan)
    for r in image.dense().collect():
        assert np.isnan(out[r.c, r.y, r.x])
        out[r.c, r.y, r.x] = r.value
    return out


def test_transforms_reach_the_background(spark, tmp_path):
    image, dense = image_of(spark)
    stats = spark.createDataFrame([(1, c, 10.0 + c, 2.0 + c) for c in range(3)], "slide_id int, c int, mean double, std double")
    scored = (dense - np.array([10, 11, 12])[:, None, None]) / np.array([2, 3, 4])[:, None, None]
    image.zscored(stats).write(str(tmp_path / "z"))
    z = SparseImage.read(spark, str(tmp_path / "z"))
    assert np.allclose(laid_out(z, dense.shape), scored)
    bounds = spark.createDataFrame([(1, c, 0.0, 100.0) for c in range(3)], "slide_id int, c int, lo double, hi double")
    gray = laid_out(image.grayed(bounds), dense.shape)
    assert (gray[dense == 0] == 255).all() and np.array_equal(gray, np.floor((1 - np.clip(dense / 100, 0, 1)) * 255))
    weights = [F.lit(0.5), F.col("c") + 1.0]
    summed = np.stack([scored.sum(0) * 0.5, (scored * np.array([1, 2, 3])[:, None, None]).sum(0)])
    assert np.allclose(laid_out(z.summed(weights), summed.shape), summed)
    totals = {r.c: r for r in z.totals().collect()}
    for c in range(3):
        assert totals[c].n == 35 and np.allclose([totals[c].total, totals[c].lo, totals[c].hi], [scored[c].sum(), scored[c].min(), scored[c].max()])


def test_tensors_start_from_the_background(spark):
    image, dense = image_of(spark, 2, 4, 4)
    shifted = image.mapped(lambda v: v - 5)

    class Whole(encoders.Encoder):
        name, dim = "whole", 48

        def load(self):
            return None

        def transform(self, batch, markers):
            return batch

        def forward(self, model, batch, markers):
            return batch.reshape(len(batch), -1)

    tensors = encoders.patch_tensors(shifted.pixels.withColumnRenamed("value", "v"), image.slides, 4, 4, shifted.background)
    (row,) = encoders.encode(tensors, Whole(), [0, 1, 2], ["a", "b", "c"], 4).collect()
    assert np.array_equal(np.array(row.features), (dense - 5).reshape(-1))


def test_boxes_at_any_place(spark):
    r = random.Random(4)
    pixels = {(s, c, y, x): r.randrange(1, 99) for s in (1, 2) for c in (0, 1) for y in range(30) for x in range(20) if r.random() < 0.3}
    boxes = [(s, i, r.randrange(-8, 32), r.randrange(-8, 22)) for s in (1, 2) for i in range(40)] + [(3, 1, 0, 0)]
    got = G.cell_box_pixels(
        spark.createDataFrame([(*k, v) for k, v in pixels.items()], "slide_id int, c int, y int, x int, v int"),
        spark.createDataFrame(boxes, "slide_id int, cell_id int, y int, x int"), 7,
    ).collect()
    want = {(s, i, c, y - by, x - bx, v) for s, i, by, bx in boxes for (t, c, y, x), v in pixels.items() if s == t and 0 <= y - by < 7 and 0 <= x - bx < 7}
    assert {tuple(g) for g in got} == want and len(got) == len(want)


def test_named_channels_and_stains(spark):
    panel = spark.createDataFrame([(1, 0, "DAPI", True), (1, 1, "HLA-DR", True), (1, 2, "hla_dr", None), (2, 0, "hla dr", True), (2, 1, "cd3", False)], "slide_id int, idx int, marker string, keep boolean")
    assert {tuple(r) for r in M.nuclear_channel(panel, strict=False).collect()} == {(1, "DAPI", 0), (2, None, None)}
    assert {tuple(r) for r in M.nuclear_channel(panel, "hla-dr").collect()} == {(1, "HLA-DR", 1), (2, "hla dr", 0)}
    for named in (None, "cd3"):
        with pytest.raises(Exception, match="slide [12]: n"):
            M.nuclear_channel(panel, named).collect()
    aliases = spark.createDataFrame([("mhc2", "hla_dr")], "alias string, name string")
    found = {(r.slide_id, r.place, r.idx, r.level) for r in M.named_channels(panel, ["MHC2", "Hla-Dr"], aliases).collect()}
    assert found == {(1, 0, 1, "alias"), (2, 0, 0, "alias"), (1, 1, 1, "exact"), (2, 1, 0, "exact")}
    with pytest.raises(Exception, match="slide 1: marker cd3 is not on the panel"):
        M.named_channels(panel, ["cd3"]).collect()
    assert M.named_channels(panel, []).count() == 0


def test_bucketed_tables_join_without_a_shuffle(spark):
    from histoframe.operators.features import join_bucketed
    from histoframe.sources.sinks import write_bucketed

    keys = ["slide_id", "patch_id"]
    left = spark.range(400).selectExpr("cast(id % 7 as int) as slide_id", "cast(id as int) as patch_id", "id * 2 as a")
    tables = [write_bucketed(left.withColumnRenamed("a", name), name, keys, 4) for name in ("first", "second", "third")]
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_bucketed(spark, tables, keys)
        assert joined.count() == 400 and joined.filter("first <> second OR second <> third").count() == 0
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") >= 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        for table in tables:
            spark.sql(f"DROP TABLE {table}")


def test_feature_sets_share_folders_and_a_rewrite_keeps_other_slides(spark, tmp_path):
    """A folder per slide made a small file of every slide."""
    from histoframe.sources import sinks

    def stored(ids, value):
        keys = "'s' as slug, 'e' as encoder, 'markers_all' as variant"
        features = spark.range(1).selectExpr(f"explode(array({','.join(map(str, ids))})) as slide_id", "0 as patch_id", f"array({value}d) as features", keys.split(", ")[0], keys.split(", ")[1], keys.split(", ")[2])
        sinks.write_features(features, features.selectExpr("slide_id", "slug", "encoder", "variant", "array('m') as markers_used"), str(tmp_path))

    stored(range(300), 1)
    stored([7, 300], 2)
    found = {r.slide_id: r.features for r in sinks.read_features(spark, str(tmp_path), "e", "s").collect()}
    assert found == {**{i: [1.0] for i in range(300)}, 7: [2.0], 300: [2.0]}
    assert spark.read.parquet(str(tmp_path / "meta")).count() == 301
    assert len(list(tmp_path.glob("features/*/*/*/*/"))) <= sinks.SHELVES + 1


def test_written_image_has_files_by_size_not_by_channel(spark, tmp_path):
    rows = [(s, c, 0, 0, 1.0) for s in range(40) for c in range(3)]
    pixels = spark.createDataFrame(rows, "slide_id int, c int, y int, x int, value double")
    slides = spark.createDataFrame([(s, 1, 1) for s in range(40)], "slide_id int, height int, width int")
    image = SparseImage(pixels, pixels.select("slide_id", "c", "value"), slides)
    image.write(str(tmp_path))
    assert sorted(SparseImage.read(spark, str(tmp_path)).pixels.collect()) == sorted(rows)
    assert len(list(tmp_path.glob("pixels/**/*.parquet"))) < 40
