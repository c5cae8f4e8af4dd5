"""Exact small results and brute-force comparisons."""

from itertools import product

import pytest
from pyspark.sql import functions as F

from histoframe.functions import names as N
from histoframe.functions import numeric as X
from histoframe.operators import cells as C
from histoframe.operators import evaluate as E
from histoframe.operators import markers as M
from histoframe.operators import patches as G
from histoframe.operators import pixels as P
from histoframe.operators import ranking as K
from histoframe.operators import runs as R
from histoframe.operators import stats as S
from histoframe.operators import status as Q
from histoframe.plans import encoders as PE


def slides(spark, h, w, **extra):
    df = spark.createDataFrame([(0, h, w, 0.5, "uint16")], "slide_id int, height int, width int, mpp double, dtype string")
    return df.withColumns({k: F.lit(v) for k, v in extra.items()})


def mask(spark, points):
    return spark.createDataFrame([(0, y, x) for y, x in points], "slide_id int, y int, x int")


def points(df):
    return {(r.y, r.x) for r in df.collect()}


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first().v


def test_names(spark):
    for raw, want in {"CD-8": "cd_8", "HLA-DR": "hla_dr", "CD8α(Opal650)": "cd8a_opal650_", "a/b": "ab"}.items():
        assert one(spark, N.clean_marker(F.lit(raw))) == want
    assert {one(spark, N.match_key(F.lit(r))) for r in ("CD-8", "CD_8", "CD 8", "CD8")} == {"cd8"}
    assert [one(spark, N.is_qc_channel(F.lit(r))) for r in ("blank", "emptyA488-1", "HOECHST1", "CD3")] == [True, True, True, False]
    assert one(spark, N.slugify(F.lit("Immune Panel.v2"))) == "immune_panel_v2"
    assert one(spark, N.output_stem(F.lit("case1.ome.tiff"))) == "case1"


def test_numbers(spark):
    assert one(spark, X.dtype_divisor(F.lit(">u2"))) == 65535.0
    assert one(spark, X.dtype_divisor(F.lit("float32"))) == 1.0
    with pytest.raises(Exception, match="unsupported pixel type"):
        one(spark, X.dtype_divisor(F.lit("uint32")))
    assert one(spark, X.patch_slug(F.lit("grid"), F.lit(0.5), F.lit(256), F.lit(128))) == "0.5mpp_256px_0.5overlap"
    assert one(spark, X.patch_slug(F.lit("cell_centered"), F.lit(0.5), F.lit(64), F.lit(64))) == "cell_0.5mpp_64px"
    assert [one(spark, X.human_duration(F.lit(s))) for s in (0.042, 8.4, 92.0, 1.15)] == ["0.042s", "8.4s", "1m 32s", "1.1s"]


def test_grid_and_tissue(spark):
    s = slides(spark, 64, 64)
    got = [(r.x, r.y) for r in G.grid_patches(s, 32, 32).orderBy("patch_id").collect()]
    assert got == [(0, 0), (32, 0), (0, 32), (32, 32)]
    tissue = mask(spark, product(range(32), range(32)))
    assert [r.tissue_prop for r in G.tissue_prop(tissue, s, 32, 32).orderBy("patch_id").collect()] == [1, 0, 0, 0]
    assert G.grid_patches(slides(spark, 20, 20), 32, 32).count() == 0


def test_overlapping_props_match_brute_force(spark):
    s, pts = slides(spark, 23, 31), {(y, x) for y in range(23) for x in range(31) if (y * 7 + x * 3) % 5 == 0}
    for size, stride in ((8, 3), (8, 8), (9, 7)):
        for r in G.tissue_prop(mask(spark, pts), s, size, stride).collect():
            want = sum((y, x) in pts for y in range(r.y, r.y + size) for x in range(r.x, r.x + size)) / size**2
            assert abs(r.tissue_prop - want) < 1e-6


def test_mean_marker(spark):
    px = spark.createDataFrame([(0, 0, 0, 0, 2), (0, 0, 1, 0, 4)], "slide_id int, c int, y int, x int, v int")
    panel = spark.createDataFrame([(0, 0, "a"), (0, 1, "b")], "slide_id int, idx int, marker string")
    row = G.mean_marker(px, slides(spark, 2, 2), panel, 2, 2).first()
    assert row.features[0] == pytest.approx(3.0 / 65535, rel=1e-6) and row.features[1] == 0.0


def test_cells(spark):
    px = spark.createDataFrame([(0, y, x, 1) for y in (2, 3) for x in (2, 3)], "slide_id int, y int, x int, cell_id int")
    r = C.cell_table(px).first()
    assert (r.cell_id, r.x, r.y, r.cell_area) == (1, 2.5, 2.5, 4)
    cents = spark.createDataFrame([(0, 7, 50.0, 40.0), (0, 9, 1.0, 1.0)], "slide_id int, cell_id int, x double, y double")
    assert [(r.x, r.y) for r in G.cell_patches(cents, 16).orderBy("cell_id").collect()] == [(42, 32), (-7, -7)]


def test_block_mean_and_region_key(spark):
    px = spark.createDataFrame([(0, 0, y, x, 4) for y in (0, 1) for x in (2, 3)], "slide_id int, c int, y int, x int, v int")
    assert [(r.y, r.x, r.v) for r in P.downsample_mean(px, slides(spark, 2, 4), 2).collect()] == [(0, 1, 4)]
    half = mask(spark, product(range(2), range(4)))
    assert S.region_keys(half, slides(spark, 4, 4)).first().region_key == "(4, 4):8:65535.0"


def test_pooling_equals_union(spark):
    parts = [[0.1, 0.5, 0.9], [0.2], [0.4, 0.45]]
    rows = []
    for i, p in enumerate(parts):
        mu = sum(p) / len(p)
        rows.append((i, "M-1", len(p), mu, sum((v - mu) ** 2 for v in p) / (len(p) - 1) if len(p) > 1 else 0.0))
    df = spark.createDataFrame(rows, "slide_id int, marker string, n bigint, mean double, var double")
    r, every = S.pool_stats(df).first(), [v for p in parts for v in p]
    mu = sum(every) / len(every)
    assert r["mean"] == pytest.approx(mu) and r["std"] == pytest.approx((sum((v - mu) ** 2 for v in every) / 5) ** 0.5)


def test_marker_map(spark):
    df = spark.createDataFrame([("DAPI", "DAPI", "RESOLVED", "yes"), ("MyTarget", "MyTarget", "NOVEL", "no")],
                               "original_name string, mapped_canonical_name string, status string, keep_for_analysis string")
    got = {r.original_name: (r.name, r.level, r.keep) for r in M.resolve_marker_map(df).collect()}
    assert got == {"DAPI": ("DAPI", "RESOLVED", True), "MyTarget": ("MyTarget", "NOVEL", False)}
    with pytest.raises(Exception, match="matches no marker"):
        M.apply_panel_keep(df, M.Selection(include=("zz*",))).collect()


def test_suggestions(spark):
    reg = spark.createDataFrame([(0, "CD8", "t"), (1, "CD4", "t"), (2, "CD40", "b")], "pos bigint, marker_name string, family string")
    names = spark.createDataFrame([("CD24",), ("CD400",)], "raw string")
    got = {(r.raw, r["rank"]): r.suggestion for r in M.suggest_markers(names, M.registry_index(reg)).collect()}
    assert got[("CD400", 1)] == "CD40" and got[("CD24", 1)] == "CD4"


def flood(pts, steps):
    left, comps = set(pts), []
    while left:
        todo, comp = [left.pop()], set()
        while todo:
            p = todo.pop()
            comp.add(p)
            for dy, dx in steps:
                q = (p[0] + dy, p[1] + dx)
                if q in left:
                    left.remove(q)
                    todo.append(q)
        comps.append(frozenset(comp))
    return set(comps)


N4 = [(-1, 0), (1, 0), (0, -1), (0, 1)]
N8 = N4 + [(-1, -1), (-1, 1), (1, -1), (1, 1)]
SHAPES = {
    "squares": {(y, x) for y in range(4) for x in range(4)} | {(y, x) for y in range(4, 8) for x in range(4, 8)},
    "ring": {(y, x) for y in range(7) for x in range(7) if y in (1, 5) and 1 <= x <= 5 or x in (1, 5) and 1 <= y <= 5},
    "open": {(0, 1), (1, 0), (1, 1), (9, 9)},
    "noise": {(y, x) for y in range(12) for x in range(150) if (y * y * 5 + x * 11 + y * x) % 7 < 3},
}


@pytest.mark.parametrize("shape", ["ring", "noise"])
def test_components(spark, shape):
    pts = SHAPES[shape]
    found = {}
    for r in R.connected_components(mask(spark, pts), diagonal=True).collect():
        found.setdefault(r.component, set()).add((r.y, r.x))
    assert {frozenset(v) for v in found.values()} == flood(pts, N8)


@pytest.mark.parametrize("shape", list(SHAPES))
def test_closing(spark, shape):
    h, w, pts = 12, 150, SHAPES[shape]
    disk = [(dy, dx) for dy in range(-2, 3) for dx in range(-2, 3) if dy * dy + dx * dx <= 4]
    frame = set(product(range(h), range(w)))
    grown = {(y + dy, x + dx) for y, x in pts for dy, dx in disk} & frame
    off = frame - grown
    want = frame - {(y + dy, x + dx) for y, x in off for dy, dx in disk}
    got = points(R.to_pixels(R.close_runs(R.to_runs(mask(spark, pts)), slides(spark, h, w, radius=2))))
    assert got == want and pts <= got


def test_fill_holes(spark):
    got = points(R.to_pixels(R.fill_holes(R.to_runs(mask(spark, SHAPES["ring"])), slides(spark, 7, 7))))
    assert got == set(product(range(1, 6), range(1, 6)))
    open_ = SHAPES["open"]
    assert points(R.to_pixels(R.fill_holes(R.to_runs(mask(spark, open_)), slides(spark, 10, 10)))) == open_


def test_complement_roundtrip(spark):
    s, pts = slides(spark, 12, 150), SHAPES["noise"]
    off = R.complement(R.to_runs(mask(spark, pts)), s)
    assert points(R.to_pixels(off)) == set(product(range(12), range(150))) - pts


def test_ranks_do_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 3)
    a = {(r.id, r["rank"]) for r in K.hash_rank(df.repartition(1), ["g"], "id", 7).collect()}
    b = {(r.id, r["rank"]) for r in K.hash_rank(df.repartition(8), ["g"], "id", 7).collect()}
    assert a == b and {r for i, r in a if i % 3 == 0} == set(range(1, 168))


def test_weighted_sample(spark):
    df = spark.range(300).select(F.col("id").alias("cell_id"), F.when(F.col("id") < 10, "rare").otherwise("common").alias("label"))
    out = E.weighted_sample(df, 2000, "cell_id")
    n = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert out.count() == 2000 and abs(n["rare"] - 1000) < 150


def test_registry():
    register, get, names = PE.make_registry(PE.Encoder)
    with pytest.raises(TypeError):
        register("x")(int)
    cls = register("a")(type("A", (PE.Encoder,), {}))
    assert get("a") is cls and names() == ["a"]
    with pytest.warns(UserWarning):
        register("a")(type("B", (PE.Encoder,), {}))
    with pytest.raises(KeyError):
        get("zz")


def test_polygons_draw_in_file_order(spark):
    """The hole of a later polygon clears what an earlier one filled."""
    def ring(feature, number, x0, y0, side):
        corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
        return [(1, feature, 0, number, k, float(x0 + dx * side), float(y0 + dy * side)) for k, (dx, dy) in enumerate(corners)]

    from histoframe.operators import ingest

    rows = ring(0, 0, 0, 0, 10) + ring(1, 0, 0, 0, 10) + ring(1, 1, 3, 3, 4)
    vertices = spark.createDataFrame(rows, "slide_id int, feature int, part int, ring int, vertex int, x double, y double")
    slides = spark.createDataFrame([(1, 20, 20)], "slide_id int, height int, width int")
    assert ingest.rasterize_polygons(vertices, slides).count() == 84


def test_small_island_stays_in_a_large_frame(spark):
    from histoframe.operators import tissue

    islands = spark.createDataFrame([(1, 2051 + i, 1003, 1009) for i in range(7)] + [(1, 100, 100, 900)], "slide_id int, y int, x0 int, x1 int")
    slides = spark.createDataFrame([(1, 4096, 4096, 0.5)], "slide_id int, height int, width int, mpp double")
    region = tissue.tissue_region(islands, slides, max_bridge_um=4.0)
    assert region.filter("y BETWEEN 2051 AND 2057 AND x0 <= 1003 AND x1 >= 1009").count() == 7


def test_variance_of_float_pixels(spark):
    from histoframe.operators import stats

    values = [0.9, 0.9 + 1e-8, 0.9 + 2e-8]
    pixels = spark.createDataFrame([(1, 0, 0, i, v) for i, v in enumerate(values)], "slide_id int, c int, y int, x int, v double")
    mask = spark.createDataFrame([(1, 0, i) for i in range(3)], "slide_id int, y int, x int")
    slides = spark.createDataFrame([(1, 4, 4, "float32")], "slide_id int, height int, width int, dtype string")
    targets = spark.createDataFrame([(1, 0, "m")], "slide_id int, idx int, marker string")
    var = stats.novel_partials(pixels, mask, slides, targets).first()["var"]
    assert abs(var - 1e-16) < 1e-18


def test_glob_problems_are_per_slide(spark):
    from histoframe.operators import markers

    channels = spark.createDataFrame([(1, 0, "dapi", True), (2, 0, "cd3", True)], "slide_id int, idx int, marker string, keep boolean")
    wanted = markers.Selection(include=("dapi",))
    found = {(r.slide_id, r.problem) for r in markers.selection_problems(channels, wanted).collect()}
    assert found == {(2, "dapi matches no marker"), (2, "the selection leaves no channel")}
    unstained = markers.Selection(include=("c*", "d*"), exclude=("dapi",))
    both = spark.createDataFrame([(1, 0, "DAPI", True), (1, 1, "cd3", True)], channels.schema)
    assert [r.problem for r in markers.selection_problems(both, unstained).collect()] == ["the selection leaves no nuclear stain"]
    with pytest.raises(Exception, match="slide 2"):
        markers.marker_glob_select(channels, wanted).collect()
    assert markers.marker_glob_select(channels.filter("slide_id = 1"), wanted).count() == 1


def test_pooling_without_pixels_is_an_error(spark):
    from histoframe.operators import stats

    partials = spark.createDataFrame([(1, "a", "k", 0, 0.0, 0.0)], "slide_id int, marker string, region_key string, n long, mean double, var double")
    with pytest.raises(Exception, match="no tissue pixels"):
        stats.pool_stats(partials).collect()


def test_scratch_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from histoframe.session import shared_root

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    cluster = SimpleNamespace(conf=Conf, sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(cluster)


def test_blank_channels_have_statistics(spark):
    pixels = spark.createDataFrame([(1, 0, 0, 0, 5)], "slide_id int, c int, y int, x int, v int")
    slides = spark.createDataFrame([(1, 2, 2)], "slide_id int, height int, width int")
    panel = spark.createDataFrame([(1, 0), (1, 1)], "slide_id int, c int")
    assert {tuple(r) for r in P.channel_minmax(pixels, slides, channels=panel).collect()} == {(1, 0, 0, 5), (1, 1, 0, 0)}
    found = {r.c: (r.lo, r.hi) for r in P.channel_percentiles(pixels, slides, channels=panel).collect()}
    assert found.keys() == {0, 1} and found[1] == (0, 0)


def test_blank_patches_are_encoded(spark):
    from histoframe.plans import encoders

    class Total(encoders.Encoder):
        name, version, required_markers = "total", "1", ()

        def forward(self, model, batch, markers):
            return batch.sum((2, 3))

    pixels = spark.createDataFrame([(1, 0, 0, 0, 5), (1, 3, 0, 0, 9)], "slide_id int, c int, y int, x int, v int")
    slides = spark.createDataFrame([(1, 4, 4)], "slide_id int, height int, width int")
    tensors = encoders.patch_tensors(pixels, slides, 2, 2)
    out = sorted(tuple(r.features) for r in encoders.encode(tensors, Total(), [0, 1], ["a", "b"], 2).collect())
    assert out == [(0.0, 0.0)] * 3 + [(5.0, 0.0)]


def test_communities_run_to_rest(spark):
    from histoframe.operators.graph import communities

    n = 256
    pairs = [(i, i + 1) for i in range(n - 1)]
    label = {r.node: r.label for r in communities(spark.createDataFrame(pairs + [(b, a) for a, b in pairs], "src long, dst long"), 0.05).collect()}
    total = {}
    for node in range(n):
        total[label[node]] = total.get(label[node], 0) + (1 if node in (0, n - 1) else 2)
    # No two neighbouring communities would gain by becoming one.
    cuts = [(label[a], label[b]) for a, b in pairs if label[a] != label[b]]
    assert all(cuts.count((x, y)) + cuts.count((y, x)) <= 0.05 * total[x] * total[y] / (2 * n - 2) + 1e-6 for x, y in cuts)


def test_a_table_that_is_a_folder_is_listed_once(spark, tmp_path):
    from histoframe.workloads.ingest import src_inputs

    spark.range(20).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    (tmp_path / "part.parquet").write_bytes(b"x")
    assert sorted(r.stem for r in src_inputs(spark, str(tmp_path)).collect()) == ["events", "part"]


def test_stale_to_the_microsecond(spark):
    """A task a few microseconds older than a day is stale, one of exactly a day is not."""
    rows = [(1, "00:00:10.900000"), (2, "00:00:10.900001"), (3, "00:00:10.100000"), (4, "00:00:10.899999")]
    tasks = spark.createDataFrame([(i, "ingest", "", "running", f"2024-01-01 {at}") for i, at in rows], "slide_id int, stage string, task_key string, status string, ts string")
    for kind in ("timestamp", "timestamp_ntz"):
        found = Q.stale_running(tasks.withColumn("ts", F.col("ts").cast(kind)), F.lit("2024-01-02 00:00:10.900000").cast(kind))
        assert sorted(r.slide_id for r in found.collect()) == [3, 4]
