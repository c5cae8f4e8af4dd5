"""Patch-grid and patch-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import cells as C
from histoframe.operators import patches as G
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.pixels import DIVISOR

SIZE, STRIDE = 20, 16  # leaves an edge box
TILE = 16  # divides the frame
DENSE_SIZE, DENSE_STRIDE = 16, 5  # strong overlap


def starts_sql(size: int, stride: int) -> str:
    last = I.FRAME - size
    return f"(SELECT DISTINCT unnest(range(0, {last} + 1, {stride}) || [{last}]) AS at)"


def grid_sql(size: int, stride: int) -> str:
    return f"""grid AS (SELECT slide_id, CAST(row_number() OVER (PARTITION BY slide_id ORDER BY b.at, a.at) - 1 AS INT) AS patch_id,
            CAST(a.at AS INT) AS x, CAST(b.at AS INT) AS y FROM slides, {starts_sql(size, stride)} a, {starts_sql(size, stride)} b)"""


def inside(size: int, p: str = "p", g: str = "g") -> str:
    return f"{p}.slide_id = {g}.slide_id AND {p}.y >= {g}.y AND {p}.y < {g}.y + {size} AND {p}.x >= {g}.x AND {p}.x < {g}.x + {size}"


@workload("grid_patches", f"WITH {grid_sql(SIZE, STRIDE)} SELECT * FROM grid")
def grid_patches(spark, sf):
    return G.grid_patches(I.slides(spark, sf), SIZE, STRIDE)


@workload(
    "box_pixels",
    f"""WITH {grid_sql(SIZE, STRIDE)} SELECT g.slide_id, patch_id, c, p.y - g.y AS dy, p.x - g.x AS dx, v
        FROM pixels p JOIN grid g ON {inside(SIZE)}""",
)
def box_pixels(spark, sf):
    return G.box_pixels(I.pixels(spark, sf), I.slides(spark, sf), SIZE, STRIDE)


def prop_sql(size: int, stride: int) -> str:
    return f"""{grid_sql(size, stride)}, props AS (
        SELECT g.slide_id, patch_id, g.x, g.y, CAST(COUNT(p.slide_id) / {size * size} AS FLOAT) AS tissue_prop
        FROM grid g LEFT JOIN tissue_px p ON {inside(size)} GROUP BY 1, 2, 3, 4)"""


@workload("tissue_prop", f"WITH {prop_sql(SIZE, STRIDE)} SELECT slide_id, patch_id, x, y, ROUND(CAST(tissue_prop AS DOUBLE), 6) AS tissue_prop FROM props")
def tissue_prop(spark, sf):
    return G.tissue_prop(I.tissue_px(spark, sf), I.slides(spark, sf), SIZE, STRIDE).withColumn("tissue_prop", F.round(F.col("tissue_prop").cast("double"), 6))


@workload(
    "tissue_prop_dense",
    f"WITH {prop_sql(DENSE_SIZE, DENSE_STRIDE)} SELECT slide_id, patch_id, x, y, ROUND(CAST(tissue_prop AS DOUBLE), 6) AS tissue_prop FROM props",
)
def tissue_prop_dense(spark, sf):
    props = G.tissue_prop(I.tissue_px(spark, sf), I.slides(spark, sf), DENSE_SIZE, DENSE_STRIDE)
    return props.withColumn("tissue_prop", F.round(F.col("tissue_prop").cast("double"), 6))


@workload("tissue_cutoff", f"WITH {prop_sql(SIZE, STRIDE)} SELECT slide_id, patch_id, x, y FROM props WHERE tissue_prop >= 0.15::FLOAT")
def tissue_cutoff(spark, sf):
    props = G.tissue_prop(I.tissue_px(spark, sf), I.slides(spark, sf), SIZE, STRIDE)
    return props.filter(F.col("tissue_prop") >= F.lit(0.15).cast("float")).drop("tissue_prop")


@workload(
    "patch_counts",
    f"WITH {prop_sql(TILE, TILE)} SELECT slide_id, COUNT(*) AS n_patches, COUNT(*) FILTER (tissue_prop > 0) AS n_tissue FROM props GROUP BY 1",
)
def patch_counts(spark, sf):
    return G.patch_counts(G.tissue_prop(I.tissue_px(spark, sf), I.slides(spark, sf), TILE, TILE))


@workload(
    "integral_image",
    f"""SELECT slide_id, y, x, CAST(SUM(r) OVER (PARTITION BY slide_id, x ORDER BY y) AS BIGINT) AS sat FROM (
            SELECT slide_id, y, x, SUM(o) OVER (PARTITION BY slide_id, y ORDER BY x) AS r FROM (
                SELECT s.slide_id, CAST(a.i AS INT) AS y, CAST(b.i AS INT) AS x, CASE WHEN t.y IS NULL THEN 0 ELSE 1 END AS o
                FROM slides s CROSS JOIN range({I.FRAME}) a(i) CROSS JOIN range({I.FRAME}) b(i)
                LEFT JOIN tissue_px t ON t.slide_id = s.slide_id AND t.y = a.i AND t.x = b.i))""",
)
def integral_image(spark, sf):
    return G.integral_image(I.tissue_px(spark, sf), I.slides(spark, sf))


def _bright(spark, sf):
    return I.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("slide_id"),
        (F.col("l_orderkey") % 30 + 5).cast("int").alias("y"),
        (F.col("l_partkey") % 20 + 25).cast("int").alias("x"),
    ).distinct()


@workload(
    "bbox_prefilter",
    f"""WITH {grid_sql(SIZE, STRIDE)}, box AS (
            SELECT CAST(l_suppkey AS INT) AS s, MIN(l_orderkey % 30 + 5) AS y0, MAX(l_orderkey % 30 + 5) AS y1,
                   MIN(l_partkey % 20 + 25) AS x0, MAX(l_partkey % 20 + 25) AS x1 FROM lineitem GROUP BY 1)
        SELECT slide_id, patch_id, x, y FROM grid JOIN box ON s = slide_id
        WHERE x <= x1 AND x + {SIZE} > x0 AND y <= y1 AND y + {SIZE} > y0""",
)
def bbox_prefilter(spark, sf):
    return G.bbox_prefilter(G.grid_patches(I.slides(spark, sf), SIZE, STRIDE), _bright(spark, sf), SIZE)


@workload("tissue_bbox", "SELECT slide_id, MIN(y) AS y0, MAX(y) AS y1, MIN(x) AS x0, MAX(x) AS x1 FROM tissue_px GROUP BY 1")
def tissue_bbox(spark, sf):
    return G.mask_bbox(I.tissue_px(spark, sf))


def mean_sql(size: int, stride: int) -> str:
    return f"""{grid_sql(size, stride)},
        agg AS (SELECT g.slide_id, patch_id, c, SUM(v) / {DIVISOR} / (1e-6::DOUBLE + COUNT(*) FILTER (v <> 0)) AS value
                FROM pixels p JOIN slides s ON s.slide_id = p.slide_id JOIN grid g ON {inside(size)} GROUP BY 1, 2, 3, dtype),
        long AS (SELECT g.slide_id, g.patch_id, n.idx AS c, COALESCE(a.value, 0) AS value
                 FROM grid g JOIN (SELECT slide_id, idx FROM panel WHERE idx < 7 AND COALESCE(keep, TRUE)) n ON n.slide_id = g.slide_id
                 LEFT JOIN agg a ON a.slide_id = g.slide_id AND a.patch_id = g.patch_id AND a.c = n.idx)"""


def image_panel(spark, sf):
    """Kept panel channels that the seven-plane image has."""
    return I.panel(spark, sf).filter("idx < 7 AND COALESCE(keep, TRUE)").select("slide_id", "idx", "marker")


def mean_features(spark, sf, size: int = TILE, stride: int = TILE):
    return G.mean_marker(I.pixels(spark, sf), I.slides(spark, sf), image_panel(spark, sf), size, stride)


def rounded(long):
    return long.withColumn("value", F.round("value", 6))


@workload("mean_marker", f"WITH {mean_sql(TILE, TILE)} SELECT slide_id, patch_id, c, ROUND(value, 6) AS value FROM long")
def mean_marker(spark, sf):
    """Flagship: tiles side by side."""
    return rounded(G.feature_long(mean_features(spark, sf)))


@workload("mean_marker_edge", f"WITH {mean_sql(SIZE, STRIDE)} SELECT slide_id, patch_id, c, ROUND(value, 6) AS value FROM long")
def mean_marker_edge(spark, sf):
    return rounded(G.feature_long(mean_features(spark, sf, SIZE, STRIDE)))


@workload("mean_marker_overlap", f"WITH {mean_sql(DENSE_SIZE, DENSE_STRIDE)} SELECT slide_id, patch_id, c, ROUND(value, 6) AS value FROM long")
def mean_marker_overlap(spark, sf):
    return rounded(G.feature_long(mean_features(spark, sf, DENSE_SIZE, DENSE_STRIDE)))


@workload(
    "mean_marker_vec",
    f"""WITH {mean_sql(TILE, TILE)} SELECT slide_id, patch_id, string_agg(c, ',' ORDER BY c) AS channels,
            string_agg(CAST(CAST(ROUND(value * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY c) AS micro FROM long GROUP BY 1, 2""",
)
def mean_marker_vec(spark, sf):
    micro = F.transform("features", lambda v: F.round(v * 1000000).cast("bigint").cast("string"))
    return mean_features(spark, sf).select(
        "slide_id", "patch_id", F.array_join(F.col("channels").cast("array<string>"), ",").alias("channels"), F.array_join(micro, ",").alias("micro")
    )


@workload(
    "feature_pos_join",
    f"""WITH {mean_sql(TILE, TILE)} SELECT l.slide_id, l.patch_id, g.x, g.y, c, ROUND(value, 6) AS value FROM long l JOIN grid g ON g.slide_id = l.slide_id AND g.patch_id = l.patch_id""",
)
def feature_pos_join(spark, sf):
    from histoframe.operators.features import join_positions

    long = rounded(G.feature_long(mean_features(spark, sf)))
    return join_positions(long, G.grid_patches(I.slides(spark, sf), TILE, TILE), ["slide_id", "patch_id"])


@workload(
    "feature_join_bucketed",
    f"""WITH {mean_sql(TILE, TILE)} SELECT l.slide_id, l.patch_id, g.x, g.y, ROUND(CAST(tissue_prop AS DOUBLE), 6) AS tissue_prop, l.c, ROUND(l.value, 6) AS value
        FROM long l JOIN grid g ON g.slide_id = l.slide_id AND g.patch_id = l.patch_id
        JOIN (WITH {prop_sql(TILE, TILE)} SELECT * FROM props) t ON t.slide_id = l.slide_id AND t.patch_id = l.patch_id""",
)
def feature_join_bucketed(spark, sf):
    """Features, positions and tissue shares stored in the same buckets, joined as they lie."""
    from histoframe.operators.features import join_bucketed
    from histoframe.sources.sinks import write_bucketed

    slides, keys = I.slides(spark, sf), ["slide_id", "patch_id"]
    sets = {
        "features": mean_features(spark, sf).select(*keys, "channels", "features"),
        "positions": G.grid_patches(slides, TILE, TILE).select(*keys, "x", "y"),
        "shares": G.tissue_prop(I.tissue_px(spark, sf), slides, TILE, TILE).select(*keys, "tissue_prop"),
    }
    joined = join_bucketed(spark, [write_bucketed(df, name, keys, 16) for name, df in sets.items()], keys)
    share = F.round(F.col("tissue_prop").cast("double"), 6).alias("tissue_prop")
    long = joined.select(*keys, "x", "y", share, F.inline(F.arrays_zip("channels", "features")))
    return long.select(*keys, "x", "y", "tissue_prop", F.col("channels").alias("c"), F.round("features", 6).alias("value"))


CELLS = "cells AS (SELECT slide_id, cell_id, AVG(x) AS x, AVG(y) AS y, COUNT(*) AS cell_area FROM cell_px GROUP BY 1, 2)"
BOXES = f"{CELLS}, boxes AS (SELECT slide_id, cell_id, CAST(round_even(x, 0) AS INT) - 5 AS x, CAST(round_even(y, 0) AS INT) - 5 AS y FROM cells)"


@workload("cell_patches", f"WITH {BOXES} SELECT * FROM boxes")
def cell_patches(spark, sf):
    return G.cell_patches(C.cell_table(I.cell_px(spark, sf)), 11)


ISOLATED = f"""{BOXES}, isolated AS (
    SELECT p.slide_id, m.cell_id, p.c, p.y - b.y AS dy, p.x - b.x AS dx, p.v FROM pixels p JOIN cell_px m USING (slide_id, y, x)
    JOIN boxes b ON b.slide_id = p.slide_id AND b.cell_id = m.cell_id WHERE p.y - b.y BETWEEN 0 AND 10 AND p.x - b.x BETWEEN 0 AND 10)"""


def _isolated(spark, sf):
    mask = I.cell_px(spark, sf)
    return G.isolate_cells(I.pixels(spark, sf), mask, G.cell_patches(C.cell_table(mask), 11), 11)


@workload("cell_isolate", f"WITH {ISOLATED} SELECT * FROM isolated")
def cell_isolate(spark, sf):
    return _isolated(spark, sf)


@workload(
    "cell_box_pixels",
    f"""WITH {BOXES} SELECT b.slide_id, b.cell_id, c, p.y - b.y AS dy, p.x - b.x AS dx, v FROM boxes b
        JOIN pixels p ON p.slide_id = b.slide_id AND p.y - b.y BETWEEN 0 AND 10 AND p.x - b.x BETWEEN 0 AND 10""",
)
def cell_box_pixels(spark, sf):
    return G.cell_box_pixels(I.pixels(spark, sf), G.cell_patches(C.cell_table(I.cell_px(spark, sf)), 11), 11)


@workload(
    "cell_mean_marker",
    f"""WITH {ISOLATED}, seen AS (SELECT slide_id, cell_id, c, SUM(v) / {DIVISOR} / (1e-6::DOUBLE + COUNT(*)) AS value
            FROM isolated JOIN slides USING (slide_id) GROUP BY 1, 2, 3, dtype)
        SELECT cells.slide_id, cells.cell_id, CAST(k AS INT) AS c, ROUND(COALESCE(value, 0), 6) AS value
        FROM cells CROSS JOIN range(7) t(k) LEFT JOIN seen ON seen.slide_id = cells.slide_id AND seen.cell_id = cells.cell_id AND seen.c = k""",
)
def cell_mean_marker(spark, sf):
    planes = I.slides(spark, sf).select("slide_id", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("idx"))
    return rounded(G.cell_mean_marker(_isolated(spark, sf), I.slides(spark, sf), C.cell_table(I.cell_px(spark, sf)), planes))


CONFIGS = """configs AS (SELECT p_partkey AS id, 16 + p_size * 8 AS patch_size, CASE WHEN p_partkey % 3 = 0 THEN 8 + p_size * 4 END AS stride,
    CASE WHEN p_partkey % 3 = 1 THEN (p_size % 4) * 0.25::DOUBLE END AS overlap, ROUND(0.2::DOUBLE + p_retailprice / 10000, 5) AS mpp,
    CASE WHEN p_partkey % 5 = 0 THEN 'cell_centered' ELSE 'grid' END AS mode FROM part)"""


def _configs(spark, sf):
    key, size = F.col("p_partkey"), F.col("p_size")
    return I.table(spark, sf, "part").select(
        key.alias("id"),
        (16 + size * 8).alias("patch_size"),
        F.when(key % 3 == 0, 8 + size * 4).alias("stride"),
        F.when(key % 3 == 1, (size % 4) * X.d(0.25)).alias("overlap"),
        F.round(X.d(0.2) + F.col("p_retailprice") / 10000, 5).alias("mpp"),
        F.when(key % 5 == 0, F.lit("cell_centered")).otherwise(F.lit("grid")).alias("mode"),
    )


STRIDE_SQL = "COALESCE(stride, GREATEST(1, CAST(FLOOR(patch_size * (1 - COALESCE(overlap, 0))) AS INT)))"


@workload("effective_stride", f"WITH {CONFIGS} SELECT id, {STRIDE_SQL} AS stride FROM configs")
def effective_stride(spark, sf):
    stride = X.effective_stride(F.col("patch_size"), F.col("stride"), F.col("overlap"))
    return _configs(spark, sf).select("id", stride.alias("stride"))


def trim_sql(x: str, places: int) -> str:
    return f"regexp_replace(regexp_replace(format('{{:.{places}f}}', ROUND({x}, {places})), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"


@workload(
    "patch_slug",
    f"""WITH {CONFIGS} SELECT id, CASE WHEN mode = 'cell_centered' THEN 'cell_' ELSE '' END || {trim_sql('mpp', 4)} || 'mpp_' || patch_size || 'px'
            || CASE WHEN mode = 'grid' AND s < patch_size THEN '_' || {trim_sql('1 - s / patch_size', 6)} || 'overlap' ELSE '' END AS slug
        FROM (SELECT *, {STRIDE_SQL} AS s FROM configs)""",
)
def patch_slug(spark, sf):
    stride = X.effective_stride(F.col("patch_size"), F.col("stride"), F.col("overlap"))
    return _configs(spark, sf).select("id", X.patch_slug(F.col("mode"), F.col("mpp"), F.col("patch_size"), stride).alias("slug"))


@workload(
    "mpp_snap",
    f"""WITH {CONFIGS} SELECT id, CASE WHEN t IS NULL OR abs(t - mpp) / mpp <= 1e-3::DOUBLE THEN 'base' WHEN t > mpp THEN 'coarser_not_implemented' ELSE 'error_finer' END AS plan
        FROM (SELECT *, CASE id % 4 WHEN 0 THEN NULL WHEN 1 THEN mpp * 1.0005::DOUBLE WHEN 2 THEN mpp * 2 ELSE mpp / 2 END AS t FROM configs)""",
)
def mpp_snap(spark, sf):
    mpp, i = F.col("mpp"), F.col("id") % 4
    target = F.when(i == 1, mpp * X.d(1.0005)).when(i == 2, mpp * 2).when(i == 3, mpp / 2)
    return _configs(spark, sf).select("id", X.mpp_snap(mpp, target).alias("plan"))


@workload("small_patch_flag", f"WITH {CONFIGS} SELECT id, mode, patch_size, mode = 'cell_centered' AND patch_size < 128 AS small_patch FROM configs")
def small_patch_flag(spark, sf):
    return G.small_patch_flag(_configs(spark, sf).select("id", "mode", "patch_size"))
