"""Raster-topology and tissue queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import patches as G
from histoframe.operators import runs as R
from histoframe.operators import tissue as T
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.patches import SIZE, STRIDE, grid_sql, inside

N4 = "(VALUES (-1, 0), (1, 0), (0, -1), (0, 1)) d(dy, dx)"
N8 = "(VALUES (-1, -1), (-1, 0), (-1, 1), (0, -1), (0, 1), (1, -1), (1, 0), (1, 1)) d(dy, dx)"


def reach_sql(name: str, mask: str, steps: str) -> str:
    """Every (pixel, reachable pixel code) pair by recursion."""
    return f"""{name} AS (SELECT slide_id, y, x, y * 100 + x AS r FROM {mask}
        UNION SELECT m.slide_id, m.y, m.x, q.r FROM {name} q, {steps}, {mask} m WHERE m.slide_id = q.slide_id AND m.y = q.y + dy AND m.x = q.x + dx)"""


def comps_sql(name: str, mask: str, steps: str) -> str:
    return f"{reach_sql(name + '_reach', mask, steps)}, {name} AS (SELECT slide_id, y, x, MIN(r) AS comp FROM {name}_reach GROUP BY 1, 2, 3)"


def _runs(spark, sf):
    return R.to_runs(I.tissue_px(spark, sf))


def _min(spark, sf, n, name="min_area"):
    return I.slides(spark, sf).select("slide_id", F.lit(n).alias(name))


@workload(
    "connected_components",
    f"""WITH RECURSIVE {comps_sql('c4', 'tissue_px', N4)}
        SELECT slide_id, y, x, dense_rank() OVER (PARTITION BY slide_id ORDER BY comp) AS component FROM c4""",
)
def connected_components(spark, sf):
    return R.connected_components(I.tissue_px(spark, sf))


@workload(
    "connected_components_8",
    f"""WITH RECURSIVE {comps_sql('c8', 'tissue_px', N8)}
        SELECT slide_id, y, x, dense_rank() OVER (PARTITION BY slide_id ORDER BY comp) AS component FROM c8""",
)
def connected_components_8(spark, sf):
    return R.connected_components(I.tissue_px(spark, sf), diagonal=True)


@workload(
    "remove_small",
    f"""WITH RECURSIVE {comps_sql('c4', 'tissue_px', N4)}
        SELECT slide_id, y, x FROM (SELECT *, COUNT(*) OVER (PARTITION BY slide_id, comp) AS n FROM c4) WHERE n >= 4""",
)
def remove_small(spark, sf):
    return R.to_pixels(R.remove_small(_runs(spark, sf), _min(spark, sf, 4)))


FRAME_SQL = f"frame AS (SELECT slide_id, CAST(a.i AS INT) AS y, CAST(b.i AS INT) AS x FROM slides, range({I.FRAME}) a(i), range({I.FRAME}) b(i))"
THICK = "thick AS (SELECT DISTINCT slide_id, y + dy AS y, x + dx AS x FROM tissue_px, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(dy, dx) WHERE y + dy < 48 AND x + dx < 48)"
EDGE = f"{I.FRAME - 1}"
HOLES = f"""{THICK}, {FRAME_SQL}, back AS (SELECT * FROM frame EXCEPT SELECT slide_id, y, x FROM thick),
    outside AS (SELECT slide_id, y, x FROM back WHERE y IN (0, {EDGE}) OR x IN (0, {EDGE})
        UNION SELECT m.slide_id, m.y, m.x FROM outside q, {N8}, back m WHERE m.slide_id = q.slide_id AND m.y = q.y + dy AND m.x = q.x + dx),
    hole AS (SELECT * FROM back EXCEPT SELECT * FROM outside), {comps_sql('hc', 'hole', N8)}"""


def _thick(spark, sf):
    """Mask grown by one pixel right and down, dense enough to enclose holes."""
    steps = F.array(*[F.struct(F.lit(dy).alias("dy"), F.lit(dx).alias("dx")) for dy in (0, 1) for dx in (0, 1)])
    px = I.tissue_px(spark, sf).select("slide_id", "y", "x", F.inline(steps))
    return px.select("slide_id", (F.col("y") + F.col("dy")).alias("y"), (F.col("x") + F.col("dx")).alias("x")).filter("y < 48 AND x < 48").distinct()


@workload(
    "fill_holes",
    f"""WITH RECURSIVE {HOLES} SELECT slide_id, y, x FROM thick UNION ALL
        SELECT slide_id, y, x FROM (SELECT *, COUNT(*) OVER (PARTITION BY slide_id, comp) AS n FROM hc) WHERE n <= 6""",
)
def fill_holes(spark, sf):
    return R.to_pixels(R.fill_holes(R.to_runs(_thick(spark, sf)), I.slides(spark, sf), _min(spark, sf, 6, "max_area")))


DISK2 = "(SELECT a.i - 2 AS dy, b.i - 2 AS dx FROM range(5) a(i), range(5) b(i) WHERE (a.i - 2) * (a.i - 2) + (b.i - 2) * (b.i - 2) <= 4)"


@workload(
    "morph_close",
    f"""WITH {FRAME_SQL}, grown AS (SELECT DISTINCT slide_id, CAST(y + dy AS INT) AS y, CAST(x + dx AS INT) AS x FROM tissue_px, {DISK2}
            WHERE y + dy BETWEEN 0 AND {EDGE} AND x + dx BETWEEN 0 AND {EDGE}),
        off AS (SELECT * FROM frame EXCEPT SELECT * FROM grown)
        SELECT * FROM frame EXCEPT SELECT slide_id, CAST(y + dy AS INT), CAST(x + dx AS INT) FROM off, {DISK2}""",
)
def morph_close(spark, sf):
    return R.to_pixels(R.close_runs(_runs(spark, sf), I.slides(spark, sf).withColumn("radius", F.lit(2))))


def _cleanup(spark, sf):
    limits = {"min_area": F.lit(9), "max_hole": F.lit(6), "radius": F.lit(1)}
    return R.cleanup(R.to_runs(_thick(spark, sf)), I.slides(spark, sf).withColumns(limits))


@workload("mask_cleanup")
def mask_cleanup(spark, sf):
    """Pixels of each slide's clean mask and the component count of each stage; slides of which nothing is left count 0."""
    mask, counts = _cleanup(spark, sf)
    area = mask.groupBy("slide_id").agg(F.sum(F.col("x1") - F.col("x0") + 1).alias("area"))
    stages = [c for c in counts.columns if c != "slide_id"]
    return counts.join(area, "slide_id", "left").select("slide_id", F.coalesce("area", F.lit(0).cast("bigint")).alias("area"), *stages)


@workload(
    "region_stats",
    f"""WITH RECURSIVE {comps_sql('c8', 'tissue_px', N8)},
        full4 AS (SELECT c.slide_id, c.y, c.x, COUNT(*) AS n FROM c8 c, {N4}, tissue_px t
                  WHERE t.slide_id = c.slide_id AND t.y = c.y + dy AND t.x = c.x + dx GROUP BY 1, 2, 3)
        SELECT c8.slide_id, COUNT(*) AS area, MIN(x) AS x0, MAX(x) AS x1, MIN(y) AS y0, MAX(y) AS y1, COUNT(*) FILTER (COALESCE(n, 0) < 4) AS n_boundary
        FROM c8 LEFT JOIN full4 USING (slide_id, y, x) GROUP BY slide_id, comp""",
)
def region_stats(spark, sf):
    return R.region_stats(_runs(spark, sf)).drop("comp")


@workload(
    "upsample_nearest",
    f"""SELECT t.slide_id, CAST(a.i AS INT) AS y, CAST(b.i AS INT) AS x FROM range(110) a(i), range(130) b(i) JOIN tissue_px t
        ON t.y = CAST(FLOOR(a.i * 48 / 110) AS INT) AND t.x = CAST(FLOOR(b.i * 48 / 130) AS INT)""",
)
def upsample_nearest(spark, sf):
    native = I.slides(spark, sf).withColumn("height", F.lit(110)).withColumn("width", F.lit(130))
    return T.resize_nearest(I.tissue_px(spark, sf), native, F.lit(I.FRAME), F.lit(I.FRAME))


@workload("tissue_region")
def tissue_region(spark, sf):
    return R.to_pixels(T.tissue_region(_runs(spark, sf), I.slides(spark, sf), max_bridge_um=2.0))


def _nuclear(spark, sf):
    return I.slides(spark, sf).select("slide_id", F.lit(0).alias("idx"))


def _structural(spark, sf):
    return I.panel(spark, sf).filter("hint IN ('ECONOMY', 'PROMO') AND idx BETWEEN 1 AND 6").select("slide_id", "idx")


@workload("detect_tissue_otsu")
def detect_tissue_otsu(spark, sf):
    """Coarse 6 x 6 blocks as the image, so that islands have some size."""
    block = [F.floor(F.col(a) / 2).cast("int").alias(a) for a in ("y", "x")]
    px = I.pixels(spark, sf).groupBy("slide_id", "c", *block).agg(F.max("v").alias("v"))
    slides = I.slides(spark, sf).withColumn("height", F.lit(24)).withColumn("width", F.lit(24))
    found = T.detect_tissue(px, slides, _nuclear(spark, sf), _structural(spark, sf), min_object_um2=0.5, max_bridge_um=2.0)
    return R.to_pixels(found)


@workload(
    "detect_islands",
    f"""WITH px AS (SELECT slide_id, c, y, x, v FROM pixels WHERE c = 0 OR (c BETWEEN 1 AND 6 AND (slide_id, c) IN (SELECT slide_id, idx FROM panel WHERE hint IN ('ECONOMY', 'PROMO')))),
        cnt AS (SELECT slide_id, c, COUNT(*) AS n FROM px GROUP BY 1, 2),
        dense AS (SELECT slide_id, c, v FROM px UNION ALL SELECT slide_id, c, 0 FROM (SELECT slide_id, c, unnest(range(0, 2304 - n)) FROM cnt)),
        bounds AS (SELECT slide_id, c, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM dense GROUP BY 1, 2),
        norm AS (SELECT slide_id, c, y, x, CASE WHEN hi <= lo THEN 0::DOUBLE ELSE LEAST(1, GREATEST(0, (v - lo) / (hi - lo))) END AS v FROM px JOIN bounds USING (slide_id, c)),
        planes AS (SELECT slide_id, 0 AS k, y, x, v FROM norm WHERE c = 0 UNION ALL SELECT slide_id, 1, y, x, MAX(v) FROM norm WHERE c > 0 GROUP BY 1, 3, 4),
        zeros AS (SELECT slide_id, k, 2304 - COUNT(*) AS n FROM planes GROUP BY 1, 2),
        hist AS (SELECT slide_id, k, v, COUNT(*) AS n FROM planes GROUP BY 1, 2, 3 UNION ALL SELECT slide_id, k, 0, n FROM zeros),
        ends AS (SELECT slide_id, k, MIN(v) AS lo, MAX(v) AS hi FROM hist GROUP BY 1, 2 HAVING MAX(v) > MIN(v)),
        bins AS (SELECT slide_id, k, lo, hi, LEAST(255, CAST(FLOOR((v - lo) / (hi - lo) * 256) AS INT)) AS b, SUM(n) AS n FROM hist JOIN ends USING (slide_id, k) GROUP BY ALL),
        cuts AS (SELECT *, SUM(n) OVER u AS w1, SUM(n * b) OVER u AS s1, SUM(n) OVER a AS w, SUM(n * b) OVER a AS s
                 FROM bins WINDOW u AS (PARTITION BY slide_id, k ORDER BY b ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY slide_id, k)),
        scored AS (SELECT *, w1::DOUBLE * (w - w1)::DOUBLE * (s1 / w1::DOUBLE - (s - s1) / (w - w1)::DOUBLE) * (s1 / w1::DOUBLE - (s - s1) / (w - w1)::DOUBLE) AS var FROM cuts WHERE w1 < w),
        th AS (SELECT slide_id, k, (lo + (b + 0.5::DOUBLE) * (hi - lo) / 256) * CASE k WHEN 0 THEN 0.7::DOUBLE ELSE 1 END AS t
               FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, k ORDER BY var DESC, b) AS rn FROM scored) WHERE rn = 1)
        SELECT DISTINCT slide_id, y, x FROM planes JOIN th USING (slide_id, k) WHERE v > t""",
)
def detect_islands(spark, sf):
    return T.detect_islands(I.pixels(spark, sf), I.slides(spark, sf), _nuclear(spark, sf), _structural(spark, sf))


@workload(
    "tile_vote",
    f"""WITH {grid_sql(SIZE, STRIDE)} SELECT slide_id, y, x, ROUND(AVG(p), 6) AS vote, AVG(p) >= 0.5::DOUBLE AS tissue FROM (
            SELECT p.slide_id, p.y, p.x, ((v // 1000 + patch_id * 7) % 64) / 64 AS p FROM pixels p JOIN grid g ON {inside(SIZE)})
        GROUP BY 1, 2, 3""",
)
def tile_vote(spark, sf):
    tiles = G.with_patches(I.pixels(spark, sf), I.slides(spark, sf), SIZE, STRIDE)
    return T.tile_vote(tiles.withColumn("p", ((F.floor(F.col("v") / 1000) + F.col("patch_id") * 7) % 64) / 64)).withColumn("vote", F.round("vote", 6))


@workload(
    "cluster_map",
    f"""WITH {grid_sql(SIZE, STRIDE)}, c AS (SELECT CAST(i AS INT) AS i FROM range({I.FRAME // 3 + 1}) t(i))
        SELECT slide_id, a.i AS cy, b.i AS cx, arg_max(patch_id % 5, patch_id) AS label FROM grid g
        JOIN c a ON a.i >= y // 3 AND a.i < (y + {SIZE}) // 3 JOIN c b ON b.i >= x // 3 AND b.i < (x + {SIZE}) // 3 GROUP BY 1, 2, 3""",
)
def cluster_map(spark, sf):
    patches = G.grid_patches(I.slides(spark, sf), SIZE, STRIDE).withColumn("label", F.col("patch_id") % 5)
    return T.cluster_map(patches, SIZE, 3)


@workload(
    "area_px",
    "SELECT slide_id, CAST(GREATEST(1, round_even(68 / (mpp * mpp), 0)) AS BIGINT) AS min_area FROM slides",
)
def area_px(spark, sf):
    return T.area_px(I.slides(spark, sf), T.MIN_OBJECT_UM2, "min_area")
