"""Pixel-statistic queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import cells as C
from histoframe.operators import markers as M
from histoframe.operators import pixels as P
from histoframe.operators import stats as S
from histoframe.operators.images import SparseImage
from histoframe.session import scratch_path
from histoframe.sources import readers
from histoframe.workloads import inputs as I
from histoframe.workloads import workload
from histoframe.workloads.markers import clean_sql, key_sql

DIVISOR = "CASE dtype WHEN 'uint8' THEN 255.0::DOUBLE WHEN 'uint16' THEN 65535.0::DOUBLE ELSE 1.0::DOUBLE END"
AREA = I.FRAME * I.FRAME


def r6(name: str):
    return F.round(name, 6).alias(name)


@workload("src_pixels", "SELECT * FROM pixels WHERE c IN (0, 3)")
def src_pixels(spark, sf):
    """Round trip through a table partitioned by channel, then a pruned read."""
    from histoframe.sources import sinks

    path = scratch_path(spark, "pixels")
    sinks.write_pixels(I.pixels(spark, sf), path, by=("c",))
    return readers.read_pixels(spark, path, channels=[0, 3])


@workload("dtype_scale", f"SELECT slide_id, c, y, x, v, ROUND(v / {DIVISOR}, 9) AS scaled FROM pixels JOIN slides USING (slide_id)")
def dtype_scale(spark, sf):
    scaled = P.scale_pixels(I.pixels(spark, sf), I.slides(spark, sf))
    return scaled.withColumn("scaled", F.round("scaled", 9))


@workload(
    "dtype_validate",
    """WITH f AS (SELECT slide_id, c, CASE WHEN slide_id % 10 = 0 AND v % 13000 = 0 THEN 'NaN'::DOUBLE ELSE v / 49000 END AS v FROM pixels),
        bad AS (SELECT slide_id, c FROM f GROUP BY 1, 2 HAVING NOT (MIN(v) >= -1e-6::DOUBLE AND MAX(v) <= 1 + 1e-6::DOUBLE))
       SELECT slide_id, array_to_string(list_sort(list(c))[1:5], ',') AS first_channels, COUNT(*) AS n_bad, GREATEST(COUNT(*) - 5, 0) AS n_more
       FROM bad GROUP BY slide_id""",
)
def dtype_validate(spark, sf):
    v = F.when((F.col("slide_id") % 10 == 0) & (F.col("v") % 13000 == 0), F.lit(float("nan"))).otherwise(F.col("v") / 49000)
    return P.bad_range(I.pixels(spark, sf).withColumn("v", v))


@workload(
    "channel_minmax",
    f"""SELECT slide_id, c, CASE WHEN COUNT(*) < {AREA} THEN LEAST(MIN(v), 0) ELSE MIN(v) END AS lo, MAX(v) AS hi FROM pixels GROUP BY 1, 2""",
)
def channel_minmax(spark, sf):
    return P.channel_minmax(I.pixels(spark, sf), I.slides(spark, sf))


DENSE = f"""dense AS (
    SELECT slide_id, c, v FROM projection UNION ALL
    SELECT slide_id, c, 0 FROM (SELECT slide_id, c, unnest(range(0, {AREA} - n)) FROM (SELECT slide_id, c, COUNT(*) AS n FROM projection GROUP BY 1, 2)))"""
BOUNDS = "bounds AS (SELECT slide_id, c, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM dense GROUP BY 1, 2)"
EACH = f"projection AS (SELECT slide_id, c, y, x, v FROM pixels), {DENSE}, {BOUNDS}"
CLIP = "CASE WHEN hi <= lo THEN 0::DOUBLE ELSE LEAST(1, GREATEST(0, (v - lo) / (hi - lo))) END"


@workload("channel_percentiles", f"WITH {EACH} SELECT slide_id, c, ROUND(lo, 6) AS lo, ROUND(hi, 6) AS hi FROM bounds")
def channel_percentiles(spark, sf):
    bounds = P.channel_percentiles(I.pixels(spark, sf), I.slides(spark, sf))
    return bounds.select("slide_id", "c", r6("lo"), r6("hi"))


@workload("percentile_clip", f"WITH {EACH} SELECT slide_id, c, y, x, v, ROUND({CLIP}, 6) AS norm FROM pixels JOIN bounds USING (slide_id, c)")
def percentile_clip(spark, sf):
    px = I.pixels(spark, sf)
    return P.percentile_clip(px, P.channel_percentiles(px, I.slides(spark, sf))).withColumn("norm", F.round("norm", 6))


@workload(
    "dapi_invert",
    f"""WITH {EACH} SELECT slide_id, y, x, CAST(FLOOR((1 - {CLIP}) * 255) AS INT) AS gray
        FROM pixels JOIN bounds USING (slide_id, c) WHERE c = 0""",
)
def dapi_invert(spark, sf):
    px = I.pixels(spark, sf).filter("c = 0")
    return P.dapi_gray(px, P.channel_percentiles(px, I.slides(spark, sf))).select("slide_id", "y", "x", "gray")


OTSU = """bins AS (
        SELECT slide_id, c, lo, hi, LEAST(255, CAST(FLOOR((v - lo) / (hi - lo) * 256) AS INT)) AS b, COUNT(*) AS n
        FROM (SELECT slide_id, c, CAST(v AS DOUBLE) AS v, CAST(MIN(v) OVER w AS DOUBLE) AS lo, CAST(MAX(v) OVER w AS DOUBLE) AS hi
              FROM dense WINDOW w AS (PARTITION BY slide_id, c))
        WHERE hi > lo GROUP BY ALL),
    cuts AS (SELECT *, SUM(n) OVER u AS w1, SUM(n * b) OVER u AS s1, SUM(n) OVER a AS w, SUM(n * b) OVER a AS s
             FROM bins WINDOW u AS (PARTITION BY slide_id, c ORDER BY b ROWS UNBOUNDED PRECEDING), a AS (PARTITION BY slide_id, c)),
    scored AS (SELECT *, w1::DOUBLE * (w - w1)::DOUBLE * (s1 / w1::DOUBLE - (s - s1) / (w - w1)::DOUBLE) * (s1 / w1::DOUBLE - (s - s1) / (w - w1)::DOUBLE) AS var
               FROM cuts WHERE w1 < w),
    otsu AS (SELECT slide_id, c, lo + (b + 0.5::DOUBLE) * (hi - lo) / 256 AS t
             FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, c ORDER BY var DESC, b) AS rn FROM scored) WHERE rn = 1)"""


@workload("otsu_threshold", f"WITH {EACH}, {OTSU} SELECT slide_id, c, ROUND(t * 0.7::DOUBLE, 6) AS threshold FROM otsu")
def otsu_threshold(spark, sf):
    hist = P.channel_histogram(I.pixels(spark, sf), I.slides(spark, sf))
    return P.otsu_threshold(hist, ["slide_id", "c"], 0.7).withColumn("threshold", F.round("threshold", 6))


#: Real-valued pixels: negative, tiny and repeated values, most of them distinct.
REAL = f"""projection AS (SELECT slide_id, c, y, x, (v - 9000) / 64.0::DOUBLE + x / 4096.0::DOUBLE + y / 1048576.0::DOUBLE AS v FROM pixels), {DENSE}, {BOUNDS}"""


def _real_pixels(spark, sf):
    v = (F.col("v") - 9000) / X.d(64) + F.col("x") / X.d(4096) + F.col("y") / X.d(1048576)
    return I.pixels(spark, sf).withColumn("v", v)


@workload("channel_percentiles_real", f"WITH {REAL} SELECT slide_id, c, ROUND(lo, 9) AS lo, ROUND(hi, 9) AS hi FROM bounds")
def channel_percentiles_real(spark, sf):
    bounds = P.channel_percentiles(_real_pixels(spark, sf), I.slides(spark, sf))
    return bounds.select("slide_id", "c", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"))


@workload("otsu_threshold_real", f"WITH {REAL}, {OTSU} SELECT slide_id, c, ROUND(t, 6) AS threshold FROM otsu")
def otsu_threshold_real(spark, sf):
    return P.otsu_of_pixels(_real_pixels(spark, sf), I.slides(spark, sf)).withColumn("threshold", F.round("threshold", 6))


#: Every channel of the panel on the whole frame; the last one has no pixel anywhere.
WHOLE = f"""planes AS (SELECT slide_id, CAST(k AS INT) AS c FROM slides, range(8) t(k)),
    whole AS (SELECT slide_id, c, y, x, COALESCE(v, 0) AS v FROM planes CROSS JOIN (SELECT CAST(a.i AS INT) AS y, CAST(b.i AS INT) AS x FROM range({I.FRAME}) a(i), range({I.FRAME}) b(i)) f
              LEFT JOIN pixels USING (slide_id, c, y, x))"""


def _planes(spark, sf):
    return I.slides(spark, sf).select("slide_id", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("c"))


def _image(spark, sf):
    return SparseImage.of_counts(I.pixels(spark, sf), _planes(spark, sf), I.slides(spark, sf))


@workload("channel_minmax_panel", f"WITH {WHOLE} SELECT slide_id, c, MIN(v) AS lo, MAX(v) AS hi FROM whole GROUP BY 1, 2")
def channel_minmax_panel(spark, sf):
    return P.channel_minmax(I.pixels(spark, sf), I.slides(spark, sf), channels=_planes(spark, sf))


@workload(
    "channel_percentiles_panel",
    f"WITH {WHOLE} SELECT slide_id, c, ROUND(quantile_cont(v, 0.01), 6) AS lo, ROUND(quantile_cont(v, 0.99), 6) AS hi FROM whole GROUP BY 1, 2",
)
def channel_percentiles_panel(spark, sf):
    bounds = P.channel_percentiles(I.pixels(spark, sf), I.slides(spark, sf), channels=_planes(spark, sf))
    return bounds.select("slide_id", "c", r6("lo"), r6("hi"))


@workload(
    "zscore_frame",
    f"""WITH {WHOLE}, s AS (SELECT slide_id, c, AVG(v) AS mean, STDDEV_POP(v) + 1 AS std FROM whole GROUP BY 1, 2),
        z AS (SELECT slide_id, c, (v - mean) / std AS z FROM whole JOIN s USING (slide_id, c))
        SELECT slide_id, c, COUNT(*) AS n, ROUND(SUM(z), 4) + 0.0::DOUBLE AS total, ROUND(MIN(z), 6) + 0.0::DOUBLE AS lo, ROUND(MAX(z), 6) + 0.0::DOUBLE AS hi FROM z GROUP BY 1, 2""",
)
def zscore_frame(spark, sf):
    """Absent pixels read (0 - mean) / std: counted over the whole frame after a round trip through files."""
    image = _image(spark, sf)
    moments = image.pixels.groupBy("slide_id", "c").agg(F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_q"))
    mean = F.coalesce("_s", X.d(0)) / X.d(AREA)
    stats = image.background.join(moments, ["slide_id", "c"], "left").select(
        "slide_id", "c", mean.alias("mean"), (F.sqrt(F.greatest(F.coalesce("_q", X.d(0)) / X.d(AREA) - mean * mean, X.d(0))) + 1).alias("std")
    )
    path = scratch_path(spark, "image")
    image.zscored(stats).write(path)
    found = SparseImage.read(spark, path).totals()
    return found.select("slide_id", "c", "n", *[(F.round(name, places) + X.d(0)).alias(name) for name, places in (("total", 4), ("lo", 6), ("hi", 6))])


@workload(
    "dapi_invert_frame",
    f"""WITH {WHOLE}, bounds AS (SELECT slide_id, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM whole WHERE c = 0 GROUP BY 1)
        SELECT slide_id, y, x, CAST(FLOOR((1 - {CLIP}) * 255) AS INT) AS gray FROM whole JOIN bounds USING (slide_id) WHERE c = 0""",
)
def dapi_invert_frame(spark, sf):
    """The inverted stain on every pixel of the frame; the background is white."""
    px, planes, slides = I.pixels(spark, sf).filter("c = 0"), _planes(spark, sf).filter("c = 0"), I.slides(spark, sf)
    bounds = P.channel_percentiles(px, slides, channels=planes)
    gray = SparseImage.of_counts(px, planes, slides).grayed(bounds).dense()
    return gray.select("slide_id", "y", "x", F.col("value").cast("int").alias("gray"))


@workload(
    "pseudo_rgb_frame",
    f"WITH {WHOLE}, n AS (SELECT slide_id, y, x, " + ", ".join(
        f"(SUM(v / {DIVISOR} * ROUND((c * 0.618034::DOUBLE + {i / 3}::DOUBLE) % 1, 4)) / 8 - {X.IMAGENET_MEAN[i]}::DOUBLE) / {X.IMAGENET_STD[i]}::DOUBLE AS v{i}" for i in range(3))
    + """ FROM whole JOIN slides USING (slide_id) GROUP BY 1, 2, 3)
        SELECT slide_id, CAST(k AS INT) AS c, ROUND(SUM(v), 4) AS total, ROUND(MIN(v), 6) AS lo, ROUND(MAX(v), 6) AS hi
        FROM (SELECT slide_id, unnest([v0, v1, v2]) AS v, unnest([0, 1, 2]) AS k FROM n) GROUP BY 1, 2""",
)
def pseudo_rgb_frame(spark, sf):
    """Pseudo-colours over the panel's eight channels, normalised for a photograph network, on the whole frame."""
    scale = I.slides(spark, sf).select("slide_id", X.dtype_divisor(F.col("dtype")).alias("_divisor"))
    unit = _image(spark, sf).mapped(lambda v: v / F.col("_divisor"), scale)
    rgb = unit.summed([P.colour_of(F.col("c"))[i] / 8 for i in range(3)])
    # By arithmetic on the plane's number: a join on it would put all pixels of a plane into one task.
    of_plane = lambda values: F.array(*[X.d(v) for v in values])[F.col("c")]
    found = rgb.mapped(lambda v: (v - of_plane(X.IMAGENET_MEAN)) / of_plane(X.IMAGENET_STD)).totals()
    return found.select("slide_id", "c", F.round("total", 4).alias("total"), r6("lo"), r6("hi"))


@workload(
    "tissue_coverage",
    f"""SELECT slide_id, ROUND(n / {AREA}, 6) AS coverage, n / {AREA} < 0.01::DOUBLE OR n / {AREA} > 0.99::DOUBLE AS degenerate
        FROM (SELECT s.slide_id, COUNT(t.slide_id) AS n FROM slides s LEFT JOIN tissue_px t ON t.slide_id = s.slide_id GROUP BY 1)""",
)
def tissue_coverage(spark, sf):
    return P.coverage(I.tissue_px(spark, sf), I.slides(spark, sf)).select("slide_id", r6("coverage"), "degenerate")


STRUCTURAL = "JOIN (SELECT slide_id AS s, idx FROM panel WHERE hint IN ('ECONOMY', 'PROMO')) ON s = slide_id AND idx = c"


def _structural_pixels(spark, sf):
    return P.select_channels(I.pixels(spark, sf), I.panel(spark, sf).filter("hint IN ('ECONOMY', 'PROMO')"))


@workload("structural_max", f"SELECT slide_id, y, x, MAX(v) AS v FROM pixels {STRUCTURAL} GROUP BY 1, 2, 3")
def structural_max(spark, sf):
    return P.max_projection(_structural_pixels(spark, sf))


@workload("membrane_sum", f"SELECT slide_id, y, x, SUM(CAST(v AS DOUBLE)) AS v FROM pixels {STRUCTURAL} GROUP BY 1, 2, 3")
def membrane_sum(spark, sf):
    return P.channel_sum(_structural_pixels(spark, sf))


@workload(
    "downsample_mean",
    f"""SELECT slide_id, c, CAST(FLOOR(y / 5) AS INT) AS y, CAST(FLOOR(x / 5) AS INT) AS x, CAST(FLOOR(SUM(v) / 25) AS INT) AS v
        FROM pixels WHERE y < {I.FRAME // 5 * 5} AND x < {I.FRAME // 5 * 5} GROUP BY 1, 2, 3, 4""",
)
def downsample_mean(spark, sf):
    return P.downsample_mean(I.pixels(spark, sf), I.slides(spark, sf), 5)


PARTIALS = f"""tissue_n AS (SELECT slide_id, COUNT(*) AS n FROM tissue_px GROUP BY 1),
    targets AS (SELECT slide_id, MAX(idx) AS idx, marker FROM panel WHERE hint IN ('ECONOMY', 'SMALL') GROUP BY ALL),
    sums AS (SELECT p.slide_id, c, SUM(v / {DIVISOR}) AS s FROM pixels p JOIN tissue_px USING (slide_id, y, x) JOIN slides USING (slide_id) GROUP BY 1, 2),
    partials AS (
        SELECT t.slide_id, t.marker, '({I.FRAME}, {I.FRAME}):' || COALESCE(n, 0) || ':' || CAST({DIVISOR} AS VARCHAR) AS region_key,
               COALESCE(n, 0) AS n, COALESCE(s / n, 0) AS mean,
               CASE WHEN n > 1 THEN (COALESCE(d, 0) + (n - COALESCE(k, 0)) * COALESCE(s / n, 0) * COALESCE(s / n, 0)) / (n - 1) ELSE 0 END AS var
        FROM targets t JOIN slides USING (slide_id) LEFT JOIN tissue_n USING (slide_id)
        LEFT JOIN sums q ON q.slide_id = t.slide_id AND q.c = t.idx
        LEFT JOIN (SELECT p.slide_id, p.c, COUNT(*) AS k, SUM((v / {DIVISOR} - s / n) * (v / {DIVISOR} - s / n)) AS d
                   FROM pixels p JOIN tissue_px USING (slide_id, y, x) JOIN slides USING (slide_id)
                   JOIN tissue_n USING (slide_id) JOIN sums q ON q.slide_id = p.slide_id AND q.c = p.c GROUP BY 1, 2) e
               ON e.slide_id = t.slide_id AND e.c = t.idx),
    pooled AS (
        SELECT key, total AS n, mu AS mean, CASE WHEN total > 1 THEN sqrt(ss / (total - 1)) ELSE 0 END AS std FROM (
            SELECT p.key, total, mu, SUM((n - 1) * var + n * (mean - mu) * (mean - mu)) AS ss
            FROM (SELECT *, {key_sql('marker')} AS key FROM partials WHERE n > 0) p
            JOIN (SELECT {key_sql('marker')} AS key, CAST(SUM(n) AS BIGINT) AS total, SUM(n * mean) / SUM(n) AS mu FROM partials GROUP BY 1) USING (key)
            GROUP BY 1, 2, 3))"""


def _targets(spark, sf):
    return I.panel(spark, sf).filter("hint IN ('ECONOMY', 'SMALL')").select("slide_id", "idx", "marker")


def _partials(spark, sf):
    return S.novel_partials(I.pixels(spark, sf), I.tissue_px(spark, sf), I.slides(spark, sf), _targets(spark, sf))


@workload("novel_partials", f"WITH {PARTIALS} SELECT slide_id, marker, region_key, n, ROUND(mean, 8) AS mean, ROUND(var, 6) AS var FROM partials")
def novel_partials(spark, sf):
    return _partials(spark, sf).withColumn("mean", F.round("mean", 8)).withColumn("var", F.round("var", 6))


@workload("pool_stats", f"WITH {PARTIALS} SELECT key, n, ROUND(mean, 8) AS mean, ROUND(std, 6) AS std FROM pooled")
def pool_stats(spark, sf):
    return S.pool_stats(_partials(spark, sf)).select("key", "n", F.round("mean", 8).alias("mean"), F.round("std", 6).alias("std"))


@workload(
    "region_key",
    f"""SELECT slide_id, COUNT(t.y) AS n_tissue, {DIVISOR} AS divisor, '({I.FRAME}, {I.FRAME}):' || COUNT(t.y) || ':' || CAST({DIVISOR} AS VARCHAR) AS region_key
        FROM slides s LEFT JOIN tissue_px t USING (slide_id) GROUP BY slide_id, dtype""",
)
def region_key(spark, sf):
    return S.region_keys(I.tissue_px(spark, sf), I.slides(spark, sf))


ADDITIONAL = f"""additional AS (
    SELECT marker_name, family, CASE pos % 3 WHEN 0 THEN NULL WHEN 1 THEN 0.5::DOUBLE END AS mean, CASE pos % 4 WHEN 0 THEN 0.25::DOUBLE END AS std
    FROM (SELECT {clean_sql('marker_name')} AS marker_name, family, pos FROM registry))"""


def _additional(spark, sf):
    from histoframe.functions import names as N

    pos = F.col("pos")
    return I.registry(spark, sf).select(
        N.clean_marker(F.col("marker_name")).alias("marker_name"),
        "family",
        F.when(pos % 3 == 1, X.d(0.5)).alias("mean"),
        F.when(pos % 4 == 0, X.d(0.25)).alias("std"),
    )


@workload(
    "prepare_cohort",
    f"""WITH {PARTIALS}, {ADDITIONAL} SELECT marker_name, family,
            ROUND(COALESCE(a.mean, p.mean, -1), 6) AS mean, ROUND(COALESCE(a.std, p.std, -1), 6) AS std
        FROM additional a LEFT JOIN pooled p ON p.key = {key_sql('marker_name')}""",
)
def prepare_cohort(spark, sf):
    """Even slides bring stored partials; some of those are out of date."""
    stored = _partials(spark, sf).filter("slide_id % 2 = 0")
    stale = F.when(F.col("slide_id") % 6 == 0, F.concat("region_key", F.lit("-old"))).otherwise(F.col("region_key"))
    filled, _ = S.prepare_cohort(
        I.pixels(spark, sf), I.tissue_px(spark, sf), I.slides(spark, sf), _targets(spark, sf),
        stored.withColumn("region_key", stale), _additional(spark, sf),
    )
    return filled.select("marker_name", "family", *[F.round(F.coalesce(c, X.d(-1)), 6).alias(c) for c in ("mean", "std")])


@workload(
    "prepare_cohort_reuse",
    f"""WITH {PARTIALS}, {ADDITIONAL} SELECT slide_id, marker, n, slide_id % 2 = 0 AND slide_id % 6 <> 0 AS reused
        FROM partials WHERE {key_sql('marker')} IN (SELECT {key_sql('marker_name')} FROM additional WHERE mean IS NULL OR std IS NULL)""",
)
def prepare_cohort_reuse(spark, sf):
    stored = _partials(spark, sf).filter("slide_id % 2 = 0")
    stale = F.when(F.col("slide_id") % 6 == 0, F.concat("region_key", F.lit("-old"))).otherwise(F.col("region_key"))
    _, partials = S.prepare_cohort(
        I.pixels(spark, sf), I.tissue_px(spark, sf), I.slides(spark, sf), _targets(spark, sf),
        stored.withColumn("region_key", stale), _additional(spark, sf),
    )
    return partials.select("slide_id", "marker", "n", "reused")


@workload(
    "fill_blanks",
    """SELECT doc_id, CASE WHEN lower(trim(lang)) IN ('', 'nan', 'en') OR lang IS NULL THEN source ELSE lang END AS filled FROM documents""",
)
def fill_blanks(spark, sf):
    from histoframe.functions import names as N

    docs = I.table(spark, sf, "documents").withColumn("lang", F.when(F.lower(F.trim("lang")) == "en", F.lit(" NaN ")).otherwise(F.col("lang")))
    return docs.select("doc_id", N.fill_blank(F.col("lang"), F.col("source")).alias("filled"))


STATS = "stats AS (SELECT slide_id, c, AVG(v) AS mean, STDDEV_POP(v) + 1 AS std FROM pixels GROUP BY 1, 2)"


@workload("zscore", f"WITH {STATS} SELECT slide_id, c, y, x, ROUND((v - mean) / std, 6) AS z FROM pixels JOIN stats USING (slide_id, c)")
def zscore(spark, sf):
    px = I.pixels(spark, sf)
    stats = px.groupBy("slide_id", "c").agg(F.avg("v").alias("mean"), (F.stddev_pop("v") + 1).alias("std"))
    return P.zscore(px, stats, "v").select("slide_id", "c", "y", "x", r6("z"))


MINMAX = f"mm AS (SELECT slide_id, c, CASE WHEN COUNT(*) < {AREA} THEN LEAST(MIN(v), 0) ELSE MIN(v) END AS lo, MAX(v) AS hi FROM pixels GROUP BY 1, 2)"
STRETCH = "CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE CAST(v AS DOUBLE) END"


def colour_sql(i: int) -> str:
    return f"ROUND((c * 0.618034::DOUBLE + {i / 3}::DOUBLE) % 1, 4)"


@workload("minmax_stretch", f"WITH {MINMAX} SELECT slide_id, c, y, x, v, ROUND({STRETCH}, 6) AS stretched FROM pixels JOIN mm USING (slide_id, c)")
def minmax_stretch(spark, sf):
    return P.minmax_stretch(I.pixels(spark, sf), I.slides(spark, sf)).withColumn("stretched", F.round("stretched", 6))


@workload(
    "pseudo_rgb",
    "SELECT slide_id, y, x, " + ", ".join(f"ROUND(SUM(v / {DIVISOR} * {colour_sql(i)}) / 7, 6) AS {n}" for i, n in enumerate("rgb"))
    + " FROM pixels JOIN slides USING (slide_id) GROUP BY 1, 2, 3",
)
def pseudo_rgb(spark, sf):
    px = I.pixels(spark, sf)
    n = px.groupBy("slide_id").agg(F.count_distinct("c").alias("n_channels"))
    return P.pseudo_rgb(P.scale_pixels(px, I.slides(spark, sf)), n).select("slide_id", "y", "x", r6("r"), r6("g"), r6("b"))


@workload(
    "colorize",
    "SELECT slide_id, c, y, x, " + ", ".join(f"ROUND(v / {DIVISOR} * {colour_sql(i)}, 6) AS {n}" for i, n in enumerate("rgb"))
    + " FROM pixels JOIN slides USING (slide_id)",
)
def colorize(spark, sf):
    return P.colorize(P.scale_pixels(I.pixels(spark, sf), I.slides(spark, sf))).select("slide_id", "c", "y", "x", r6("r"), r6("g"), r6("b"))


@workload(
    "imagenet_norm",
    "SELECT slide_id, c, y, x, " + ", ".join(
        f"ROUND((v / {DIVISOR} * {colour_sql(i)} - {X.IMAGENET_MEAN[i]}::DOUBLE) / {X.IMAGENET_STD[i]}::DOUBLE, 6) AS {n}" for i, n in enumerate("rgb"))
    + " FROM pixels JOIN slides USING (slide_id)",
)
def imagenet_norm(spark, sf):
    rgb = P.colorize(P.scale_pixels(I.pixels(spark, sf), I.slides(spark, sf)))
    return rgb.select("slide_id", "c", "y", "x", *[F.round(X.imagenet_norm(F.col(n), i), 6).alias(n) for i, n in enumerate("rgb")])


@workload(
    "composite_rgb",
    f"WITH {MINMAX} SELECT slide_id, y, x, " + ", ".join(
        f"CAST(FLOOR(LEAST(255, GREATEST(0, ROUND(SUM({STRETCH} * 2 * FLOOR({colour_sql(i)} * 255)), 6)))) AS INT) AS {n}" for i, n in enumerate("rgb"))
    + " FROM pixels JOIN mm USING (slide_id, c) GROUP BY 1, 2, 3",
)
def composite_rgb(spark, sf):
    return P.composite_rgb(I.pixels(spark, sf), I.slides(spark, sf))


@workload("center_crop", "SELECT slide_id, c, y - 3 AS y, x - 3 AS x, v FROM pixels WHERE y BETWEEN 3 AND 44 AND x BETWEEN 3 AND 44")
def center_crop(spark, sf):
    return P.center_crop(I.pixels(spark, sf), F.lit(I.FRAME), F.lit(I.FRAME), 14)


@workload("flatten_cycles", "SELECT slide_id, y, x, v, CAST(FLOOR(c / 3) AS INT) * 3 + c % 3 AS c FROM pixels")
def flatten_cycles(spark, sf):
    cycles = I.pixels(spark, sf).withColumn("t", F.floor(F.col("c") / 3).cast("int")).withColumn("c", F.col("c") % 3)
    return P.flatten_cycles(cycles, "TCYX", 3).select("slide_id", "y", "x", "v", "c")


@workload("box_window", "SELECT * FROM pixels WHERE y >= 10 AND y < 30 AND x >= 5 AND x < 41")
def box_window(spark, sf):
    return C.window(I.pixels(spark, sf), 10, 30, 5, 41)


@workload(
    "sink_omero_meta",
    f"""SELECT p.slide_id, idx, '{{"label":"' || marker || '","color":"' || ['0000FF', '00FF00', 'FF0000', 'FFFF00', '00FFFF', 'FF00FF', 'FFFFFF', 'FFA500'][idx % 8 + 1]
            || '","active":' || CASE WHEN COALESCE(idx = n, FALSE) THEN 'true' ELSE 'false' END || ',"window":{{"min":0,"max":65535,"start":0,"end":4096}}}}' AS omero
        FROM panel p LEFT JOIN (SELECT slide_id, arg_min(idx, CASE WHEN COALESCE(keep, TRUE) THEN 0 ELSE 1 END * 100 + idx) AS n FROM panel
            WHERE regexp_matches(marker, 'dapi|hoechst|draq5|dna|syto') GROUP BY 1) q ON q.slide_id = p.slide_id""",
)
def sink_omero_meta(spark, sf):
    panel = I.panel(spark, sf)
    return P.omero_channels(panel, M.first_nuclear(panel.withColumn("stored_nuclear", F.lit(None).cast("string"))))
