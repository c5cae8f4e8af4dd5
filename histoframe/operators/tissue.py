"""Tissue detection: thresholds, islands, region, votes and maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import pixels as P
from histoframe.operators import runs as R

# Detection defaults in microns and factors.
NUCLEAR_FACTOR = 0.7
MIN_OBJECT_UM2 = 68.0
MAX_BRIDGE_UM = 100.0
PITCHES_PER_BRIDGE = 20  # the working pitch of the region, as a part of the bridge
CLEANUP_MIN_UM2, CLEANUP_HOLE_UM2, CLEANUP_CLOSE_UM = 17000.0, 2000.0, 2.0

#: Coarse cells of a row that are painted together.
STRETCH = 64


def area_px(slides: DataFrame, um2: float, name: str) -> DataFrame:
    """Square microns in pixels of each slide, at least one."""
    px = F.greatest(F.lit(1), F.bround(X.d(um2) / (F.col("mpp") * F.col("mpp")))).cast("bigint")
    return slides.select("slide_id", px.alias(name))


def upsample_nearest(coarse: DataFrame, slides: DataFrame) -> DataFrame:
    """Coarse mask pixels blown up to the native frame by each slide's ``factor``.

    Every coarse pixel writes its own block, so nothing joins the grid.
    """
    f = F.col("factor")
    block = lambda axis: F.explode(F.sequence(F.col(axis) * f, F.col(axis) * f + f - 1)).alias(axis)
    sized = coarse.join(slides.select("slide_id", "height", "width", "factor"), "slide_id")
    rows = sized.select("slide_id", "height", "width", "factor", block("y"), "x").filter("y < height")
    return rows.select("slide_id", "width", "y", block("x")).filter("x < width").select("slide_id", "y", "x")


def resize_nearest(coarse: DataFrame, slides: DataFrame, coarse_height: Column, coarse_width: Column) -> DataFrame:
    """Coarse mask of any size to the native frame by ``floor(y * h / h0)``.

    The native rows that read a coarse row form a range found by arithmetic.
    """
    dims = slides.select("slide_id", "height", "width")

    def span(axis: str, small: Column, full: Column) -> Column:
        first = F.ceil(F.col(axis) * full / small).cast("int")
        last = (F.ceil((F.col(axis) + 1) * full / small) - 1).cast("int")
        return F.explode(F.when(first <= last, F.sequence(first, last))).alias(axis)

    joined = coarse.join(dims, "slide_id").withColumns({"_h": coarse_height, "_w": coarse_width})
    rows = joined.select("slide_id", "x", "_w", "width", span("y", F.col("_h"), F.col("height")))
    return rows.select("slide_id", "y", span("x", F.col("_w"), F.col("width")))


def tissue_region(
    islands: DataFrame, slides: DataFrame, max_bridge_um: float = MAX_BRIDGE_UM, pitch_um: float | None = None
) -> DataFrame:
    """Region that encloses the islands, as runs on the native frame.

    The alpha shape of a point set is what a closing by a disk of the same
    radius leaves (Edelsbrunner, Kirkpatrick, Seidel 1983). The closing works
    on cells of ``pitch_um`` microns (a twentieth of the bridge by default); a
    cell is set when any of its pixels is, and the islands themselves always
    belong to the region, so none is lost whatever the frame's size.
    """
    pitch = X.d(max_bridge_um / PITCHES_PER_BRIDGE if pitch_um is None else pitch_um)
    plan = slides.withColumn("factor", F.greatest(F.lit(1), F.bround(pitch / F.col("mpp")).cast("int")))
    plan = plan.withColumn("radius", F.floor(X.d(max_bridge_um) / (F.col("mpp") * F.col("factor")) / 2).cast("int"))
    f = F.col("factor")
    at = lambda a: F.floor(F.col(a) / f).cast("int").alias(a)
    coarse = R.merge_runs(islands.join(plan.select("slide_id", "factor"), "slide_id").select("slide_id", at("y"), at("x0"), at("x1")))
    shrunk = [F.ceil(F.col(a) / f).cast("int").alias(a) for a in ("height", "width")]
    small_frame = plan.select("slide_id", *shrunk, "radius")
    closed = R.fill_holes(R.close_runs(coarse, small_frame), small_frame, diagonal=False)
    rows = closed.join(plan.select("slide_id", "factor"), "slide_id").select(
        "slide_id", F.explode(F.sequence(F.col("y") * f, F.col("y") * f + f - 1)).alias("y"), (F.col("x0") * f).alias("x0"), (F.col("x1") * f + f - 1).alias("x1")
    )
    return R.merge_runs(R.clip_runs(rows, slides).unionByName(islands.select("slide_id", "y", "x0", "x1")))


def otsu_mask(image: DataFrame, slides: DataFrame, factor: float) -> DataFrame:
    """Pixels of one plane per slide above its threshold; flat planes give none.

    ``image`` is (slide_id, y, x, v). Stretching between the percentiles is
    monotone and done on the histogram, so only two scalars come back to the
    pixels.
    """
    plane = image.withColumn("c", F.lit(0))
    bounds = P.channel_percentiles(plane, slides)
    hist = P.channel_histogram(plane, slides).join(bounds, P.CHANNEL)
    norm = hist.select("slide_id", "c", X.clip_unit(F.col("value"), F.col("lo"), F.col("hi")).alias("value"), "n")
    norm = norm.groupBy("slide_id", "c", "value").agg(F.sum("n").alias("n"))
    limits = P.otsu_threshold(norm, ["slide_id", "c"], factor).join(bounds, P.CHANNEL).drop("c")
    stretched = X.clip_unit(F.col("v"), F.col("lo"), F.col("hi"))
    return image.join(limits, "slide_id").filter(stretched > F.col("threshold")).select("slide_id", "y", "x")


def detect_islands(pixels: DataFrame, slides: DataFrame, nuclear: DataFrame, structural: DataFrame) -> DataFrame:
    """Nuclear mask joined with the mask of the structural maximum.

    ``nuclear`` and ``structural`` are (slide_id, idx). Planes are stretched
    one by one before the maximum is taken.
    """
    nuc = P.select_channels(pixels, nuclear).select("slide_id", "y", "x", "v")
    wanted = P.select_channels(pixels, structural)
    bounds = P.channel_percentiles(wanted, slides)
    top = P.percentile_clip(wanted, bounds).groupBy("slide_id", "y", "x").agg(F.max("norm").alias("v"))
    hist = P.channel_histogram(top.withColumn("c", F.lit(0)), slides)
    limits = P.otsu_threshold(hist, ["slide_id", "c"]).drop("c")
    struct = top.join(limits, "slide_id").filter("v > threshold").select("slide_id", "y", "x")
    return otsu_mask(nuc, slides, NUCLEAR_FACTOR).unionByName(struct).distinct()


def detect_tissue(
    pixels: DataFrame, slides: DataFrame, nuclear: DataFrame, structural: DataFrame,
    min_object_um2: float = MIN_OBJECT_UM2, max_bridge_um: float = MAX_BRIDGE_UM,
) -> DataFrame:
    """Thresholds, island clean-up and region of every slide, as runs."""
    islands = R.to_runs(detect_islands(pixels, slides, nuclear, structural))
    kept = R.remove_small(islands, area_px(slides, min_object_um2, "min_area"))
    return tissue_region(kept, slides, max_bridge_um)


def tile_vote(predictions: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """Mean of overlapping tile predictions per pixel and its verdict."""
    votes = predictions.groupBy("slide_id", "y", "x").agg(F.avg("p").alias("vote"))
    return votes.withColumn("tissue", F.col("vote") >= X.d(cutoff))


def cluster_map(patches: DataFrame, size: int, factor: int) -> DataFrame:
    """Cluster ids painted on a coarse grid; later patches overwrite.

    ``patches`` has slide_id, patch_id, x, y and label. A patch travels as its
    stretches of coarse rows, cut at every ``STRETCH`` cells; the task that
    has all stretches of a place paints its cells, so no map holds them.
    """

    def ends(axis: str) -> tuple[Column, Column]:
        return F.floor(F.col(axis) / factor).cast("int"), (F.floor((F.col(axis) + size) / factor) - 1).cast("int")

    (y0, y1), (x0, x1) = ends("y"), ends("x")
    inside = patches.filter((y0 <= y1) & (x0 <= x1))
    rows = inside.select("slide_id", "patch_id", "label", F.explode(F.sequence(y0, y1)).alias("cy"), x0.alias("_x0"), x1.alias("_x1"))
    place = F.floor(F.col("_x0") / STRETCH), F.floor(F.col("_x1") / STRETCH)
    cut = rows.select("slide_id", "patch_id", "label", "cy", "_x0", "_x1", F.explode(F.sequence(*place)).alias("_at"))
    spans = cut.select(
        "slide_id", "cy", "_at",
        F.struct(
            "patch_id", F.greatest("_x0", (F.col("_at") * STRETCH).cast("int")).alias("first"),
            F.least("_x1", (F.col("_at") * STRETCH + STRETCH - 1).cast("int")).alias("last"), "label",
        ).alias("span"),
    )
    keys = ["slide_id", "cy", "_at"]
    met = spans.repartition(*keys).groupBy(*keys).agg(F.array_sort(F.collect_list("span")).alias("spans"))

    def painted(cx: Column) -> Column:
        top = F.try_element_at(F.filter("spans", lambda s: (s["first"] <= cx) & (cx <= s["last"])), F.lit(-1))
        return F.struct(cx.alias("cx"), top.alias("top"))

    cells = F.transform(F.sequence(F.array_min("spans.first"), F.array_max("spans.last")), painted)
    return met.select("slide_id", "cy", F.inline(cells)).filter("top IS NOT NULL").select("slide_id", "cy", "cx", F.col("top.label").alias("label"))
