"""Patch grids over slides and the pixels they cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import words as W

# Added to the non-zero count of a patch mean; small-patch bound.
MEAN_EPSILON = 1e-6
FIXED_INPUT_MIN_PX = 128

#: Rows of a slide that stay in one task where boxes are summed, and the overlap up to which a row is copied to all its boxes at once.
BAND, DIRECT = 256, 4


def axis_starts(extent: Column, size: int, stride: int) -> Column:
    """Starts of all boxes along an axis, the last one flush with the edge."""
    last = extent - size
    starts = F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(stride)), F.array(last)))
    return F.when(last >= 0, starts).otherwise(F.array().cast("array<int>"))


def axis_count(extent: Column, size: int, stride: int) -> Column:
    last = extent - size
    edge = F.when(last % stride != 0, 1).otherwise(0)
    return F.when(last >= 0, F.floor(last / stride).cast("int") + 1 + edge).otherwise(0)


def axis_touching(low: Column, high: Column, extent: Column, size: int, stride: int) -> Column:
    """Positions along an axis of the boxes that hold any coordinate from ``low`` to ``high``.

    Pure arithmetic: a pixel finds its boxes without joining the grid, and
    gets at most ceil(size / stride) of them plus the edge box.
    """
    last = extent - size
    top = F.floor(last / stride).cast("int")
    first = F.greatest(F.lit(0), (F.floor((low - size) / stride) + 1).cast("int"))
    final = F.least(F.floor(high / stride).cast("int"), top)
    none = F.array().cast("array<int>")
    regular = F.when(first <= final, F.sequence(first, final)).otherwise(none)
    edge = F.when((last % stride != 0) & (high >= last) & (low < extent), F.array(top + 1)).otherwise(none)
    return F.when(last >= 0, F.concat(regular, edge)).otherwise(none)


def axis_covering(at: Column, extent: Column, size: int, stride: int) -> Column:
    """Positions along an axis of the boxes that contain a coordinate."""
    return axis_touching(at, at, extent, size, stride)


def grid_patches(slides: DataFrame, size: int, stride: int) -> DataFrame:
    """Boxes of a regular grid in row-major order; none on a too small slide."""
    rows = slides.select(
        "slide_id", F.posexplode(axis_starts(F.col("height"), size, stride)).alias("_iy", "y"), "width"
    )
    cells = rows.select("slide_id", "_iy", "y", "width", F.posexplode(axis_starts(F.col("width"), size, stride)).alias("_ix", "x"))
    patch_id = F.col("_iy") * axis_count(F.col("width"), size, stride) + F.col("_ix")
    return cells.select("slide_id", patch_id.cast("int").alias("patch_id"), "x", "y")


def cell_patches(cells: DataFrame, size: int) -> DataFrame:
    """Box around each centroid, half-even rounding; may reach off the slide."""
    half = size // 2
    return cells.select(
        "slide_id",
        "cell_id",
        (F.bround("x").cast("int") - half).alias("x"),
        (F.bround("y").cast("int") - half).alias("y"),
    )


def with_patches(rows: DataFrame, slides: DataFrame, size: int, stride: int) -> DataFrame:
    """Rows with y, x once per grid patch that covers them."""
    width = F.col("_width")
    dims = slides.select("slide_id", F.col("height").alias("_height"), F.col("width").alias("_width"))
    return (
        rows.join(dims, "slide_id")
        .withColumn("_iy", F.explode(axis_covering(F.col("y"), F.col("_height"), size, stride)))
        .withColumn("_ix", F.explode(axis_covering(F.col("x"), width, size, stride)))
        .withColumn("patch_id", (F.col("_iy") * axis_count(width, size, stride) + F.col("_ix")).cast("int"))
        .drop("_height", "_width", "_iy", "_ix")
    )


def banded(rows: DataFrame) -> DataFrame:
    """Rows with slide_id and y, a band of ``BAND`` rows of a slide in one task."""
    return rows.withColumn("_band", F.floor(F.col("y") / BAND)).repartition("slide_id", "_band").drop("_band")


def box_sums(rows: DataFrame, slides: DataFrame, size: int, stride: int, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Additive aggregates per grid patch.

    With some overlap every row goes straight to its boxes, in tasks that hold
    whole bands of a slide: there the copies combine to a row per box at once.
    With more, the sums run along x first and along y second, so a pixel is
    copied k times instead of k * k and the second step starts from combined
    rows.
    """
    if size <= DIRECT * stride:
        near = rows if size <= stride else banded(rows)
        return with_patches(near, slides, size, stride).groupBy("slide_id", "patch_id", *keys).agg(
            *[F.sum(expr).alias(name) for name, expr in sums.items()]
        )
    width = F.col("_width")
    dims = slides.select("slide_id", F.col("height").alias("_height"), F.col("width").alias("_width"))
    strips = (
        rows.join(dims, "slide_id")
        .withColumn("_ix", F.explode(axis_covering(F.col("x"), width, size, stride)))
        .groupBy("slide_id", "_height", "_width", "y", "_ix", *keys)
        .agg(*[F.sum(expr).alias(name) for name, expr in sums.items()])
    )
    patch_id = (F.col("_iy") * axis_count(width, size, stride) + F.col("_ix")).cast("int")
    return (
        strips.withColumn("_iy", F.explode(axis_covering(F.col("y"), F.col("_height"), size, stride)))
        .groupBy("slide_id", patch_id.alias("patch_id"), *keys)
        .agg(*[F.sum(name).alias(name) for name in sums])
    )


def box_counts(mask: DataFrame, slides: DataFrame, size: int, stride: int) -> DataFrame:
    """(slide_id, patch_id, _n): mask pixels of each grid patch that has any.

    Rows of the mask travel as words of 64 columns, and a box counts bits; a
    repeated pixel counts once.
    """
    height, width, start = F.col("_height"), F.col("_width"), F.col("word") * W.BITS
    dims = slides.select("slide_id", F.col("height").alias("_height"), F.col("width").alias("_width"))
    words = banded(W.to_words(mask)).join(dims, "slide_id")
    boxes = words.withColumn("_ix", F.explode(axis_touching(start, start + W.BITS - 1, width, size, stride)))
    first = F.least(F.col("_ix") * stride, width - size) - start
    seen = W.bits_between(F.greatest(F.lit(0), first), F.least(F.lit(W.BITS - 1), first + size - 1))
    counted = boxes.withColumn("_n", F.bit_count(F.col("bits").bitwiseAND(seen))).filter("_n > 0")
    patch_id = (F.col("_iy") * axis_count(width, size, stride) + F.col("_ix")).cast("int")
    return (
        counted.withColumn("_iy", F.explode(axis_covering(F.col("y"), height, size, stride)))
        .groupBy("slide_id", patch_id.alias("patch_id"))
        .agg(F.sum("_n").alias("_n"))
    )


def tissue_prop(mask: DataFrame, slides: DataFrame, size: int, stride: int) -> DataFrame:
    """All patches with the share of each under tissue; zeros stay."""
    counts = box_counts(mask, slides, size, stride)
    prop = (F.coalesce("_n", F.lit(0)) / (size * size)).cast("float")
    return grid_patches(slides, size, stride).join(counts, ["slide_id", "patch_id"], "left").select(
        "slide_id", "patch_id", "x", "y", prop.alias("tissue_prop")
    )


def integral_image(mask: DataFrame, slides: DataFrame) -> DataFrame:
    """Summed-area table over the dense frame.

    Two running sums, each inside one row or one column of one slide.
    """
    ys = slides.select("slide_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"))
    grid = ys.select("slide_id", "y", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"))
    dense = grid.join(mask.withColumn("_on", F.lit(1)), ["slide_id", "y", "x"], "left").fillna(0, ["_on"])
    along = Window.partitionBy("slide_id", "y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("slide_id", "x").orderBy("y").rowsBetween(Window.unboundedPreceding, 0)
    return (
        dense.withColumn("_row", F.sum("_on").over(along))
        .withColumn("sat", F.sum("_row").over(down))
        .select("slide_id", "y", "x", "sat")
    )


def mask_bbox(mask: DataFrame) -> DataFrame:
    """Bounding box of each slide's mask."""
    return mask.groupBy("slide_id").agg(
        *[f(a).alias(f"{a}{n}") for a in ("y", "x") for n, f in (("0", F.min), ("1", F.max))]
    )


def bbox_prefilter(patches: DataFrame, mask: DataFrame, size: int) -> DataFrame:
    """Patches that touch the mask's bounding box; only those can be above 0."""
    return (
        patches.join(mask_bbox(mask), "slide_id")
        .filter((F.col("x") <= F.col("x1")) & (F.col("x") + size > F.col("x0")) & (F.col("y") <= F.col("y1")) & (F.col("y") + size > F.col("y0")))
        .drop("x0", "x1", "y0", "y1")
    )


def mean_marker_sparse(pixels: DataFrame, slides: DataFrame, size: int, stride: int) -> DataFrame:
    """Non-zero mean of each (patch, channel) that has any pixel."""
    sums = box_sums(
        pixels, slides, size, stride, ["c"], {"_sum": F.col("v"), "_n": F.when(F.col("v") != 0, 1).otherwise(0)}
    )
    divisor = slides.select("slide_id", X.dtype_divisor(F.col("dtype")).alias("_divisor"))
    value = F.col("_sum") / F.col("_divisor") / (X.d(MEAN_EPSILON) + F.col("_n"))
    return sums.join(divisor, "slide_id").select("slide_id", "patch_id", "c", value.alias("value"))


def mean_marker(pixels: DataFrame, slides: DataFrame, panel: DataFrame, size: int, stride: int) -> DataFrame:
    """One feature row per patch: the non-zero mean of every panel channel.

    ``panel`` is (slide_id, idx) of the selected channels, in idx order.
    Pixels of other channels are dropped before the shuffle; a patch or
    channel without pixels reads 0.
    """
    wanted = panel.select("slide_id", F.col("idx").alias("c"))
    selected = pixels.join(wanted, ["slide_id", "c"], "left_semi")
    by_patch = (
        mean_marker_sparse(selected, slides, size, stride)
        .groupBy("slide_id", "patch_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("c", "value"))).alias("_values"))
    )
    order = panel.groupBy("slide_id").agg(F.array_sort(F.collect_list("idx")).alias("channels"))
    empty = F.create_map().cast("map<int, double>")
    features = F.transform("channels", lambda c: F.coalesce(F.try_element_at(F.coalesce("_values", empty), c), X.d(0)))
    return (
        grid_patches(slides, size, stride)
        .join(order, "slide_id")
        .join(by_patch, ["slide_id", "patch_id"], "left")
        .select("slide_id", "patch_id", "x", "y", "channels", features.alias("features"))
    )


def feature_long(features: DataFrame) -> DataFrame:
    """Feature rows as one row per (patch, channel)."""
    pairs = F.arrays_zip("channels", "features")
    return features.select("slide_id", "patch_id", F.inline(pairs)).select(
        "slide_id", "patch_id", F.col("channels").alias("c"), F.col("features").alias("value")
    )


def box_pixels(pixels: DataFrame, slides: DataFrame, size: int, stride: int) -> DataFrame:
    """Pixels of every grid patch with their place inside it."""
    starts = grid_patches(slides, size, stride).select("slide_id", "patch_id", F.col("y").alias("_py"), F.col("x").alias("_px"))
    return (
        with_patches(pixels, slides, size, stride)
        .join(starts, ["slide_id", "patch_id"])
        .select("slide_id", "patch_id", "c", (F.col("y") - F.col("_py")).alias("dy"), (F.col("x") - F.col("_px")).alias("dx"), "v")
    )


def cell_box_pixels(pixels: DataFrame, boxes: DataFrame, size: int) -> DataFrame:
    """Pixels of boxes of ``size`` at any place, overlapping or partly off the frame, with their place inside.

    ``boxes`` has slide_id, cell_id and the corner y, x; what has no pixel,
    off the frame as well, reads 0. A bucketed interval join: a box is listed
    under the coarse squares of its own size that it touches, four at most,
    and a pixel looks up its square.
    """
    square = lambda column: F.floor(column / size)
    corner = boxes.select("slide_id", "cell_id", F.col("y").alias("_py"), F.col("x").alias("_px"))
    listed = corner.select("*", F.explode(F.array_distinct(F.array(square(F.col("_py")), square(F.col("_py") + size - 1)))).alias("_sy"))
    listed = listed.select("*", F.explode(F.array_distinct(F.array(square(F.col("_px")), square(F.col("_px") + size - 1)))).alias("_sx"))
    placed = pixels.withColumns({"_sy": square(F.col("y")), "_sx": square(F.col("x"))})
    dy, dx = F.col("y") - F.col("_py"), F.col("x") - F.col("_px")
    return (
        placed.join(listed, ["slide_id", "_sy", "_sx"])
        .filter(dy.between(0, size - 1) & dx.between(0, size - 1))
        .select("slide_id", "cell_id", "c", dy.alias("dy"), dx.alias("dx"), "v")
    )


def isolate_cells(pixels: DataFrame, cell_px: DataFrame, patches: DataFrame, size: int) -> DataFrame:
    """Pixels of each cell patch that belong to that very cell.

    The mask already says which cell a pixel is in, so this is one equi join
    on the pixel and one on the cell, then a box test.
    """
    owned = pixels.join(cell_px, ["slide_id", "y", "x"])
    boxes = patches.select("slide_id", "cell_id", F.col("y").alias("_py"), F.col("x").alias("_px"))
    dy, dx = F.col("y") - F.col("_py"), F.col("x") - F.col("_px")
    return (
        owned.join(boxes, ["slide_id", "cell_id"])
        .filter(dy.between(0, size - 1) & dx.between(0, size - 1))
        .select("slide_id", "cell_id", "c", dy.alias("dy"), dx.alias("dx"), "v")
    )


def cell_mean_marker(isolated: DataFrame, slides: DataFrame, cells: DataFrame, panel: DataFrame) -> DataFrame:
    """Non-zero mean of each (cell, channel) over its isolated patch.

    ``cells`` has slide_id and cell_id, ``panel`` slide_id and idx: every cell
    gets a value for every channel of its slide, 0 where it has no pixel.
    """
    divisor = slides.select("slide_id", X.dtype_divisor(F.col("dtype")).alias("_divisor"))
    sums = isolated.groupBy("slide_id", "cell_id", "c").agg(F.sum("v").alias("_sum"), F.count_if(F.col("v") != 0).alias("_n"))
    value = F.col("_sum") / F.col("_divisor") / (X.d(MEAN_EPSILON) + F.col("_n"))
    channels = panel.groupBy("slide_id").agg(F.collect_set("idx").alias("_channels")).join(divisor, "slide_id")
    every = cells.select("slide_id", "cell_id").join(channels, "slide_id").select("slide_id", "cell_id", "_divisor", F.explode("_channels").alias("c"))
    return every.join(sums, ["slide_id", "cell_id", "c"], "left").select("slide_id", "cell_id", "c", F.coalesce(value, X.d(0)).alias("value"))


def small_patch_flag(patch_sets: DataFrame) -> DataFrame:
    """Cell patch sets below the input size of fixed-input encoders."""
    small = (F.col("mode") == "cell_centered") & (F.col("patch_size") < FIXED_INPUT_MIN_PX)
    return patch_sets.withColumn("small_patch", small)


def patch_counts(patches: DataFrame) -> DataFrame:
    return patches.groupBy("slide_id").agg(
        F.count(F.lit(1)).alias("n_patches"), F.count_if(F.col("tissue_prop") > 0).alias("n_tissue")
    )
