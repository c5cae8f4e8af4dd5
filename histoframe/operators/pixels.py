"""Per-channel pixel statistics and intensity transforms.

Pixels are sparse rows (slide_id, c, y, x, v); an absent pixel is 0. Whatever
needs the zeros adds them back from the frame size instead of storing them.
Nothing here puts a channel into one task: per-channel values come from
hash aggregates with map-side combine and are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators.quantiles import refined_quantiles

CHANNEL = ["slide_id", "c"]
OTSU_BINS = 256

# Frame coverage outside this range marks a useless mask.
COVERAGE_RANGE = (0.01, 0.99)

# Display colours of channels, used in turn.
DISPLAY_COLOURS = ("0000FF", "00FF00", "FF0000", "FFFF00", "00FFFF", "FF00FF", "FFFFFF", "FFA500")
DISPLAY_WINDOW = {"min": 0, "max": 65535, "start": 0, "end": 4096}
MAX_RGB_CHANNELS = 60


def scale_pixels(pixels: DataFrame, slides: DataFrame) -> DataFrame:
    """Intensities as fractions of full scale by the slide's pixel type."""
    divisor = slides.select("slide_id", X.dtype_divisor(F.col("dtype")).alias("_divisor"))
    return pixels.join(divisor, "slide_id").withColumn("scaled", F.col("v") / F.col("_divisor")).drop("_divisor")


def bad_range(pixels: DataFrame, first: int = 5) -> DataFrame:
    """Float slides with channels outside [0, 1]; NaN counts as outside.

    NaN is the greatest double, so the negated test on the maximum sees it.
    """
    tol = X.d(X.FLOAT_RANGE_TOLERANCE)
    ranges = pixels.groupBy(*CHANNEL).agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    bad = ranges.filter(~((F.col("lo") >= -tol) & (F.col("hi") <= X.d(1) + tol)))
    found = F.array_sort(F.collect_list("c"))
    return bad.groupBy("slide_id").agg(
        F.array_join(F.slice(found, 1, first), ",").alias("first_channels"),
        F.count(F.lit(1)).alias("n_bad"),
        F.greatest(F.count(F.lit(1)) - first, F.lit(0)).alias("n_more"),
    )


def _frame(slides: DataFrame) -> DataFrame:
    return slides.select("slide_id", (F.col("height").cast("bigint") * F.col("width")).alias("_area"))


def channel_minmax(pixels: DataFrame, slides: DataFrame, value: str = "v", channels: DataFrame | None = None) -> DataFrame:
    """Range of each channel over the whole frame, zeros included.

    ``channels`` (slide_id, c) names those that may have no pixel at all;
    they read 0 to 0.
    """
    stats = pixels.groupBy(*CHANNEL).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("_n"))
    if channels is not None:
        zero = F.lit(0).cast(dict(stats.dtypes)["lo"])
        blank = channels.select(*CHANNEL).distinct().join(stats, CHANNEL, "left_anti")
        stats = stats.unionByName(blank.select(*CHANNEL, zero.alias("lo"), zero.alias("hi"), F.lit(0).cast("bigint").alias("_n")))
    gap = F.col("_n") < F.col("_area")
    return stats.join(_frame(slides), "slide_id").select(
        *CHANNEL,
        F.when(gap, F.least("lo", F.lit(0))).otherwise(F.col("lo")).alias("lo"),
        F.when(gap, F.greatest("hi", F.lit(0))).otherwise(F.col("hi")).alias("hi"),
    )


def channel_histogram(
    pixels: DataFrame, slides: DataFrame, value: str = "v", stride: int = 1, channels: DataFrame | None = None
) -> DataFrame:
    """Counts per distinct value of each channel, the zeros among them.

    At most 65,536 rows a channel for integer pixels, so all that follows
    (percentiles, thresholds) works on a table that no longer grows with the
    image. ``stride`` keeps every n-th row and column of the frame.
    ``channels`` (slide_id, c) names those that may have no pixel at all;
    they are all zeros.
    """
    area = (F.ceil(F.col("height") / stride) * F.ceil(F.col("width") / stride)).cast("bigint")
    frame = slides.select("slide_id", area.alias("_area"))
    seen = pixels if stride == 1 else pixels.filter((F.col("y") % stride == 0) & (F.col("x") % stride == 0))
    counts = seen.groupBy(*CHANNEL, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    present = counts.groupBy(*CHANNEL).agg(F.sum("n").alias("_seen"))
    if channels is not None:
        named = channels.select(*CHANNEL).distinct().join(present, CHANNEL, "left_anti")
        present = present.unionByName(named.withColumn("_seen", F.lit(0).cast("bigint")))
    zeros = (
        present.join(frame, "slide_id")
        .select(*CHANNEL, F.lit(0).cast(dict(counts.dtypes)["value"]).alias("value"), (F.col("_area") - F.col("_seen")).alias("n"))
        .filter("n > 0")
    )
    return counts.unionByName(zeros)


def channel_percentiles(
    pixels: DataFrame, slides: DataFrame, low: float = 0.01, high: float = 0.99, value: str = "v", stride: int = 1,
    channels: DataFrame | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation over the whole frame.

    Whole numbers go through their histogram; real ones, whose histogram
    would be as long as the image, through refinement by leading bits.
    """
    if dict(pixels.dtypes)[value] in ("float", "double"):
        seen, zeros = _with_zeros(pixels, slides, value, stride, channels)
        weighed = seen.select(*CHANNEL, value, F.lit(1).cast("bigint").alias("n")).unionByName(zeros)
        found = refined_quantiles(weighed, CHANNEL, value, (low, high), "n")
        return found.select(*CHANNEL, F.col("quantiles")[0].alias("lo"), F.col("quantiles")[1].alias("hi"))
    hist = channel_histogram(pixels, slides, value, stride, channels)
    q = F.percentile("value", F.array(F.lit(low), F.lit(high)), F.col("n"))
    return hist.groupBy(*CHANNEL).agg(q.alias("_q")).select(*CHANNEL, F.col("_q")[0].alias("lo"), F.col("_q")[1].alias("hi"))


def _with_zeros(pixels: DataFrame, slides: DataFrame, value: str, stride: int, channels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Pixels on the stride, and one row (slide_id, c, value 0, n) for the absent ones of each channel."""
    area = (F.ceil(F.col("height") / stride) * F.ceil(F.col("width") / stride)).cast("bigint")
    frame = slides.select("slide_id", area.alias("_area"))
    seen = pixels if stride == 1 else pixels.filter((F.col("y") % stride == 0) & (F.col("x") % stride == 0))
    present = seen.groupBy(*CHANNEL).agg(F.count(F.lit(1)).alias("_seen"))
    if channels is not None:
        named = channels.select(*CHANNEL).distinct().join(present, CHANNEL, "left_anti")
        present = present.unionByName(named.withColumn("_seen", F.lit(0).cast("bigint")))
    zero = F.lit(0).cast(dict(pixels.dtypes)[value]).alias(value)
    zeros = present.join(frame, "slide_id").select(*CHANNEL, zero, (F.col("_area") - F.col("_seen")).alias("n")).filter("n > 0")
    return seen, zeros


def percentile_clip(pixels: DataFrame, bounds: DataFrame) -> DataFrame:
    """Each pixel stretched between its channel's bounds and cut to [0, 1]."""
    return pixels.join(bounds, CHANNEL).withColumn("norm", X.clip_unit(F.col("v"), F.col("lo"), F.col("hi"))).drop("lo", "hi")


def otsu_threshold(hist: DataFrame, keys: Sequence[str], factor: float = 1.0) -> DataFrame:
    """Between-class-variance threshold of a value histogram.

    256 equal bins between the extremes; the first best split wins and its
    bin centre is the threshold. A flat channel gives no row. The moments
    are kept in whole bin numbers, so the choice is exact. The windows run
    over at most 256 rows per key.
    """
    keys = list(keys)
    ends = hist.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi")).filter("hi > lo")
    binned = hist.join(ends, keys).groupBy(*keys, _otsu_bin(F.col("value")).alias("bin"))
    return _best_split(binned.agg(F.sum("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")), keys, factor)


def otsu_of_pixels(pixels: DataFrame, slides: DataFrame, factor: float = 1.0, value: str = "v", channels: DataFrame | None = None) -> DataFrame:
    """``otsu_threshold`` straight from the pixels, whatever their type: the range first, then 256 counts a channel."""
    seen, zeros = _with_zeros(pixels, slides, value, 1, channels)
    ends = channel_minmax(pixels, slides, value, channels).filter("hi > lo")
    weighed = seen.select(*CHANNEL, value, F.lit(1).cast("bigint").alias("n")).unionByName(zeros)
    binned = weighed.join(ends, CHANNEL).groupBy(*CHANNEL, _otsu_bin(F.col(value)).alias("bin"))
    return _best_split(binned.agg(F.sum("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi")), CHANNEL, factor)


def _otsu_bin(value: Column) -> Column:
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    return F.least(F.lit(OTSU_BINS - 1), F.floor((value - lo) / (hi - lo) * OTSU_BINS).cast("int"))


def _best_split(bins: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Threshold of (keys, bin, n, lo, hi)."""
    lo, hi = F.col("lo").cast("double"), F.col("hi").cast("double")
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*keys)
    moment = F.col("n") * F.col("bin")
    cut = bins.select(
        *keys, "bin", "lo", "hi",
        F.sum("n").over(upto).alias("w1"), F.sum(moment).over(upto).alias("s1"),
        F.sum("n").over(whole).alias("w"), F.sum(moment).over(whole).alias("s"),
    ).filter("w1 < w")
    w1, w2 = F.col("w1").cast("double"), (F.col("w") - F.col("w1")).cast("double")
    gap = F.col("s1") / w1 - (F.col("s") - F.col("s1")) / w2
    best = cut.groupBy(*keys).agg(
        F.min_by("bin", F.struct(-(w1 * w2 * gap * gap), F.col("bin"))).alias("bin"), F.first("lo").alias("lo"), F.first("hi").alias("hi")
    )
    return best.select(*keys, ((lo + (F.col("bin") + 0.5) * (hi - lo) / OTSU_BINS) * factor).alias("threshold"))


def coverage(mask: DataFrame, slides: DataFrame) -> DataFrame:
    """Share of the frame under a mask and whether it is degenerate."""
    counted = mask.groupBy("slide_id").agg(F.count(F.lit(1)).alias("_n"))
    share = F.coalesce(F.col("_n"), F.lit(0)) / F.col("_area")
    return _frame(slides).join(counted, "slide_id", "left").select(
        "slide_id", share.alias("coverage"), (~share.between(*[X.d(v) for v in COVERAGE_RANGE])).alias("degenerate")
    )


def select_channels(pixels: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pixels of the wanted (slide_id, idx) channels."""
    return pixels.join(wanted.select("slide_id", F.col("idx").alias("c")), CHANNEL, "left_semi")


def max_projection(pixels: DataFrame) -> DataFrame:
    return pixels.groupBy("slide_id", "y", "x").agg(F.max("v").alias("v"))


def channel_sum(pixels: DataFrame) -> DataFrame:
    """Sum over channels per pixel, the composite membrane image."""
    return pixels.groupBy("slide_id", "y", "x").agg(F.sum(F.col("v").cast("double")).alias("v"))


def downsample_mean(pixels: DataFrame, slides: DataFrame, factor: int) -> DataFrame:
    """Block means cut to whole numbers; part blocks at the edge are dropped.

    Absent pixels are zeros, so the sum is divided by the block area.
    """
    inside = (F.col("y") < F.floor(F.col("height") / factor) * factor) & (F.col("x") < F.floor(F.col("width") / factor) * factor)
    by = F.floor(F.col("y") / factor).cast("int")
    bx = F.floor(F.col("x") / factor).cast("int")
    return (
        pixels.join(slides.select("slide_id", "height", "width"), "slide_id")
        .filter(inside)
        .groupBy(*CHANNEL, by.alias("y"), bx.alias("x"))
        .agg(F.floor(F.sum("v") / (factor * factor)).cast("int").alias("v"))
    )


def zscore(pixels: DataFrame, stats: DataFrame, value: str = "scaled") -> DataFrame:
    """(v - mean) / std with per-channel statistics (slide_id, c, mean, std)."""
    return pixels.join(stats, CHANNEL).withColumn("z", (F.col(value) - F.col("mean")) / F.col("std")).drop("mean", "std")


def minmax_stretch(pixels: DataFrame, slides: DataFrame) -> DataFrame:
    """Channels stretched from their own range to [0, 1]; flat ones unchanged."""
    ranged = pixels.join(channel_minmax(pixels, slides), CHANNEL)
    span = F.col("hi") - F.col("lo")
    stretched = F.when(span > 0, (F.col("v") - F.col("lo")) / span).otherwise(F.col("v").cast("double"))
    return ranged.withColumn("stretched", stretched).drop("lo", "hi")


def colour_of(c: Column) -> Column:
    """Our colour rule: hues a golden step apart, as three weights in [0, 1]."""
    return F.array(*[F.round(F.pmod(c * X.d(0.618034) + X.d(third / 3), X.d(1)), 4) for third in range(3)])


def pseudo_rgb(pixels: DataFrame, n_channels: DataFrame, value: str = "scaled") -> DataFrame:
    """Colour-weighted channel mean per pixel; order of channels matters.

    ``n_channels`` is (slide_id, n_channels) with at most 60 channels a slide.
    """
    checked = n_channels.withColumn(
        "n_channels",
        F.when(F.col("n_channels") <= MAX_RGB_CHANNELS, F.col("n_channels")).otherwise(
            F.raise_error(F.lit(f"pseudo-RGB takes at most {MAX_RGB_CHANNELS} channels")).cast("bigint")
        ),
    )
    col = colour_of(F.col("c"))
    sums = pixels.groupBy("slide_id", "y", "x").agg(*[F.sum(F.col(value) * col[i]).alias(n) for i, n in enumerate("rgb")])
    return sums.join(checked, "slide_id").select("slide_id", "y", "x", *[(F.col(n) / F.col("n_channels")).alias(n) for n in "rgb"])


def colorize(pixels: DataFrame, value: str = "scaled") -> DataFrame:
    """Every channel as its own coloured image, not blended."""
    col = colour_of(F.col("c"))
    return pixels.select("slide_id", "c", "y", "x", *[(F.col(value) * col[i]).alias(n) for i, n in enumerate("rgb")])


def composite_rgb(pixels: DataFrame, slides: DataFrame, factor: int = 1) -> DataFrame:
    """Stretched channels times two in their colours, summed, cut to 8 bit."""
    strided = pixels.filter((F.col("y") % factor == 0) & (F.col("x") % factor == 0)) if factor > 1 else pixels
    frame = slides.withColumn("height", F.ceil(F.col("height") / factor)).withColumn("width", F.ceil(F.col("width") / factor))
    stretched = minmax_stretch(strided, frame)
    col = colour_of(F.col("c"))
    total = lambda i: F.sum(F.col("stretched") * 2 * F.floor(col[i] * 255))
    cut = lambda v: F.floor(F.least(X.d(255), F.greatest(X.d(0), F.round(v, 6)))).cast("int")
    at = [F.floor(F.col(a) / factor).cast("int").alias(a) for a in ("y", "x")]
    return stretched.groupBy("slide_id", *at).agg(*[cut(total(i)).alias(n) for i, n in enumerate("rgb")])


def dapi_gray(pixels: DataFrame, bounds: DataFrame, invert: bool = True) -> DataFrame:
    """8-bit gray of the percentile-stretched nuclear stain, dark on light by default."""
    norm = F.col("norm")
    return percentile_clip(pixels, bounds).withColumn("gray", X.to_uint8(X.d(1) - norm if invert else norm)).drop("norm")


def center_crop(pixels: DataFrame, height: Column, width: Column, multiple: int) -> DataFrame:
    """Central part whose sides are the largest multiples that fit."""
    crop = {}
    for axis, extent in (("y", height), ("x", width)):
        size = (F.floor(extent / multiple) * multiple).cast("int")
        crop[axis] = (size, F.floor((extent - size) / 2).cast("int"))
    kept = pixels
    for axis, (size, start) in crop.items():
        kept = kept.filter((F.col(axis) >= start) & (F.col(axis) < start + size))
    return kept.withColumns({axis: F.col(axis) - start for axis, (_, start) in crop.items()})


# Axis orders that map onto channel, row, column.
AXIS_CHANNELS = {
    "YX": (),
    "CYX": ("c",),
    "IYX": ("c",),
    "QYX": ("c",),
    "YX*": ("c",),
    "YXC": ("c",),
    "YXS": ("c",),
    "TCYX": ("t", "c"),
    "ZCYX": ("t", "c"),
    "TYXC": ("t", "c"),
    "ZYXC": ("t", "c"),
    "QYXS": ("t", "c"),
}


def flatten_cycles(pixels: DataFrame, axes: str, n_per_cycle: int = 1) -> DataFrame:
    """Cycle and channel to one channel index, cycle by cycle.

    On long pixels the order of the axes is only the meaning of columns, so
    every known layout ends in the same projection. ``QYX`` names no channel
    axis; its first one is taken for it. ``YX*`` is a stack of one file a
    channel.
    """
    if axes not in AXIS_CHANNELS:
        raise ValueError(f"unknown axes {axes!r}; known: {sorted(AXIS_CHANNELS)}")
    parts = AXIS_CHANNELS[axes]
    if not parts:
        return pixels.withColumn("c", F.lit(0))
    if parts == ("c",):
        return pixels
    return pixels.withColumn("c", (F.col("t") * n_per_cycle + F.col("c")).cast("int")).drop("t")


def omero_channels(channels: DataFrame, nuclear: DataFrame) -> DataFrame:
    """Display record of each channel: colour cycle, window, nuclear active."""
    palette = F.array(*[F.lit(c) for c in DISPLAY_COLOURS])
    window = F.struct(*[F.lit(v).alias(k) for k, v in DISPLAY_WINDOW.items()])
    record = F.struct(
        F.coalesce("marker", "raw").alias("label"),
        F.element_at(palette, F.col("idx") % len(DISPLAY_COLOURS) + 1).alias("color"),
        F.coalesce(F.col("idx") == F.col("nuclear_idx"), F.lit(False)).alias("active"),
        window.alias("window"),
    )
    joined = channels.join(nuclear.select("slide_id", "nuclear_idx"), "slide_id", "left")
    return joined.select("slide_id", "idx", F.to_json(record).alias("omero"))
