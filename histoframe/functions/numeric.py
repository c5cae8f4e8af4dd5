"""Scaling, geometry and unit expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Full-scale divisor of each supported pixel type.
DTYPE_DIVISOR = {"uint8": 255.0, "uint16": 65535.0}
FLOAT_DTYPES = ("float16", "float32", "float64")

# OME pixel type name and significant bits per pixel type.
OME_PIXEL_TYPE = {
    "uint8": ("uint8", 8),
    "uint16": ("uint16", 16),
    "uint32": ("uint32", 32),
    "int8": ("int8", 8),
    "int16": ("int16", 16),
    "int32": ("int32", 32),
    "float32": ("float", 32),
    "float64": ("double", 64),
}

# ImageNet channel statistics.
IMAGENET_MEAN = (0.485, 0.456, 0.406)
IMAGENET_STD = (0.229, 0.224, 0.225)

# Tolerances of the physical-resolution rules.
FLOAT_RANGE_TOLERANCE = 1e-6
MPP_REL_TOLERANCE = 1e-3
MPP_USUAL_RANGE = (0.1, 1.0)


def d(value: float) -> Column:
    """Double literal."""
    return F.lit(float(value)).cast("double")


def bare_dtype(dtype: Column) -> Column:
    """Type name without byte order; ``u1``/``u2``/``f4`` codes spelled out."""
    name = F.regexp_replace(dtype, "^[<>=|]", "")
    codes = {"u1": "uint8", "u2": "uint16", "u4": "uint32", "f2": "float16", "f4": "float32", "f8": "float64"}
    out = name
    for code, full in codes.items():
        out = F.when(name == code, F.lit(full)).otherwise(out)
    return out


def dtype_divisor(dtype: Column) -> Column:
    """255, 65535 or 1 by pixel type; any other type fails the query."""
    name = bare_dtype(dtype)
    expr = F.when(name.isin(*FLOAT_DTYPES), d(1.0))
    for known, divisor in DTYPE_DIVISOR.items():
        expr = expr.when(name == known, d(divisor))
    return expr.otherwise(F.raise_error(F.concat(F.lit("unsupported pixel type: "), dtype)).cast("double"))


def ome_pixel_type(dtype: Column) -> Column:
    """OME type and bit depth; unknown types read as 16-bit unsigned."""
    name = bare_dtype(dtype)
    fallback = F.struct(F.lit("uint16").alias("ome_type"), F.lit(16).alias("bits"))
    cases = [
        (name == known, F.struct(F.lit(kind).alias("ome_type"), F.lit(bits).alias("bits")))
        for known, (kind, bits) in OME_PIXEL_TYPE.items()
    ]
    return reduce(lambda acc, case: F.when(case[0], case[1]).otherwise(acc), cases, fallback)


def effective_stride(size: Column, stride: Column, overlap: Column) -> Column:
    """The stride, else what the overlap leaves, at least one pixel."""
    derived = F.greatest(F.lit(1), F.floor(size * (d(1) - F.coalesce(overlap, d(0)))).cast("int"))
    both = stride.isNotNull() & overlap.isNotNull()
    return F.when(both, F.raise_error(F.lit("give stride or overlap, not both")).cast("int")).otherwise(
        F.coalesce(stride, derived)
    )


def trim_number(value: Column, places: int) -> Column:
    """Shortest decimal text of a number rounded to ``places``."""
    whole = F.floor(value * d(10**places) + d(0.5))
    text = F.format_string(f"%.{places}f", whole / d(10**places))
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def patch_slug(mode: Column, mpp: Column, size: Column, stride: Column) -> Column:
    """Folder-safe name of a patch set."""
    base = F.concat(
        F.when(mode == "cell_centered", F.lit("cell_")).otherwise(F.lit("")),
        trim_number(mpp, 4),
        F.lit("mpp_"),
        size.cast("string"),
        F.lit("px"),
    )
    overlap = d(1) - stride / size
    suffix = F.concat(F.lit("_"), trim_number(overlap, 6), F.lit("overlap"))
    return F.when((mode != "cell_centered") & (stride < size), F.concat(base, suffix)).otherwise(base)


def mpp_snap(base: Column, target: Column) -> Column:
    """Status of a target resolution against the slide's own."""
    rel = F.abs(target - base) / base
    return (
        F.when(target.isNull() | (rel <= MPP_REL_TOLERANCE), F.lit("base"))
        .when(target > base, F.lit("coarser_not_implemented"))
        .otherwise(F.lit("error_finer"))
    )


def tiff_mpp(num: Column, den: Column, unit: Column) -> Column:
    """Microns per pixel from a TIFF resolution tag; null when undefined."""
    microns = F.when(unit == 2, d(25400)).when(unit == 3, d(10000))
    ratio = num.cast("double") / F.nullif(den.cast("double"), d(0))
    return microns / F.nullif(ratio, d(0))


def to_microns(value: Column, unit: Column) -> Column:
    """Physical size in microns; a missing unit reads as microns, others as null."""
    return (
        F.when(unit.isNull() | unit.isin("µm", "um", "micrometer"), value)
        .when(unit.isin("nm", "nanometer"), value / d(1000))
    )


def clip_unit(value: Column, lo: Column, hi: Column) -> Column:
    """``(v - lo) / (hi - lo)`` cut to [0, 1]; a flat channel gives 0."""
    scaled = (value - lo) / (hi - lo)
    return F.when(hi <= lo, d(0)).otherwise(F.least(d(1), F.greatest(d(0), scaled)))


def to_uint8(unit_value: Column) -> Column:
    return F.floor(unit_value * d(255)).cast("int")


def imagenet_norm(value: Column, channel: int) -> Column:
    return (value - d(IMAGENET_MEAN[channel])) / d(IMAGENET_STD[channel])


def duration_seconds(started: Column, completed: Column) -> Column:
    """Seconds between two timestamps; null until both are known."""
    micros = F.unix_micros(completed) - F.unix_micros(started)
    return micros.cast("double") / d(1e6)


def fixed_text(value: Column, places: int) -> Column:
    """Decimal text of a value below 60, rounded as the binary double it is.

    Java rounds the shortest decimal form (1.15 to 1.2); the double itself
    is a little less, and in units of 2**-52 whole-number arithmetic sees it.
    """
    unit = 2**52
    scaled = (value * d(unit)).cast("bigint") * 10**places
    whole = F.shiftright(scaled, 52)
    rest = scaled.bitwiseAND(F.lit(unit - 1))
    up = (rest > unit // 2) | ((rest == unit // 2) & (whole % 2 == 1))
    whole = whole + F.when(up, 1).otherwise(0)
    scale = F.lit(10**places)
    return F.concat(
        F.floor(whole / scale).cast("string"), F.lit("."), F.lpad((whole % scale).cast("string"), places, "0")
    )


def human_duration(seconds: Column) -> Column:
    """``0.042s`` below a second, ``8.4s`` below a minute, else ``1m 32s``."""
    minutes = F.floor(seconds / 60).cast("int")
    rest = F.floor(seconds - minutes * 60).cast("int")
    return (
        F.when(seconds < 1, F.concat(fixed_text(seconds, 3), F.lit("s")))
        .when(seconds < 60, F.concat(fixed_text(seconds, 1), F.lit("s")))
        .when(seconds >= 60, F.format_string("%dm %ds", minutes, rest))
    )
