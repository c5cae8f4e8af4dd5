"""Images whose absent pixels have a value of their own.

A sparse image leaves out pixels of one value per channel. For raw counts that
value is 0; after a shift, a z-score or an inversion it is what 0 became. So a
transform changes pixels and backgrounds alike, and whoever needs the whole
frame (a sum over channels, a tensor, an export) starts from the background.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators.pixels import CHANNEL

PIXEL = [*CHANNEL, "y", "x"]

#: Rows of a channel that stay together in one file.
BAND = 4096


@dataclass(frozen=True)
class SparseImage:
    """``pixels`` (slide_id, c, y, x, value), ``background`` (slide_id, c, value) of every channel, ``slides`` (slide_id, height, width)."""

    pixels: DataFrame
    background: DataFrame
    slides: DataFrame

    @classmethod
    def of_counts(cls, pixels: DataFrame, channels: DataFrame, slides: DataFrame, value: str = "v") -> SparseImage:
        """Raw pixels, 0 where there is none; ``channels`` (slide_id, c) may have no pixel at all."""
        background = channels.select(*CHANNEL).distinct().withColumn("value", X.d(0))
        return cls(pixels.select(*PIXEL, F.col(value).cast("double").alias("value")), background, slides.select("slide_id", "height", "width"))

    def mapped(self, to: Callable[[Column], Column], by: DataFrame | None = None) -> SparseImage:
        """Every value changed, the background too; ``by`` brings columns per slide or channel that ``to`` may use."""

        def changed(rows: DataFrame, keep: list[str]) -> DataFrame:
            if by is not None:
                rows = rows.join(by, [k for k in CHANNEL if k in by.columns])
            return rows.select(*keep, to(F.col("value")).alias("value"))

        return SparseImage(changed(self.pixels, PIXEL), changed(self.background, CHANNEL), self.slides)

    def zscored(self, stats: DataFrame) -> SparseImage:
        """(v - mean) / std with statistics (slide_id, c, mean, std)."""
        return self.mapped(lambda v: (v - F.col("mean")) / F.col("std"), stats)

    def imagenet_normed(self, channel: int) -> SparseImage:
        """Unit values as one colour channel of a network trained on photographs."""
        return self.mapped(lambda v: X.imagenet_norm(v, channel))

    def grayed(self, bounds: DataFrame, invert: bool = True) -> SparseImage:
        """8-bit gray between bounds (slide_id, c, lo, hi), dark on light by default."""

        def gray(v: Column) -> Column:
            norm = X.clip_unit(v, F.col("lo"), F.col("hi"))
            return X.to_uint8(X.d(1) - norm if invert else norm).cast("double")

        return self.mapped(gray, bounds)

    def summed(self, weights: Sequence[Column]) -> SparseImage:
        """One channel per weight (a Column of ``c``): the weighted sum over all channels, absent pixels included.

        The sum starts from the backgrounds', and a pixel adds by how much it differs from its own.
        """
        names = [f"_w{i}" for i in range(len(weights))]
        sums = lambda value: [F.sum(F.col(value) * w.cast("double")).alias(n) for w, n in zip(weights, names, strict=True)]
        base = self.background.groupBy("slide_id").agg(*sums("value"))
        own = self.background.withColumnRenamed("value", "_own")
        apart = self.pixels.join(own, CHANNEL).select("slide_id", "c", "y", "x", (F.col("value") - F.col("_own")).alias("_by"))
        # All channels of a pixel are one row until they are listed, after the last aggregate and join.
        more = apart.groupBy("slide_id", "y", "x").agg(*sums("_by"))
        listed = lambda value: F.inline(F.array(*[F.struct(F.lit(i).alias("c"), value(n).alias("value")) for i, n in enumerate(names)]))
        start = base.select("slide_id", *[F.col(n).alias(f"{n}_base") for n in names])
        pixels = more.join(start, "slide_id").select("slide_id", "y", "x", listed(lambda n: F.col(f"{n}_base") + F.col(n))).select(*PIXEL, "value")
        base = base.select("slide_id", listed(F.col))
        return SparseImage(pixels, base, self.slides)

    def dense(self) -> DataFrame:
        """(slide_id, c, y, x, value) of every pixel of the frame; pixels off the frame or of unlisted channels don't show."""
        rows = self.slides.select("slide_id", "width", F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y")).filter("width > 0")
        frame = rows.join(self.background.withColumnRenamed("value", "_own"), "slide_id")
        frame = frame.select(*CHANNEL, "y", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"), "_own")
        return frame.join(self.pixels, PIXEL, "left").select(*PIXEL, F.coalesce("value", "_own").alias("value"))

    def totals(self) -> DataFrame:
        """(slide_id, c, n, total, lo, hi) over the whole frame, without laying it out."""
        seen = self.pixels.groupBy(*CHANNEL).agg(F.count(F.lit(1)).alias("_n"), F.sum("value").alias("_sum"), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
        n = (F.col("height").cast("bigint") * F.col("width")).alias("n")
        joined = self.background.join(self.slides, "slide_id").select(*CHANNEL, "value", n).join(seen, CHANNEL, "left").fillna(0, ["_n", "_sum"])
        absent = F.col("n") - F.col("_n")
        bare = F.when(absent > 0, F.col("value"))
        return joined.select(
            *CHANNEL, "n", (F.col("_sum") + absent * F.col("value")).alias("total"), F.least("_lo", bare).alias("lo"), F.greatest("_hi", bare).alias("hi")
        )

    def write(self, path: str) -> None:
        """Pixels in order of slide, channel and row band, so that files and row groups prune; backgrounds and frames beside them."""
        place = [*CHANNEL, F.floor(F.col("y") / BAND)]
        bands = self.pixels.repartitionByRange(*place).sortWithinPartitions(*place)
        bands.write.mode("overwrite").parquet(f"{path}/pixels")
        self.background.write.mode("overwrite").parquet(f"{path}/background")
        self.slides.write.mode("overwrite").parquet(f"{path}/slides")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> SparseImage:
        pixels = spark.read.parquet(f"{path}/pixels").select(*PIXEL, "value")
        return cls(pixels, spark.read.parquet(f"{path}/background"), spark.read.parquet(f"{path}/slides"))
